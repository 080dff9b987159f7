"""Finding the keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.sources.workspace import stored

# Rows of one key that a single task may sort or join. Above this the key is split.
HOT_ROWS = 5_000_000

# Hot keys, as measured, that are sent to every executor. There are at most as many as rows / hot_rows.
SPREAD_BYTES = 128 * 1024 * 1024

KEY, ROWS = "__hot_key", "__hot_rows"
_SLOT = "__slot"


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key (NULL included) with more than ``hot_rows`` rows, and how many: one row per key, exact.

    No key of a table of ``hot_rows`` rows or fewer is hot, which the footers of stored columns tell. Otherwise rows are
    counted by slots of a hash of the key, sixteen for each key that could be hot, so that a task hands on as
    many counts as there are slots, whatever the number of keys. A hot key's slot is above ``hot_rows`` as well: only the keys in
    such slots, about one in sixteen at most, are candidates and counted one by one. Keys stay in Spark, equal as
    its joins hold them equal, and may be of any type that it can group and hash.

    The table is stored. ``df`` should be one too, or a light plan over one: it is read up to three times.
    """
    keys = df.select(F.col(f"`{key}`").alias(KEY))
    rows = keys.count()
    schema = T.StructType([keys.schema[KEY], T.StructField(ROWS, T.LongType(), False)])
    if rows <= hot_rows:
        return df.sparkSession.createDataFrame([], schema)
    slots = 1 << max(10, (16 * rows // max(hot_rows, 1)).bit_length())
    slotted = keys.withColumn(_SLOT, F.pmod(F.xxhash64(KEY), F.lit(slots)))
    full = slotted.groupBy(_SLOT).agg(F.count("*").alias(ROWS)).where(F.col(ROWS) > hot_rows).select(_SLOT)
    full = stored(full, "slots")
    if full.isEmpty():
        return df.sparkSession.createDataFrame([], schema)
    # At most rows / hot_rows slots are that full.
    candidates = slotted.join(F.broadcast(full), _SLOT, "left_semi")
    counts = candidates.groupBy(KEY).agg(F.count("*").alias(ROWS))
    return stored(counts.filter(F.col(ROWS) > hot_rows), "hot-keys")


def pieces(hot_rows: int):
    """Into how many pieces of at most ``hot_rows`` rows a key has to be cut."""
    return F.ceil(F.col(ROWS) / hot_rows).cast("int")
