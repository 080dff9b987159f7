"""Left joins to lookup tables, and the resolution of natural keys to surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.operators.hotkeys import HOT_ROWS, KEY, SPREAD_BYTES, hot_keys, pieces
from conform.operators.select import sortable_columns
from conform.sources.inputs import planned, settled
from conform.sources.jobs import side_by_side
from conform.sources.workspace import stored

# Largest lookup, as measured, that is sent whole to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024

# A lookup that the planner estimates at so many times the limit is large without being measured.
_FAR = 16

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_SALT = "__salt"
_ON = "__on"
_PIECES = "__pieces"
_LOOKUP_PIECES = "__lookup_pieces"
_COPY = "__copy"
_MATCHED = "__matched"


def measured_bytes(df: DataFrame) -> int | None:
    """Memory the rows take once broadcast, measured by one aggregation; None for types it cannot measure."""
    metrics = _metrics(df)
    return None if metrics is None else _broadcast_bytes(df, df.agg(*[m.alias(name) for name, m in metrics.items()]).first())


def _metrics(df: DataFrame) -> dict[str, Column] | None:
    texts = _texts(df)
    fixed = [f.name for f in df.schema.fields if isinstance(f.dataType, _FIXED_WIDTH)]
    if len(texts) + len(fixed) < len(df.columns):
        return None
    text_bytes = sum((F.coalesce(F.octet_length(f"`{name}`"), F.lit(0)) for name in texts), F.lit(0).cast("bigint"))
    return {"rows": F.count(F.lit(1)), "text": F.sum(text_bytes)}


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]


def _broadcast_bytes(df: DataFrame, measured: Row | dict) -> int:
    # Each row is stored with a header and a hash slot, each column takes a word, each text pads to one more.
    return measured["rows"] * (32 + 8 * len(df.columns) + 8 * len(_texts(df))) + (measured["text"] or 0)


def _measured(lookup: DataFrame, limit: int) -> tuple[DataFrame, int | None]:
    """The lookup, stored unless it is a scan of stored columns, and its size in memory; None if unknown or far above the limit."""
    known, metrics = planned(lookup), _metrics(lookup)
    if known.light:
        far = known.size is not None and known.size > _FAR * max(limit, 1)
        return lookup, None if metrics is None or far else measured_bytes(lookup)
    if metrics is None:
        return stored(lookup, "lookup"), None
    written = Observation()
    rows = stored(lookup, "lookup", written, **metrics)
    return rows, _broadcast_bytes(lookup, written.get)


def left_lookup(
    df: DataFrame,
    on: str,
    *lookups: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the columns of each lookup by equality on the column ``on``; rows without a match keep NULLs.

    A lookup measured to be small is broadcast, so ``df`` is not shuffled for it. Larger ones are joined by
    shuffle, on the key and a salt that cuts hot keys into pieces. They share one shuffle of ``df`` except
    for a lookup that has hot keys of its own.

    Nothing is computed twice. A lookup that is more than a scan of stored columns is stored, and measured while it is
    written; one whose stored columns the planner puts far above the limit is not measured at all. ``df`` is stored
    only where its keys have to be counted and it is more than a scan.
    """
    added = [c for lookup in lookups for c in lookup.columns if c != on]
    if len(set(df.columns) | set(added)) < len(df.columns) + len(added):
        raise ValueError(f"the columns of the lookups must differ from each other and from {df.columns}: {added}")
    found = side_by_side([lambda lookup=lookup: _measured(lookup, broadcast_bytes) for lookup in lookups], len(lookups))
    lookups = [lookup for lookup, _ in found]
    fits = [size is not None and size <= broadcast_bytes for _, size in found]
    if not all(fits):
        df = settled(df, "main")
    joined = df
    for lookup, small in zip(lookups, fits):
        if small:
            joined = joined.join(F.broadcast(lookup), on, "left")
    large = [lookup for lookup, small in zip(lookups, fits) if not small]
    by_type: dict[str, list[DataFrame]] = {}
    for lookup in large:
        by_type.setdefault(_common_type(df, lookup, on), []).append(lookup)
    for kind, group in by_type.items():
        keyed = [_keyed(lookup, on, kind).drop(on).filter(F.col(_ON).isNotNull()) for lookup in group]
        main = _keyed(df, on, kind)
        hot = hot_keys(main, _ON, hot_rows)
        hot_in = side_by_side([lambda side=side: hot_keys(side, _ON, hot_rows) for side in keyed], len(keyed))
        joined = _keyed(joined, on, kind)
        own = [not table.isEmpty() for table in hot_in]
        together = [side for side, split in zip(keyed, own) if not split]
        joined = _shuffled(joined, together, hot, None, hot_rows)
        for side, table, split in zip(keyed, hot_in, own):
            if split:
                joined = _shuffled(joined, [side], hot, table, hot_rows)
        joined = joined.drop(_ON)
    return joined.select(*df.columns, *added)


def _common_type(df: DataFrame, lookup: DataFrame, on: str) -> str:
    """The type in which Spark compares the keys of the two sides."""
    sides = [frame.schema[on].dataType for frame in (df, lookup)]
    if sides[0] == sides[1]:
        return sides[0].simpleString()
    empty = df.sparkSession.createDataFrame([], T.StructType([T.StructField(name, kind) for name, kind in zip("ab", sides)]))
    if T.StringType() in sides:
        # Compared as the other side's type is compared with text.
        other = next(kind for kind in sides if kind != T.StringType())
        return "bigint" if isinstance(other, T.IntegralType) else other.simpleString()
    return empty.select(F.coalesce("a", "b").alias("c")).schema["c"].dataType.simpleString()


def _keyed(df: DataFrame, on: str, kind: str) -> DataFrame:
    same = df.schema[on].dataType.simpleString() == kind
    return df.withColumn(_ON, F.col(on) if same else F.col(on).cast(kind))


def _shuffled(
    df: DataFrame, lookups: list[DataFrame], hot: DataFrame, hot_in_lookup: DataFrame | None, hot_rows: int
) -> DataFrame:
    """Left joins by one shuffle of ``df`` in which no task gets all rows of a hot key.

    Where a key is cut into pieces on one side, its rows on the other side are repeated for each piece. Rows
    whose key is NULL match nothing and are dealt out freely.
    """
    spread = _spread(hot, hot_in_lookup, hot_rows)
    if not lookups or spread is None:
        for lookup in lookups:
            df = df.join(lookup, _ON, "left")
        return df
    joined = _salted(df, spread, cut=_PIECES, repeated=_LOOKUP_PIECES if hot_in_lookup is not None else None)
    for lookup in lookups:
        other = _salted(lookup.withColumn(_MATCHED, F.lit(True)), spread, cut=_LOOKUP_PIECES, repeated=_PIECES)
        joined = joined.join(other.drop(_PIECES, _LOOKUP_PIECES), [_ON, _SALT], "left")
        if hot_in_lookup is not None:
            # A key that is hot in the lookup has a match there, though not in every piece.
            joined = joined.filter((F.coalesce(_LOOKUP_PIECES, F.lit(1)) == 1) | F.col(_MATCHED).isNotNull())
        joined = joined.drop(_MATCHED)
    return joined.drop(_SALT, _PIECES, _LOOKUP_PIECES)


def _spread(hot: DataFrame, hot_in_lookup: DataFrame | None, hot_rows: int) -> DataFrame | None:
    """One row per hot key: its pieces on either side. A key that is hot on both sides is cut on the main side.

    None where there is no hot key. More of them than can be broadcast, trillions of rows at the usual limit,
    are left to adaptive execution, which splits partitions instead of keys.
    """
    known = hot.filter(F.col(KEY).isNotNull())
    one = F.lit(1)
    spread = known.select(KEY, pieces(hot_rows).alias(_PIECES), one.alias(_LOOKUP_PIECES))
    if hot_in_lookup is not None:
        theirs = hot_in_lookup.join(known.select(KEY), KEY, "left_anti")
        spread = spread.unionByName(theirs.select(KEY, one.alias(_PIECES), pieces(hot_rows).alias(_LOOKUP_PIECES)))
    # Rows without a key may be hot as well, and are dealt out by the salt alone.
    if hot.isEmpty() and spread.isEmpty():
        return None
    size = measured_bytes(spread)
    if size is None:
        size = spread.count() * 1024
    return F.broadcast(spread) if size <= SPREAD_BYTES else None


def _salted(df: DataFrame, spread: DataFrame, cut: str, repeated: str | None) -> DataFrame:
    """Add a salt that cuts the rows of a key into ``cut`` pieces, each repeated for the pieces of the other side.

    The salt comes from the row and its input partition: the same again when the task is run again, different for
    the rows of a key whether they lie in one partition or in many.
    """
    columns = sortable_columns(df, without=[_ON])
    number = F.xxhash64(*columns, F.spark_partition_id())
    salted = df.withColumn(_SALT, number).join(spread, F.col(_ON) == F.col(KEY), "left").drop(KEY)
    salt = F.pmod(_SALT, F.coalesce(cut, F.lit(1)))
    if repeated is not None:
        salted = salted.withColumn(_COPY, F.explode(F.sequence(F.lit(0), F.coalesce(repeated, F.lit(1)) - 1)))
        salt = salt + F.col(_COPY)
    return salted.withColumn(_SALT, F.when(F.col(_ON).isNull(), F.col(_SALT)).otherwise(salt)).drop(_COPY)


def resolve_key(
    facts: DataFrame,
    dimension: DataFrame,
    natural: str,
    surrogate: str,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the surrogate key of the dimension row with the same natural key; unresolved facts are kept."""
    pairs = dimension.select(natural, surrogate)
    return left_lookup(facts, natural, pairs, broadcast_bytes=broadcast_bytes, hot_rows=hot_rows)
