"""Checks of stored tables, and checks that ride on the write of a table: each gives one row of numbers or a plain answer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.sources.workspace import stored

# Tables of fewer rows are grouped by key at once.
BITMAP_ROWS = 1_000_000

# Keys of one bitmap, and its bytes; the range of keys may be so many times the rows.
_KEYS, _BYTES, _SPARSE = 32_768, 4_096, 64


def not_empty(df: DataFrame) -> bool:
    """Whether there is any row; tries a few partitions before the rest."""
    return not df.isEmpty()


def key_uniqueness(df: DataFrame, key: str, *, bitmap_rows: int = BITMAP_ROWS) -> DataFrame:
    """``keys`` and how many of them are ``repeated_keys``; NULL counts as a key.

    Integer keys that lie close enough are set in bitmaps: one row per 32,768 keys leaves a task instead of all keys.
    Only where more rows than keys are found are the keys of that bitmap counted one by one.
    """
    found = _bitmaps(df, key, bitmap_rows)
    if found is None:
        return (
            df.groupBy(key)
            .agg(F.count("*").alias("rows"))
            .agg(F.count("*").alias("keys"), F.count_if(F.col("rows") > 1).alias("repeated_keys"))
        )
    nulls = found.rows - found.filled
    return _repeated(df, key, found).select(
        F.lit(found.keys + (nulls > 0)).cast("bigint").alias("keys"),
        (F.col("repeated") + int(nulls > 1)).cast("bigint").alias("repeated_keys"),
    )


def key_gaps(df: DataFrame, key: str, *, bitmap_rows: int = BITMAP_ROWS) -> DataFrame:
    """``first_key``, ``last_key``, ``keys`` and whether they are ``gapless`` from 1; in bitmaps like ``key_uniqueness``."""
    found = _bitmaps(df, key, bitmap_rows)
    if found is None:
        per_key = df.groupBy(key).agg(F.count("*").alias("rows"))
        measured = per_key.agg(
            F.min(key).alias("first_key"),
            F.max(key).alias("last_key"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.count(key).alias("keys"),
        )
    else:
        kind = df.schema[key].dataType
        measured = df.sparkSession.range(1).select(
            F.lit(found.first).cast(kind).alias("first_key"),
            F.lit(found.last).cast(kind).alias("last_key"),
            F.lit(found.rows).cast("bigint").alias("rows"),
            F.lit(found.keys).cast("bigint").alias("keys"),
        )
    gapless = (F.col("rows") == F.col("keys")) & (
        (F.col("rows") == 0) | ((F.col("first_key") == 1) & (F.col("last_key") == F.col("rows")))
    )
    return measured.select("first_key", "last_key", "keys", F.coalesce(gapless, F.lit(False)).alias("gapless"))


def join_fan_out(lookup: DataFrame, on: str, *, bitmap_rows: int = BITMAP_ROWS) -> DataFrame:
    """``fan_out_keys``: keys a left join would repeat rows for. A NULL key never matches. In bitmaps like ``key_uniqueness``."""
    found = _bitmaps(lookup, on, bitmap_rows)
    if found is None:
        return (
            lookup.filter(F.col(on).isNotNull())
            .groupBy(on)
            .agg(F.count("*").alias("rows"))
            .agg(F.count_if(F.col("rows") > 1).alias("fan_out_keys"))
        )
    return _repeated(lookup, on, found).select(F.col("repeated").alias("fan_out_keys"))


def rows_preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """``rows_before``, ``rows_after`` and whether they are ``preserved``."""
    counts = (
        before.select(F.lit(1).alias("before"), F.lit(0).alias("after"))
        .unionAll(after.select(F.lit(0).alias("before"), F.lit(1).alias("after")))
        .agg(
            F.coalesce(F.sum("before"), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("after"), F.lit(0)).alias("rows_after"),
        )
    )
    return counts.withColumn("preserved", F.col("rows_before") == F.col("rows_after"))


def unresolved_keys(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` and, for each key column, ``<key>_unresolved``: rows kept although the key is NULL."""
    return facts.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(key).isNull()).alias(f"{key}_unresolved") for key in keys],
    )


def has_columns(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the columns are exactly these, in any order; looks at the schema only."""
    return sorted(df.columns) == sorted(columns)


class WriteChecks:
    """Checks of a table and of the input it keeps all rows of, taken while the table is written.

    ``input`` and ``output`` return their frame with counters in it; whatever is written or computed from them first fills the
    counters, so that nothing is read again. Spark adds up what each task counted once it has ended, and once only
    for the tasks that write. Counters of an input that is shuffled on its way may count a task twice that was
    repeated after an executor was lost: ``preserved`` is then False for rows that are all there, never the other way.
    """

    def __init__(self, keys: Sequence[str] = ()):
        self._keys = list(keys)
        self._before, self._after = Observation(), Observation()

    def input(self, df: DataFrame) -> DataFrame:
        return df.observe(self._before, F.count(F.lit(1)).alias("rows"))

    def output(self, df: DataFrame) -> DataFrame:
        missing = [F.count_if(F.col(key).isNull()).alias(f"{key}_unresolved") for key in self._keys]
        return df.observe(self._after, F.count(F.lit(1)).alias("rows"), *missing)

    @property
    def rows_before(self) -> int:
        return self._before.get["rows"]

    @property
    def rows_after(self) -> int:
        return self._after.get["rows"]

    @property
    def not_empty(self) -> bool:
        return self.rows_after > 0

    @property
    def preserved(self) -> bool:
        return self.rows_before == self.rows_after

    @property
    def unresolved(self) -> dict[str, int]:
        """For each key, the rows kept although it is NULL."""
        return {key: self._after.get[f"{key}_unresolved"] for key in self._keys}


@dataclass(frozen=True)
class _Bitmaps:
    """Rows, rows with a key, the ends of the keys, how many there are, and a stored row per bitmap."""

    rows: int
    filled: int
    first: int | None
    last: int | None
    keys: int
    table: DataFrame


def _bitmaps(df: DataFrame, key: str, least: int) -> _Bitmaps | None:
    """Bitmaps of the keys; None where grouping by key costs less: few rows, keys that are no integers or lie far apart."""
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return None
    keys = df.select(F.col(f"`{key}`").cast("bigint").alias("key"))
    apart = F.col("last").cast("double") - F.col("first") + 1
    # A task's keys fill no more bitmaps than their range spans, and no more than there are.
    spans = F.least(F.ceil(apart / _KEYS) + 1, F.col("filled"))
    per_task = keys.groupBy(F.spark_partition_id()).agg(
        F.count("*").alias("rows"), F.count("key").alias("filled"), F.min("key").alias("first"), F.max("key").alias("last")
    )
    ends = [F.min("first").alias("first"), F.max("last").alias("last")]
    measured = per_task.agg(F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), *ends, F.sum(spans).alias("spans")).first()
    rows, filled, first, last = measured["rows"] or 0, measured["filled"] or 0, measured["first"], measured["last"]
    if rows < least or not filled or last - first + 1 > _SPARSE * filled:
        return None
    placed = keys.where("key is not null").select("key", F.bitmap_bucket_number("key").alias("bucket"))
    if measured["spans"] * _BYTES > filled * 8:
        # Keys that are strewn over the tasks go to their bitmap's task first, or every task would send nearly empty bitmaps.
        placed = placed.repartition("bucket")
    table = placed.groupBy("bucket").agg(
        F.count("*").alias("rows"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("key"))).alias("keys"),
    )
    table = stored(table, "bitmaps")
    return _Bitmaps(rows, filled, first, last, table.agg(F.sum("keys")).first()[0], table)


def _repeated(df: DataFrame, key: str, found: _Bitmaps) -> DataFrame:
    """One row: how many keys, apart from NULL, have more than one row."""
    if found.keys == found.filled:
        return df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("repeated"))
    column = F.col(f"`{key}`").cast("bigint")
    keys = df.where(column.isNotNull()).select(column.alias("key"), F.bitmap_bucket_number(column).alias("bucket"))
    counted = keys.join(found.table.where("rows > keys"), "bucket", "left_semi").groupBy("key").agg(F.count("*").alias("rows"))
    return counted.agg(F.count_if(F.col("rows") > 1).alias("repeated"))
