"""Validity intervals of versioned rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.functions import last_day_before
from conform.operators.hotkeys import HOT_ROWS, KEY, SPREAD_BYTES, hot_keys
from conform.operators.lookup import measured_bytes
from conform.operators.ordering import PART, POSITION, sorted_parts
from conform.operators.select import sortable_columns
from conform.sources.inputs import settled
from conform.sources.workspace import stored

_KEY_ID = "__key_id"
_NEXT = "__next"
_OPEN = "__open"
_FIXED = "__fixed"


def close_validity(
    df: DataFrame,
    key: str,
    start: str,
    end: str = "end_date",
    *,
    tie_break: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the last valid day of each version: the day before the next start of the same key, NULL for the last.

    Versions that start together are ordered by ``tie_break``, every other column unless given. Rows without
    a key form a key of their own, and a version without a start comes first.

    Keys of ordinary size are handled by one window per key. Keys above ``hot_rows`` rows are sorted across many tasks
    instead, by one range exchange, and every row is compared with the next one of its part; parts are stitched together where they
    were cut. The rows are stored first unless reading them again costs a scan only.
    """
    ties = sortable_columns(df, without=[key, start]) if tie_break is None else list(tie_break)
    df = settled(df, "versions")
    hot = hot_keys(df, key, hot_rows)
    if hot.isEmpty():
        return _by_window(df, key, start, end, ties)
    hot_table = stored(hot.select(KEY, F.monotonically_increasing_id().alias(_KEY_ID)), "hot-keys")
    size = measured_bytes(hot_table)
    if size is not None and size <= SPREAD_BYTES:
        hot_table = F.broadcast(hot_table)
    is_hot = F.col(f"`{key}`").eqNullSafe(F.col(KEY))
    ordinary = _by_window(df.join(hot_table, is_hot, "left_anti"), key, start, end, ties)
    return ordinary.unionByName(_by_order(df.join(hot_table, is_hot).drop(KEY), start, end, ties).select(*ordinary.columns))


def _by_window(df: DataFrame, key: str, start: str, end: str, ties: Sequence[str]) -> DataFrame:
    versions = Window.partitionBy(key).orderBy(*[F.asc_nulls_first(c) for c in (start, *ties)])
    return df.withColumn(end, last_day_before(F.lead(start).over(versions)))


def _by_order(df: DataFrame, start: str, end: str, ties: Sequence[str]) -> DataFrame:
    """Rows of hot keys, which have a number in ``_KEY_ID``."""
    ordered = sorted_parts(df, [_KEY_ID, start], ties)
    kind = df.schema[start].dataType
    schema = T.StructType([*ordered.schema.fields, T.StructField(_NEXT, kind), T.StructField(_OPEN, T.BooleanType())])
    rows = stored(ordered.mapInArrow(_with_next(start), schema), "versions")
    fixed = _across_parts(rows, start, ties)
    next_start = F.when(F.col(_FIXED).isNotNull(), F.col(f"{_FIXED}.next")).otherwise(F.col(_NEXT))
    return rows.join(F.broadcast(fixed), [PART, POSITION], "left").withColumn(end, last_day_before(next_start))


def _with_next(start: str):
    """Adds to each row of a sorted part the start of the row behind it if that has the same key, and marks the last row.

    Batches come in order; the last row of one waits for the first of the next, so that one batch is in memory at a time.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            held = table.slice(table.num_rows - 1).combine_chunks().to_batches()[0]
            if table.num_rows > 1:
                yield _extended(table.slice(0, table.num_rows - 1), table.slice(1), False)
        if held is not None:
            yield _extended(pa.Table.from_batches([held]), None, True)

    def _extended(rows: pa.Table, behind: pa.Table | None, last: bool) -> pa.RecordBatch:
        starts = rows[start] if behind is None else behind[start]
        same = False if behind is None else pc.equal(rows[_KEY_ID], behind[_KEY_ID])
        following = pc.if_else(same, starts, pa.scalar(None, starts.type))
        extended = rows.append_column(_NEXT, following).append_column(_OPEN, pa.array([last] * rows.num_rows))
        return extended.combine_chunks().to_batches()[0]

    return compare


def _across_parts(rows: DataFrame, start: str, ties: Sequence[str]) -> DataFrame:
    """PART, POSITION and the next start, in a struct, of the rows that could not know it: at most three for each part.

    The last row of a part looks at the first row of the part behind. Where versions of one key and start lie in several
    parts, only the last of them in the order of their ties has the start that follows; it changes places with the
    row that is last by position.
    """
    first = F.struct(F.col(_KEY_ID).alias("key"), F.col(f"`{start}`").alias("start"))
    heads = rows.where(F.col(POSITION) == 0).select(PART, first.alias("head"))
    opens = rows.where(_OPEN).select(PART, POSITION, first.alias("own"))
    following = F.lead("head").over(Window.orderBy(PART))  # one row per part
    borders = opens.join(heads.withColumn("head", following), PART)
    across = F.when(F.col("head.key") == F.col("own.key"), F.col("head.start"))
    fixed = stored(borders.select(PART, POSITION, "own", across.alias("next"), F.col("head").alias("behind")), "borders")
    answers = fixed.select(PART, POSITION, F.struct("next").alias(_FIXED))
    cut = stored(fixed.where(F.col("own").eqNullSafe(F.col("behind"))).select("own").distinct(), "cut")
    if not ties or cut.isEmpty():
        return answers
    known = rows.join(F.broadcast(answers), [PART, POSITION], "left")
    following = F.when(F.col(_FIXED).isNotNull(), F.col(f"{_FIXED}.next")).otherwise(F.col(_NEXT))
    place = [F.col(PART), F.col(POSITION)]
    in_cut = known.join(F.broadcast(cut), first.eqNullSafe(F.col("own")))
    pairs = in_cut.groupBy("own").agg(
        F.max(F.struct(*place, following.alias("next"))).alias("by_place"),
        F.max(F.struct(*[F.col(f"`{tie}`").alias(f"tie{i}") for i, tie in enumerate(ties)], *place)).alias("by_ties"),
    )
    swapped = [
        F.struct(F.col(f"by_place.{PART}"), F.col(f"by_place.{POSITION}"), F.struct(F.col("own.start").alias("next")).alias(_FIXED)),
        F.struct(F.col(f"by_ties.{PART}"), F.col(f"by_ties.{POSITION}"), F.struct(F.col("by_place.next")).alias(_FIXED)),
    ]
    moved = F.struct(f"by_place.{PART}", f"by_place.{POSITION}") != F.struct(f"by_ties.{PART}", f"by_ties.{POSITION}")
    swaps = pairs.where(moved).select(F.explode(F.array(*swapped)).alias("swap")).select("swap.*")
    swaps = stored(swaps, "swaps")
    return answers.join(swaps, [PART, POSITION], "left_anti").unionByName(swaps)
