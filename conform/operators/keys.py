"""Surrogate keys without gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.operators.ordering import PART, POSITION, sorted_parts
from conform.operators.select import sortable_columns
from conform.sources.workspace import stored

_NUMBER, _SHIFT = "__number", "__shift"


def gapless_key(
    df: DataFrame,
    order_by: Sequence[str],
    name: str,
    *,
    tie_break: Sequence[str] | None = None,
    key_type: str = "int",
) -> DataFrame:
    """Number the rows from 1 in the given order, NULLs first; the number becomes the first column.

    The same numbers as ``row_number`` over an unpartitioned window, which would sort the whole table in one task. Rows
    of one order value are told apart by ``tie_break``, every other column unless given.

    Two levels: the table is sorted in parts by ``order_by`` alone and stored, and each part starts counting after the rows of
    the parts before it. Where rows of one order value lie in more than one part, they are sorted among themselves by
    the first tie column, and so on; for order values without ties, which is the usual case, there is nothing
    left to sort. What passes through the driver are row counts: one per part, and one per order value that
    is cut by a border between parts.

    An ``int`` key fails the job beyond 2,147,483,647 rows; pass ``key_type="bigint"`` for larger tables.
    """
    ties = sortable_columns(df, without=list(order_by)) if tie_break is None else list(tie_break)
    numbered = _numbered(df, list(order_by), ties)
    return numbered.select(F.col(_NUMBER).cast(key_type).alias(name), *[F.col(f"`{column}`") for column in df.columns])


def _numbered(df: DataFrame, order_by: list[str], ties: list[str]) -> DataFrame:
    """The rows with their place in the order, from 1, as a bigint."""
    group = f"__group{len(ties)}"
    rows = stored(sorted_parts(df, order_by, ties), "sorted")
    counts = rows.groupBy(PART).agg(F.count("*").alias("rows")).collect()
    first, shifts = 1, []
    for count in sorted(counts, key=lambda c: c[PART]):
        shifts.append((count[PART], first))
        first += count["rows"]
    numbered = _shifted(rows, PART, shifts, F.col(POSITION)).drop(PART, POSITION)
    cut = cut_groups(rows, order_by) if ties and len(shifts) > 1 else None
    if cut is None:
        return numbered
    # A group is named by the smallest number of its rows, which it keeps.
    same = _same(order_by, cut)
    least = numbered.join(F.broadcast(cut), same).groupBy(*cut.columns).agg(F.min(_NUMBER).alias(group))
    groups = F.broadcast(stored(least, "cut-groups"))
    inside = numbered.drop(_NUMBER).join(groups, same).select(*df.columns, group)
    inside = stored(_numbered(inside, [group, ties[0]], ties[1:]), "ties")
    sizes = inside.groupBy(group).agg(F.count("*").alias("rows")).collect()
    before, shifts = 0, []
    for size in sorted(sizes, key=lambda s: s[group]):
        # The group's rows have the numbers behind ``before`` among the rows of all groups.
        shifts.append((size[group], size[group] - before - 1))
        before += size["rows"]
    inside = _shifted(inside, group, shifts, F.col(_NUMBER)).drop(group)
    columns = [*df.columns, _NUMBER]
    return numbered.join(groups, same, "left_anti").select(columns).unionByName(inside.select(columns))


def _shifted(rows: DataFrame, by: str, shifts: list[tuple[int, int]], number: Column) -> DataFrame:
    """The rows with ``number`` moved by the shift of their part or group."""
    if len(shifts) == 1:  # a small table, sorted in one piece
        return rows.withColumn(_NUMBER, number + F.lit(shifts[0][1]).cast("bigint"))
    kind = rows.schema[by].dataType.simpleString()
    table = rows.sparkSession.createDataFrame(shifts, f"{by} {kind}, {_SHIFT} bigint")
    return rows.join(F.broadcast(table), by).withColumn(_NUMBER, number + F.col(_SHIFT)).drop(_SHIFT)


def cut_groups(rows: DataFrame, order_by: Sequence[str]) -> DataFrame | None:
    """The values of ``order_by`` whose rows lie in more than one of the stored parts, under names of their own; None if
    there are none. At most one for each border between parts, so they can be sent to every task."""
    value = F.struct(*[F.col(f"`{name}`").alias(f"__value{i}") for i, name in enumerate(order_by)])
    ends = rows.groupBy(PART).agg(F.min_by(value, POSITION).alias("low"), F.max_by(value, POSITION).alias("high"))
    # One row per part.
    following = F.lead("low").over(Window.orderBy(PART))
    borders = ends.withColumn("following", following).where(F.col("following").isNotNull() & F.col("high").eqNullSafe(F.col("following")))
    cut = stored(borders.select("high.*").distinct(), "cut")
    return None if cut.isEmpty() else cut


def _same(order_by: Sequence[str], cut: DataFrame) -> Column:
    condition = F.lit(True)
    for name, value in zip(order_by, cut.columns):
        condition = condition & F.col(f"`{name}`").eqNullSafe(F.col(value))
    return condition
