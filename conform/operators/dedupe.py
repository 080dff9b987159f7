"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conform.operators.select import sortable_columns

_RANK = "__rank"


def dedupe_latest(df: DataFrame, key: str, latest_by: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The latest row of every key; rows without a key are dropped.

    A row without a date counts as the oldest. Rows of the same date are told apart by ``tie_break``,
    smallest first, which is every other column unless given, so that reruns agree.

    Spark keeps only the first row of each key within a partition before it shuffles (the group limit in
    the plan), so a key that holds a large share of all rows sends one row per input partition.
    """
    ties = sortable_columns(df, without=[key, latest_by]) if tie_break is None else tie_break
    newest_first = Window.partitionBy(key).orderBy(F.desc_nulls_last(latest_by), *[F.asc(c) for c in ties])
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn(_RANK, F.row_number().over(newest_first))
        .filter(F.col(_RANK) == 1)
        .drop(_RANK)
    )
