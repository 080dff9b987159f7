"""A total order over a table, cut into sorted parts that are stored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = "__part"
POSITION = "__position"
_HASH = "__hash"
_SOURCE = "__source"
_IN_PART = (1 << 33) - 1


def sorted_parts(df: DataFrame, order_by: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The table in sorted parts: PART numbers them in the order of ``order_by``, POSITION the rows of a part from 0.

    One range exchange on ``order_by``, a hash of ``ties`` and the partition a row was read from. The last two let the
    exchange cut rows that are equal in ``order_by``, and even copies that no column can tell apart, into pieces; they do
    not change when a task is run again. Rows of a part are sorted by ``order_by``, then by ``ties``. So only rows that are equal in
    ``order_by`` and lie in different parts are not yet in the order of their ties: there are such rows around the
    borders of parts alone.

    The numbers belong to the physical layout of one run: store the result before it is used.
    """
    cut = [_SOURCE]
    marked = df.withColumn(_SOURCE, F.spark_partition_id())
    if ties:
        marked, cut = marked.withColumn(_HASH, F.xxhash64(*[F.col(f"`{tie}`") for tie in ties])), [_HASH, _SOURCE]
    ranged = marked.repartitionByRange(*[F.asc_nulls_first(f"`{name}`") for name in order_by], *cut)
    ordered = ranged.sortWithinPartitions(*[F.asc_nulls_first(f"`{name}`") for name in (*order_by, *ties)])
    # The upper bits of the id are the partition it is given in, the lower ones count its rows.
    number = F.monotonically_increasing_id()
    return ordered.drop(*cut).withColumns(
        {PART: F.shiftright(number, 33).cast("int"), POSITION: number.bitwiseAND(F.lit(_IN_PART))}
    )
