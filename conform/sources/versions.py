"""Versions of rows, stored so that readers of the current ones do not touch the ended ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that files are filed under: whether a version is still valid.
CURRENT = "is_current"


def write_versions(df: DataFrame, folder: str, *, end: str = "end_date", mode: str = "overwrite") -> None:
    """Store the versions as Parquet below ``folder``, those without an end apart from the ended ones.

    No shuffle: a task writes one file for each of the two that it has rows of. A column of the name ``is_current`` is
    an error, since the files are filed under it.
    """
    if CURRENT in df.columns:
        raise ValueError(f"a column {CURRENT} is there already")
    df.withColumn(CURRENT, F.col(end).isNull()).write.mode(mode).partitionBy(CURRENT).parquet(folder)


def read_versions(spark: SparkSession, folder: str, schema: T.StructType, *, current: bool | None = None) -> DataFrame:
    """The stored versions in the columns of ``schema``: the current ones, the ended ones, or all of them if not said.

    Which files are read is settled by their folders when the query is planned, so the share of ended versions, which
    grows with time, costs readers of current ones nothing.
    """
    filed = T.StructType([*schema.fields, T.StructField(CURRENT, T.BooleanType())])
    rows = spark.read.schema(filed).parquet(folder)
    if current is not None:
        rows = rows.where(F.col(CURRENT) if current else ~F.col(CURRENT))
    return rows.drop(CURRENT)
