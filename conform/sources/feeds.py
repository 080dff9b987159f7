"""Delimited feeds with a declared schema, landed as raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conform.sources.jobs import side_by_side
from conform.sources.tables import TABLE_FORMAT, new_version, publish, qualified_name, read_table, write_table

_LINE, _FILE = "__line", "__file"


@dataclass(frozen=True)
class FeedSpec:
    """One feed: the system it comes from, where its files are and which table it lands in."""

    source: str
    path: str
    table: str
    schema: str
    catalog: str | None = None

    @property
    def target(self) -> str:
        return qualified_name(self.table, self.schema, self.catalog)


def read_csv_feed(
    spark: SparkSession, path: str, schema: T.StructType | str, *, rejects_column: str | None = None
) -> DataFrame:
    """The rows of CSV files with a header line, bound to the schema by position.

    A value that does not fit its type is NULL, a short line is filled with NULLs, surplus fields are
    dropped. ``rejects_column`` names an extra column that receives the text of every such line.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.option("header", True)
    if rejects_column is not None:
        declared = T.StructType([*declared.fields, T.StructField(rejects_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", rejects_column)
    return reader.schema(declared).csv(path)


def ingest_feed(
    spark: SparkSession,
    spec: FeedSpec,
    schemas: Mapping[str, T.StructType | str],
    *,
    mode: str = "overwrite",
    table_format: str = TABLE_FORMAT,
    rejects: str | None = None,
) -> DataFrame:
    """Land one feed in its table, and return the table so that the files are not parsed again.

    ``rejects`` names a second table for the lines that did not fit: ``file``, ``line`` (its text), and ``feed``. The
    lines are parsed once. Their text is kept in the files of the first table, beside its columns, and the second is
    written from that one column, which is empty but for rejected lines.
    """
    if rejects is None:
        df = read_csv_feed(spark, spec.path, schemas[spec.table])
        write_table(df, spec.target, mode=mode, table_format=table_format)
        return read_table(spark, spec.target)
    if mode != "overwrite" or table_format not in ("parquet", "orc"):
        raise ValueError("rejected lines are kept where columnar files are replaced")
    df = read_csv_feed(spark, spec.path, schemas[spec.table], rejects_column=_LINE)
    kept = df.withColumn(_FILE, F.when(F.col(_LINE).isNotNull(), F.col("_metadata.file_path")))
    folder = new_version(spark, spec.target)
    kept.write.format(table_format).save(folder)
    fields = [field for field in df.schema.fields if field.name != _LINE]
    publish(spark, spec.target, folder, T.StructType(fields), table_format=table_format)
    lines = spark.read.schema(kept.select(_LINE, _FILE).schema).format(table_format).load(folder)
    lines = lines.where(F.col(_LINE).isNotNull())
    lines = lines.select(F.lit(spec.table).alias("feed"), F.col(_FILE).alias("file"), F.col(_LINE).alias("line"))
    write_table(lines, rejects, table_format=table_format)
    return read_table(spark, spec.target)


def ingest_all(
    spark: SparkSession,
    specs: Iterable[FeedSpec],
    schemas: Mapping[str, T.StructType | str],
    *,
    mode: str = "overwrite",
    table_format: str = TABLE_FORMAT,
    parallel: int = 1,
) -> list[DataFrame]:
    """Land every feed, up to ``parallel`` at a time, and return the tables in the order of the specs."""
    return side_by_side(
        [lambda spec=s: ingest_feed(spark, spec, schemas, mode=mode, table_format=table_format) for s in specs],
        parallel,
    )
