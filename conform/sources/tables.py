"""Tables by name."""

from __future__ import annotations

import datetime
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Plain Spark ships parquet. Any installed table format can be named instead, for example one that
# replaces a table atomically.
TABLE_FORMAT = "parquet"

# Formats whose tables are folders of files, so that a table can be moved to another folder.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")

# Versions of a table that stay: the one that is read from now on, and the one that running queries still read.
KEPT_VERSIONS = 2

_PART = re.compile(r"`((?:[^`]|``)+)`|([^.`]+)")


def qualified_name(table: str, schema: str | None = None, catalog: str | None = None) -> str:
    """``catalog.schema.table``, quoted, without the parts that are not given."""
    parts = [part for part in (catalog, schema, table) if part]
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def set_current_catalog(spark: SparkSession, catalog: str) -> None:
    """Resolve names without a catalog in this one from now on."""
    spark.catalog.setCurrentCatalog(catalog)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or a temporary view."""
    return spark.table(name)


def write_table(
    df: DataFrame,
    name: str,
    *,
    mode: str = "overwrite",
    table_format: str = TABLE_FORMAT,
    columns: Sequence[str] | None = None,
) -> None:
    """Store the rows as a table: a full refresh unless another mode is asked for.

    A refresh of a table of files in the session's own catalog leaves no gap. The rows go to a new folder beside the
    table, and one change of the catalog's entry publishes them; until then readers find the old rows, and queries
    that run keep the folder they have planned with, which stays for one more refresh. A session that has read the
    table before sees the new rows at once if it is the one that writes, else from its next ``REFRESH TABLE`` on. Where the
    columns change, the entry is dropped and made anew. Other formats and catalogs replace the table their own way.

    ``columns`` are the table's columns, all of them unless given; the files may hold more.
    """
    spark = df.sparkSession
    if mode != "overwrite" or table_format not in FILE_FORMATS or not _in_session_catalog(spark, name):
        df.write.mode(mode).format(table_format).saveAsTable(name)
        return
    folder = new_version(spark, name)
    df.write.format(table_format).save(folder)
    kept = [field for field in df.schema.fields if columns is None or field.name in columns]
    publish(spark, name, folder, T.StructType(kept), table_format=table_format)


def new_version(spark: SparkSession, name: str) -> str:
    """A path of its own for the table's next rows, beside its schema's tables; nothing is created yet."""
    moment = datetime.datetime.now(datetime.UTC).strftime("%Y%m%dT%H%M%S%f")
    return f"{_versions(spark, name)}/{moment}-{uuid.uuid4().hex[:8]}"


def publish(
    spark: SparkSession,
    name: str,
    folder: str,
    schema: T.StructType,
    *,
    table_format: str = TABLE_FORMAT,
    keep: int = KEPT_VERSIONS,
) -> None:
    """Let the table ``name`` show the files in ``folder`` from now on, and remove its versions before the last ``keep``."""
    wanted = [(field.name, field.dataType) for field in schema.fields]
    if spark.catalog.tableExists(name):
        same = [(field.name, field.dataType) for field in spark.table(name).schema.fields] == wanted
        if same and _provider(spark, name) == table_format:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{_quoted(folder)}'")
            _remove_versions(spark, name, keep)
            return
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"{qualified_name(column)} {kind.simpleString()}" for column, kind in wanted)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {table_format} LOCATION '{_quoted(folder)}'")
    _remove_versions(spark, name, keep)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _parts(name: str) -> list[str]:
    return [(quoted or plain).replace("``", "`") for quoted, plain in _PART.findall(name)]


def _in_session_catalog(spark: SparkSession, name: str) -> bool:
    parts = _parts(name)
    return (parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()) == "spark_catalog"


def _versions(spark: SparkSession, name: str) -> str:
    parts = _parts(name)
    schema = parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()
    # A folder that starts with an underscore is no part of any table's files.
    return f"{spark.catalog.getDatabase(qualified_name(schema)).locationUri.rstrip('/')}/_versions/{parts[-1]}"


def _provider(spark: SparkSession, name: str) -> str:
    details = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return details.get("Provider", "").lower()


def _remove_versions(spark: SparkSession, name: str, keep: int) -> None:
    """Names of versions begin with the moment they were begun, so the last ones are the last by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_versions(spark, name))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path):
        versions = sorted((status.getPath() for status in files.listStatus(path)), key=lambda found: found.getName())
        for version in versions[: len(versions) - keep]:
            files.delete(version, True)
