"""The shared folder for data that must outlive executors."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or a temporary one on a local master only."""
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="conform-")
    context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own under the shared folder; nothing is created yet."""
    folder = f"{shared_folder(spark).rstrip('/')}/conform-{purpose}-{uuid.uuid4().hex}"
    made = _made.get()
    if made is not None:
        made.append(folder)
    return folder


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Removes the folders that were begun inside it, by this thread and the jobs it runs side by side, once it is left.

    Frames made inside must have been written elsewhere or collected by then. Paths taken off the list stay.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str, observed: Observation | None = None, **metrics: Column) -> DataFrame:
    """The rows written once as Parquet below the shared folder and read back, whatever happens to the executors.

    ``observed`` collects the metrics while the rows are written. A reader of the result scans the columns it needs only.
    Columns without a type (bare NULLs) are left out of the files and put back.
    """
    spark = df.sparkSession
    untyped = {field.name for field in df.schema.fields if isinstance(field.dataType, T.NullType)}
    typed = [field for field in df.schema.fields if field.name not in untyped]
    if not typed:
        return durable(df)
    rows = df.select(*[F.col(f"`{field.name}`") for field in typed]) if untyped else df
    if observed is not None:
        rows = rows.observe(observed, *[metric.alias(name) for name, metric in metrics.items()])
    folder = new_folder(spark, purpose)
    rows.write.parquet(folder)
    back = spark.read.schema(T.StructType(typed)).parquet(folder)
    if not untyped:
        return back
    return back.select(*[F.lit(None).alias(name) if name in untyped else F.col(f"`{name}`") for name in df.columns])


def durable(df: DataFrame) -> DataFrame:
    """The rows checkpointed to reliable storage, for what files of columns cannot hold."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
