"""What a layered run has finished, so that the next one does only the rest."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from hashlib import sha256

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from conform.plans.run import GOLD_INPUTS, Layout, run_gold_table, run_silver_table
from conform.plans.schemas import RAW_SCHEMAS
from conform.plans.silver import SILVER_TABLES
from conform.sources import FeedSpec, ingest_feed
from conform.sources.jobs import side_by_side

_SCHEMA = "step string, fingerprint string, target string, finished timestamp"


@dataclass
class RunReport:
    """Steps by what became of them: done now, up to date already, failed, or waiting for one that failed."""

    done: list[str] = field(default_factory=list)
    current: list[str] = field(default_factory=list)
    failed: dict[str, Exception] = field(default_factory=dict)
    waiting: list[str] = field(default_factory=list)


class RunFailed(RuntimeError):
    """Some steps failed; all that do not need them are finished and stay so."""

    def __init__(self, report: RunReport):
        super().__init__(f"failed: {report.failed}; waiting for them: {report.waiting}")
        self.report = report


class Manifest:
    """The finished steps below a folder, one small file each, so that steps that end together do not meet."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def finished(self) -> dict[str, str]:
        """The fingerprint each step had when it was last finished."""
        try:
            entries = self._spark.read.schema(_SCHEMA).json(f"{self._folder}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        last = entries.groupBy("step").agg(F.max_by("fingerprint", "finished").alias("fingerprint"))
        return {row["step"]: row["fingerprint"] for row in last.collect()}

    def record(self, step: str, fingerprint: str, target: str) -> None:
        entry = (step, fingerprint, target, datetime.datetime.now(datetime.UTC))
        self._spark.createDataFrame([entry], _SCHEMA).coalesce(1).write.json(f"{self._folder}/{uuid.uuid4().hex}")


def files_fingerprint(spark: SparkSession, path: str) -> str:
    """Of the names, lengths and times of the files below a path; none of them is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    seen = files.agg(
        F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))
    ).first()
    return _hash(map(str, seen))


def resume_all(
    spark: SparkSession,
    layout: Layout,
    specs: Iterable[FeedSpec],
    manifest: str,
    *,
    parallel: int = 1,
    as_of: datetime.date | None = None,
) -> RunReport:
    """All three layers, but only those tables whose inputs have changed since they were last finished.

    A step's fingerprint is made of the fingerprints of its inputs, down to the files of the feeds, and of where and how
    it stores its table. A step is skipped if the manifest has it with this fingerprint and its table is still there. A step that fails
    stops only the steps that read its table; the run goes on with all others and then raises ``RunFailed``. Called
    again, it does what is left. Demographics depend on the day as well, since dates after it are removed.
    """
    book = Manifest(spark, manifest)
    known, prints, report = book.finished(), {}, RunReport()
    day = as_of or datetime.date.today()

    def step(name: str, inputs: list[str], fingerprint: Callable[[], str], action: Callable[[], object], target: str) -> None:
        if any(needed not in prints for needed in inputs):
            report.waiting.append(name)
            return
        try:
            print_ = fingerprint()
            if known.get(name) == print_ and spark.catalog.tableExists(target):
                report.current.append(name)
            else:
                action()
                book.record(name, print_, target)
                report.done.append(name)
            prints[name] = print_
        except Exception as error:  # whatever a source or a job raises; it is handed on below
            report.failed[name] = error

    def made_of(inputs: list[str], *more: str) -> Callable[[], str]:
        return lambda: _hash([*(prints[name] for name in inputs), *more])

    def bronze(spec: FeedSpec) -> None:
        step(
            f"bronze.{spec.table}",
            [],
            lambda: _hash([files_fingerprint(spark, spec.path), RAW_SCHEMAS[spec.table], spec.target, layout.table_format]),
            lambda: ingest_feed(spark, spec, RAW_SCHEMAS, table_format=layout.table_format),
            spec.target,
        )

    def silver(table: str) -> None:
        inputs, target = [f"bronze.{table}"], layout.name("silver", table)
        dated = [str(day)] if table == "erp_cust_az12" else []
        step(
            f"silver.{table}",
            inputs,
            made_of(inputs, target, layout.table_format, *dated),
            lambda: run_silver_table(spark, layout, table, as_of=day),
            target,
        )

    def gold(table: str) -> None:
        inputs, target = [f"{layer}.{source}" for layer, source in GOLD_INPUTS[table]], layout.name("gold", table)
        step(
            f"gold.{table}",
            inputs,
            made_of(inputs, target, layout.table_format),
            lambda: run_gold_table(spark, layout, table),
            target,
        )

    side_by_side([lambda spec=spec: bronze(spec) for spec in specs], parallel)
    side_by_side([lambda table=table: silver(table) for table in SILVER_TABLES], parallel)
    side_by_side([lambda table=table: gold(table) for table in ("dim_customers", "dim_products")], parallel)
    gold("fact_sales")
    if report.failed:
        raise RunFailed(report)
    return report


def _hash(parts: Iterable[str]) -> str:
    return sha256("\0".join(parts).encode()).hexdigest()
