"""Running the layers against stored tables."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from conform.operators.checks import WriteChecks
from conform.plans import gold, silver
from conform.plans.schemas import FEED_FILES, RAW_SCHEMAS
from conform.sources import FeedSpec, ingest_all, qualified_name, read_table, write_table
from conform.sources.jobs import side_by_side
from conform.sources.tables import TABLE_FORMAT
from conform.sources.workspace import scratch

# The tables each part of the star schema is built from, by layer.
GOLD_INPUTS = {
    "dim_customers": [("silver", "crm_cust_info"), ("silver", "erp_cust_az12"), ("silver", "erp_loc_a101")],
    "dim_products": [("silver", "crm_prd_info"), ("silver", "erp_px_cat_g1v2")],
    "fact_sales": [("silver", "crm_sales_details"), ("gold", "dim_products"), ("gold", "dim_customers")],
}
GOLD_TABLES = {
    "dim_customers": gold.dim_customers,
    "dim_products": gold.dim_products,
    "fact_sales": gold.fact_sales,
}


@dataclass(frozen=True)
class Layout:
    """Where the tables of the three layers live, and in what format."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    catalog: str | None = None
    table_format: str = TABLE_FORMAT

    def name(self, layer: str, table: str) -> str:
        return qualified_name(table, getattr(self, layer), self.catalog)


def feed_specs(layout: Layout, folder: str) -> list[FeedSpec]:
    """The feeds below ``folder``, in one subfolder per source system."""
    return [
        FeedSpec(source, f"{folder}/source_{source}/{file}", table, layout.bronze, layout.catalog)
        for source, files in FEED_FILES.items()
        for table, file in files.items()
    ]


def run_bronze(spark: SparkSession, layout: Layout, specs: Iterable[FeedSpec], parallel: int = 1) -> list[DataFrame]:
    """Land the feeds and return the raw tables in the order of the specs."""
    return ingest_all(spark, specs, RAW_SCHEMAS, table_format=layout.table_format, parallel=parallel)


def run_silver_table(
    spark: SparkSession,
    layout: Layout,
    table: str,
    *,
    source: str | None = None,
    target: str | None = None,
    as_of: datetime.date | None = None,
) -> str:
    """Clean one raw table; source and target may be any table names. Returns the name of the target."""
    raw = read_table(spark, source or layout.name("bronze", table))
    clean = silver.SILVER_TABLES[table]
    target = target or layout.name("silver", table)
    with scratch(spark):
        cleaned = clean(raw, as_of) if clean is silver.demographics else clean(raw)
        write_table(cleaned, target, table_format=layout.table_format)
    return target


def run_silver(
    spark: SparkSession, layout: Layout, parallel: int = 1, as_of: datetime.date | None = None
) -> list[str]:
    """Clean all raw tables. None reads another's output, so they may run side by side."""
    return side_by_side(
        [lambda t=table: run_silver_table(spark, layout, t, as_of=as_of) for table in silver.SILVER_TABLES],
        parallel,
    )


def build_gold_table(spark: SparkSession, layout: Layout, table: str, sources: Iterable[str] = ()) -> DataFrame:
    """One table of the star schema, from the named tables or views where given."""
    names = list(sources) or [layout.name(*source) for source in GOLD_INPUTS[table]]
    return GOLD_TABLES[table](*[read_table(spark, name) for name in names])


def run_gold_table(
    spark: SparkSession,
    layout: Layout,
    table: str,
    *,
    sources: Iterable[str] = (),
    target: str | None = None,
    watch: WriteChecks | None = None,
) -> str:
    """Build and store one table of the star schema. Returns the name of the target.

    ``watch`` checks the rows of the first source and of the result while they are written.
    """
    target = target or layout.name("gold", table)
    frames = [read_table(spark, name) for name in list(sources) or [layout.name(*source) for source in GOLD_INPUTS[table]]]
    with scratch(spark):
        if watch is None:
            built = GOLD_TABLES[table](*frames)
        else:
            built = watch.output(GOLD_TABLES[table](watch.input(frames[0]), *frames[1:]))
        write_table(built, target, table_format=layout.table_format)
    return target


def run_gold(spark: SparkSession, layout: Layout, parallel: int = 1) -> list[str]:
    """Both dimensions, then the fact: their keys are renumbered by every run, so they belong together."""
    dimensions = side_by_side(
        [lambda t=table: run_gold_table(spark, layout, t) for table in ("dim_customers", "dim_products")],
        parallel,
    )
    return [*dimensions, run_gold_table(spark, layout, "fact_sales")]


def run_all(
    spark: SparkSession,
    layout: Layout,
    specs: Iterable[FeedSpec],
    *,
    parallel: int = 1,
    as_of: datetime.date | None = None,
) -> None:
    """All three layers, in order."""
    run_bronze(spark, layout, specs, parallel)
    run_silver(spark, layout, parallel, as_of)
    run_gold(spark, layout, parallel)

