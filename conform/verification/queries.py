"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import (
    null_after,
    packed_date,
    prefer,
    remove_text,
    repaired_amount,
    repaired_price,
    strip_prefix,
)
from conform.operators import checks, close_validity, current_only, dedupe_latest, gapless_key, left_lookup, resolve_key
from conform.plans import gold, silver
from conform.plans.manifest import RunFailed, resume_all
from conform.plans.run import GOLD_INPUTS, Layout, feed_specs, run_all, run_bronze, run_gold_table
from conform.plans.schemas import RAW_SCHEMAS
from conform.sources import FeedSpec, ingest_feed, qualified_name, read_csv_feed, read_versions, write_versions
from conform.sources.jobs import side_by_side
from conform.sources.workspace import new_folder, stored
from conform.verification.raw_feeds import RAW_FEEDS, table

Query = Callable[[SparkSession, str], DataFrame]


def _raw(name: str) -> Query:
    return lambda spark, folder: RAW_FEEDS[name](spark, folder)


customers_raw = _raw("crm_cust_info")
products_raw = _raw("crm_prd_info")
sales_raw = _raw("crm_sales_details")
demographics_raw = _raw("erp_cust_az12")
locations_raw = _raw("erp_loc_a101")
categories_raw = _raw("erp_px_cat_g1v2")


def silver_customers(spark: SparkSession, folder: str) -> DataFrame:
    return silver.customers(customers_raw(spark, folder))


def silver_products(spark: SparkSession, folder: str) -> DataFrame:
    return silver.products(products_raw(spark, folder))


def silver_sales(spark: SparkSession, folder: str) -> DataFrame:
    return silver.sales(sales_raw(spark, folder))


def silver_demographics(spark: SparkSession, folder: str) -> DataFrame:
    return silver.demographics(demographics_raw(spark, folder))


def silver_locations(spark: SparkSession, folder: str) -> DataFrame:
    return silver.locations(locations_raw(spark, folder))


def silver_categories(spark: SparkSession, folder: str) -> DataFrame:
    return silver.categories(categories_raw(spark, folder))


def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_customers(
        silver_customers(spark, folder), silver_demographics(spark, folder), silver_locations(spark, folder)
    )


def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_products(silver_products(spark, folder), silver_categories(spark, folder))


def _dimensions(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Products and customers; numbering them takes jobs of its own, which run side by side."""
    return side_by_side([lambda: dim_products(spark, folder), lambda: dim_customers(spark, folder)], parallel=2)


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_sales(silver_sales(spark, folder), *_dimensions(spark, folder))


# --- feeds and tables -------------------------------------------------------------------------------------


def write_csv_feeds(spark: SparkSession, folder: str, specs: list[FeedSpec]) -> None:
    """The raw feeds as CSV files with a header; blanks around values are part of them."""

    def write(spec: FeedSpec) -> None:
        (
            RAW_FEEDS[spec.table](spark, folder)
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(spec.path)
        )

    side_by_side([lambda spec=spec: write(spec) for spec in specs], parallel=4)


def _new_layout(spark: SparkSession) -> tuple[Layout, list[FeedSpec]]:
    """Three empty schemas of their own in the shared folder, and feeds that land in the first."""
    place = new_folder(spark, "run")
    suffix = uuid.uuid4().hex
    layout = Layout(bronze=f"bronze_{suffix}", silver=f"silver_{suffix}", gold=f"gold_{suffix}")
    for schema in (layout.bronze, layout.silver, layout.gold):
        spark.sql(f"CREATE DATABASE {qualified_name(schema)} LOCATION '{place}/{schema}'")
    return layout, feed_specs(layout, f"{place}/feeds")


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def bronze_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    spec = FeedSpec("crm", new_folder(spark, "csv"), "crm_cust_info", "bronze")
    write_csv_feeds(spark, folder, [spec])
    return read_csv_feed(spark, spec.path, RAW_SCHEMAS[spec.table])


def bronze_ingest_all(spark: SparkSession, folder: str) -> DataFrame:
    layout, specs = _new_layout(spark)
    write_csv_feeds(spark, folder, specs)
    landed = run_bronze(spark, layout, specs, parallel=4)
    return _row_counts({spec.table: df for spec, df in zip(specs, landed)})


def _run_layers(spark: SparkSession, folder: str) -> Layout:
    layout, specs = _new_layout(spark)
    write_csv_feeds(spark, folder, specs)
    run_all(spark, layout, specs, parallel=4)
    return layout


def layered_run(spark: SparkSession, folder: str) -> DataFrame:
    layout = _run_layers(spark, folder)
    names = [(layer, t) for layer in ("bronze", "silver") for t in RAW_SCHEMAS]
    names += [("gold", t) for t in ("dim_customers", "dim_products", "fact_sales")]
    return _row_counts({f"{layer}.{t}": spark.table(layout.name(layer, t)) for layer, t in names})


def layered_fact(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(_run_layers(spark, folder).name("gold", "fact_sales"))


def rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with bad, short and long lines, landed once: the rejected lines as stored, and how many rows landed."""
    layout, _ = _new_layout(spark)
    spec = FeedSpec("crm", new_folder(spark, "csv"), "crm_cust_info", layout.bronze)
    key = F.col("c_custkey").cast("string")
    good = F.concat(key, F.lit(",AW"), key, F.lit(",Ann,Lee,S,F,2024-01-01"))
    kind = F.col("c_custkey") % 5
    line = (
        F.when(kind == 1, F.concat(F.lit("x"), good))
        .when(kind == 2, F.concat(key, F.lit(",AW"), key))
        .when(kind == 3, F.concat(good, F.lit(",surplus")))
        .otherwise(good)
    )
    # Every file begins with a line of names.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = table(spark, folder, "customer").select(F.when(first, F.concat(F.lit("names\n"), line)).otherwise(line))
    lines.write.text(spec.path)
    rejects = qualified_name("rejects", layout.bronze)
    landed = ingest_feed(spark, spec, RAW_SCHEMAS, rejects=rejects).count()
    return spark.table(rejects).select("feed", "line", F.lit(landed).cast("bigint").alias("landed"))


def resumed_run(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after a run that broke off, since one feed had not arrived, and one that did the rest."""
    layout, specs = _new_layout(spark)
    late = [spec for spec in specs if spec.table == "crm_sales_details"]
    write_csv_feeds(spark, folder, [spec for spec in specs if spec not in late])
    book = new_folder(spark, "manifest")
    try:
        resume_all(spark, layout, specs, book, parallel=4)
    except RunFailed as broken:
        assert list(broken.report.failed) == ["bronze.crm_sales_details"], broken.report
    write_csv_feeds(spark, folder, late)
    report = resume_all(spark, layout, specs, book, parallel=4)
    assert report.done == ["bronze.crm_sales_details", "silver.crm_sales_details", "gold.fact_sales"], report
    return spark.table(layout.name("gold", "fact_sales"))


def stored_customers(spark: SparkSession, folder: str) -> DataFrame:
    return spark.table(_run_layers(spark, folder).name("gold", "dim_customers"))


def stored_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products built from sources and stored in a table of the caller's names, with exactly the columns they should have."""
    layout = _run_layers(spark, folder)
    sources = []
    for number, (layer, source) in enumerate(GOLD_INPUTS["dim_products"]):
        sources.append(f"source_{number}_{uuid.uuid4().hex}")
        spark.table(layout.name(layer, source)).createOrReplaceTempView(sources[-1])
    target = layout.name("gold", "products_by_name")
    run_gold_table(spark, layout, "dim_products", sources=sources, target=target)
    empty = gold.dim_products(spark.table(sources[0]).limit(0), spark.table(sources[1]).limit(0))
    stored_table = spark.table(target)
    assert checks.has_columns(stored_table, spark.table(layout.name("gold", "dim_products")).columns)
    assert empty.count() == 0 and checks.has_columns(empty, stored_table.columns)
    return stored_table


# --- rules ------------------------------------------------------------------------------------------------


def dedupe_latest_customer(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_latest(customers_raw(spark, folder), "cst_id", "cst_create_date")


def _customer_rule(column: str, rule: Callable, name: str) -> Query:
    return lambda spark, folder: customers_raw(spark, folder).select(
        "cst_id", "cst_key", column, rule(F.col(column)).alias(name)
    )


def trimmed_names(spark: SparkSession, folder: str) -> DataFrame:
    return customers_raw(spark, folder).select(
        "cst_id", "cst_key", F.trim("cst_firstname").alias("first_name"), F.trim("cst_lastname").alias("last_name")
    )


def _product_rule(column: str, rule: Callable, name: str) -> Query:
    return lambda spark, folder: products_raw(spark, folder).select(
        "prd_id", column, rule(F.col(column)).alias(name)
    )


def product_validity(spark: SparkSession, folder: str) -> DataFrame:
    versions = products_raw(spark, folder).select("prd_id", "prd_key", "prd_start_dt")
    return close_validity(versions, "prd_key", "prd_start_dt").select(
        "prd_id", "prd_key", F.col("prd_start_dt").cast("date").alias("start_date"), "end_date"
    )


def packed_dates(spark: SparkSession, folder: str) -> DataFrame:
    dates = {"sls_order_dt": "order_date", "sls_ship_dt": "ship_date", "sls_due_dt": "due_date"}
    return sales_raw(spark, folder).select(
        "sls_ord_num", *dates, *[packed_date(F.col(packed)).alias(name) for packed, name in dates.items()]
    )


def repaired_amounts(spark: SparkSession, folder: str) -> DataFrame:
    rule = repaired_amount(F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price"))
    return sales_raw(spark, folder).select(
        "sls_ord_num", "sls_sales", "sls_quantity", "sls_price", rule.alias("sales_amount")
    )


def repaired_prices(spark: SparkSession, folder: str) -> DataFrame:
    rule = repaired_price(F.col("sls_price"), F.col("sls_sales"), F.col("sls_quantity"))
    return sales_raw(spark, folder).select("sls_ord_num", "sls_sales", "sls_quantity", "sls_price", rule.alias("price"))


def _demographics_rule(column: str, rule: Callable, name: str) -> Query:
    columns = list(dict.fromkeys(["cid", column]))
    return lambda spark, folder: demographics_raw(spark, folder).select(*columns, rule(F.col(column)).alias(name))


def _location_rule(column: str, rule: Callable, name: str) -> Query:
    columns = list(dict.fromkeys(["cid", column]))
    return lambda spark, folder: locations_raw(spark, folder).select(*columns, rule(F.col(column)).alias(name))


# --- keys and joins ---------------------------------------------------------------------------------------


def customer_keys(spark: SparkSession, folder: str) -> DataFrame:
    ids = silver_customers(spark, folder).select("customer_id")
    return gapless_key(ids, ["customer_id"], "customer_key")


def gender_precedence(spark: SparkSession, folder: str) -> DataFrame:
    erp = silver_demographics(spark, folder).select("customer_number", F.col("gender").alias("erp_gender"))
    joined = left_lookup(silver_customers(spark, folder), "customer_number", erp)
    return joined.select("customer_id", prefer(F.col("gender"), F.col("erp_gender")).alias("gender"))


def current_products(spark: SparkSession, folder: str) -> DataFrame:
    return current_only(silver_products(spark, folder))


def stored_current_products(spark: SparkSession, folder: str) -> DataFrame:
    """The current versions from files that hold no ended ones."""
    versions, place = silver_products(spark, folder), new_folder(spark, "versions")
    write_versions(versions, place)
    return read_versions(spark, place, versions.schema, current=True)


def product_keys(spark: SparkSession, folder: str) -> DataFrame:
    active = current_products(spark, folder).select("start_date", "product_number", "product_id")
    return gapless_key(active, ["start_date", "product_number"], "product_key")


def resolved_product_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = silver_sales(spark, folder).select("order_number", "product_number")
    return resolve_key(lines, dim_products(spark, folder), "product_number", "product_key")


def resolved_customer_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = silver_sales(spark, folder).select("order_number", "customer_id")
    return resolve_key(lines, dim_customers(spark, folder), "customer_id", "customer_key")


# --- the same operators on the given tables themselves ----------------------------------------------------


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice"
    )


def latest_order_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_latest(_orders(spark, folder), "o_custkey", "o_orderdate", tie_break=["o_orderkey"])


def order_validity_intervals(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).drop("o_totalprice")
    return close_validity(orders, "o_custkey", "o_orderdate", "valid_to", tie_break=["o_orderkey"])


def gapless_order_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder).select("o_orderdate", "o_orderkey")
    return gapless_key(orders, ["o_orderdate", "o_orderkey"], "order_seq")


# The paths for large tables. Limits as low as these split the hot keys of the given tables as well.


def validity_of_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Three keys that hold all lines, sorted across tasks."""
    shipped = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_shipdate").cast("date").alias("l_shipdate")
    )
    ties = ["l_orderkey", "l_linenumber"]
    return close_validity(shipped, "l_returnflag", "l_shipdate", "valid_to", tie_break=ties, hot_rows=5_000)


def lookups_of_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """About 600 lines of a supplier, in pieces of 200, against two lookups by shuffle."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    suppliers = table(spark, folder, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    nations = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    names = suppliers.select("l_suppkey", "s_name")
    homes = suppliers.join(nations, "s_nationkey", "left").select("l_suppkey", "n_name")
    return left_lookup(lines, "l_suppkey", names, homes, broadcast_bytes=0, hot_rows=200)


def hot_keys_in_a_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The other way round: the keys are hot in the lookup, and each supplier meets all of its lines."""
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    lines = table(spark, folder, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), "l_orderkey", "l_linenumber")
    return left_lookup(suppliers, "s_suppkey", lines, broadcast_bytes=0, hot_rows=200)


def gapless_key_of_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of which only a few values are left, so that most rows are copies."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")
    return gapless_key(lines, ["l_returnflag", "l_linestatus"], "line_seq", key_type="bigint")


# --- checks -----------------------------------------------------------------------------------------------


def star_schema_checks(spark: SparkSession, folder: str) -> DataFrame:
    """One row: each check gives one row with columns of its own, and the rows are folded into one.

    The fact is computed once, to be stored; its checks and those of the sales it is made from ride on that write.
    """
    watch = checks.WriteChecks(["product_key", "customer_key"])
    products, customers = _dimensions(spark, folder)
    sales = watch.input(silver_sales(spark, folder))
    stored(watch.output(gold.fact_sales(sales, products, customers)), "facts")
    parts = [
        checks.key_uniqueness(customers, "customer_id").toDF("customer_ids", "repeated_customer_ids"),
        checks.key_uniqueness(products, "product_number").toDF("product_numbers", "repeated_product_numbers"),
        checks.key_gaps(customers, "customer_key").toDF(
            "first_customer_key", "last_customer_key", "customer_keys", "customer_keys_gapless"
        ),
        checks.key_gaps(products, "product_key").toDF(
            "first_product_key", "last_product_key", "product_keys", "product_keys_gapless"
        ),
        checks.join_fan_out(products, "product_number").toDF("product_fan_out_keys"),
        checks.join_fan_out(customers, "customer_id").toDF("customer_fan_out_keys"),
    ]
    rows = reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), parts)
    folded = rows.agg(*(F.max(name).alias(name) for name in rows.columns))
    counted = {"rows_before": watch.rows_before, "rows_after": watch.rows_after}
    counted |= {f"{key}_unresolved": missing for key, missing in watch.unresolved.items()}
    told = {"preserved": watch.preserved, "not_empty": watch.not_empty}
    return folded.withColumns(
        {name: F.lit(n).cast("bigint") for name, n in counted.items()} | {name: F.lit(answer) for name, answer in told.items()}
    )


def keys_in_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of integer keys in bitmaps, on keys with gaps, copies and NULLs; one row for each column."""
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    thinned = F.when(F.col("o_custkey") % 5 > 0, F.col("o_custkey")).alias("key")
    columns = {
        "o_orderkey": orders.select(F.col("o_orderkey").alias("key")),
        "o_custkey_thinned": orders.select(thinned),
        "l_orderkey": lines.select(F.col("l_orderkey").alias("key")),
    }
    rows = []
    for name, keys in columns.items():
        parts = [check(keys, "key", bitmap_rows=1) for check in (checks.key_uniqueness, checks.key_gaps, checks.join_fan_out)]
        parts[1] = parts[1].withColumnRenamed("keys", "keys_set")
        row = reduce(lambda above, below: above.unionByName(below, allowMissingColumns=True), parts)
        rows.append(row.agg(F.lit(name).alias("column_name"), *(F.max(c).alias(c) for c in row.columns)))
    return reduce(DataFrame.unionByName, rows)


QUERIES: dict[str, Query] = {
    "q01_bronze_csv_scan": bronze_csv_scan,
    "q02_bronze_ingest_all": bronze_ingest_all,
    "q03_dedupe_latest_customer": dedupe_latest_customer,
    "q04_marital_status_labels": _customer_rule("cst_martial_status", silver.marital_status_label, "marital_status"),
    "q05_gender_code_labels": _customer_rule("cst_gndr", silver.gender_code_label, "gender"),
    "q06_trimmed_names": trimmed_names,
    "q07_silver_customers": silver_customers,
    "q08_category_id_from_key": _product_rule("prd_key", silver.category_id, "category_id"),
    "q09_product_number_from_key": _product_rule("prd_key", silver.product_number, "product_number"),
    "q10_product_line_labels": _product_rule("prd_line", silver.product_line_label, "product_line"),
    "q11_cost_default": _product_rule("prd_cost", lambda c: F.coalesce(c, F.lit(0)), "product_cost"),
    "q12_product_validity": product_validity,
    "q13_silver_products": silver_products,
    "q14_packed_dates": packed_dates,
    "q15_repaired_amount": repaired_amounts,
    "q16_repaired_price": repaired_prices,
    "q17_silver_sales": silver_sales,
    "q18_strip_prefix": _demographics_rule(
        "cid", lambda c: strip_prefix(c, silver.CUSTOMER_PREFIX), "customer_number"
    ),
    "q19_null_future_birthdate": _demographics_rule("bdate", null_after, "birth_date"),
    "q20_gender_word_labels": _demographics_rule("gen", silver.gender_word_label, "gender"),
    "q21_silver_demographics": silver_demographics,
    "q22_remove_hyphens": _location_rule("cid", lambda c: remove_text(c, "-"), "customer_number"),
    "q23_country_labels": _location_rule("cntry", silver.country_label, "country"),
    "q24_silver_locations": silver_locations,
    "q25_silver_categories": silver_categories,
    "q26_customer_keys": customer_keys,
    "q27_gender_precedence": gender_precedence,
    "q28_dim_customers": dim_customers,
    "q29_current_products": current_products,
    "q30_product_keys": product_keys,
    "q31_dim_products": dim_products,
    "q32_resolve_product_key": resolved_product_keys,
    "q33_resolve_customer_key": resolved_customer_keys,
    "q34_fact_sales": fact_sales,
    "q35_layered_run": layered_run,
    "q36_latest_order_per_customer": latest_order_per_customer,
    "q37_order_validity_intervals": order_validity_intervals,
    "q38_gapless_order_key": gapless_order_key,
    "q39_star_schema_checks": star_schema_checks,
    "q40_layered_fact": layered_fact,
    "q41_validity_of_hot_keys": validity_of_hot_keys,
    "q42_lookups_of_hot_keys": lookups_of_hot_keys,
    "q43_hot_keys_in_a_lookup": hot_keys_in_a_lookup,
    "q44_gapless_key_of_copies": gapless_key_of_copies,
    "q45_keys_in_bitmaps": keys_in_bitmaps,
    "q46_rejected_lines": rejected_lines,
    "q47_resumed_run": resumed_run,
    "q48_stored_customers": stored_customers,
    "q49_stored_products": stored_products,
    "q50_stored_current_products": stored_current_products,
}
