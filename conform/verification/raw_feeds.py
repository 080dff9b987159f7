"""The six raw feeds, derived from the given tables by the rules of FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _text(number: Column) -> Column:
    return number.cast("string")


def _padded(number: Column, width: int) -> Column:
    return F.lpad(_text(number), width, "0")


def _third(number: Column) -> Column:
    return F.floor(number / 3).cast("bigint")


def _cycle(number: Column, values: dict[int, str], base: int) -> Column:
    """A text chosen by the remainder of a number; remainders without a text give NULL."""
    chosen = F.lit(None).cast("string")
    for remainder, value in values.items():
        chosen = F.when(number % base == remainder, F.lit(value)).otherwise(chosen)
    return chosen


def _packed(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.day(date)


def crm_cust_info(spark: SparkSession, folder: str) -> DataFrame:
    k, rev = F.col("c_custkey"), F.col("rev")
    # Each customer once, some with an older copy, some with a copy that has lost its id.
    copies = F.array_compact(F.array(F.lit(0), F.when(k % 7 == 0, 1), F.when(k % 50 == 3, 2)))
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return customers.withColumn("rev", F.explode(copies)).select(
        F.when(rev != 2, k.cast("int")).alias("cst_id"),
        F.concat(F.lit("AW"), _padded(k, 8)).alias("cst_key"),
        F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("cst_firstname"),
        F.concat("c_name", F.lit("  ")).alias("cst_lastname"),
        _cycle(k + rev, {0: "S", 1: " m", 2: "M ", 3: "D"}, 5).alias("cst_martial_status"),
        _cycle(k + rev, {0: "F", 1: " m ", 2: "M", 3: "f", 4: "X"}, 6).alias("cst_gndr"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int") - rev * 30).alias("cst_create_date"),
    )


def crm_prd_info(spark: SparkSession, folder: str) -> DataFrame:
    part_id = F.col("p_partkey")
    k, version = _third(part_id), part_id % 3
    category = F.concat(
        F.lit("C"), _text(k % 5), F.lit("-"), _padded(F.floor(k / 5).cast("bigint") % 25, 2), F.lit("-P")
    )
    start = F.date_add(F.lit("2010-01-01").cast("date"), (k % 100 + version * 400).cast("int"))
    return table(spark, folder, "part").select(
        part_id.cast("int").alias("prd_id"),
        F.concat(category, _padded(k, 8)).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(part_id % 11 != 0, F.floor("p_retailprice").cast("int")).alias("prd_cost"),
        _cycle(F.col("p_size"), {0: "M ", 1: "r", 2: "S", 3: " t", 4: "Z"}, 6).alias("prd_line"),
        start.cast("timestamp").alias("prd_start_dt"),
        F.lit(None).cast("timestamp").alias("prd_end_dt"),
    )


def crm_sales_details(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", _packed(F.col("o_orderdate")).alias("ordered")
    )
    parts = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        _packed(F.col("l_shipdate")).alias("shipped"),
        F.col("l_quantity").cast("int").alias("q"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("int").alias("p"),
    )
    # Both sides grow with the data. The shuffle also spreads lines that were stored as one row group.
    lines = parts.join(orders.hint("merge"), "l_orderkey")
    order_key, ordered, shipped, q, p = (F.col(c) for c in ("l_orderkey", "ordered", "shipped", "q", "p"))
    return lines.select(
        F.concat(F.lit("SO"), _text(order_key), F.lit("-"), _text(F.col("l_linenumber"))).alias("sls_ord_num"),
        F.when(order_key % 41 == 0, "PXXX")
        .otherwise(F.concat(F.lit("P"), _padded(_third(F.col("l_partkey")), 8)))
        .alias("sls_prd_key"),
        F.when(order_key % 43 == 0, -1).otherwise(F.col("o_custkey").cast("int")).alias("sls_cust_id"),
        F.when(order_key % 97 == 0, 0)
        .when(order_key % 89 == 0, F.floor(ordered / 10).cast("int"))
        .otherwise(ordered)
        .alias("sls_order_dt"),
        shipped.alias("sls_ship_dt"),
        F.when(order_key % 53 != 0, shipped).alias("sls_due_dt"),
        F.when(order_key % 10 == 1, -(q * p))
        .when(order_key % 10 == 2, q * p + 7)
        .when(order_key % 10 != 0, q * p)
        .alias("sls_sales"),
        F.when(order_key % 61 == 0, 0).otherwise(q).alias("sls_quantity"),
        F.when(order_key % 13 == 1, -p).when(order_key % 13 != 0, p).alias("sls_price"),
    )


def erp_cust_az12(spark: SparkSession, folder: str) -> DataFrame:
    # Some identifiers match no customer.
    k = F.col("c_custkey")
    known = F.when(k % 19 == 0, "XX").otherwise("AW")
    return (
        table(spark, folder, "customer")
        .select(
            F.concat(F.when(k % 2 == 0, "NAS").otherwise(""), known, _padded(k, 8)).alias("cid"),
            F.when(k % 17 == 0, F.lit("2099-01-01").cast("date"))
            .otherwise(F.date_add(F.lit("1950-01-01").cast("date"), (k * 13 % 18000).cast("int")))
            .alias("bdate"),
            _cycle(k, {0: "F", 1: "Male ", 2: "FEMALE", 3: "m", 4: "", 5: "X"}, 7).alias("gen"),
        )
    )


def erp_loc_a101(spark: SparkSession, folder: str) -> DataFrame:
    k, n = F.col("c_custkey"), F.col("n_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    known = F.when(k % 23 == 0, "XX-").otherwise("AW-")
    customers = table(spark, folder, "customer")
    return customers.join(nations, F.col("c_nationkey") == n).select(
        F.concat(known, _padded(k, 8)).alias("cid"),
        F.when(n % 7 == 5, F.concat(F.lit(" "), "n_name", F.lit(" ")))
        .when(n % 7 == 6, F.col("n_name"))
        .otherwise(_cycle(n, {0: "DE", 1: "US ", 2: "USA", 3: "  "}, 7))
        .alias("cntry"),
    )


def erp_px_cat_g1v2(spark: SparkSession, folder: str) -> DataFrame:
    # The categories that products point to; those of one nation under identifiers that match none of them.
    k = _third(F.col("p_partkey"))
    used = table(spark, folder, "part").select((k % 5).alias("r_regionkey"), (F.floor(k / 5).cast("bigint") % 25).alias("n_nationkey"))
    named = (
        used.distinct()
        .join(table(spark, folder, "region").select("r_regionkey", "r_name"), "r_regionkey")
        .join(table(spark, folder, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    )
    n = F.col("n_nationkey")
    return named.select(
        F.concat(F.when(n == 24, "X").otherwise("C"), _text(F.col("r_regionkey")), F.lit("_"), _padded(n, 2)).alias("id"),
        F.col("r_name").alias("cat"),
        F.col("n_name").alias("subcat"),
        F.when(n % 2 == 0, "Yes").otherwise("No").alias("maintenance"),
    )


RAW_FEEDS = {
    "crm_cust_info": crm_cust_info,
    "crm_prd_info": crm_prd_info,
    "crm_sales_details": crm_sales_details,
    "erp_cust_az12": erp_cust_az12,
    "erp_loc_a101": erp_loc_a101,
    "erp_px_cat_g1v2": erp_px_cat_g1v2,
}
