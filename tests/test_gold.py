"""The star schema on small cleaned frames, and the layers as stored tables."""

from __future__ import annotations

import datetime
import os
import threading
import uuid
from collections import Counter

import pytest

from conform.operators import checks
from conform.plans import gold, silver
from conform.plans.manifest import RunFailed, resume_all
from conform.plans.run import Layout, build_gold_table, feed_specs, run_all, run_gold_table, run_silver_table
from conform.plans.schemas import RAW_SCHEMAS
from conform.verification.queries import write_csv_feeds

D = datetime.date


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


CUSTOMER_SCHEMA = (
    "customer_id int, customer_number string, first_name string, last_name string, gender string, "
    "marital_status string, created_date date"
)
DEMOGRAPHICS_SCHEMA = "customer_number string, gender string, birth_date date"
LOCATION_SCHEMA = "customer_number string, country string"
PRODUCT_SCHEMA = (
    "product_id int, product_number string, product_name string, category_id string, product_cost double, "
    "product_line string, start_date date, end_date date"
)
CATEGORY_SCHEMA = "category_id string, category string, subcategory string, maintenance_flag boolean"
SALES_SCHEMA = (
    "order_number string, product_number string, customer_id int, order_date date, ship_date date, due_date date, "
    "sales_amount double, quantity int, price double"
)


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [
            (30, "C", "Cy", "Ra", "n/a", "Single", D(2020, 1, 3)),
            (10, "A", "An", "Ba", "Male", "Single", D(2020, 1, 1)),
            (20, "B", "Bo", "Ca", "n/a", "Married", D(2020, 1, 2)),
            (40, "D", "Di", "Da", "n/a", "n/a", None),
        ],
        CUSTOMER_SCHEMA,
    )


@pytest.fixture
def demographics(spark):
    data = [("A", "Female", D(1980, 1, 1)), ("B", "Female", D(1981, 1, 1)), ("C", None, None)]
    return spark.createDataFrame(data, DEMOGRAPHICS_SCHEMA)


@pytest.fixture
def locations(spark):
    return spark.createDataFrame([("A", "Germany"), ("B", "n/a")], LOCATION_SCHEMA)


def test_dim_customers(customers, demographics, locations):
    result = gold.dim_customers(customers, demographics, locations)
    assert result.columns == [
        "customer_key",
        "customer_id",
        "customer_number",
        "first_name",
        "last_name",
        "country",
        "marital_status",
        "gender",
        "birthdate",
        "create_date",
    ]
    assert {tuple(row) for row in result.collect()} == {
        (1, 10, "A", "An", "Ba", "Germany", "Single", "Male", D(1980, 1, 1), D(2020, 1, 1)),
        (2, 20, "B", "Bo", "Ca", "n/a", "Married", "Female", D(1981, 1, 1), D(2020, 1, 2)),
        (3, 30, "C", "Cy", "Ra", None, "Single", "n/a", None, D(2020, 1, 3)),
        (4, 40, "D", "Di", "Da", None, "n/a", "n/a", None, None),
    }


def test_dim_customers_without_customers_or_lookups(spark, customers, demographics, locations):
    nobody = spark.createDataFrame([], CUSTOMER_SCHEMA)
    assert gold.dim_customers(nobody, demographics, locations).count() == 0
    nothing_known = gold.dim_customers(customers, demographics.limit(0), locations.limit(0)).collect()
    assert sorted(row["customer_key"] for row in nothing_known) == [1, 2, 3, 4]
    assert {(row["country"], row["birthdate"]) for row in nothing_known} == {(None, None)}
    assert {row["customer_id"]: row["gender"] for row in nothing_known} == {10: "Male", 20: "n/a", 30: "n/a", 40: "n/a"}


def test_repeated_lookup_key_repeats_customers_and_is_found(spark, customers, demographics, locations):
    twice = locations.unionByName(locations)
    result = gold.dim_customers(customers, demographics, twice)
    assert sorted(row["customer_key"] for row in result.collect()) == [1, 2, 3, 4, 5, 6]
    assert checks.join_fan_out(twice, "customer_number").first()["fan_out_keys"] == 2
    assert checks.key_uniqueness(result, "customer_id").first()["repeated_keys"] == 2


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [
            (1, "P1", "Old", "C1", 1.0, "Road", D(2010, 1, 1), D(2010, 12, 31)),
            (2, "P1", "New", "C1", 2.0, "Road", D(2011, 1, 1), None),
            (3, "P0", "Other", "C2", 3.0, "n/a", D(2011, 1, 1), None),
            (4, "P9", "First", "CX", 4.0, "n/a", D(2009, 1, 1), None),
        ],
        PRODUCT_SCHEMA,
    )


def test_dim_products(spark, products):
    categories = spark.createDataFrame([("C1", "Bikes", "Road", True), ("C2", "Parts", "Nut", False)], CATEGORY_SCHEMA)
    result = gold.dim_products(products, categories)
    assert result.columns == [
        "product_key",
        "product_id",
        "product_number",
        "product_name",
        "category_id",
        "category",
        "subcategory",
        "maintenance_flag",
        "product_cost",
        "product_line",
        "start_date",
    ]
    assert {tuple(row) for row in result.collect()} == {
        (1, 4, "P9", "First", "CX", None, None, None, 4.0, "n/a", D(2009, 1, 1)),
        (2, 3, "P0", "Other", "C2", "Parts", "Nut", False, 3.0, "n/a", D(2011, 1, 1)),
        (3, 2, "P1", "New", "C1", "Bikes", "Road", True, 2.0, "Road", D(2011, 1, 1)),
    }
    assert gold.dim_products(products.limit(0), categories).count() == 0
    unknown = gold.dim_products(products, categories.limit(0)).collect()
    assert sorted(row["product_key"] for row in unknown) == [1, 2, 3]
    assert {row["category"] for row in unknown} == {None}


@pytest.fixture
def sales(spark):
    day = D(2019, 11, 30)
    return spark.createDataFrame(
        [
            ("SO1", "P1", 1, day, day, day, 20.0, 2, 10.0),
            ("SO2", "PX", 1, day, None, day, 20.0, 2, 10.0),
            ("SO3", "P1", -5, day, day, day, None, 2, None),
            ("SO4", None, None, None, None, None, None, None, None),
            ("SO1", "P1", 1, day, day, day, 20.0, 2, 10.0),
        ],
        SALES_SCHEMA,
    )


def test_fact_sales(spark, sales):
    products = spark.createDataFrame([(7, "P1")], "product_key int, product_number string")
    customers = spark.createDataFrame([(3, 1)], "customer_key int, customer_id int")
    result = gold.fact_sales(sales, products, customers)
    assert checks.has_columns(
        result,
        [
            "order_number",
            "product_key",
            "customer_key",
            "order_date",
            "ship_date",
            "due_date",
            "sales_amount",
            "quantity",
            "price",
        ],
    )
    keys = sorted((row["order_number"], row["product_key"], row["customer_key"]) for row in result.collect() if row[1])
    assert keys == [("SO1", 7, 3), ("SO1", 7, 3), ("SO3", 7, None)]
    assert checks.rows_preserved(sales, result).first() == (5, 5, True)
    assert tuple(checks.unresolved_keys(result, ["product_key", "customer_key"]).first()) == (5, 2, 2)
    assert gold.fact_sales(sales.limit(0), products, customers).count() == 0
    unresolved = gold.fact_sales(sales, products.limit(0), customers.limit(0))
    assert tuple(checks.unresolved_keys(unresolved, ["product_key", "customer_key"]).first()) == (5, 5, 5)


def test_gold_reads_named_views(spark, sales):
    sales.createOrReplaceTempView("some_sales")
    spark.createDataFrame([(7, "P1")], "product_key int, product_number string").createOrReplaceTempView("some_p")
    spark.createDataFrame([(3, 1)], "customer_key int, customer_id int").createOrReplaceTempView("some_c")
    result = build_gold_table(spark, Layout(), "fact_sales", ["some_sales", "some_p", "some_c"])
    assert result.filter("product_key = 7 and customer_key = 3").count() == 2


@pytest.fixture
def layout(spark, tmp_path):
    suffix = uuid.uuid4().hex
    layout = Layout(f"b_{suffix}", f"s_{suffix}", f"g_{suffix}", catalog="spark_catalog")
    for name in (layout.bronze, layout.silver, layout.gold):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield layout
    for name in (layout.bronze, layout.silver, layout.gold):
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_layers(spark, layout, tmp_path):
    specs = feed_specs(layout, f"{tmp_path}/feeds")
    write_csv_feeds(spark, "/root/testdata/sf0.01", specs)
    for _ in range(2):  # a second run replaces the first
        run_all(spark, layout, specs, parallel=3)
    counted = {t: spark.table(layout.name("silver", t)).count() for t in RAW_SCHEMAS}
    assert counted == {
        "crm_cust_info": 1500,
        "crm_prd_info": 2000,
        "crm_sales_details": 60000,
        "erp_cust_az12": 1500,
        "erp_loc_a101": 1500,
        "erp_px_cat_g1v2": 125,
    }
    customers, products, facts = (
        spark.table(layout.name("gold", t)) for t in ("dim_customers", "dim_products", "fact_sales")
    )
    genders = {row["gender"]: row["count"] for row in customers.groupBy("gender").count().collect()}
    assert genders == {"Female": 636, "Male": 636, "n/a": 228}
    assert customers.filter("country is null").count() == 66
    assert customers.filter("birthdate is null").count() == 163
    assert checks.key_gaps(products, "product_key").first() == (1, 667, 667, True)
    missing = ["product_key", "customer_key", "order_date", "sales_amount", "price"]
    assert tuple(checks.unresolved_keys(facts, missing).first()) == (60000, 1479, 1411, 1215, 898, 1040)

    # The scans read what is needed and no more.
    fact_plan = plan(build_gold_table(spark, layout, "fact_sales"))
    assert "ReadSchema: struct<product_key:int,product_number:string>" in fact_plan
    assert "ReadSchema: struct<customer_key:int,customer_id:int>" in fact_plan
    assert "hashpartitioning" not in fact_plan
    silver_tables = [spark.table(layout.name("silver", t)) for t in ("crm_prd_info", "erp_px_cat_g1v2")]
    assert "PushedFilters: [IsNull(end_date)]" in plan(gold.categorized_products(*silver_tables))
    for table in ("crm_sales_details", "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"):
        assert "Exchange" not in plan(silver.SILVER_TABLES[table](spark.table(layout.name("bronze", table))))

    # One table at a time, under names of the caller's choice.
    target = layout.name("silver", "elsewhere")
    source = layout.name("bronze", "erp_loc_a101")
    assert run_silver_table(spark, layout, "erp_loc_a101", source=source, target=target) == target
    assert spark.table(target).count() == 1500
    target = layout.name("gold", "elsewhere")
    assert run_gold_table(spark, layout, "dim_products", target=target) == target
    assert spark.table(target).count() == 667


def test_readers_see_no_gap_while_tables_are_replaced(spark, layout, tmp_path):
    specs = feed_specs(layout, f"{tmp_path}/feeds")
    write_csv_feeds(spark, "/root/testdata/sf0.001", specs)
    run_all(spark, layout, specs, parallel=3)
    names = [layout.name("bronze", "erp_loc_a101"), layout.name("silver", "crm_cust_info"), layout.name("gold", "fact_sales")]
    expected = {name: spark.table(name).count() for name in names}
    done, seen = threading.Event(), Counter()

    def read():
        while not done.is_set():
            for name in names:
                try:
                    seen[spark.table(name).count() == expected[name]] += 1
                except Exception as error:
                    seen[str(error)[:200]] += 1

    reader = threading.Thread(target=read)
    reader.start()
    for _ in range(3):
        run_all(spark, layout, specs, parallel=3)
    done.set()
    reader.join()
    assert set(seen) == {True} and seen[True] >= 10
    # The version before the last stays for queries that still read it.
    location = f"{tmp_path}/{layout.gold}/_versions/fact_sales"
    assert len(os.listdir(location)) == 2


def test_resumed_run(spark, layout, tmp_path):
    specs = feed_specs(layout, f"{tmp_path}/feeds")
    late = [spec for spec in specs if spec.table == "erp_loc_a101"]
    write_csv_feeds(spark, "/root/testdata/sf0.001", [spec for spec in specs if spec not in late])
    book = f"{tmp_path}/manifest"
    with pytest.raises(RunFailed) as broken:
        resume_all(spark, layout, specs, book, parallel=3)
    report = broken.value.report
    assert list(report.failed) == ["bronze.erp_loc_a101"]
    assert set(report.waiting) == {"silver.erp_loc_a101", "gold.dim_customers", "gold.fact_sales"}
    assert len(report.done) == 5 + 5 + 1 and "gold.dim_products" in report.done
    write_csv_feeds(spark, "/root/testdata/sf0.001", late)
    report = resume_all(spark, layout, specs, book, parallel=3)
    assert set(report.done) == {"bronze.erp_loc_a101", "silver.erp_loc_a101", "gold.dim_customers", "gold.fact_sales"}
    facts = sorted(map(repr, spark.table(layout.name("gold", "fact_sales")).collect()))
    again = resume_all(spark, layout, specs, book, parallel=3)
    assert again.done == [] and len(again.current) == 6 + 6 + 3
    # A table that is gone is made again, and a feed that has changed goes through all its layers.
    spark.sql(f"DROP TABLE {layout.name('silver', 'erp_px_cat_g1v2')}")
    assert resume_all(spark, layout, specs, book).done == ["silver.erp_px_cat_g1v2"]
    (sales,) = [spec for spec in specs if spec.table == "crm_sales_details"]
    spark.read.option("header", True).csv(sales.path).limit(7).write.mode("append").option("header", True).csv(sales.path)
    changed = resume_all(spark, layout, specs, book, parallel=3)
    assert changed.done == ["bronze.crm_sales_details", "silver.crm_sales_details", "gold.fact_sales"]
    assert spark.table(layout.name("gold", "fact_sales")).count() == len(facts) + 7


def test_checks_ride_on_the_write_of_the_fact(spark, layout, tmp_path):
    specs = feed_specs(layout, f"{tmp_path}/feeds")
    write_csv_feeds(spark, "/root/testdata/sf0.001", specs)
    run_all(spark, layout, specs, parallel=3)
    watch = checks.WriteChecks(["product_key", "customer_key"])
    run_gold_table(spark, layout, "fact_sales", watch=watch)
    facts = spark.table(layout.name("gold", "fact_sales"))
    assert watch.preserved and watch.not_empty and watch.rows_after == facts.count()
    counted = checks.unresolved_keys(facts, ["product_key", "customer_key"]).first()
    assert list(watch.unresolved.values()) == list(counted)[1:]
