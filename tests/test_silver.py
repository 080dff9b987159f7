"""Cleaned tables on small raw frames."""

from __future__ import annotations

import datetime

import pytest

from conform.plans import silver
from conform.plans.schemas import RAW_SCHEMAS

D = datetime.date
T = datetime.datetime


def by(df, key):
    return {row[key]: row for row in df.collect()}


def test_customers(spark):
    raw = spark.createDataFrame(
        [
            (11, "AW11", " Jon", "Yang ", "M", "M", D(2025, 1, 1)),
            (11, "AW11", "Jon", "Yang", "S", "M", D(2025, 6, 1)),
            (12, "AW12", "  Eva  ", "Ruiz", " s ", "f", D(2025, 2, 1)),
            (None, "AW13", "No", "Id", "S", "F", D(2025, 2, 1)),
            (14, "AW14", None, None, None, None, None),
        ],
        RAW_SCHEMAS["crm_cust_info"],
    )
    result = silver.customers(raw)
    assert result.columns == [
        "customer_id",
        "customer_number",
        "first_name",
        "last_name",
        "marital_status",
        "gender",
        "created_date",
    ]
    assert {k: tuple(row)[1:] for k, row in by(result, "customer_id").items()} == {
        11: ("AW11", "Jon", "Yang", "Single", "Male", D(2025, 6, 1)),
        12: ("AW12", "Eva", "Ruiz", "Single", "Female", D(2025, 2, 1)),
        14: ("AW14", None, None, "n/a", "n/a", None),
    }


@pytest.mark.parametrize("start_type", ["timestamp", "date"])
@pytest.mark.parametrize("cost_type", ["int", "float", "double"])
def test_products(spark, start_type, cost_type):
    start = (lambda *d: T(*d)) if start_type == "timestamp" else (lambda *d: D(*d))
    cost = int if cost_type == "int" else float
    raw = spark.createDataFrame(
        [
            (1, "BI-MB-BK-M18", "Old", cost(10), "M ", start(2011, 7, 1)),
            (2, "BI-MB-BK-M18", "New", cost(12), "m", start(2012, 7, 1)),
            (3, "AC-HE-HL-U5", "Helmet", None, "S", start(2013, 7, 1)),
            (4, "CL-JE", "Short", cost(5), "Z", start(2013, 7, 1)),
            (5, "CO-RF-R9", "Frame", cost(5), None, start(2013, 7, 1)),
        ],
        f"prd_id int, prd_key string, prd_nm string, prd_cost {cost_type}, prd_line string, prd_start_dt {start_type}",
    )
    result = silver.products(raw)
    assert result.columns == [
        "product_id",
        "category_id",
        "product_number",
        "product_name",
        "product_cost",
        "product_line",
        "start_date",
        "end_date",
    ]
    assert {k: tuple(row)[1:] for k, row in by(result, "product_id").items()} == {
        1: ("BI_MB", "BK-M18", "Old", 10, "Mountain", D(2011, 7, 1), D(2012, 6, 30)),
        2: ("BI_MB", "BK-M18", "New", 12, "Mountain", D(2012, 7, 1), None),
        3: ("AC_HE", "HL-U5", "Helmet", 0, "Other Sales", D(2013, 7, 1), None),
        4: ("CL_JE", "", "Short", 5, "n/a", D(2013, 7, 1), None),
        5: ("CO_RF", "R9", "Frame", 5, "n/a", D(2013, 7, 1), None),
    }


def test_delivered_end_date_is_not_used(spark):
    raw = spark.createDataFrame(
        [(1, "BI-MB-BK", "Bike", 1, "M", T(2011, 7, 1), T(2011, 1, 1))], RAW_SCHEMAS["crm_prd_info"]
    )
    assert silver.products(raw).first()["end_date"] is None


def test_sales(spark):
    raw = spark.createDataFrame(
        [
            ("SO1", "P1", 1, 20101229, 20110105, 20110110, 20, 2, 10),
            ("SO2", "P1", 1, 0, 2011010, 20211399, None, 2, 10),
            ("SO3", "P1", 1, None, 20110105, 20110110, -30, 3, None),
            ("SO4", None, None, 20101229, 20110105, 20110110, 30, 0, -5),
        ],
        RAW_SCHEMAS["crm_sales_details"],
    )
    result = silver.sales(raw)
    assert result.columns == [
        "order_number",
        "product_number",
        "customer_id",
        "order_date",
        "ship_date",
        "due_date",
        "sales_amount",
        "quantity",
        "price",
    ]
    assert {k: tuple(row)[1:] for k, row in by(result, "order_number").items()} == {
        "SO1": ("P1", 1, D(2010, 12, 29), D(2011, 1, 5), D(2011, 1, 10), 20, 2, 10.0),
        "SO2": ("P1", 1, None, None, None, 20, 2, 10.0),
        "SO3": ("P1", 1, None, D(2011, 1, 5), D(2011, 1, 10), None, 3, -10.0),
        "SO4": (None, None, D(2010, 12, 29), D(2011, 1, 5), D(2011, 1, 10), 0, 0, None),
    }


def test_overflow_is_not_silent(spark):
    raw = spark.createDataFrame(
        [("SO1", "P1", 1, None, None, None, None, 2**30, 4)], RAW_SCHEMAS["crm_sales_details"]
    )
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        silver.sales(raw).collect()


def test_demographics(spark):
    raw = spark.createDataFrame(
        [
            ("NASAW1", D(1980, 1, 1), "F"),
            ("AW2", D(2099, 1, 1), " male "),
            ("nasAW3", None, "FEMALE"),
            (None, D(2020, 1, 2), "x"),
        ],
        RAW_SCHEMAS["erp_cust_az12"],
    )
    expected = {
        ("AW1", D(1980, 1, 1), "Female"),
        ("AW2", None, "Male"),
        ("nasAW3", None, "Female"),
        (None, D(2020, 1, 2), "n/a"),
    }
    result = silver.demographics(raw)
    assert result.columns == ["customer_number", "birth_date", "gender"]
    assert {tuple(row) for row in result.collect()} == expected
    earlier = silver.demographics(raw, as_of=D(2020, 1, 1))
    assert {row["birth_date"] for row in earlier.collect()} == {D(1980, 1, 1), None}


def test_locations(spark):
    raw = spark.createDataFrame(
        [("AW-1", "DE"), ("A-W-2", "USA "), ("AW3", " "), ("AW-4", None), ("AW-5", " France")],
        RAW_SCHEMAS["erp_loc_a101"],
    )
    result = silver.locations(raw)
    assert result.columns == ["customer_number", "country"]
    assert {tuple(row) for row in result.collect()} == {
        ("AW1", "Germany"),
        ("AW2", "United States"),
        ("AW3", "n/a"),
        ("AW4", "n/a"),
        ("AW5", "France"),
    }


def test_categories_pass_through(spark):
    data = [("AC_BR", "Accessories", "Bike Racks", "Yes"), (None, " x ", None, "")]
    result = silver.categories(spark.createDataFrame(data, RAW_SCHEMAS["erp_px_cat_g1v2"]))
    assert result.columns == ["category_id", "category", "subcategory", "maintenance_flag"]
    assert {tuple(row) for row in result.collect()} == set(data)


@pytest.mark.parametrize("table", list(RAW_SCHEMAS))
def test_empty_in_empty_out_and_no_python_workers(spark, table):
    result = silver.SILVER_TABLES[table](spark.createDataFrame([], RAW_SCHEMAS[table]))
    assert result.count() == 0
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
