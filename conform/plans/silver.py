"""Cleaned tables, one function per raw table.

Every rule reads raw columns only, within one projection, so no rule sees the output of another.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.functions import (
    NOT_AVAILABLE,
    key_head,
    key_tail,
    map_codes,
    null_after,
    packed_date,
    remove_text,
    repaired_amount,
    repaired_price,
    strip_prefix,
)
from conform.operators import close_validity, dedupe_latest, project

# The codes of each label.
MARITAL_STATUS = {"Single": ["S"], "Married": ["M"]}
GENDER_CODES = {"Female": ["F"], "Male": ["M"]}
GENDER_WORDS = {"Female": ["F", "FEMALE"], "Male": ["M", "MALE"]}
PRODUCT_LINE = {"Mountain": ["M"], "Road": ["R"], "Other Sales": ["S"], "Touring": ["T"]}
COUNTRY = {"Germany": ["DE"], "United States": ["US", "USA"]}

# The parts of a composite product key, and the prefix of older customer numbers.
CATEGORY_LENGTH = 5
PRODUCT_NUMBER_START = 7
CUSTOMER_PREFIX = "NAS"


def marital_status_label(code: Column) -> Column:
    return map_codes(code, MARITAL_STATUS)


def gender_code_label(code: Column) -> Column:
    return map_codes(code, GENDER_CODES)


def gender_word_label(code: Column) -> Column:
    return map_codes(code, GENDER_WORDS)


def product_line_label(code: Column) -> Column:
    return map_codes(code, PRODUCT_LINE)


def country_label(code: Column) -> Column:
    """Country names are compared as written, and names that are no code stay."""
    return map_codes(code, COUNTRY, default=None, blank=NOT_AVAILABLE, fold_case=False)


def category_id(key: Column) -> Column:
    return key_head(key, CATEGORY_LENGTH)


def product_number(key: Column) -> Column:
    return key_tail(key, PRODUCT_NUMBER_START)


def customers(raw: DataFrame) -> DataFrame:
    """CRM customers, the latest record of each."""
    return project(
        dedupe_latest(raw, key="cst_id", latest_by="cst_create_date"),
        {
            "customer_id": "cst_id",
            "customer_number": "cst_key",
            "first_name": F.trim("cst_firstname"),
            "last_name": F.trim("cst_lastname"),
            "marital_status": marital_status_label(F.col("cst_martial_status")),
            "gender": gender_code_label(F.col("cst_gndr")),
            "created_date": "cst_create_date",
        },
    )


def products(raw: DataFrame) -> DataFrame:
    """CRM product versions. The end of a version is derived; the one delivered with the feed is not used."""
    key = F.col("prd_key")
    versions = raw.select("prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt")
    return project(
        close_validity(versions, key="prd_key", start="prd_start_dt", end="end_date"),
        {
            "product_id": "prd_id",
            "category_id": category_id(key),
            "product_number": product_number(key),
            "product_name": "prd_nm",
            "product_cost": F.coalesce(F.col("prd_cost"), F.lit(0)),
            "product_line": product_line_label(F.col("prd_line")),
            "start_date": F.col("prd_start_dt").cast("date"),
            "end_date": "end_date",
        },
    )


def sales(raw: DataFrame) -> DataFrame:
    """CRM sales lines."""
    amount, quantity, price = F.col("sls_sales"), F.col("sls_quantity"), F.col("sls_price")
    return project(
        raw,
        {
            "order_number": "sls_ord_num",
            "product_number": "sls_prd_key",
            "customer_id": "sls_cust_id",
            "order_date": packed_date(F.col("sls_order_dt")),
            "ship_date": packed_date(F.col("sls_ship_dt")),
            "due_date": packed_date(F.col("sls_due_dt")),
            "sales_amount": repaired_amount(amount, quantity, price),
            "quantity": quantity,
            "price": repaired_price(price, amount, quantity),
        },
    )


def demographics(raw: DataFrame, as_of: datetime.date | Column | None = None) -> DataFrame:
    """ERP customers; a birth date after ``as_of`` (today unless given) is dropped."""
    return project(
        raw,
        {
            "customer_number": strip_prefix(F.col("cid"), CUSTOMER_PREFIX),
            "birth_date": null_after(F.col("bdate"), as_of),
            "gender": gender_word_label(F.col("gen")),
        },
    )


def locations(raw: DataFrame) -> DataFrame:
    """ERP customer locations."""
    return project(
        raw,
        {
            "customer_number": remove_text(F.col("cid"), "-"),
            "country": country_label(F.col("cntry")),
        },
    )


def categories(raw: DataFrame) -> DataFrame:
    """ERP product categories, taken as they come."""
    return project(
        raw,
        {
            "category_id": "id",
            "category": "cat",
            "subcategory": "subcat",
            "maintenance_flag": "maintenance",
        },
    )


# The cleaning of each table by its name.
SILVER_TABLES = {
    "crm_cust_info": customers,
    "crm_prd_info": products,
    "crm_sales_details": sales,
    "erp_cust_az12": demographics,
    "erp_loc_a101": locations,
    "erp_px_cat_g1v2": categories,
}
