"""The star schema. Builders take DataFrames, so tables, views and test frames serve alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.functions import prefer
from conform.operators import current_only, gapless_key, left_lookup, project, resolve_key


def merged_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers with what the ERP knows about them; the CRM gender wins where it says anything."""
    from_erp = project(
        demographics,
        {"customer_number": "customer_number", "erp_gender": "gender", "birthdate": "birth_date"},
    )
    where = project(locations, {"customer_number": "customer_number", "country": "country"})
    joined = left_lookup(customers, "customer_number", from_erp, where)
    return project(
        joined,
        {
            "customer_id": "customer_id",
            "customer_number": "customer_number",
            "first_name": "first_name",
            "last_name": "last_name",
            "country": "country",
            "marital_status": "marital_status",
            "gender": prefer(F.col("gender"), F.col("erp_gender")),
            "birthdate": "birthdate",
            "create_date": "created_date",
        },
    )


def dim_customers(customers: DataFrame, demographics: DataFrame, locations: DataFrame) -> DataFrame:
    """Customers numbered by id."""
    merged = merged_customers(customers, demographics, locations)
    return gapless_key(merged, ["customer_id"], "customer_key")


def categorized_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Current product versions with their category."""
    joined = left_lookup(current_only(products), "category_id", categories)
    return joined.select(
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
    )


def dim_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Current product versions numbered by start and product number, gapless because ended ones go first."""
    return gapless_key(categorized_products(products, categories), ["start_date", "product_number"], "product_key")


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Every sales line with the keys of both dimensions, NULL where a dimension has no such row."""
    resolved = sales.transform(resolve_key, products, "product_number", "product_key").transform(
        resolve_key, customers, "customer_id", "customer_key"
    )
    return resolved.select(
        "order_number",
        "product_key",
        "customer_key",
        "order_date",
        "ship_date",
        "due_date",
        "sales_amount",
        "quantity",
        "price",
    )
