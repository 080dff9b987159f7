"""Repair of amounts that do not fit together.

Both rules read the raw columns: the price repair divides the raw amount, not the repaired one.
Integer overflow fails the job under Spark's ANSI default; nothing is wrapped around silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def repaired_amount(amount: Column, quantity: Column, price: Column) -> Column:
    """Quantity times absolute price wherever the amount is missing, not positive or different from it.

    A NULL product is never found different, so a positive amount survives a missing price.
    """
    product = quantity * F.abs(price)
    return F.when((amount > 0) & F.coalesce(amount == product, F.lit(True)), amount).otherwise(product)


def repaired_price(price: Column, amount: Column, quantity: Column) -> Column:
    """Amount per unit wherever the price is missing or not positive; NULL for a quantity of zero."""
    return F.when(price > 0, price).otherwise(amount / F.nullif(quantity, F.lit(0)))
