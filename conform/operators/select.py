"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """The named output columns, in order, each from an input column or a rule."""
    return df.select(*[(F.col(rule) if isinstance(rule, str) else rule).alias(name) for name, rule in columns.items()])


def current_only(df: DataFrame, end: str = "end_date") -> DataFrame:
    """Versions that are still valid: those without an end."""
    return df.filter(F.col(end).isNull())


def sortable_columns(df: DataFrame, *, without: list[str]) -> list[str]:
    """Columns, in schema order, that can break ties in a sort."""
    unsortable = (T.MapType, T.VariantType)
    return [f.name for f in df.schema.fields if f.name not in without and not isinstance(f.dataType, unsortable)]
