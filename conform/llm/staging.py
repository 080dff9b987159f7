"""Tables written to the shared folder and read back, so that a lost executor costs a reread and no recomputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.sources.workspace import new_folder

#: White space as the contracts of these operators name it, for regular expressions of Spark and Python alike.
BLANKS = r"\x20\x09-\x0D"


def staged(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, written once as Parquet below the shared folder."""
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def check_columns(df: DataFrame, *needed: str) -> None:
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def row_hash(df: DataFrame) -> Column:
    """128 bits of hash over all columns, nulls included, as text: the same for rows that are equal in all of them."""
    parts = []
    for at, field in enumerate(df.schema.fields):
        simple = field.dataType.simpleString()
        column = F.col(f"`{field.name}`")
        # What cannot be hashed as it is, is hashed as text.
        parts += [F.lit(at), F.to_json(F.struct(column)) if "map<" in simple or "variant" in simple else column]
    return F.concat(F.hex(F.xxhash64(*parts)), F.lit("-"), F.hex(F.xxhash64(F.lit("second"), *parts)))
