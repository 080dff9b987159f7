"""Column rules on rows of their own."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from conform.functions import (
    key_head,
    key_tail,
    last_day_before,
    map_codes,
    null_after,
    packed_date,
    prefer,
    remove_text,
    repaired_amount,
    repaired_price,
    strip_prefix,
)
from conform.plans import silver

D = datetime.date


def apply(spark, rule, values, type_name="string"):
    """The rule on each value, in the order of the values."""
    rows = [(i, value) for i, value in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {type_name}")
    return [row["r"] for row in df.select("i", rule(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("rule", "expected"),
    [
        (
            silver.marital_status_label,
            {"S": "Single", " m ": "Married", "M": "Married", "D": "n/a", "": "n/a", "\tM": "n/a", None: "n/a"},
        ),
        (silver.gender_code_label, {"f": "Female", " M": "Male", "Female": "n/a", "X": "n/a", None: "n/a"}),
        (
            silver.gender_word_label,
            {"F": "Female", "female ": "Female", "M": "Male", " MALE": "Male", "": "n/a", "X": "n/a", None: "n/a"},
        ),
        (
            silver.product_line_label,
            {"M ": "Mountain", "r": "Road", "S": "Other Sales", " t": "Touring", "Z": "n/a", None: "n/a"},
        ),
        (
            silver.country_label,
            {
                " DE ": "Germany",
                "de": "de",
                "US": "United States",
                "USA ": "United States",
                "usa": "usa",
                " France ": "France",
                "  ": "n/a",
                "": "n/a",
                None: "n/a",
            },
        ),
    ],
)
def test_labels(spark, rule, expected):
    assert apply(spark, rule, list(expected)) == list(expected.values())


def test_map_codes_keeps_null_when_unknown_codes_pass_through(spark):
    assert apply(spark, lambda c: map_codes(c, {"One": ["1"]}, default=None), ["1", " 2 ", None]) == ["One", "2", None]


def test_prefer(spark):
    rows = [("Male", "Female"), ("n/a", "Female"), ("n/a", "n/a"), ("n/a", None), (None, "Male"), (None, None)]
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "i int, a string, b string")
    result = df.select("i", prefer(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()
    assert [row["r"] for row in result] == ["Male", "Female", "n/a", "n/a", "Male", "n/a"]


def test_key_parts(spark):
    keys = ["CO-RF-FR-R92B-58", "AC-HE", "AC-HE-", "A", "", None]
    assert apply(spark, lambda c: key_head(c, 5), keys) == ["CO_RF", "AC_HE", "AC_HE", "A", "", None]
    assert apply(spark, lambda c: key_tail(c, 7), keys) == ["FR-R92B-58", "", "", "", "", None]


def test_strip_prefix(spark):
    values = ["NASAW1", "AW1", "nasAW1", " NASAW1", "NAS", "AWNAS", None]
    expected = ["AW1", "AW1", "nasAW1", " NASAW1", "", "AWNAS", None]
    assert apply(spark, lambda c: strip_prefix(c, "NAS"), values) == expected


def test_remove_text(spark):
    assert apply(spark, lambda c: remove_text(c, "-"), ["A-W-1", "--", "AW", None]) == ["AW1", "", "AW", None]


def test_packed_date(spark):
    expected = {
        20101229: D(2010, 12, 29),
        20200229: D(2020, 2, 29),
        99991231: D(9999, 12, 31),
        10000101: D(1000, 1, 1),
        20210229: None,
        20211399: None,
        20210132: None,
        20210100: None,
        20210010: None,
        0: None,
        2010122: None,
        201012290: None,
        -1234567: None,
        -20101229: None,
        None: None,
    }
    assert apply(spark, packed_date, list(expected), "int") == list(expected.values())


def test_packed_date_agrees_with_text_parsing_on_every_day_and_non_day(spark):
    numbers = spark.range(19990000, 20010000).select(F.col("id").cast("int").alias("n"))
    parsed = F.try_to_date(F.col("n").cast("string"), "yyyyMMdd")
    assert numbers.filter(~packed_date(F.col("n")).eqNullSafe(parsed)).count() == 0


def test_null_after(spark):
    dates = [D(1980, 1, 1), D(2024, 5, 1), D(2024, 5, 2), None]
    assert apply(spark, lambda c: null_after(c, D(2024, 5, 1)), dates, "date") == [*dates[:2], None, None]
    assert apply(spark, null_after, [D(2099, 1, 1), D(1980, 1, 1)], "date") == [None, D(1980, 1, 1)]


def test_last_day_before_goes_by_the_calendar(spark):
    starts = [datetime.datetime(2024, 3, 1, 12), datetime.datetime(2024, 1, 1), None]
    assert apply(spark, last_day_before, starts, "timestamp_ntz") == [D(2024, 2, 29), D(2023, 12, 31), None]


AMOUNTS = [
    # amount, quantity, price -> repaired amount, repaired price
    ((20, 2, 10), 20, 10.0),
    ((None, 2, 10), 20, 10.0),
    ((-20, 2, 10), 20, 10.0),
    ((0, 2, 10), 20, 10.0),
    ((25, 2, 10), 20, 10.0),
    ((20, 2, -10), 20, 10.0),
    ((20, 2, None), 20, 10.0),
    ((-20, 2, None), None, -10.0),
    ((None, 2, None), None, None),
    ((20, 2, 0), 0, 10.0),
    ((20, 0, None), 20, None),
    ((20, 0, 10), 0, 10.0),
    ((20, None, 10), 20, 10.0),
    ((None, None, -10), None, None),
    ((7, 2, None), 7, 3.5),
]


@pytest.mark.parametrize("number", ["int", "bigint", "double"])
def test_amount_and_price(spark, number):
    cast = float if number == "double" else int
    rows = [
        (i, *[None if v is None else cast(v) for v in raw[:1]], raw[1], None if raw[2] is None else cast(raw[2]))
        for i, (raw, _, _) in enumerate(AMOUNTS)
    ]
    df = spark.createDataFrame(rows, f"i int, amount {number}, quantity int, price {number}")
    amount, quantity, price = F.col("amount"), F.col("quantity"), F.col("price")
    result = df.select(
        "i",
        repaired_amount(amount, quantity, price).alias("amount"),
        repaired_price(price, amount, quantity).alias("price"),
    )
    assert result.schema["amount"].dataType == df.schema["amount"].dataType
    assert result.schema["price"].dataType.simpleString() == "double"
    assert [(r["amount"], r["price"]) for r in result.orderBy("i").collect()] == [case[1:] for case in AMOUNTS]
