"""Checks of stored tables, holding and failing."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conform.operators import checks


def frame(spark, keys):
    return spark.createDataFrame([(key,) for key in keys], "k int")


def key_cases(spark, kind):
    rng = random.Random(4)
    dense = list(range(1, 40_001))
    cases = {
        "gapless": dense,
        "gap": dense[:35_000] + dense[35_001:],
        "copy": dense + [33_333],
        "copies and nulls": [None] * 3 + dense + [5] * 4 + [32_768, 39_999],
        "one null": [None, *dense],
        "around zero": list(range(-33_000, 33_000)) + [-32_768, 32_768],
        "ends": [2**31 - 2, 2**31 - 1, 2**31 - 2],
    }
    for name, keys in cases.items():
        for order in ("sorted", "strewn") if kind == "bigint" else ("strewn",):
            keys = sorted(keys, key=lambda k: (k is not None, k)) if order == "sorted" else rng.sample(keys, len(keys))
            rows = spark.sparkContext.parallelize([(key,) for key in keys], 5)
            yield f"{name}, {order}", spark.createDataFrame(rows, f"k {kind}")


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_bitmaps_equal_group_counts(spark, kind):
    for name, df in key_cases(spark, kind):
        for check in (checks.key_uniqueness, checks.key_gaps, checks.join_fan_out):
            by_bitmap, by_group = check(df, "k", bitmap_rows=1), check(df, "k", bitmap_rows=10**9)
            assert by_bitmap.first() == by_group.first(), (name, check)
            assert by_bitmap.dtypes == by_group.dtypes


def test_bitmaps_need_a_row_per_32768_keys(spark):
    df = spark.range(1, 2_000_001, 1, 4).withColumnRenamed("id", "k")
    found = checks._bitmaps(df, "k", 1)
    assert found.keys == found.filled == 2_000_000 and found.table.count() == 62  # 2,000,000 / 32,768
    assert checks._bitmaps(df.withColumn("k", F.xxhash64("k")), "k", 1) is None  # too far apart
    assert checks._bitmaps(df.withColumn("k", F.col("k").cast("string")), "k", 1) is None
    assert checks._bitmaps(df, "k", 10**7) is None


def test_checks_that_ride_on_the_write(spark, tmp_path):
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(len(batch))
            yield batch

    before = spark.range(1000).mapInPandas(count, "id long")
    watch = checks.WriteChecks(["key"])
    after = watch.input(before).withColumn("key", F.when(F.col("id") % 10 > 0, F.col("id")))
    watch.output(after).write.parquet(str(tmp_path / "t"))
    assert (watch.rows_before, watch.rows_after, watch.preserved, watch.not_empty) == (1000, 1000, True, True)
    assert watch.unresolved == {"key": 100} and counted.value == 1000
    lost = checks.WriteChecks()
    lost.output(lost.input(spark.range(10)).where("id > 20")).write.parquet(str(tmp_path / "u"))
    assert (lost.preserved, lost.not_empty) == (False, False)


def test_not_empty(spark):
    assert checks.not_empty(frame(spark, [1]))
    assert not checks.not_empty(frame(spark, []))


def test_key_uniqueness(spark):
    assert checks.key_uniqueness(frame(spark, [1, 2, 3]), "k").first() == (3, 0)
    assert checks.key_uniqueness(frame(spark, [1, 1, 2, None, None]), "k").first() == (3, 2)
    assert checks.key_uniqueness(frame(spark, []), "k").first() == (0, 0)


def test_key_gaps(spark):
    assert checks.key_gaps(frame(spark, [2, 1, 3]), "k").first() == (1, 3, 3, True)
    for bad in ([1, 3], [2, 3], [1, 1], [1, 2, 2], [1, 2, None], [None], [0, 1, 2]):
        assert checks.key_gaps(frame(spark, bad), "k").first()["gapless"] is False
    assert checks.key_gaps(frame(spark, []), "k").first() == (None, None, 0, True)


def test_join_fan_out(spark):
    assert checks.join_fan_out(frame(spark, [1, 2, None, None]), "k").first() == (0,)
    assert checks.join_fan_out(frame(spark, [1, 1, 2, 2, 3]), "k").first() == (2,)


def test_rows_preserved(spark):
    assert checks.rows_preserved(frame(spark, [1, 2]), frame(spark, [5, 6])).first() == (2, 2, True)
    assert checks.rows_preserved(frame(spark, [1, 2]), frame(spark, [])).first() == (2, 0, False)


def test_unresolved_keys(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 5)], "a int, b int")
    assert checks.unresolved_keys(df, ["a", "b"]).first().asDict() == {
        "rows": 3,
        "a_unresolved": 1,
        "b_unresolved": 2,
    }


def test_has_columns(spark):
    assert checks.has_columns(frame(spark, []), ["k"])
    assert not checks.has_columns(frame(spark, []), ["k", "x"])
