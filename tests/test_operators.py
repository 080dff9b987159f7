"""Table operators: results against plain Spark windows and joins, and the shape of the plans."""

from __future__ import annotations

import contextlib
import datetime
import random
import re
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conform.operators import (
    close_validity,
    current_only,
    dedupe_latest,
    gapless_key,
    left_lookup,
    project,
    resolve_key,
)
from conform.operators import hotkeys, keys, lookup, validity
from conform.operators.hotkeys import KEY, ROWS, hot_keys, pieces
from conform.operators.lookup import measured_bytes
from conform.sources.inputs import planned
from conform.sources.workspace import stored

D = datetime.date


@contextlib.contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def no_broadcast(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> Counter:
    return Counter(tuple(row) for row in df.collect())


def shuffled(spark, data, schema, partitions=6):
    """Rows spread over several partitions in no order."""
    data = list(data)
    random.Random(7).shuffle(data)
    return spark.createDataFrame(spark.sparkContext.parallelize(data, partitions), schema)


# --- projections ------------------------------------------------------------------------------------------


def test_project_and_current_only(spark):
    df = spark.createDataFrame([(1, None), (2, D(2020, 1, 1))], "a int, e date")
    assert current_only(df, "e").collect() == [(1, None)]
    projected = project(df, {"end": "e", "twice": F.col("a") * 2})
    assert projected.columns == ["end", "twice"]
    assert rows(projected) == Counter([(None, 2), (D(2020, 1, 1), 4)])


# --- keep latest ------------------------------------------------------------------------------------------


def test_dedupe_latest(spark):
    data = [
        (1, D(2024, 1, 1), "old"),
        (1, D(2024, 2, 1), "new"),
        (2, None, "undated"),
        (2, D(2020, 1, 1), "dated"),
        (3, None, "only"),
        (4, D(2024, 1, 1), "b"),
        (4, D(2024, 1, 1), "a"),
        (4, D(2024, 1, 1), None),
        (None, D(2024, 1, 1), "no key"),
    ]
    result = dedupe_latest(shuffled(spark, data, "k int, d date, v string"), "k", "d")
    assert result.columns == ["k", "d", "v"]
    assert rows(result) == Counter(
        [(1, D(2024, 2, 1), "new"), (2, D(2020, 1, 1), "dated"), (3, None, "only"), (4, D(2024, 1, 1), None)]
    )


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("d"))
    text = plan(dedupe_latest(df, "k", "d"))
    final, partial = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert final < text.index("Exchange hashpartitioning") < partial
    assert "Partial" in text[partial : partial + 300]


# --- hot keys ---------------------------------------------------------------------------------------------


def test_hot_keys(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 4 == 0, None).otherwise(F.col("id").cast("string"))
    found = hot_keys(spark.range(30000).select(key.alias("k")), "k", 1000)
    cut = found.select(KEY, ROWS, pieces(1000).alias("thousands"), pieces(3000).alias("more"))
    assert rows(cut) == rows(
        spark.createDataFrame([("hot", 10000, 10, 4), (None, 5000, 5, 2)], "k string, n bigint, t int, m int")
    )
    assert hot_keys(spark.range(0).select(key.alias("k")), "k", 0).isEmpty()


@pytest.mark.parametrize("many", [1_500, 20_000])
def test_every_hot_key_is_found(spark, many):
    df = spark.range(many * 4).select((F.col("id") % many).alias("k"))
    assert hot_keys(df, "k", 3).count() == many
    assert hot_keys(df, "k", 4).isEmpty()


def test_counts_of_keys_are_not_shuffled(spark, monkeypatch):
    df = stored(spark.range(40_000).select(F.when(F.col("id") % 4 == 0, -1).otherwise(F.col("id")).alias("k")), "t")
    plans = stored_plans(monkeypatch, hotkeys)
    assert rows(hot_keys(df, "k", 1000)) == Counter([(-1, 10_000)])
    assert "hashpartitioning(__slot" in plans[0] and "__hot_key" not in plans[0].split("Exchange")[1].split("+-")[0]
    assert "BroadcastHashJoin" in plans[1] and "LeftSemi" in plans[1]
    # The second count sees the keys of one slot of a thousand.
    slots = 1 << (16 * 40).bit_length()
    slot = F.pmod(F.xxhash64("k"), F.lit(slots))
    hot = df.where("k = -1").select(slot.alias("s")).distinct()
    assert df.select("k", slot.alias("s")).join(hot, "s").select("k").distinct().count() < 40_000 / 16
    before = len(plans)
    assert hot_keys(df, "k", 40_000).isEmpty() and len(plans) == before  # nothing counted


def test_inputs_are_computed_once(spark):
    computed = {name: spark.sparkContext.accumulator(0) for name in ("main", "small", "large")}

    def counted(name):
        def count(batches):
            for batch in batches:
                computed[name].add(len(batch))
                yield batch

        return count

    main = spark.range(5000).mapInPandas(counted("main"), "id long").select((F.col("id") % 50).alias("k"), "id")
    small = spark.range(40).mapInPandas(counted("small"), "id long").select(F.col("id").alias("k"), F.lit("s").alias("a"))
    large = spark.range(45).mapInPandas(counted("large"), "id long").select(F.col("id").alias("k"), F.lit("t" * 99).alias("b"))
    with no_broadcast(spark):
        result = left_lookup(main, "k", small, large, broadcast_bytes=6_000, hot_rows=60)
        assert result.where("a is not null").count() == 4000 and result.where("b is not null").count() == 4500
        assert "BroadcastHashJoin" in plan(result) and "SortMergeJoin" in plan(result)
        close_validity(main.withColumn("s", F.current_date()), "k", "s", hot_rows=60).count()
    assert {name: n.value for name, n in computed.items()} == {"main": 2 * 5000, "small": 40, "large": 45}


def test_far_larger_lookup_is_not_measured(spark, monkeypatch):
    stored_lookup = stored(spark.range(100_000).select(F.col("id").alias("k"), F.xxhash64("id").alias("a")), "t")
    monkeypatch.setattr(lookup, "measured_bytes", lambda df: pytest.fail("measured"))
    with no_broadcast(spark):
        facts = stored(spark.range(100).withColumnRenamed("id", "k"), "t")
        assert left_lookup(facts, "k", stored_lookup, broadcast_bytes=1000, hot_rows=10**9).count() == 100


def test_planned(spark):
    table = stored(spark.range(1000).withColumn("v", F.lit("x")), "t")
    assert planned(table).light and planned(table).size > 0
    assert planned(table.where("id > 5").select("id")).light and planned(table.where("id > 5")).size is None
    for heavy in (table.join(table, "id"), table.distinct(), table.orderBy("id"), spark.createDataFrame([(1,)], "a int")):
        assert not planned(heavy).light and planned(heavy).size is None
    void = stored(table.select("id", F.lit(None).alias("nothing"), "v"), "t")
    assert void.columns == ["id", "nothing", "v"] and void.schema["nothing"].dataType.simpleString() == "void"


ODD_KEYS = {
    "nan": ("double", [float("nan"), 1.5, -0.0, 0.0, None]),
    "binary": ("binary", [b"hot", b"", b"x", None]),
    "struct": ("struct<a:int,b:string>", [(1, "x"), (1, None), (2, "y"), None]),
    "far date": ("date", []),
}


def far_date():
    return F.expr("date_add(date'9999-12-30', cast(id % 4 as int))").alias("k")


@pytest.mark.parametrize("name", list(ODD_KEYS))
def test_odd_keys_that_are_hot_on_both_sides(spark, name):
    kind, values = ODD_KEYS[name]
    if kind == "date":
        facts = spark.range(600).select(F.col("id").alias("n"), far_date())
        lookup = spark.range(80).select(far_date(), F.col("id").alias("a"))
    else:
        pool = [values[0]] * 3 + [values[1]] * 2 + values[2:]
        facts = shuffled(spark, [(i, pool[i % len(pool)]) for i in range(600)], f"n int, k {kind}")
        lookup = shuffled(spark, [(pool[i % len(pool)], i) for i in range(80)], f"k {kind}, a int")
    with no_broadcast(spark):
        result = left_lookup(facts, "k", lookup, broadcast_bytes=0, hot_rows=15)
        expected = facts.join(lookup, "k", "left").select("n", "k", "a")
        digest = [F.count("*"), F.sum("n"), F.sum("a"), F.count("k"), F.bit_xor(F.xxhash64("n", "a"))]
        assert result.agg(*digest).collect() == expected.agg(*digest).collect()
    versions = facts.withColumn("s", F.expr("date_add(date'2020-01-01', cast(n % 50 as int))"))
    closed = close_validity(versions, "k", "s", tie_break=["n"], hot_rows=40)
    window = Window.partitionBy("k").orderBy("s", "n")
    plain = versions.withColumn("end_date", F.date_sub(F.lead("s").over(window), 1))
    digest = [F.count("*"), F.count("end_date"), F.bit_xor(F.xxhash64("n", "s", "end_date"))]
    assert closed.agg(*digest).collect() == plain.agg(*digest).collect()


@pytest.mark.parametrize("case", ["two types", "timestamp", "hashed by the key"])
def test_hot_keys_are_spread_in_every_case(spark, case):
    facts = spark.range(8000).select(
        F.col("id").alias("n"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("int").alias("k")
    )
    lookup = spark.createDataFrame([(7, 1), (9, 2)], "k bigint, a int")
    if case == "timestamp":
        facts, lookup = (side.withColumn("k", F.timestamp_seconds("k")) for side in (facts, lookup))
    if case == "hashed by the key":
        facts, lookup = facts.repartition(8, "k"), lookup.withColumn("k", F.col("k").cast("int"))
    with no_broadcast(spark), settings(spark, spark__sql__adaptive__enabled="false"):
        result = left_lookup(facts, "k", lookup, broadcast_bytes=0, hot_rows=250)
        sizes = result.groupBy("a", F.spark_partition_id().alias("p")).count().where("a = 1").collect()
        assert rows(result) == rows(facts.join(lookup, "k", "left").select("n", "k", "a"))
    assert len(sizes) >= 5


# --- validity ---------------------------------------------------------------------------------------------


def expected_validity(df, ties):
    w = Window.partitionBy("k").orderBy(*[F.asc_nulls_first(c) for c in ("s", *ties)])
    return df.withColumn("end_date", F.date_sub(F.lead("s").over(w).cast("date"), 1))


def test_close_validity_cases(spark):
    data = [
        ("A", 1, D(2020, 1, 1)),
        ("A", 2, D(2021, 1, 1)),
        ("A", 3, D(2021, 1, 1)),
        ("B", 4, D(2020, 3, 1)),
        ("C", 5, None),
        ("C", 6, D(2020, 1, 1)),
        (None, 7, D(2020, 1, 1)),
        (None, 8, D(2020, 1, 2)),
    ]
    result = close_validity(shuffled(spark, data, "k string, id int, s date"), "k", "s")
    assert {r["id"]: r["end_date"] for r in result.collect()} == {
        1: D(2020, 12, 31),
        2: D(2020, 12, 31),
        3: None,
        4: None,
        5: D(2019, 12, 31),
        6: None,
        7: D(2020, 1, 1),
        8: None,
    }


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("start_type", ["date", "timestamp"])
def test_close_validity_of_hot_keys(spark, start_type, coalesce):
    rng = random.Random(3)
    data = []
    for i in range(6000):
        key = rng.choice(["hot", "hot", None, f"k{rng.randrange(400)}"])
        start = rng.choice([None, D(2020, 1, 1), D(2020, 1, 1) + datetime.timedelta(days=rng.randrange(900))])
        data.append((key, i, start))
    df = shuffled(spark, data, "k string, id int, s date").withColumn("s", F.col("s").cast(start_type))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled=coalesce):
        assert {row[KEY] for row in hot_keys(df, "k", 500).collect()} == {"hot", None}
        result = close_validity(df, "k", "s", hot_rows=500)
        assert "NestedLoop" not in plan(result) and "SinglePartition" not in plan(result).split("BroadcastExchange")[0]
        assert result.columns == ["k", "id", "s", "end_date"]
        assert rows(result) == rows(expected_validity(df, ["id"]))
        assert rows(close_validity(df, "k", "s")) == rows(expected_validity(df, ["id"]))


def test_close_validity_cuts_copies_of_one_row(spark):
    data = [("hot", D(2020, 1, 1))] * 3000 + [("hot", D(2021, 1, 1))] + [("cold", D(2020, 5, 5))] * 2
    df = shuffled(spark, data, "k string, s date")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        result = close_validity(df, "k", "s", hot_rows=500)
    assert rows(result) == Counter(
        {
            ("hot", D(2020, 1, 1), D(2019, 12, 31)): 2999,
            ("hot", D(2020, 1, 1), D(2020, 12, 31)): 1,
            ("hot", D(2021, 1, 1), None): 1,
            ("cold", D(2020, 5, 5), D(2020, 5, 4)): 1,
            ("cold", D(2020, 5, 5), None): 1,
        }
    )


def stored_plans(monkeypatch, module):
    """The plans of all frames that a module stores, as they were before."""
    plans, store = [], module.stored

    def recorded(df, *args, **kwargs):
        plans.append(plan(df))
        return store(df, *args, **kwargs)

    monkeypatch.setattr(module, "stored", recorded)
    return plans


def test_hot_versions_take_one_range_exchange(spark, monkeypatch):
    data = [(["hot", "warm"][i % 2], i, D(2020, 1, 1) + datetime.timedelta(days=i % 90)) for i in range(3000)]
    df = stored(shuffled(spark, data, "k string, id int, s date"), "t")
    plans = stored_plans(monkeypatch, validity)
    result = close_validity(df, "k", "s", hot_rows=500)
    whole_rows = [text for text in plans if "MapInArrow" in text or "MapInPandas" in text or "PythonMapInArrow" in text]
    assert len(whole_rows) == 1
    assert whole_rows[0].count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in whole_rows[0]
    assert sum(text.count("rangepartitioning") for text in plans) == 1
    assert "Exchange" not in plan(result.where("k = 'hot'")).split("Union")[0].replace("BroadcastExchange", "")
    assert rows(result) == rows(expected_validity(df, ["id"]))


def test_ties_of_hot_versions_are_settled_across_parts(spark):
    rng = random.Random(8)
    data = [("hot", rng.randrange(30), rng.choice("abc"), D(2020, 1, 1 + rng.randrange(3))) for _ in range(4000)]
    df = shuffled(spark, data, "k string, id int, t string, s date")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        result = close_validity(df, "k", "s", hot_rows=100)
        assert rows(result) == rows(expected_validity(df, ["id", "t"]))


# --- surrogate keys ---------------------------------------------------------------------------------------


def global_numbers(df, order):
    w = Window.orderBy(*[F.asc_nulls_first(c) for c in order])
    return df.select(F.row_number().over(w).alias("key"), *df.columns)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_gapless_key_is_row_number(spark, coalesce):
    rng = random.Random(5)
    data = [
        (rng.choice([None, "same", "same", f"v{rng.randrange(50)}"]), D(2020, 1, 1 + rng.randrange(28)), i)
        for i in range(5000)
    ]
    df = shuffled(spark, data, "a string, d date, id int")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled=coalesce):
        keyed = gapless_key(df, ["a", "d"], "key")
        assert keyed.columns == ["key", "a", "d", "id"]
        assert keyed.schema["key"].dataType.simpleString() == "int"
        assert rows(keyed) == rows(global_numbers(df, ["a", "d", "id"]))


@pytest.mark.parametrize("ties", [["id", "t", "u"], ["u"], []])
def test_gapless_key_with_ties_in_many_parts(spark, ties):
    rng = random.Random(9)
    data = [(rng.choice("ab"), rng.randrange(4), rng.choice([None, "x", "y"]), i) for i in range(3000)]
    df = shuffled(spark, data, "a string, id int, t string, u int")
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = gapless_key(df, ["a"], "key", tie_break=ties)
        columns = ["key", "a", *ties]
        assert rows(found.select(columns)) == rows(global_numbers(df, ["a", *ties]).select(columns))
        assert rows(found.drop("key")) == rows(df)


def test_gapless_key_exchanges_order_values_only(spark, monkeypatch):
    df = shuffled(spark, [(i, f"t{i}", i * 0.5, "more") for i in range(500)], "a int, b string, c double, d string")
    plans = stored_plans(monkeypatch, keys)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        text = plan(gapless_key(df, ["a"], "n"))
    exchanges = re.findall(r"rangepartitioning\((.*?), \d+\)", plans[0])
    assert len(exchanges) == 1 and len(exchanges[0].split(",")) == 3  # the order value, a hash and the source partition
    assert len(plans) == 2 and "rangepartitioning" not in plans[1]  # ends of the parts: no value is cut
    assert "FileScan parquet" in text and "ExistingRDD[a" not in text


def test_gapless_key_of_copies_nulls_and_nothing(spark):
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        copies = gapless_key(shuffled(spark, [("x", 1)] * 2000 + [(None, None)] * 500, "a string, b int"), ["a"], "n")
        result = copies.collect()
        assert sorted(r["n"] for r in result) == list(range(1, 2501))
        assert all((r["a"] is None) == (r["n"] <= 500) for r in result)
    empty = gapless_key(spark.createDataFrame([], "a string"), ["a"], "n", key_type="bigint")
    assert empty.schema.simpleString() == "struct<n:bigint,a:string>"
    assert empty.count() == 0


def test_gapless_key_spreads_copies_over_tasks(spark):
    df = shuffled(spark, [("x", 1)] * 4000, "a string, b int", partitions=8)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        keyed = gapless_key(df, ["a"], "n")
        sizes = keyed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 6


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_gapless_key_numbers_rows_without_a_single_task(spark, coalesce):
    df = spark.range(1000).withColumn("v", F.hash("id"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled=coalesce):
        text = plan(gapless_key(df, ["v"], "n"))
    assert not any(step in text for step in ("SinglePartition", "Window", "hashpartitioning"))


# --- lookups ----------------------------------------------------------------------------------------------


def plain(df, lookups, on):
    for lookup in lookups:
        df = df.join(lookup, on, "left")
    return df


def lookup_data(spark):
    rng = random.Random(11)
    keys = ["hot", None, "absent", "wide"] + [f"k{i}" for i in range(60)]
    weights = [900, 600, 500, 0.2] + [30] * 60
    facts = [(i % 97, rng.choices(keys, weights)[0]) for i in range(4000)] + [(500, "wide")] * 3
    first = [(f"k{i}", i) for i in range(50)] + [("hot", 100), ("hot", 101), (None, 1), (None, 2)]
    second = [(f"k{i}", D(2020, 1, 1)) for i in range(20, 60)] + [("hot", None), ("k20", D(2021, 1, 1))]
    copied = [("wide", "copy")] * 1500 + [("k1", "one"), ("never", "x"), (None, "null")] + [("hot", "h")]
    return (
        shuffled(spark, facts, "n int, k string"),
        shuffled(spark, first, "k string, a int"),
        shuffled(spark, second, "k string, b date"),
        shuffled(spark, copied, "k string, c string"),
    )


@pytest.mark.parametrize("hot_rows", [100, 10**9])
@pytest.mark.parametrize("broadcast_bytes", [0, 4000, 10**9])
def test_left_lookup_is_a_left_join(spark, hot_rows, broadcast_bytes):
    facts, *lookups = lookup_data(spark)
    with no_broadcast(spark):
        result = left_lookup(facts, "k", *lookups, broadcast_bytes=broadcast_bytes, hot_rows=hot_rows)
        assert result.columns == ["n", "k", "a", "b", "c"]
        assert rows(result) == rows(plain(facts, lookups, "k").select("n", "k", "a", "b", "c"))


def test_large_lookups_share_one_shuffle_of_the_main_side(spark):
    facts, first, second, _ = lookup_data(spark)
    with no_broadcast(spark):
        text = plan(left_lookup(facts, "k", first, second, broadcast_bytes=0))
        assert text.count("SortMergeJoin") == 2
        assert text.count("Exchange hashpartitioning") == 3
        assert "BroadcastHashJoin" not in text


@pytest.mark.parametrize("hot", ["hot", None])
def test_hot_keys_and_missing_keys_are_spread(spark, hot):
    facts = shuffled(spark, [(i, hot) for i in range(4000)] + [(i, f"k{i}") for i in range(50)], "n int, k string", 16)
    lookup = spark.createDataFrame([("hot", 1), ("k7", 2)], "k string, a int")
    with no_broadcast(spark), settings(spark, spark__sql__adaptive__enabled="false"):
        result = left_lookup(facts, "k", lookup, broadcast_bytes=0, hot_rows=250)
        sizes = result.groupBy("k", F.spark_partition_id().alias("p")).count().collect()
    assert len([s for s in sizes if s["k"] == hot]) >= 4
    assert max(s["count"] for s in sizes) < 2500


def test_key_that_is_hot_on_both_sides(spark):
    facts = shuffled(spark, [(i, "wide") for i in range(300)] + [(i, f"k{i}") for i in range(20)], "n int, k string")
    lookup = shuffled(spark, [("wide", i) for i in range(200)] + [("other", i) for i in range(200)], "k string, a int")
    with no_broadcast(spark):
        result = left_lookup(facts, "k", lookup, broadcast_bytes=0, hot_rows=50)
        assert rows(result) == rows(facts.join(lookup, "k", "left").select("n", "k", "a"))


@pytest.mark.parametrize("key_type", ["int", "bigint", "string", "date", "timestamp", "timestamp_ntz"])
def test_left_lookup_on_keys_of_other_types(spark, key_type):
    def typed(df, name):
        day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("k"))
        return df.withColumn("k", (F.col("k") if name in ("int", "bigint", "string") else day).cast(name))

    facts = shuffled(spark, [(i, 1) for i in range(400)] + [(i, i % 50) for i in range(200)], "n int, k int")
    repeated = [(2, i) for i in range(300)] + [(None, 1)] * 300
    lookup = shuffled(spark, repeated + [(i, i) for i in range(30)], "k int, a int")
    with no_broadcast(spark):
        for other in {key_type, "bigint" if key_type in ("int", "string") else key_type}:
            left, right = typed(facts, key_type), typed(lookup, other)
            result = left_lookup(left, "k", right, broadcast_bytes=0, hot_rows=50)
            assert rows(result) == rows(left.join(right, "k", "left").select("n", left["k"], "a"))


def test_copies_in_a_lookup_are_spread(spark):
    facts = shuffled(spark, [(1, "wide"), (2, "k1"), (3, None)], "n int, k string", 3)
    lookup = shuffled(spark, [("wide", "copy")] * 4000 + [("k1", "one")], "k string, a string", 16)
    with no_broadcast(spark), settings(spark, spark__sql__adaptive__enabled="false"):
        result = left_lookup(facts, "k", lookup, broadcast_bytes=0, hot_rows=250)
        sizes = result.groupBy("k", F.spark_partition_id().alias("p")).count().collect()
    assert sum(s["count"] for s in sizes if s["k"] == "wide") == 4000
    assert len([s for s in sizes if s["k"] == "wide"]) >= 4


def test_small_lookup_does_not_shuffle_the_main_side(spark):
    facts, first, second, _ = lookup_data(spark)
    with no_broadcast(spark):
        text = plan(left_lookup(facts, "k", first, second))
        assert text.count("BroadcastHashJoin") == 2
        assert "Exchange hashpartitioning" not in text


def test_left_lookup_refuses_columns_of_one_name(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    with pytest.raises(ValueError, match="differ"):
        left_lookup(df, "k", df)
    with pytest.raises(ValueError, match="differ"):
        left_lookup(df.select("k"), "k", df, df)


def test_measured_bytes_bounds_the_text(spark):
    df = spark.createDataFrame([(1, "äö" * 100, D(2020, 1, 1)), (2, None, None)], "a int, t string, d date")
    assert 400 < measured_bytes(df) < 1000
    assert measured_bytes(df.limit(0)) == 0
    assert measured_bytes(df.select(F.array("a"))) is None


def test_resolve_key(spark):
    facts = spark.createDataFrame([("o1", "P1"), ("o2", "PX"), ("o3", None)], "o string, p string")
    dimension = spark.createDataFrame([(7, "P1", "more")], "key int, p string, text string")
    result = resolve_key(facts, dimension, "p", "key")
    assert result.columns == ["o", "p", "key"]
    assert rows(result) == Counter([("o1", "P1", 7), ("o2", "PX", None), ("o3", None, None)])
