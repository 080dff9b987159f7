"""Feeds, tables and the shared folder."""

from __future__ import annotations

import datetime
import os
import uuid

import pytest

from conform.plans.run import Layout, feed_specs, run_bronze
from conform.plans.schemas import RAW_SCHEMAS
from conform.sources import FeedSpec, ingest_feed, qualified_name, read_csv_feed, set_current_catalog, write_table
from conform.sources import read_versions, write_versions
from conform.sources.jobs import side_by_side
from conform.sources.workspace import durable, new_folder, scratch, shared_folder, stored


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def csv(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


CUSTOMERS = (
    "id,key,first,last,status,sex,created\n"
    "1,AW1,  Ann ,Lee,S,F,2024-01-01\n"
    "x,AW2,Bo,,M,M,not a date\n"
    "3,AW3\n"
    '4,"AW,4","",D,S,F,2024-01-04,surplus\n'
)


def test_csv_is_bound_by_position_and_forgiving(spark, tmp_path):
    path = csv(tmp_path, "c.csv", CUSTOMERS)
    df = read_csv_feed(spark, path, RAW_SCHEMAS["crm_cust_info"])
    assert df.columns[:3] == ["cst_id", "cst_key", "cst_firstname"]
    assert [tuple(row) for row in df.collect()] == [
        (1, "AW1", "  Ann ", "Lee", "S", "F", datetime.date(2024, 1, 1)),
        (None, "AW2", "Bo", None, "M", "M", None),
        (3, "AW3", None, None, None, None, None),
        (4, "AW,4", None, "D", "S", "F", datetime.date(2024, 1, 4)),
    ]


def test_rejected_lines_can_be_kept(spark, tmp_path):
    path = csv(tmp_path, "c.csv", CUSTOMERS)
    df = read_csv_feed(spark, path, RAW_SCHEMAS["crm_cust_info"], rejects_column="rejected")
    rejected = {row["cst_key"]: row["rejected"] for row in df.collect()}
    assert rejected["AW1"] is None
    assert rejected["AW3"] == "3,AW3"
    assert all(rejected[key] for key in ("AW2", "AW,4"))


def test_ingest_overwrites_or_appends(spark, tmp_path, database):
    schemas = {"loc": "cid string, cntry string"}
    spec = FeedSpec("erp", csv(tmp_path, "loc.csv", "cid,cntry\nAW-1,DE\n"), "loc", database)
    assert [tuple(r) for r in ingest_feed(spark, spec, schemas).collect()] == [("AW-1", "DE")]
    csv(tmp_path, "loc.csv", "cid,cntry\nAW-2,US\n")
    assert [tuple(r) for r in ingest_feed(spark, spec, schemas).collect()] == [("AW-2", "US")]
    assert ingest_feed(spark, spec, schemas, mode="append").count() == 2


def test_rejected_lines_have_a_table_of_their_own(spark, tmp_path, database):
    spec = FeedSpec("crm", csv(tmp_path, "c.csv", CUSTOMERS), "crm_cust_info", database)
    rejects = qualified_name("rejects", database)
    landed = ingest_feed(spark, spec, RAW_SCHEMAS, rejects=rejects)
    plain = read_csv_feed(spark, spec.path, RAW_SCHEMAS["crm_cust_info"])
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, plain.collect())) and landed.columns == plain.columns
    lines = spark.table(rejects).collect()
    assert sorted(row["line"] for row in lines) == sorted(CUSTOMERS.splitlines()[2:])
    assert {(row["feed"], row["file"].rsplit("/", 1)[-1]) for row in lines} == {("crm_cust_info", "c.csv")}
    csv(tmp_path, "c.csv", "header\n1,AW1,Ann,Lee,S,F,2024-01-01\n")
    assert ingest_feed(spark, spec, RAW_SCHEMAS, rejects=rejects).count() == 1
    assert spark.table(rejects).count() == 0
    with pytest.raises(ValueError, match="rejected"):
        ingest_feed(spark, spec, RAW_SCHEMAS, mode="append", rejects=rejects)


def test_table_with_other_columns_or_format_is_replaced(spark, database):
    name = qualified_name("t", database)
    write_table(spark.range(3), name)
    write_table(spark.range(4).selectExpr("id", "'x' as v"), name)
    assert spark.table(name).columns == ["id", "v"] and spark.table(name).count() == 4
    write_table(spark.range(5).selectExpr("id", "'x' as v"), name, table_format="orc")
    assert spark.table(name).count() == 5
    write_table(spark.range(2).selectExpr("id", "'x' as v", "1 as hidden"), name, table_format="orc", columns=["id", "v"])
    assert spark.table(name).columns == ["id", "v"] and spark.table(name).count() == 2


@pytest.mark.parametrize("parallel", [1, 4])
def test_run_bronze_lands_every_feed(spark, tmp_path, database, parallel):
    layout = Layout(bronze=database)
    specs = feed_specs(layout, str(tmp_path))
    assert [(spec.source, spec.table) for spec in specs] == [
        ("crm", "crm_cust_info"),
        ("crm", "crm_prd_info"),
        ("crm", "crm_sales_details"),
        ("erp", "erp_cust_az12"),
        ("erp", "erp_loc_a101"),
        ("erp", "erp_px_cat_g1v2"),
    ]
    for i, spec in enumerate(specs):
        csv(tmp_path, spec.path.removeprefix(str(tmp_path) + "/"), "header\n" + "1\n" * (i + 1))
    assert [df.count() for df in run_bronze(spark, layout, specs, parallel)] == [1, 2, 3, 4, 5, 6]
    landed = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert landed == set(RAW_SCHEMAS)


def test_table_format_is_a_parameter(spark, database):
    name = qualified_name("t", database)
    write_table(spark.range(3), name, table_format="orc")
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert detail["Provider"].lower() == "orc"
    assert spark.table(name).count() == 3


def test_names_and_catalog(spark):
    assert qualified_name("t", "s", "my-catalog") == "`my-catalog`.`s`.`t`"
    assert qualified_name("a`b") == "`a``b`"
    set_current_catalog(spark, "spark_catalog")
    assert spark.catalog.currentCatalog() == "spark_catalog"


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert new_folder(spark, "x").startswith(folder + "/conform-x-")
    assert durable(spark.range(5)).count() == 5


def test_scratch_removes_what_was_stored_inside(spark, tmp_path):
    with scratch(spark) as made:
        frames = side_by_side([lambda n=n: stored(spark.range(n), "part") for n in (3, 4)], 2)
        kept = stored(frames[0].unionAll(frames[1]), "kept")
        assert kept.count() == 7 and len(made) == 3 and all(map(os.path.isdir, made))
        place = made.pop()
    assert not any(map(os.path.exists, made)) and kept.count() == 7
    assert stored(spark.range(2), "outside").count() == 2 and os.path.isdir(place)


def test_versions_are_read_from_their_own_files(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "a", datetime.date(2020, 1, 1)), (1, "b", None), (2, None, None), (3, "c", datetime.date(2021, 1, 1))],
        "key long, name string, end_date date",
    )
    write_versions(df, f"{tmp_path}/versions")
    current = read_versions(spark, f"{tmp_path}/versions", df.schema, current=True)
    ended = read_versions(spark, f"{tmp_path}/versions", df.schema, current=False)
    assert current.schema == df.schema and {(r.key, r.name) for r in current.collect()} == {(1, "b"), (2, None)}
    assert {(r.key, r.name) for r in ended.collect()} == {(1, "a"), (3, "c")}
    assert read_versions(spark, f"{tmp_path}/versions", df.schema).count() == 4
    # The folders alone decide which files are read: ended versions that are no Parquet at all go unnoticed.
    for part in os.listdir(f"{tmp_path}/versions/is_current=false"):
        if part.endswith(".parquet"):
            (tmp_path / "versions" / "is_current=false" / part).write_text("not to be read")
    spark.catalog.refreshByPath(f"{tmp_path}/versions")
    again = read_versions(spark, f"{tmp_path}/versions", df.schema, current=True)
    assert again.count() == 2 and "PartitionFilters: [isnotnull(is_current" in again._jdf.queryExecution().toString()
    write_versions(df.limit(0), f"{tmp_path}/none")
    assert read_versions(spark, f"{tmp_path}/none", df.schema, current=True).collect() == []
    with pytest.raises(ValueError, match="is_current"):
        write_versions(df.withColumnRenamed("name", "is_current"), f"{tmp_path}/clash")
