import datetime as dt
import os
import re
from pathlib import Path

import pytest
from conftest import one, plan_of, rows
from pyspark.sql import functions as F

from wardline.context import RunContext
from wardline.plans.staging import new_rows
from wardline.sources import extract, files, tables
from wardline.streaming import ingest, ingest_files, read_raw_table, validate_batch


def run(n):
    return RunContext(as_of=dt.date(2024, 3, n), run_ts=dt.datetime.now(), run_id=f"r{n}")


def land(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/raw/{name}")


def test_files_are_taken_once_and_columns_may_be_added(spark, folder):
    def ingest(n):
        return ingest_files(spark, f"{folder}/raw/*", f"{folder}/table", f"{folder}/cp", run(n))

    land(spark, folder, "a", [("1", "x"), ("2", "y")], "id string, v string")
    assert ingest(1) == 2
    assert ingest(2) == 0
    land(spark, folder, "b", [("3", "z", "new")], "id string, v string, extra string")
    assert ingest(3) == 1
    land(spark, folder, "c", [("4", "w")], "id string, v string")
    assert ingest(4) == 1
    table = read_raw_table(spark, f"{folder}/table")
    assert rows(table, "id", "extra", "_job_run_id") == [
        ("1", None, "r1"), ("2", None, "r1"), ("3", "new", "r3"), ("4", None, "r4"),
    ]
    assert validate_batch(table, "r3") == 1
    assert validate_batch(table) == 4
    with pytest.raises(ValueError, match="no rows"):
        validate_batch(table, "r2")
    with pytest.raises(ValueError, match="missing"):
        validate_batch(table.drop("_row_hash"))
    with pytest.raises(ValueError, match="NULL lineage"):
        validate_batch(table.withColumn("_source_file", F.lit(None).cast("string")))


def test_columns_of_files_with_old_times_are_kept(spark, folder):
    def ingest(n):
        return ingest_files(spark, f"{folder}/raw/*", f"{folder}/table", f"{folder}/cp", run(n))

    land(spark, folder, "a", [("1",)], "id string")
    assert ingest(1) == 1
    land(spark, folder, "b", [("2", "kept")], "id string, extra string")
    for path in Path(folder, "raw", "b").iterdir():
        os.utime(path, (1_000_000_000, 1_000_000_000))
    assert ingest(2) == 1
    assert rows(read_raw_table(spark, f"{folder}/table"), "id", "extra") == [("1", None), ("2", "kept")]


def test_columns_that_change_their_type(spark, folder):
    def ingest(n, **kw):
        return ingest_files(spark, f"{folder}/raw/*", f"{folder}/table", f"{folder}/cp", run(n), **kw)

    land(spark, folder, "a", [(1, 1, 1.5, "s")], "id int, v int, w float, t string")
    assert ingest(1) == 1
    # Wider numbers, a text where a number was, and a number where a text was; with the old form
    # again in the same batch, and a type that no text column can hold as it is.
    land(spark, folder, "b", [(2**40, "7", 2.5, 5), (2, "seven", 0.1, 6)], "id long, v string, w double, t int")
    land(spark, folder, "c", [(3, 3, 3.5, "u")], "id int, v int, w float, t string")
    land(spark, folder, "d", [(4, [1, 2])], "id int, v array<int>")
    assert ingest(2) == 4
    land(spark, folder, "e", [(5, 9, 0.5, "z")], "id int, v int, w float, t string")
    assert ingest(3) == 1
    table = read_raw_table(spark, f"{folder}/table")
    assert dict(table.dtypes)["id"] == "bigint" and dict(table.dtypes)["w"] == "double"
    assert rows(table, "id", "v", "v__text", "t") == sorted(
        [
            (1, 1, None, "s"), (2**40, 7, "7", "5"), (2, None, "seven", "6"), (3, 3, None, "u"),
            (4, None, '{"v":[1,2]}', None), (5, 9, None, "z"),
        ],
        key=repr,
    )
    assert sorted(r.w for r in table.filter("w is not null").collect()) == [0.1, 0.5, 1.5, 2.5, 3.5]


def test_many_files_come_in_bounded_batches(spark, folder, monkeypatch):
    spark.range(60).selectExpr("cast(id as string) id").repartition(30).write.parquet(f"{folder}/raw/a")
    sizes = []
    real = ingest.same_schema_groups
    monkeypatch.setattr(ingest, "same_schema_groups", lambda s, p: (sizes.append(len(p)), real(s, p))[1])
    assert ingest_files(spark, f"{folder}/raw", f"{folder}/t", f"{folder}/cp", run(1), max_files=8) == 60
    assert max(sizes) == 8 and sum(sizes) == 30
    assert read_raw_table(spark, f"{folder}/t").select("id").distinct().count() == 60


def test_new_rows_skip_older_days(spark, folder):
    land(spark, folder, "a", [("1",)], "id string")
    ingest_files(spark, f"{folder}/raw/*", f"{folder}/table", f"{folder}/cp", run(1))
    plan = plan_of(new_rows(read_raw_table(spark, f"{folder}/table"), dt.datetime(2024, 1, 1)))
    assert re.search(r"PartitionFilters: \[.*_ingest_date", plan)


def test_same_row_has_the_same_hash_in_every_run(spark, folder):
    for n in (1, 2):
        land(spark, folder, f"f{n}", [("1", "x")], "id string, v string")
        ingest_files(spark, f"{folder}/raw/*", f"{folder}/table", f"{folder}/cp", run(n))
    table = read_raw_table(spark, f"{folder}/table")
    assert table.count() == 2
    assert table.select("_row_hash").distinct().count() == 1


def test_two_feeds_fill_one_table(spark, folder):
    for feed in ("historic", "current"):
        land(spark, folder, feed, [(feed, "x")], "id string, v string")
        ingest_files(spark, f"{folder}/raw/{feed}", f"{folder}/table", f"{folder}/cp", run(1), feed)
    table = read_raw_table(spark, f"{folder}/table", ["historic", "current", "never"])
    assert rows(table, "id") == [("current",), ("historic",)]


def test_cursor_forms():
    assert extract.parse_cursor(None, "d") == extract.Cursor("d")
    assert extract.parse_cursor(" 2020-01-01 ", "d") == extract.Cursor("2020-01-01")
    stored = extract.Cursor("2020-01-01", ("a", "b"))
    assert extract.parse_cursor(stored.to_text(), "d") == stored
    assert extract.parse_cursor('{"date": "x", "pk": "1"}', "d") == extract.Cursor("x", ("1",))
    assert extract.parse_cursor("{broken", "d") == extract.Cursor("{broken")
    ctx = RunContext(as_of=dt.date(2024, 3, 1))
    assert extract.first_watermark("arrests_current", ctx) == "2024-01-01T00:00:00.000"
    assert extract.first_watermark("permits", ctx) == "2020-01-01T00:00:00.000"
    back = extract.lookback_cursor(extract.Cursor("2024-01-31T00:00:00.000", ("1",)), 30)
    assert back == extract.Cursor("2024-01-01T00:00:00.000")


def test_pages_cover_every_row_once(spark, folder):
    data = [(f"2021-01-0{1 + i % 3}", f"J{i % 7}", f"{i:03d}", i) for i in range(50)]
    source = spark.createDataFrame(data, "issuance_date string, job__ string, permit_sequence__ string, n int")
    counts = []
    for n in range(1, 9):
        counts.append(
            extract.extract_new_rows(
                spark, source, "permits", f"{folder}/land", f"{folder}/cursor.json", run(n), page_rows=10
            )
        )
    assert counts == [10, 10, 10, 10, 10, 0, 0, 0]
    landed = spark.read.parquet(f"{folder}/land/run=r*")
    assert {t for _, t in landed.dtypes} == {"string"}
    assert sorted(int(r.n) for r in landed.collect()) == list(range(50))


def test_typed_cursor_and_default_without_a_cap(spark, folder):
    """Numbers compare as numbers: 10 comes after 9, and no row is landed twice."""
    data = [("2021-01-01", "J", n) for n in range(6, 14)]
    source = spark.createDataFrame(data, "issuance_date string, job__ string, permit_sequence__ int")
    where = ("permits", f"{folder}/land", f"{folder}/cursor.json")
    paged = [extract.extract_new_rows(spark, source, *where, run(n), page_rows=3) for n in range(1, 5)]
    assert paged == [3, 3, 2, 0]
    landed = spark.read.parquet(f"{folder}/land/run=r*")
    assert sorted(int(r.permit_sequence__) for r in landed.collect()) == list(range(6, 14))
    whole = ("permits", f"{folder}/all", f"{folder}/all.json")
    assert [extract.extract_new_rows(spark, source, *whole, run(n)) for n in (1, 2)] == [8, 0]
    assert extract.extract_new_rows(spark, source, *whole, run(3), lookback_days=2) == 8


def test_refused_rows_never_land(spark, folder):
    rows_ = [("2021-01-01", "1"), ("2021-01-01", None), ("2021-01-02", "3")]
    schema = "arrest_date string, arrest_key string"
    where = ("arrests_historic", f"{folder}/land", f"{folder}/c.json")
    assert extract.extract_new_rows(spark, spark.createDataFrame(rows_[:1], schema), *where, run(1)) == 1
    for n in (2, 3):  # a null key on the cursor's own date is seen as well
        with pytest.raises(ValueError, match="cursor not moved"):
            extract.extract_new_rows(spark, spark.createDataFrame(rows_, schema), *where, run(n))
    assert spark.read.parquet(f"{folder}/land/run=*").count() == 1


def test_small_files_survive_a_lost_driver(spark, folder):
    path = f"{folder}/state.json"
    files.write_text(spark, path, "one")
    files.write_text(spark, path, "two")
    assert files.read_text(spark, path) == "two"
    files.rename(spark, path, f"{path}.new")  # lost between delete and rename
    assert files.read_text(spark, path) == "two"
    files.write_text(spark, path, "three")
    assert files.read_text(spark, path) == "three"


def test_null_key_stops_the_cursor(spark, folder):
    source = spark.createDataFrame([("2021-01-01", None)], "arrest_date string, arrest_key string")
    with pytest.raises(ValueError, match="cursor not moved"):
        extract.extract_new_rows(
            spark, source, "arrests_historic", f"{folder}/land", f"{folder}/c.json", run(1)
        )
    assert files.read_text(spark, f"{folder}/c.json") is None


def test_names_and_locations():
    assert tables.quoted("a", "b_1") == "`a`.`b_1`"
    assert tables.schema_for(None) == "silver" and tables.schema_for(" gold ") == "gold"
    assert tables.clean_location("s3a://x/y/") == "s3a://x/y"
    for bad in ("", "x/y", None):
        with pytest.raises(ValueError):
            tables.clean_location(bad)
    with pytest.raises(ValueError):
        tables.quoted("a;b")


def test_registered_table(spark, folder):
    spark.range(3).write.parquet(f"{folder}/t")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS tests_gold LOCATION '{folder}/schema'")
    name = tables.register_table(spark, "tests_gold", "numbers", f"{folder}/t")
    assert tables.register_table(spark, "tests_gold", "numbers", f"{folder}/t") == name
    assert tables.scan_nonempty(spark.table(name), name).count() == 3
    spark.sql("DROP SCHEMA tests_gold CASCADE")
    with pytest.raises(ValueError, match="no rows"):
        tables.scan_nonempty(spark.range(0), "empty")


def test_seed_is_all_text(spark, folder):
    with open(f"{folder}/zips.csv", "w") as out:
        out.write("zip_code,borough,neighborhood_name,nta_code\n00501,QUEENS,Here,Q1\n")
    assert one(tables.read_seed(spark, "zip_codes", f"{folder}/zips.csv")) == ("00501", "QUEENS", "Here", "Q1")
