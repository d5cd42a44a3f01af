import datetime as dt
import random
from pathlib import Path

import pytest
from conftest import one, rows
from pyspark.sql import functions as F

from wardline.operators import history, upsert
from wardline.operators.dedup import first_per_key
from wardline.sources import files, versions
from wardline.sources.versions import VersionedTable

SCHEMA = "id int, v string, year_month string"


def table(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def stored(spark, path):
    return rows(spark.read.parquet(path).selectExpr("id", "v", "cast(year_month as string) m"))


def test_merge_rows(spark):
    target = table(spark, (1, "a", "m"), (2, "b", "m"), (None, "n", "m"))
    updates = table(spark, (2, "B", "m"), (3, "c", "m"), (None, "N", "m"))
    once = upsert.merge_rows(target, updates, ["id"])
    assert rows(once, "id", "v") == sorted(
        [(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "N")], key=repr
    )
    keyed = upsert.merge_rows(target.filter("id is not null"), updates.filter("id is not null"), ["id"])
    assert rows(upsert.merge_rows(keyed, updates.filter("id is not null"), ["id"])) == rows(keyed)


def test_merge_rows_adds_columns(spark):
    updates = spark.createDataFrame([(3, "c", "m", "x")], SCHEMA + ", extra string")
    merged = upsert.merge_rows(table(spark, (1, "a", "m")), updates, ["id"])
    assert rows(merged, "id", "extra") == [(1, None), (3, "x")]


def months(spark, path):
    return VersionedTable(spark, path, ("year_month",))


def test_replaced_months(spark, folder):
    path = f"{folder}/t"
    first = table(spark, (1, "a", "2024-01"), (2, "b", "2024-02"), (3, "c", "2024-03"), (4, "d", None))
    upsert.replace_months(spark, path, first)
    # From February on: March has lost its rows, April is new; what lies before stays.
    upsert.replace_months(spark, path, table(spark, (5, "e", "2024-02"), (6, "f", "2024-04"), (7, "g", "2024-01")), "2024-02")
    kept = [(1, "a", "2024-01"), (5, "e", "2024-02"), (6, "f", "2024-04"), (4, "d", None)]
    assert rows(months(spark, path).read()) == sorted(kept, key=repr)
    upsert.replace_months(spark, path, table(spark), "2024-02")
    assert rows(months(spark, path).read()) == sorted([kept[0], kept[3]], key=repr)
    upsert.replace_months(spark, path, table(spark, (9, "z", "2024-09")))
    assert rows(months(spark, path).read()) == [(9, "z", "2024-09")]


def parts(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def held(spark, path):
    return rows(upsert.keyed_table(spark, path).read(), "id", "v", "year_month")


def test_upsert(spark, folder):
    path = f"{folder}/t"
    first = table(spark, (1, "a", "2024-01"), (2, "b", "2024-02"), (4, "d", "2024-03"), (5, "e", None), (None, "n", "2024-03"))
    upsert.upsert(spark, path, first, ["id"], 4)
    before = parts(path)
    # 1 is changed, 2 moves to another month and leaves its own empty, 3 is new, 5 gets a month.
    updates = table(spark, (1, "A", "2024-01"), (2, "B", "2024-01"), (3, "c", "2024-04"), (5, "E", "2024-04"))
    version = upsert.upsert(spark, path, updates, ["id"])
    expected = [
        (1, "A", "2024-01"), (2, "B", "2024-01"), (3, "c", "2024-04"), (4, "d", "2024-03"), (5, "E", "2024-04"),
        (None, "n", "2024-03"),
    ]
    assert held(spark, path) == sorted(expected, key=repr)
    assert not any("2024-02" in f for f in version.folders)
    march = {f for f in before if "2024-03" in f}
    assert march and all(parts(path)[f] == before[f] for f in march)
    upsert.upsert(spark, path, updates, ["id"])
    assert held(spark, path) == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="keyed by"):
        upsert.upsert(spark, path, updates, ["v"])


def test_late_row_rewrites_one_bucket_of_its_month(spark, folder):
    path = f"{folder}/t"
    many = spark.range(4000).selectExpr("cast(id as int) id", "'a' v", "concat('2024-0', 1 + id % 4) year_month")
    upsert.upsert(spark, path, many, ["id"], 8)
    version = upsert.upsert(spark, path, table(spark, (8, "late", "2024-01")), ["id"])
    new = [f for f in version.folders if f.startswith("_v=2/")]
    assert len(new) == 1 and len(version.folders) == 32
    read = upsert.keyed_table(spark, path).read()
    assert read.count() == 4000 and one(read.filter("v = 'late'").select("id")) == (8,)


def test_upsert_with_new_columns(spark, folder):
    path = f"{folder}/t"
    upsert.upsert(spark, path, table(spark, (1, "a", "2024-01"), (4, "d", "2024-05")), ["id"])
    for n, month in ((2, "2024-02"), (3, "2024-01")):
        wide = spark.createDataFrame([(n, "b", month, "x")], SCHEMA + ", extra string")
        upsert.upsert(spark, path, wide, ["id"])
    upsert.upsert(spark, path, table(spark, (4, "D", "2024-05")), ["id"])
    merged = upsert.keyed_table(spark, path).read()
    assert rows(merged, "id", "extra") == [(1, None), (2, "x"), (3, "x"), (4, None)]
    with pytest.raises(ValueError, match="column v"):
        upsert.upsert(spark, path, spark.createDataFrame([(1, 2, "m")], "id int, v int, year_month string"), ["id"])


@pytest.mark.parametrize("step", ["write", "commit", "create_text", "clean"])
def test_upsert_that_dies(spark, folder, monkeypatch, step):
    """Whatever step dies, readers see the table before or after it, and a repeat completes it."""
    path = f"{folder}/t"
    upsert.upsert(spark, path, table(spark, (1, "a", "2024-01"), (2, "b", "2024-01"), (3, "c", "2024-02")), ["id"], 2)
    before, updates = held(spark, path), table(spark, (2, "B", "2024-03"), (4, "d", "2024-02"))
    after = [(1, "a", "2024-01"), (2, "B", "2024-03"), (3, "c", "2024-02"), (4, "d", "2024-02")]

    def dies(*args, **kw):
        if step == "write":  # half of the rows are out
            args[1].limit(1).write.mode("overwrite").partitionBy(*args[0].layout).parquet(f"{path}/data/_v={args[2]}")
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions.files if step == "create_text" else VersionedTable, step, dies)
        with pytest.raises(OSError, match="lost"):
            upsert.upsert(spark, path, updates, ["id"])
    assert held(spark, path) == (after if step == "clean" else before)
    upsert.upsert(spark, path, updates, ["id"])
    assert held(spark, path) == after
    live = {f for n in versions_of(spark, path)[-versions.KEEP :] for f in upsert.keyed_table(spark, path).version(n).folders}
    on_disk = {str(p.parent.relative_to(f"{path}/data")) for p in Path(f"{path}/data").rglob("*.parquet")}
    assert on_disk == live


def versions_of(spark, path):
    return upsert.keyed_table(spark, path)._numbers()


def test_readers_keep_their_version(spark, folder):
    path = f"{folder}/t"
    upsert.upsert(spark, path, table(spark, (1, "a", "2024-01")), ["id"])
    reader = upsert.keyed_table(spark, path).read()
    upsert.upsert(spark, path, table(spark, (1, "b", "2024-02")), ["id"])
    assert rows(reader, "id", "v") == [(1, "a")] and held(spark, path) == [(1, "b", "2024-02")]


def test_second_writer_fails(spark, folder):
    t = VersionedTable(spark, f"{folder}/t")
    data = table(spark, (1, "a", "m"))
    before, number = t.next_number()
    t.commit(before, t.write(data, number), data.schema)
    with pytest.raises(FileExistsError):
        t.commit(before, [], data.schema)
    assert rows(t.read()) == [(1, "a", "m")]
    with pytest.raises(ValueError, match="no version 7"):
        t.version(7)


T1, T2, T3, T4 = (dt.datetime(2024, m, 1) for m in (1, 2, 3, 4))


def snapshot(spark, *data):
    return spark.createDataFrame(list(data), "id string, grade string, score int")


def test_history_over_four_runs(spark):
    h = history.start_history(snapshot(spark, ("a", "C", 1), ("b", "A", 2), ("c", None, 3)), T1)
    h = history.apply_snapshot(h, snapshot(spark, ("a", "A", 9), ("b", "A", 99), ("c", None, 4)), "id", ["grade"], T2)
    h = history.apply_snapshot(h, snapshot(spark, ("a", "A", 9), ("d", "B", 5)), "id", ["grade"], T3)
    h = history.apply_snapshot(h, snapshot(spark, ("a", "A", 9), ("b", "A", 7), ("d", "B", 5)), "id", ["grade"], T4)
    assert rows(h, "id", "grade", "score", "valid_from", "valid_to") == sorted(
        [
            ("a", "C", 1, T1, T2), ("a", "A", 9, T2, None),
            ("b", "A", 2, T1, T3), ("b", "A", 7, T4, None),  # unchanged grade keeps its row; vanishes; returns
            ("c", None, 3, T1, T3),
            ("d", "B", 5, T3, None),
        ],
        key=repr,
    )
    assert rows(history.as_of(h, dt.datetime(2024, 1, 15)), "id", "grade") == [("a", "C"), ("b", "A"), ("c", None)]
    moved = history.transitions(h, "id", "grade", dt.datetime(2024, 1, 15), dt.datetime(2024, 4, 2))
    assert rows(moved) == sorted([("C", "A", 1), ("A", "A", 1)], key=repr)
    # at most one open row per key and no overlaps
    opened = h.filter("valid_to is null").groupBy("id").count().filter("count > 1")
    assert opened.count() == 0
    overlap = h.alias("x").join(h.alias("y"), "id").filter(
        "x.valid_from < y.valid_from and (x.valid_to is null or x.valid_to > y.valid_from)"
    )
    assert overlap.count() == 0


def test_repeated_snapshot_changes_nothing(spark):
    now = snapshot(spark, ("a", "C", 1), ("b", None, 2))
    h = history.start_history(now, T1)
    assert rows(history.apply_snapshot(h, now, "id", ["grade"], T2)) == rows(h)


def test_stored_history(spark, folder):
    snapshots = [
        snapshot(spark, ("a", "C", 1), ("b", "A", 2), ("c", None, 3)),
        snapshot(spark, ("a", "A", 9), ("b", "A", 99), ("c", None, 4)),
        snapshot(spark, ("a", "A", 9), ("d", "B", 5)),
        snapshot(spark, ("a", "A", 9), ("b", "A", 7), ("d", "B", 5)),
    ]
    lazy = history.start_history(snapshots[0], T1)
    history.add_run(spark, folder, snapshots[0], "id", ["grade"], T1, "r1")
    closed = set()
    for moment, now in zip((T2, T3, T4), snapshots[1:]):
        lazy = history.apply_snapshot(lazy, now, "id", ["grade"], moment)
        before = parts(folder)
        version = history.add_run(spark, folder, now, "id", ["grade"], moment, str(moment))
        # Closed rows stay where they were written; open ones are written once a run.
        assert closed <= set(parts(folder)) and all(parts(folder)[f] == before[f] for f in closed)
        closed = {f for f in parts(folder) if "part=closed" in f}
        assert sum("part=open" in f for f in version.folders) == 1
    assert rows(history.read_history(spark, folder)) == rows(lazy)
    assert history.add_run(spark, folder, snapshots[0], "id", ["grade"], T4, str(T4)).number == 4
    with pytest.raises(ValueError, match="not later"):
        history.add_run(spark, folder, snapshots[0], "id", ["grade"], T4, "other")


def test_closed_folders_are_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(history, "FAN", 2)
    lazy, most, tiers = None, 0, set()
    for i in range(9):
        moment = T1 + dt.timedelta(days=i)
        # k0 changes in every run, k1 in every second, k2 comes and goes.
        data = [("k0", str(i)), ("k1", str(i // 2))] + ([("k2", "x")] if i % 3 else [])
        now = spark.createDataFrame(data, "id string, grade string")
        lazy = history.start_history(now, moment) if lazy is None else history.apply_snapshot(lazy, now, "id", ["grade"], moment)
        version = history.add_run(spark, folder, now, "id", ["grade"], moment, str(i))
        closed = [f for f in version.folders if "part=closed" in f]
        most, tiers = max(most, len(closed)), tiers | set(version.facts["tiers"].values())
        assert set(version.facts["tiers"]) == set(closed)
        if i % 4 == 0:
            assert rows(history.read_history(spark, folder)) == rows(lazy)
    # Eight runs closed rows: never more than one folder per tier is left.
    assert most <= 3 and max(tiers) == 3


def test_replay_equals_runs(spark):
    rnd = random.Random(3)
    data = [
        (f"k{rnd.randrange(12)}", dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(200)), rnd.choice("ABC") if rnd.random() < 0.8 else None, i)
        for i in range(150)
    ]
    df = spark.createDataFrame(data, "id string, day date, grade string, n int")
    runs = [dt.datetime(2024, m, 20) for m in (1, 2, 3, 5, 6)]
    order = [F.col("day").desc(), F.col("n")]
    lazy = None
    for r in runs:
        now = first_per_key(df.filter(F.col("day") <= F.lit(r.date())), ["id"], order)
        now = now.filter(F.col("day") >= F.lit(r.date() - dt.timedelta(days=25)))
        lazy = history.start_history(now, r) if lazy is None else history.apply_snapshot(lazy, now, "id", ["grade"], r)
    once = history.replay(df, "id", ["grade"], "day", order, runs, 25)
    assert rows(once) == rows(lazy) and once.filter("valid_to is null").count() > 0
    assert history.replay(df.filter("false"), "id", ["grade"], "day", order, runs, 25).count() == 0


@pytest.mark.parametrize("text", [None, "plain"])
def test_small_files(spark, folder, text):
    assert files.read_text(spark, f"{folder}/x.json") is None
    if text:
        files.write_text(spark, f"{folder}/x.json", text)
        files.write_text(spark, f"{folder}/x.json", text + "2")
        assert files.read_text(spark, f"{folder}/x.json") == "plain2"
        assert one(spark.read.text(f"{folder}/x.json")) == ("plain2",)
