"""Upserts and history, as functions and as stored tables."""

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from plantlake.functions.hashing import row_hash
from plantlake.operators.history import OPEN_END, apply_history, as_of_join, first_versions
from plantlake.config import LakeConfig
from plantlake.operators.merge import compared_rows, merge_insert_only, merge_upsert, replace_rows
from plantlake.sources.store import Lake

SCHEMA = "id string, v int, note string, row_hash string"


def rows(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [("same", 1, "t", "h1"), ("changed", 1, "t", "h1"), ("unhashed", 1, "t", None),
         ("alone", 1, "t", "h1"), (None, 1, "t", "h1")], SCHEMA)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame(
        [("same", 9, "s", "h1"), ("changed", 2, "s", "h2"), ("unhashed", 2, "s", "h2"),
         ("new", 2, "s", "h2"), (None, 2, "s", "h2")], SCHEMA)


def test_guarded_upsert(target, source):
    merged = merge_upsert(target, source, "id", "row_hash")
    expected = {
        ("same", 1, "t", "h1"), ("changed", 2, "s", "h2"), ("unhashed", 2, "s", "h2"),
        ("alone", 1, "t", "h1"), ("new", 2, "s", "h2"), (None, 1, "t", "h1"),
    }
    assert rows(merged) == expected
    assert merged.count() == 6
    again = merge_upsert(merged, source, "id", "row_hash")
    assert rows(again) == expected and again.count() == 6
    found = compared_rows(target.unionAll(target), source.where("id is not null"), "id", "row_hash")
    assert {(r["id"], r["is_new"]) for r in found.collect()} == {
        ("changed", False), ("unhashed", False), ("new", True)}
    replaced = replace_rows(target.unionAll(target), source, "id")
    assert replaced.where("id = 'same' and v = 9").count() == 2 and replaced.count() == 10
    twice = merge_upsert(target, source.unionAll(source.selectExpr("id", "v + 1", "note", "row_hash")),
                         "id", latest_by=["v"])
    assert twice.count() == 6 and twice.where("id = 'new' and v = 3").count() == 1


def test_unguarded_and_insert_only(target, source):
    assert ("same", 9, "s", "h1") in rows(merge_upsert(target, source, "id"))
    inserted = merge_insert_only(target, source, "id")
    assert inserted.count() == 6
    assert ("changed", 1, "t", "h1") in rows(inserted)


HISTORY_BATCH = "id string, status string, ts timestamp_ntz, row_hash string"
DAYS = [datetime(2024, 1, d) for d in range(1, 10)]


def check_intervals(history):
    by_id = {}
    for r in history.orderBy("id", "effective_start", "effective_end").collect():
        by_id.setdefault(r["id"], []).append(r)
    for versions in by_id.values():
        assert sum(r["is_current"] for r in versions) <= 1
        for older, newer in zip(versions, versions[1:]):
            assert older["effective_end"] <= newer["effective_start"]
        assert all(r["effective_start"] <= r["effective_end"] for r in versions)
    return by_id


def test_history_over_runs(spark):
    runs = [
        ([("a", "x", DAYS[2], "h1"), ("b", "x", None, "h1")], DAYS[3]),
        ([("a", "y", DAYS[4], "h2"), ("b", "x", DAYS[5], "h1"), ("c", "x", DAYS[4], "h1")], DAYS[5]),
        # Late rows: before all versions, and within a version that has ended.
        ([("a", "z", DAYS[0], "h3"), ("b", "y", None, "h2")], DAYS[6]),
        ([("a", "w", DAYS[3], "h4"), ("c", "x", DAYS[2], "h1")], DAYS[7]),
        ([("a", "w", DAYS[3], "h4"), ("a", "v", DAYS[1], "h5")], DAYS[8]),
    ]
    history = None
    for data, as_of in runs:
        batch = spark.createDataFrame(data, HISTORY_BATCH)
        if history is None:
            history = first_versions(batch, "id", "ts", as_of)
        else:
            history = apply_history(history, batch, "id", "ts", "row_hash", as_of)
        history = spark.createDataFrame(history.collect(), history.schema)
    found = check_intervals(history)
    assert [(r["status"], r["effective_start"], r["effective_end"], r["is_current"]) for r in found["a"]] == [
        ("z", DAYS[0], DAYS[2], False), ("x", DAYS[2], DAYS[3], False), ("w", DAYS[3], DAYS[4], False),
        ("y", DAYS[4], OPEN_END, True)]
    assert [r["effective_start"] for r in found["b"]] == [DAYS[3], DAYS[6]]
    assert len(found["c"]) == 1

    events = spark.createDataFrame(
        [("e1", "a", DAYS[1]), ("e2", "a", DAYS[2]), ("e3", "a", DAYS[4]), ("e4", "q", DAYS[4])],
        "event string, id string, at timestamp_ntz")
    joined = {r["event"]: r["status"] for r in as_of_join(events, history, "id", "at").collect()}
    assert joined == {"e1": "z", "e2": "x", "e3": "y", "e4": None}


def test_missing_hash_opens_no_version(spark):
    first = spark.createDataFrame([("a", "x", DAYS[2], None)], HISTORY_BATCH)
    history = first_versions(first, "id", "ts", DAYS[3])
    hashed = [("status", "text")]
    same = spark.createDataFrame([("a", "x", DAYS[4])], "id string, status string, ts timestamp_ntz")
    same = same.withColumn("row_hash", row_hash(hashed))
    kept = apply_history(history, same, "id", "ts", "row_hash", DAYS[5], hashed).collect()
    assert len(kept) == 1 and kept[0]["is_current"] and kept[0]["row_hash"] is not None


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, LakeConfig(str(tmp_path), raw=f"raw_{uuid4().hex[:8]}"))
    lake.create_schema(lake.config.raw)
    return lake


def files(table):
    return {r["f"] for r in table.spark.table(table.name).select(F.input_file_name().alias("f")).collect()}


def test_keyed_table(lake, target, source):
    table = lake.keyed(lake.config.raw, "t", target.schema, "id", key_groups=4)
    assert not table.exists() and table.read().isEmpty()
    with_key = target.where("id is not null")
    assert table.load(with_key) == 4
    table.upsert(source, "row_hash")
    expected = rows(merge_upsert(with_key, source, "id", "row_hash"))
    assert rows(table.read()) == expected
    before = files(table)
    table.upsert(source, "row_hash")
    assert files(table) == before, "an unchanged batch wrote data"
    table.upsert(source.where("id = 'same'"))
    assert ("same", 9, "s", "h1") in rows(table.read())
    assert table.read().count() == len(expected)
    with pytest.raises(ValueError):
        lake.keyed(lake.config.raw, "t", target.schema, "id", key_groups=8).read()
    with pytest.raises(ValueError):
        table.load(source)


@pytest.mark.parametrize("logged", [False, True])
def test_split_table(spark, lake, target, source, logged):
    """Several buckets a group, with keys that the first load has twice, as an unbucketed table takes them."""
    first = target.unionAll(target).where("id is not null")
    more = spark.range(60).selectExpr("concat('k', id % 50) id", "cast(id as int) v", "'m' note", "concat('h', id % 7) row_hash")
    steps = [(source, "row_hash"), (more, "row_hash"), (more.where("v < 20").withColumn("v", F.col("v") + 100), None)]
    found = []
    for name, layout in (("plain", {}), ("split", {"bucketed": True, "split": 3})):
        table = lake.keyed(lake.config.raw, name, target.schema, "id", 4, logged=logged, **layout)
        table.load(first)
        for batch, hash_col in steps:
            counted = table.upsert(batch, hash_col, latest_by=["v"])
            assert counted == batch.where("id is not null").select("id").distinct().count()
        found.append(sorted(map(tuple, table.read().collect()), key=repr))
        assert not lake.exists(lake.config.raw, f"{name}_staged")
        before = files(table)
        table.upsert(source.where("id = 'alone'"), "row_hash", latest_by=["v"])
        assert files(table) == before
    assert found[0] == found[1] and len(found[0]) == 59
    for path in files(table):
        bucket = int(path.split("_")[-1].split(".")[0])
        assert bucket < 12 and bucket % 4 == int(path.split("key_group=")[1].split("/")[0])
    with pytest.raises(ValueError, match="buckets"):
        lake.keyed(lake.config.raw, "split", target.schema, "id", 4, bucketed=True).read()


def test_new_keys_only_add_files(spark, lake):
    schema = "id string, v int, note string, row_hash string"
    old = spark.range(1000).selectExpr("cast(id as string) id", "1 v", "'t' note", "'h' row_hash")
    table = lake.keyed(lake.config.raw, "many", spark.createDataFrame([], schema).schema, "id", 4)
    table.load(old)
    before = files(table)
    new = spark.range(1000, 1040).selectExpr("cast(id as string) id", "1 v", "'t' note", "'h' row_hash")
    assert table.upsert(new, "row_hash") == 40
    added = files(table) - before
    assert before <= files(table) and table.read().count() == 1040
    assert spark.read.parquet(*added).count() == 40
    one = new.limit(1).withColumn("row_hash", F.lit("other"))
    kept = files(table)
    table.upsert(one, "row_hash")
    groups = {f.split("key_group=")[1][0] for f in kept - files(table)}
    assert len(groups) == 1 and table.read().count() == 1040


def test_conflicting_batch_takes_latest(spark, lake):
    batch = spark.createDataFrame(
        [("r1", 1, "old", "h1"), ("r1", 2, "new", "h2"), ("r1", None, "none", "h3")], SCHEMA)
    table = lake.keyed(lake.config.raw, "t", batch.schema, "id", key_groups=2)
    table.upsert(batch, "row_hash", latest_by=["v"])
    assert rows(table.read()) == {("r1", 2, "new", "h2")}


def test_history_table(spark, lake):
    first = spark.createDataFrame([("a", "x", DAYS[2], "h1"), ("b", "x", DAYS[2], "h1")], HISTORY_BATCH)
    second = spark.createDataFrame([("a", "y", DAYS[4], "h2"), ("n", "x", DAYS[4], "h1")], HISTORY_BATCH)
    late = spark.createDataFrame([("a", "w", DAYS[3], "h9")], HISTORY_BATCH)
    schema = first_versions(first, "id", "ts", DAYS[3]).withColumn(
        "version_key", F.lit(0).cast("long")).schema
    table = lake.history(lake.config.raw, "h", schema, "id", key_groups=4)
    for batch in (first, second, second, late, late):
        table.track(batch, "ts", "row_hash", DAYS[5])
    found = check_intervals(table.read())
    assert [r["status"] for r in found["a"]] == ["x", "w", "y"]
    assert len(found["b"]) == len(found["n"]) == 1
    keys = [r["version_key"] for r in table.read().collect()]
    assert len(keys) == len(set(keys)) == 5
