"""Upkeep of stored tables: identity keys, small files, catalog views, pruning by the calendar, lookups."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from plantlake.config import LakeConfig
from plantlake.operators.history import as_of_join, as_of_lookup
from plantlake.operators.identity import identity, with_place
from plantlake.operators.merge import compared_rows, replace_rows
from plantlake.plans import reports, views
from plantlake.plans.view_text import publish_views
from plantlake.sources.store import Lake


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, LakeConfig(str(tmp_path), gold=f"gold_{uuid4().hex[:8]}"))
    lake.create_schema(lake.config.gold)
    return lake


def test_identity_is_dense(spark, tmp_path):
    rows = with_place(spark.range(1000, numPartitions=7).where("id % 3 = 0 or id < 200"))
    rows.write.parquet(str(tmp_path / "placed"))
    stored = spark.read.parquet(str(tmp_path / "placed"))
    keys = [r.k for r in stored.select(identity(stored, 41).alias("k")).collect()]
    assert sorted(keys) == list(range(42, 42 + len(keys)))
    none = stored.limit(0)
    assert none.select(identity(none, 0).alias("k")).collect() == []


def paths(lake, table):
    return sorted(Path(lake.config.location(lake.config.gold), table).glob("*=*/*.parquet"))


def test_small_files_are_merged_once(spark, lake):
    gold = lake.config.gold
    name = lake.config.qualify(gold, "log")
    day = F.when(F.col("id") % 3 < 2, F.col("id") % 3).cast("int").alias("day")
    for n in range(12):
        spark.range(n * 30, n * 30 + 30, numPartitions=1).select("id", day).write.mode("append").partitionBy("day").saveAsTable(name)
    spark.range(3).select("id", F.lit(7).alias("day")).coalesce(1).write.mode("append").partitionBy("day").saveAsTable(name)
    before = lake.read(gold, "log").agg(F.count("*"), F.sum(F.xxhash64("id", "day").cast("decimal(20,0)"))).first()
    alone = [p.stat().st_mtime_ns for p in paths(lake, "log") if p.parent.name == "day=7"]
    assert len(paths(lake, "log")) == 37
    assert lake.compact(gold, "log", ["day"]) == 3
    assert len(paths(lake, "log")) == 4
    assert [p.stat().st_mtime_ns for p in paths(lake, "log") if p.parent.name == "day=7"] == alone
    after = lake.read(gold, "log").agg(F.count("*"), F.sum(F.xxhash64("id", "day").cast("decimal(20,0)"))).first()
    assert after == before
    times = [p.stat().st_mtime_ns for p in paths(lake, "log")]
    assert lake.compact(gold, "log", ["day"]) == 0
    assert [p.stat().st_mtime_ns for p in paths(lake, "log")] == times
    # Towards a size that one file does not reach.
    size = paths(lake, "log")[0].stat().st_size
    assert lake.compact(gold, "log", ["day"], file_bytes=size // 2, min_files=1) == 0


def test_calendar_prunes_directories(spark, lake):
    gold = lake.config.gold
    made = [(f"m{i % 2}", 20240101 + i % 20, 1) for i in range(200)]
    lake.overwrite(spark.createDataFrame(made, "equipment_id string, start_date_key int, actual_qty int"), gold, "fact", ["start_date_key"])
    days = [(20240101 + i, date(2024, 1, 1) + timedelta(days=i), (i % 7) > 4) for i in range(31)]
    lake.replace(spark.createDataFrame(days, "date_key int, full_date date, is_weekend boolean"), gold, "dim_date")
    found = reports.production_by_calendar(lake.read(gold, "fact"), lake.read(gold, "dim_date"), date(2024, 1, 4), date(2024, 1, 9))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert sorted((r.full_date.day, r.orders) for r in found.collect()) == [(4, 10), (5, 10), (8, 10), (9, 10)]


def test_catalog_views_in_another_session(spark, lake):
    gold = lake.config.gold
    ts = datetime(2024, 1, 5, 8)
    production = spark.createDataFrame(
        [("p1", "m1", 20240105, 60.0, 10, 9), ("p2", "m1", 20240105, 30.5, 0, None), ("p3", "m2", None, 5.0, 1, 1), ("p4", "m2", 20240106, 5.0, 0, 1)],
        "production_key string, equipment_id string, start_date_key int, duration_minutes double, planned_qty int, actual_qty int")
    maintenance = spark.createDataFrame([("k1", "m1", 20240105, 12.5), ("k2", "m2", 20240106, None)], "maintenance_key string, equipment_id string, start_date_key int, downtime_minutes double")
    quality = spark.createDataFrame([("m1", 20240105, 8, 2), ("m3", 20240105, 0, 0)], "equipment_id string, date_key int, total_quantity int, failed_quantity int")
    equipment = spark.createDataFrame([("m1", "one"), ("m2", "two"), ("m3", "three")], "equipment_id string, equipment_name string")
    dates = spark.createDataFrame([(20240105, ts.date()), (20240106, date(2024, 1, 6))], "date_key int, full_date date")
    tables = {"fact_production": production, "fact_maintenance": maintenance, "fact_quality": quality, "dim_equipment": equipment, "dim_date": dates}
    for name, frame in tables.items():
        lake.replace(frame, gold, name)
    name = lake.config.qualify(gold, "oee_daily_view")
    lake.publish_view(gold, "oee_daily_view", "SELECT 1 AS x")
    assert spark.newSession().table(name).columns == ["x"]
    publish_views(lake)
    other = spark.newSession()
    expected = views.oee_daily(production, maintenance, quality, dates, equipment)
    found = other.table(name).select(expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    critical = views.critical_equipment(maintenance, quality, equipment)
    found = other.table(lake.config.qualify(gold, "critical_equipment_view")).select(critical.columns)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, critical.collect()), key=repr)


@pytest.mark.parametrize("bucket_days", [None, 1, 30])
def test_lookup_equals_the_join(spark, bucket_days):
    rng, start = random.Random(5), datetime(2024, 1, 1)
    versions = []
    for key in ("a", "b", None):
        at = start
        for n in range(60):
            end = at + timedelta(hours=rng.choice([0, 1, 5, 90]))
            if rng.random() < 0.8:
                versions.append((key, f"{key}{n}", at, end))
            at = end
    events = [(n, rng.choice(["a", "b", "c", None]), rng.choice([None, start + timedelta(hours=rng.randrange(-50, 2500))])) for n in range(600)]
    history = spark.createDataFrame(versions, "id string, state string, effective_start timestamp_ntz, effective_end timestamp_ntz")
    frame = spark.createDataFrame(events, "n int, id string, ts timestamp_ntz")
    wanted = as_of_join(frame, history, "id", "ts")
    found = as_of_lookup(frame, history, "id", "ts", bucket_days)
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


@pytest.mark.parametrize("bucket_days", [None, 30])
def test_many_versions_of_one_machine_make_no_product(spark, bucket_days):
    start = F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    history = spark.range(10_000).select(
        F.lit("m").alias("machine"), F.col("id").alias("version"), start.alias("effective_start"),
        F.timestamp_add("MINUTE", F.lit(1), start).alias("effective_end"),
    )
    events = spark.range(20_000).select(F.lit("m").alias("machine"), "id", F.timestamp_add("SECOND", (F.col("id") * 37).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    found = as_of_lookup(events, history, "machine", "ts", bucket_days)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.where(F.floor(F.col("id") * 37 / 60) == F.col("version")).count() == found.where("version is not null").count() == 16217


def exchanges(df):
    """Shuffles of a plan, each with the tables and folders scanned below it."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(plan):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            below = []
            for under in plan[i + 1 :]:
                if len(under) - len(under.lstrip(" :+-*(0123456789)")) <= depth:
                    break
                below.append(under)
            found.append(" ".join(x for x in below if "FileScan" in x))
    return found


def test_bucketed_upsert_leaves_the_table_in_place(spark, lake):
    gold = lake.config.gold

    def rows(first, last, tag):
        return spark.range(first, last).select(
            F.concat(F.lit("K"), "id").alias("k"), F.lit(tag).alias("v"), F.md5(F.lit(tag)).alias("h")
        )

    table = lake.keyed(gold, "orders", rows(0, 0, "a").schema, "k", key_groups=4, bucketed=True)
    assert table.load(rows(0, 200, "a")) == 200
    # A key's group is its bucket, also the one in the file's name.
    for path in paths(lake, "orders"):
        assert int(path.stem.split("_")[-1].split(".")[0]) == int(path.parent.name.split("=")[1])
    assert table.upsert(rows(190, 210, "b"), "h") == 20
    assert table.upsert(rows(190, 210, "b"), "h") == 20
    found = {r.k: r.v for r in table.read().collect()}
    assert found == {f"K{i}": "b" if i >= 190 else "a" for i in range(210)}
    files = paths(lake, "orders")
    one = table.read().where("k = 'K5'").select("k", F.lit("c").alias("v"), F.lit("c").alias("h"))
    assert table.upsert(spark.createDataFrame(one.collect(), one.schema), "h") == 1
    assert len({p.parent for p in set(files) - set(paths(lake, "orders"))}) == 1

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        batch = table._stage(table._grouped(rows(0, 30, "d")), "plan")
        stored = spark.table(table.name)
        compared = exchanges(compared_rows(stored.drop("key_group"), batch, "k", "h"))
        replaced = exchanges(replace_rows(stored, batch, "k"))
        for scans in (compared, replaced):
            assert scans and all(f"{gold}.orders" not in s for s in scans)
        plain = lake.keyed(gold, "plain", rows(0, 0, "a").schema, "k", key_groups=4)
        plain.load(rows(0, 200, "a"))
        assert any(f"{gold}.plain" in s for s in exchanges(replace_rows(spark.table(plain.name), batch, "k")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    with pytest.raises(ValueError, match="buckets"):
        lake.keyed(gold, "orders", rows(0, 0, "a").schema, "k", key_groups=4)._stored()
