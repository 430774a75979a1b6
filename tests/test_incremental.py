"""Change log, curation of new rows only, facts by touched days, and runs that are lost half-way."""

import random
from datetime import datetime, timedelta
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from plantlake.config import LakeConfig
from plantlake.operators.curate import COMPILED_BYTES, HUGE_METHOD, curate
from plantlake.operators.merge import compared_rows, marked_rows
from plantlake.plans import facts, incremental
from plantlake.plans.build import build_lake, curated_table
from plantlake.plans.entities import PRODUCTION, SENSORS, TABLE_HASH
from plantlake.plans.incremental import ROW_FACTS, curated_batch, new_rows, refresh_hourly, refresh_row_fact
from plantlake.plans.ingest import ingest_all, raw_table
from plantlake.sources.schemas import RAW_TABLES, raw_schema
from plantlake.sources.store import KeyedTable, Lake

ORDERS, READINGS = PRODUCTION.raw, SENSORS.raw
PRODUCTION_FACT = ROW_FACTS[0]
AS_OF = datetime(2024, 3, 1)


@pytest.fixture
def lake(spark, tmp_path):
    run = uuid4().hex[:8]
    lake = Lake(spark, LakeConfig(str(tmp_path), raw=f"raw_{run}", curated=f"cur_{run}", gold=f"gold_{run}"))
    for schema in (lake.config.raw, lake.config.curated, lake.config.gold):
        lake.create_schema(schema)
    return lake


def orders(spark, rows):
    """(number, start or None, quantity, minute of update)"""
    listed = [
        (f"o{i}", f"m{i % 3}", "p", None, None, start, None, "9", str(q), "x", f"2024-02-01 00:{minute:02d}:00")
        for i, start, q, minute in rows
    ]
    return spark.createDataFrame(listed, raw_schema(ORDERS))


def readings(spark, rows):
    """(id, machine, type, value, time)"""
    return spark.createDataFrame([(i, m, "s1", kind, v, t, "u") for i, m, kind, v, t in rows], raw_schema(READINGS))


def files(lake, fact):
    root = Path(lake.config.location(lake.config.gold)) / fact
    found = {}
    for path in root.glob("*=*/**/*.parquet"):
        found.setdefault(str(path.parent.relative_to(root)), set()).add((path.name, path.stat().st_mtime_ns))
    return found


def sorted_rows(df, columns=None):
    return sorted((tuple(r) for r in (df.select(columns) if columns else df).collect()), key=repr)


def curated_orders(lake, spark, rows):
    """Upsert raw orders straight into the curated table, as a run would."""
    batch = curate(orders(spark, rows), PRODUCTION)
    table = curated_table(lake, PRODUCTION, batch, 4)
    table.upsert(batch, TABLE_HASH, latest_by=[PRODUCTION.ts_col])
    return table


def check_fact(lake, table):
    stored = lake.read(lake.config.gold, "fact_production")
    assert sorted_rows(stored, sorted(stored.columns)) == sorted_rows(facts.fact_production(table.read()), sorted(stored.columns))


def test_a_batch_touches_its_days_only(spark, lake):
    day = lambda d: f"2024-01-{d:02d} 08:00:00"
    table = curated_orders(lake, spark, [(i, day(1 + i % 9), i, 0) for i in range(45)] + [(99, None, 1, 0), (98, day(20), 1, 0)])
    assert refresh_row_fact(lake, PRODUCTION_FACT, table) is None
    assert refresh_row_fact(lake, PRODUCTION_FACT, table) == 0
    before = files(lake, "fact_production")
    # One order moves from day 3 to day 5, one of day 5 changes, a new one has day 5.
    curated_orders(lake, spark, [(2, day(5), 2, 1), (4, day(5), 400, 1), (100, day(5), 7, 1), (0, day(1), 0, 1)])
    assert refresh_row_fact(lake, PRODUCTION_FACT, table) == 2
    after = files(lake, "fact_production")
    changed = {d for d in before.keys() | after.keys() if before.get(d) != after.get(d)}
    assert changed == {"start_date_key=20240103", "start_date_key=20240105"}
    check_fact(lake, table)
    # The only order of a day leaves it, another starts, one loses its start.
    curated_orders(lake, spark, [(98, day(1), 1, 2), (99, day(30), 1, 2), (8, None, 8, 2)])
    assert refresh_row_fact(lake, PRODUCTION_FACT, table) == 4
    assert "start_date_key=20240120" not in files(lake, "fact_production")
    check_fact(lake, table)
    # Two batches behind.
    curated_orders(lake, spark, [(98, day(2), 5, 3), (4, day(6), 1, 3)])
    curated_orders(lake, spark, [(98, day(7), 6, 4), (200, day(2), 1, 4)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    check_fact(lake, table)
    before = files(lake, "fact_production")
    curated_orders(lake, spark, [(98, day(7), 6, 5)])
    assert refresh_row_fact(lake, PRODUCTION_FACT, table) == 0 and files(lake, "fact_production") == before


def test_a_second_run_shuffles_its_batch_and_the_touched_days_once(spark, lake, monkeypatch):
    day = lambda d: f"2024-01-{d:02d} 08:00:00"
    monkeypatch.setattr(incremental, "HOT_ROWS", 3, raising=False)
    table = curated_orders(lake, spark, [(i, day(1 + i % 9), i, 0) for i in range(45)] + [(98, day(20), 1, 0)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    shuffles, whole = [], Lake.overwrite_partitions

    def recorded(self, rows, name):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        shuffles.append(sum("Exchange " in line for line in plan.splitlines()))
        whole(self, rows, name)

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(Lake, "overwrite_partitions", recorded)
    try:
        curated_orders(lake, spark, [(i, day(3), 100 + i, 1) for i in range(12)] + [(60, day(3), 1, 1), (61, day(21), 1, 1)])
        refresh_row_fact(lake, PRODUCTION_FACT, table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # The log, the stored table, the fact.
    assert shuffles == [1, 0, 1]
    check_fact(lake, table)
    # All that is left of the touched days goes.
    curated_orders(lake, spark, [(98, None, 1, 2)])
    assert refresh_row_fact(lake, PRODUCTION_FACT, table) == 1
    assert "start_date_key=20240120" not in files(lake, "fact_production")
    check_fact(lake, table)


def test_a_curated_table_without_buckets_stays_so(spark, lake):
    batch = curate(orders(spark, [(i, None, i, 0) for i in range(9)]), PRODUCTION)
    old = lake.keyed(lake.config.curated, PRODUCTION.name, batch.schema, PRODUCTION.key, 4, logged=True)
    old.load(batch)
    table = curated_orders(lake, spark, [(2, None, 70, 1), (40, None, 1, 1)])
    assert not table.bucketed and table.done() == 1
    wanted = {f"o{i}": i for i in range(9)} | {"o2": 70, "o40": 1}
    assert {r.production_order_id: r.actual_quantity for r in table.read().collect()} == wanted


def test_only_touched_partitions_are_read(spark, lake):
    table = curated_orders(lake, spark, [(i, f"2024-01-{1 + i % 9:02d} 08:00:00", i, 0) for i in range(45)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    from plantlake.plans.incremental import Partitions

    wanted = spark.createDataFrame([(20240103,), (20240108,)], "start_date_key int")
    part = Partitions(lake, "fact_production", ["start_date_key"], wanted)
    plan = part.rows()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20240103" in plan.split("PartitionFilters")[1]
    assert {Path(f).parent.name for f in part.rows().inputFiles()} == {"start_date_key=20240103", "start_date_key=20240108"}


def test_null_partition(spark, lake):
    spec = ROW_FACTS[2]
    rows = lambda d, n: [(f"i{i}", "o", "m", "v", d, "x", "yes", "1", "2", None, None, f"2024-02-01 00:{n:02d}:00") for i in range(3)]
    from plantlake.plans.entities import QUALITY

    def put(day, n):
        batch = curate(spark.createDataFrame(rows(day, n), raw_schema(QUALITY.raw)), QUALITY)
        table = curated_table(lake, QUALITY, batch, 2)
        table.upsert(batch, TABLE_HASH, latest_by=[QUALITY.ts_col])
        refresh_row_fact(lake, spec, table)
        stored = lake.read(lake.config.gold, spec.name)
        assert sorted_rows(stored, sorted(stored.columns)) == sorted_rows(facts.fact_quality(table.read()), sorted(stored.columns))
        return set(files(lake, spec.name))

    null = "date_key=__HIVE_DEFAULT_PARTITION__"
    assert put(None, 0) == {null}
    assert put("2024-01-05", 1) == {"date_key=20240105"}
    assert put(None, 2) == {null}


class Lost(Exception):
    pass


@pytest.mark.parametrize(
    "step,when", [("_log", "before"), ("_log", "after"), ("overwrite_partitions", "before"), ("_append", "after"), ("note", "before")]
)
def test_a_lost_upsert_is_finished_by_the_next(spark, lake, monkeypatch, step, when):
    day = lambda d: f"2024-01-{d:02d} 08:00:00"
    table = curated_orders(lake, spark, [(i, day(1 + i % 9), i, 0) for i in range(20)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    second = [(2, day(11), 5, 1), (30, day(12), 1, 1)]
    owner = Lake if step == "overwrite_partitions" else KeyedTable
    whole = getattr(owner, step)

    def lost(self, *args, **kwargs):
        if when == "after":
            whole(self, *args, **kwargs)
        raise Lost

    monkeypatch.setattr(owner, step, lost)
    with pytest.raises(Lost):
        curated_orders(lake, spark, second)
    monkeypatch.undo()
    # The next run has other rows as well.
    curated_orders(lake, spark, [*second, (3, day(13), 9, 2)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    wanted = {f"o{i}": i for i in range(20)} | {"o2": 5, "o30": 1, "o3": 9}
    assert {r.production_order_id: r.actual_quantity for r in table.read().collect()} == wanted
    assert table.read().count() == len(wanted)
    check_fact(lake, table)


@pytest.mark.parametrize("step", ["_append", "note"])
def test_a_lost_first_load_is_repeated(spark, lake, monkeypatch, step):
    whole = getattr(KeyedTable, step)

    def lost(self, *args, **kwargs):
        if step == "_append":
            whole(self, *args, **kwargs)
        raise Lost

    rows = [(i, None, i, 0) for i in range(9)]
    monkeypatch.setattr(KeyedTable, step, lost)
    with pytest.raises(Lost):
        raw_table(lake, ORDERS).load(orders(spark, rows))
    monkeypatch.undo()
    table = raw_table(lake, ORDERS)
    assert not table.exists() and table.read().count() == 0
    table.load(orders(spark, rows))
    assert table.read().count() == 9
    table.upsert(orders(spark, [(1, None, 5, 1), (50, None, 5, 1)]))
    assert table.read().count() == 10
    with pytest.raises(ValueError):
        table.load(orders(spark, rows))


def test_a_lost_refresh_is_repeated(spark, lake, monkeypatch):
    day = lambda d: f"2024-01-{d:02d} 08:00:00"
    table = curated_orders(lake, spark, [(i, day(1 + i % 9), i, 0) for i in range(20)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    curated_orders(lake, spark, [(2, day(11), 5, 1), (3, day(9), 5, 1)])
    whole = Lake.note

    def lost(self, *args, **kwargs):
        raise Lost

    monkeypatch.setattr(Lake, "note", lost)
    with pytest.raises(Lost):
        refresh_row_fact(lake, PRODUCTION_FACT, table)
    monkeypatch.setattr(Lake, "note", whole)
    curated_orders(lake, spark, [(2, day(12), 6, 2)])
    refresh_row_fact(lake, PRODUCTION_FACT, table)
    check_fact(lake, table)


def check_hours(lake, table):
    stored = lake.read(lake.config.gold, "fact_sensor_hourly")
    wanted = facts.fact_sensor_hourly(table.read())
    assert sorted_rows(stored, wanted.columns) == sorted_rows(wanted)


def test_late_repeated_and_corrected_readings_equal_a_rebuild(spark, lake, monkeypatch):
    rng = random.Random(7)
    known = {}

    def some(n, hours):
        rows = {}
        for _ in range(n):
            i = f"r{rng.randrange(400)}"
            start = datetime(2024, 1, 1) + timedelta(hours=rng.choice(hours), seconds=rng.randrange(3600))
            kind = rng.choice(["temp", "Load ", None])
            value = rng.choice([None, str(round(rng.uniform(-50, 50), 4))])
            rows[i] = (i, f"m{rng.randrange(3)}", kind, value, str(start))
        known.update(rows)
        return list(rows.values())

    def put(rows):
        batch = curate(readings(spark, rows), SENSORS)
        table = curated_table(lake, SENSORS, batch, 4)
        table.upsert(batch, TABLE_HASH, latest_by=[SENSORS.ts_col])
        return table

    table = put(some(200, range(72)))
    assert refresh_hourly(lake, table) is None
    check_hours(lake, table)
    before = files(lake, "fact_sensor_hourly")
    # Late ones of one day and type, and one of them again.
    late = [(f"late{i}", "m1", "temp", str(i), f"2024-01-02 05:{i:02d}:00") for i in range(20)]
    put(late)
    put(late[:5] + [("late99", "m2", "temp", "-3,5", "2024-01-02 05:00:00")])
    assert refresh_hourly(lake, table) == 1
    after = files(lake, "fact_sensor_hourly")
    assert {d for d in after if before.get(d) != after[d]} == {"date_key=20240102/sensor_type=temp"}
    check_hours(lake, table)
    # Corrections: the extreme value goes down, a reading changes its hour and another its type.
    put([("late19", "m1", "temp", "1", "2024-01-02 05:19:00"), ("late18", "m1", "temp", "18", "2024-01-09 05:19:00"),
         ("late17", "m1", "Load", "17", "2024-01-02 05:17:00")])
    refresh_hourly(lake, table)
    check_hours(lake, table)
    for n in (60, 150):
        put(some(n, range(200)))
    refresh_hourly(lake, table)
    check_hours(lake, table)
    # Lost after the partitions were replaced: merged once all the same.
    put([(f"x{i}", "m1", "temp", str(i), f"2024-01-02 05:{i:02d}:30") for i in range(20)])

    def lost(self, *args, **kwargs):
        raise Lost

    whole = Lake.note
    monkeypatch.setattr(Lake, "note", lost)
    with pytest.raises(Lost):
        refresh_hourly(lake, table)
    monkeypatch.setattr(Lake, "note", whole)
    put([("y", "m1", "temp", "1000", "2024-01-02 05:31:00")])
    refresh_hourly(lake, table)
    check_hours(lake, table)
    assert refresh_hourly(lake, table) == 0


def feed(spark, rng, n):
    """A day's raw rows of all five tables; some ids come again with other values, some without a time."""
    frames = {}
    for table, spec in RAW_TABLES.items():
        rows = []
        for _ in range(n):
            row = {c: rng.choice([None, f"{c}{rng.randrange(3)}"]) for c in spec.columns}
            row[spec.key] = f"k{rng.randrange(60)}"
            for c in spec.columns:
                if c.endswith(("_start", "_end", "_date", "_timestamp")) or c == "last_update":
                    # Few times, so that readings compete for one identity.
                    row[c] = rng.choice([None, "bad", *(f"2024-0{m}-{d:02d} 10:00:00" for m in (1, 2) for d in (1, 9, 20))])
                if "quantity" in c or c == "reading_value":
                    row[c] = rng.choice([None, str(rng.randrange(50))])
            if table == READINGS:
                row |= {"equipment_id": f"m{rng.randrange(2)}", "sensor_id": "s"}
            rows.append(tuple(row[c] for c in spec.columns))
        # One row per key and batch, so that a run over all rows sees the same.
        frames[table] = list({r[spec.columns.index(spec.key)]: r for r in rows}.values())
    return {t: spark.createDataFrame(rows, raw_schema(t)) for t, rows in frames.items()}


@pytest.mark.parametrize("full", [False, True])
def test_curation_of_new_rows_equals_that_of_all(spark, lake, tmp_path, monkeypatch, full):
    """Several nights in two lakes, one of which curates everything every time."""
    from plantlake.plans import build

    chosen = ["equipment_versions", "sensor_readings_clean"] if full else ["sensor_readings_clean", "production_orders_clean"]
    monkeypatch.setattr(build, "ENTITIES", {name: build.ENTITIES[name] for name in chosen})
    run = uuid4().hex[:8]
    other = Lake(spark, LakeConfig(str(tmp_path / "other"), raw=f"raw2_{run}", curated=f"cur2_{run}", gold=f"gold2_{run}"))
    for schema in (other.config.raw, other.config.curated):
        other.create_schema(schema)
    rng = random.Random(3 + full)
    for night in range(2 if full else 3):
        frames = feed(spark, rng, 40 if night else 80)
        as_of = datetime(2024, 3, 1) + timedelta(days=12 * night)
        built = []
        for one, rebuild in ((lake, False), (other, True)):
            for spec in build.ENTITIES.values():
                raw_table(one, spec.raw, 2).upsert(frames[spec.raw])
            built.append(build.build_curated(one, as_of, full, 2, rebuild))
        new, whole = ({name: table.read() for name, table in tables.items()} for tables in built)
        assert new.keys() == whole.keys()
        for name in new:
            columns = [c for c in new[name].columns if c != "version_key"]
            assert sorted_rows(new[name], columns) == sorted_rows(whole[name], columns), (night, name)


def test_a_second_build_writes_what_changed(spark, lake):
    rng = random.Random(11)
    frames = feed(spark, rng, 30)
    for table, frame in frames.items():
        raw_table(lake, table, 2).upsert(frame)
    build_lake(lake, AS_OF, full=True, key_groups=2)
    before = {name: files(lake, name) for name in facts.PARTITION_BY}
    row = ("po_new", "m", "p", None, None, "2031-05-05 10:00:00", None, "1", "1", "x", "2024-02-01 00:00:00")
    raw_table(lake, ORDERS, 2).upsert(spark.createDataFrame([row], raw_schema(ORDERS)))
    built = build_lake(lake, AS_OF, full=True, key_groups=2)
    after = {name: files(lake, name) for name in facts.PARTITION_BY}
    changed = {(name, d) for name in after for d in before[name].keys() | after[name].keys() if before[name].get(d) != after[name].get(d)}
    assert changed == {("fact_production", "start_date_key=20310505")}
    assert built["fact_production"].where("production_key = 'po_new'").count() == 1
    for table in RAW_TABLES:
        log = raw_table(lake, table, 2).log_name
        assert not spark.catalog.tableExists(log) or spark.sql(f"SHOW PARTITIONS {log}").isEmpty()


def test_second_run_reads_new_rows_only(spark, lake):
    raw = raw_table(lake, ORDERS, 4)
    raw.upsert(orders(spark, [(i, None, i, 0) for i in range(50)]))
    batch, done = curated_batch(raw, raw, PRODUCTION, AS_OF, 60)
    table = curated_table(lake, PRODUCTION, batch, 4)
    table.upsert(batch, TABLE_HASH)
    table.note(seen=str(done))
    raw.upsert(orders(spark, [(3, None, 9, 1), (70, None, 9, 1)]))
    batch, done = curated_batch(raw, table, PRODUCTION, AS_OF, 60)
    assert done == 1 and {r.production_order_id for r in batch.collect()} == {"o3", "o70"}
    read = {Path(f).parent.parent.name for f in batch.inputFiles()}
    assert read == {f"{ORDERS}_changes"}
    rebuilt, _ = curated_batch(raw, table, PRODUCTION, AS_OF, 60, rebuild=True)
    assert rebuilt.count() == 51


def ingested(lake, spark, rows):
    return ingest_all(lake, lambda _: orders(spark, rows), AS_OF, [ORDERS], key_groups=4).collect()[0]


def raw_quantities(lake):
    return sorted((r.production_order_id, r.actual_quantity) for r in raw_table(lake, ORDERS, 4).read().collect())


def test_an_ingested_batch_is_stored_in_its_log_only(spark, lake):
    # Order 3 is there twice, and both rows take the update.
    ingested(lake, spark, [(i, None, i, 0) for i in range(20)] + [(3, None, 33, 0)])
    table = raw_table(lake, ORDERS, 4)
    assert table.bucketed and table.noted("bucketed") == "true"
    found = ingested(lake, spark, [(3, None, 70, 4), (3, None, 71, 5), (50, None, 5, 6), (4, None, 9, 0)])
    assert (found.mode, found.rows_read, found.rows_written) == ("incremental", 3, 2)
    wanted = {f"o{i}": str(i) for i in range(20) if i != 3} | {"o50": "5"}
    assert raw_quantities(lake) == sorted([*wanted.items(), ("o3", "71"), ("o3", "71")])
    # The batch is not kept beside its log, whose files hold one group each.
    assert not (Path(lake.config.location(lake.config.raw)) / "_stage").exists()
    log = spark.table(table.log_name).withColumn("file", F.input_file_name())
    assert log.groupBy("file").agg(F.count_distinct("key_group").alias("n")).where("n > 1").isEmpty()
    kinds = sorted((r.change, r.actual_quantity) for r in table.changes(0).collect())
    assert kinds == [("before", "3"), ("before", "33"), ("inserted", "5"), ("updated", "71")]
    # Rows of one batch need no choice among states.
    plan = new_rows(table, PRODUCTION, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    assert ingested(lake, spark, [(3, None, 99, 1)]).mode == "skipped" and table.done() == 1
    ingested(lake, spark, [(3, None, 88, 9)])
    assert {r.actual_quantity for r in new_rows(table, PRODUCTION, 0).collect()} == {"88", "5"}


@pytest.mark.parametrize("step,when", [
    ("_log_marked", "after"), ("_log_before", "before"), ("_log_before", "after"), ("_update", "after"), ("_append", "after"),
])
def test_a_lost_ingest_is_finished_by_the_next(spark, lake, monkeypatch, step, when):
    ingested(lake, spark, [(i, None, i, 0) for i in range(12)])
    whole = getattr(KeyedTable, step)

    def lost(self, *args, **kwargs):
        if when == "after":
            whole(self, *args, **kwargs)
        raise Lost

    monkeypatch.setattr(KeyedTable, step, lost)
    assert ingested(lake, spark, [(2, None, 70, 5), (40, None, 1, 5)]).status == "failed"
    monkeypatch.undo()
    noted = step not in ("_log_marked", "_log_before") or (step, when) == ("_log_before", "after")
    # A batch that was not noted leaves nothing behind, also where the next one changes nothing.
    raw_table(lake, ORDERS, 4).upsert(orders(spark, []))
    wanted = {f"o{i}": str(i) for i in range(12)}
    assert raw_quantities(lake) == sorted((wanted | ({"o2": "70", "o40": "1"} if noted else {})).items())
    ingested(lake, spark, [(2, None, 70, 5), (40, None, 1, 5), (41, None, 2, 5)])
    assert raw_quantities(lake) == sorted((wanted | {"o2": "70", "o40": "1", "o41": "2"}).items())


def test_a_raw_table_without_buckets_stays_so(spark, lake):
    old = lake.keyed(lake.config.raw, ORDERS, raw_schema(ORDERS), "production_order_id", 4, logged=True)
    old.load(orders(spark, [(i, None, i, 0) for i in range(9)]))
    assert not raw_table(lake, ORDERS, 4).bucketed
    ingested(lake, spark, [(2, None, 70, 5), (40, None, 1, 5)])
    wanted = {f"o{i}": str(i) for i in range(9)} | {"o2": "70", "o40": "1"}
    assert raw_quantities(lake) == sorted(wanted.items())


def test_marked_rows_are_the_compared_ones(spark):
    schema = "k string, v int, h string"
    target = spark.createDataFrame([
        ("a", 1, "1"), ("b", 1, "1"), ("b", 1, "2"), ("c", 1, None), ("c", 1, "1"), ("d", 1, "1"), (None, 1, "1"), ("f", 1, None),
    ], schema)
    source = spark.createDataFrame([(k, 2, h) for k, h in zip("abcdefg", ["1", "1", "1", None, "1", "1", None])], schema)
    for hash_col in (None, "h"):
        marked = marked_rows(target, source, "k", hash_col)
        assert sorted_rows(marked) == sorted_rows(compared_rows(target, source, "k", hash_col))


def test_ingest_compiles_its_methods_and_parses_each_time_once(spark, lake, monkeypatch):
    before = spark.conf.get(HUGE_METHOD)
    plans = []
    monkeypatch.setattr(KeyedTable, "load", lambda self, df, **_: plans.append(df) or df.count())
    try:
        spark.conf.set(HUGE_METHOD, 65535)
        ingested(lake, spark, [(1, None, 1, 0)])
        assert int(spark.conf.get(HUGE_METHOD)) == COMPILED_BYTES
    finally:
        spark.conf.set(HUGE_METHOD, before)
    assert "_time" in plans[0].columns
