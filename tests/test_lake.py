"""Ordinary tables, ingest and audits in a temporary lake."""

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

import plantlake.plans.ingest as ingest_module
from plantlake.config import LakeConfig, qualify
from plantlake.plans.ingest import ingest_all, raw_table
from plantlake.queries import QUERIES, Frames
from plantlake.sources.audit import missing_tables, reconcile, row_counts
from plantlake.sources.extract import extract, watermark_value
from plantlake.sources.schemas import RAW_TABLES, raw_schema
from plantlake.sources.store import Lake

TABLE = "iot_sensor_readings"


@pytest.fixture
def lake(spark, tmp_path):
    run = uuid4().hex[:8]
    lake = Lake(spark, LakeConfig(str(tmp_path), raw=f"raw_{run}", gold=f"gold_{run}"))
    lake.create_schema(lake.config.raw)
    lake.create_schema(lake.config.gold)
    return lake


def readings(spark, *times):
    rows = [(f"r{i}", "m1", "s1", "temp", str(i), t, "u") for i, t in enumerate(times)]
    return spark.createDataFrame(rows, raw_schema(TABLE))


def test_qualify():
    assert qualify("s", "t") == "`s`.`t`"
    assert qualify("s", "t", "None") == "`s`.`t`"
    assert qualify("s", "t", "c") == "`c`.`s`.`t`"


def test_partitioned_overwrite_keeps_null_partition(spark, lake):
    gold = lake.config.gold
    df = spark.createDataFrame([("a", 1), ("b", None)], "id string, date_key int")
    lake.overwrite(df.limit(1), gold, "f", ["date_key"])
    lake.overwrite(df, gold, "f", ["date_key"])
    assert {tuple(r) for r in lake.read(gold, "f").collect()} == {("a", 1), ("b", None)}
    lake.append(df.select("date_key", "id"), gold, "log")
    lake.append(df, gold, "log")
    assert lake.read(gold, "log").where("id = 'a' and date_key = 1").count() == 2
    assert not lake.load_if_empty(df, gold, "log")
    lake.drop(gold, "log")
    assert lake.load_if_empty(df, gold, "log")
    lake.reset_schema(gold)
    assert lake.tables(gold).isEmpty()


def test_views_of_the_session_are_in_no_schema(spark, lake):
    spark.range(1).createOrReplaceTempView("view_of_the_session")
    try:
        assert lake.tables(lake.config.gold).isEmpty()
        lake.replace(spark.range(1), lake.config.gold, "d")
        assert [r["tableName"] for r in lake.tables(lake.config.gold).collect()] == ["d"]
    finally:
        spark.catalog.dropTempView("view_of_the_session")


def test_extract_rules(spark):
    df = readings(spark, None, "2024-01-01", "02/01/2024", "unreadable", "2024-01-01T00:00:01")
    kept = extract(df, TABLE, watermark=datetime(2024, 1, 1))
    assert {r["reading_id"] for r in kept.collect()} == {"r0", "r2", "r4"}
    back = extract(df, TABLE, as_of=datetime(2024, 1, 31), days_back=29)
    assert {r["reading_id"] for r in back.collect()} == {"r0"}
    assert extract(df, TABLE, full=True).count() == 5
    # As text, 31/12/2001 would be the highest.
    assert watermark_value(readings(spark, "31/12/2001", "2024-01-01"), TABLE) == datetime(2024, 1, 1)


def test_ingest_modes_and_failures(spark, lake):
    as_of = datetime(2024, 2, 1)

    def run(frames):
        out = ingest_all(lake, frames.__getitem__, as_of, ["missing_source", *frames])
        return {r["table_name"]: (r["mode"], r["rows_read"], r["rows_written"], r["status"])
                for r in out.collect()}

    first = {TABLE: readings(spark, "2024-01-01", "02/01/2024")}
    got = run(first)
    assert got["missing_source"][3] == "failed"
    assert got[TABLE] == ("full", 2, 2, "ok")
    assert run(first)[TABLE] == ("skipped", 0, 0, "ok")
    more = {TABLE: readings(spark, "2024-01-01", "2024-01-05", "2024-01-06", None)}
    assert run(more)[TABLE] == ("incremental", 3, 3, "ok")
    stored = {r["reading_id"]: r["reading_timestamp"] for r in raw_table(lake, TABLE).read().collect()}
    assert stored == {"r0": "2024-01-01", "r1": "2024-01-05", "r2": "2024-01-06", "r3": None}


@pytest.mark.parametrize("query", ["flt3_new_rows_only", "src8_ingested_orders", "aud4_ingest_summary"])
@pytest.mark.parametrize("run", [0, 1])
def test_a_failed_ingest_is_no_result(spark, monkeypatch, query, run):
    whole, calls = ingest_module.ingest, []

    def lost(lake, table, *args, **kwargs):
        if table == "production_orders":
            calls.append(table)
            if len(calls) == run + 1:
                raise OSError("no space left")
        return whole(lake, table, *args, **kwargs)

    times = ("1999-12-20 03:04:05", "2001-10-20 03:04:05")
    raw = {}
    for table, spec in RAW_TABLES.items():
        values = [(f"k{n}", t) for n, t in enumerate(times)]
        known = spark.createDataFrame(values, f"{spec.key} string, {spec.ts_col} string")
        raw[table] = known.select(*[F.col(c) if c in known.columns else F.lit("1").alias(c) for c in spec.columns])
    monkeypatch.setattr(ingest_module, "ingest", lost)
    with pytest.raises(ingest_module.IngestError, match="production_orders: no space left"):
        QUERIES[query](Frames(spark, "/none", raw))
    assert len(calls) == run + 1


def test_ingest_into_a_target_without_a_noted_time(spark, lake):
    # Filled without ingest; what follows its latest time is older than the fallback.
    raw_table(lake, TABLE).load(readings(spark, "2023-01-01", "2023-01-05"))
    source = readings(spark, "2023-01-01", "2023-01-05", "2023-01-06", "2024-01-31")
    out = ingest_all(lake, {TABLE: source}.__getitem__, datetime(2024, 2, 1), [TABLE]).first()
    assert (out["mode"], out["rows_read"], out["rows_written"]) == ("incremental", 2, 2)
    assert raw_table(lake, TABLE).read().count() == 4
    again = ingest_all(lake, {TABLE: source}.__getitem__, datetime(2024, 2, 1), [TABLE]).first()
    assert again["mode"] == "skipped"


def test_audits(spark):
    two, one = spark.range(2), spark.range(1)
    assert [tuple(r) for r in row_counts({"b": two, "a": one}).collect()] == [("a", 1), ("b", 2)]
    found = {r["table_name"]: tuple(r)[1:] for r in
             reconcile({"a": one, "b": two, "c": two}, {"a": one, "b": one}).collect()}
    assert found == {
        "a": (1, 1, 0, "ok"), "b": (2, 1, 1, "different"), "c": (2, None, None, "missing"),
        "TOTAL": (5, 2, 3, ""),
    }
    present = row_counts({"production_orders": one})
    assert missing_tables(spark, RAW_TABLES, present).count() == 4
