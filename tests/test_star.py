"""Facts, views and reports on hand-made rows, and fan-out forms against real joins."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plantlake.plans import dimensions, facts, reports, views
from plantlake.plans.calendar import calendar, day_range

DAY = datetime(2024, 1, 1)
KEY = 20240101


@pytest.fixture(scope="module")
def star(spark):
    production = spark.createDataFrame(
        [("p1", "m1", "x", KEY, 60.0, 100, 120), ("p2", "m2", "x", KEY, -30.0, 10, 10),
         ("p3", "m3", "x", KEY, 60.0, 0, 5), ("p4", "m4", "x", KEY, 30.0, 10, 9),
         ("p5", "m4", "x", KEY, 30.0, 10, 9)],
        "production_key string, equipment_id string, product_id string, start_date_key int,"
        " duration_minutes double, planned_qty int, actual_qty int")
    maintenance = spark.createDataFrame(
        [("w1", "m3", KEY, "fix", 0.0), ("w2", "m4", KEY, "fix", 20.0), ("w3", "m4", KEY, None, 10.0),
         ("w4", "m4", KEY, "fix", None)],
        "maintenance_key string, equipment_id string, start_date_key int, maintenance_type string,"
        " downtime_minutes double")
    quality = spark.createDataFrame(
        [("i1", "m4", KEY, 10, 1), ("i2", "m4", KEY, 10, 2), ("i3", "m4", KEY, 0, 0),
         ("i4", "m1", None, 5, 5)],
        "inspection_id string, equipment_id string, date_key int, total_quantity int,"
        " failed_quantity int")
    equipment = spark.createDataFrame(
        [(f"m{i}", f"Machine {i}", "CNC") for i in range(1, 6)],
        "equipment_id string, equipment_name string, equipment_type string")
    dates = calendar(day_range(spark, date(2023, 12, 30), date(2024, 1, 3)))
    return production, maintenance, quality, dates, equipment


def test_oee_edges(star):
    found = {r["equipment_id"]: r for r in views.oee_daily(*star).collect()}
    assert set(found) == {"m1", "m3", "m4"}, "negative production time must not appear"
    m1, m3, m4 = found["m1"], found["m3"], found["m4"]
    assert (m1["availability_rate"], m1["performance_rate"], m1["quality_rate"]) == (0.9998, 1.2, 1.0)
    assert (m3["availability_rate"], m3["performance_rate"]) == (1.0, 0.0)
    assert (m4["availability_rate"], m4["quality_rate"]) == (round(60 / 90, 4), 0.85)
    assert views.oee_daily(*star, since=date(2024, 1, 2)).isEmpty()


def test_downtime_by_cause(star):
    _, maintenance, _, dates, equipment = star
    types = dimensions.dim_maintenance_type(maintenance)
    found = {
        (r["equipment_name"], r["maintenance_type"]):
            (r["total_downtime_minutes"], r["maintenance_count"], r["avg_downtime_minutes"])
        for r in views.downtime_by_cause(maintenance, dates, equipment, types).collect()
    }
    assert found == {
        ("Machine 3", "fix"): (0.0, 1, 0.0),
        ("Machine 4", "fix"): (20.0, 2, 20.0),
        ("Machine 4", None): (10.0, 1, 10.0),
    }


def test_critical_fanout_equals_joined_rows(star):
    _, maintenance, quality, _, equipment = star
    joined = (
        equipment.join(maintenance, "equipment_id", "left")
        .join(quality, "equipment_id", "left")
        .groupBy("equipment_id")
        .agg(F.sum("downtime_minutes"), F.count_distinct("maintenance_key"),
             F.sum("failed_quantity"))
    )
    fanout = views.critical_equipment_fanout(maintenance, quality, equipment)
    columns = ("equipment_id", "total_downtime", "maintenance_count", "total_failures")
    assert {tuple(r) for r in fanout.select(*columns).collect()} == {
        tuple(r) for r in joined.collect()
    }
    plain = {r["equipment_id"]: r for r in
             views.critical_equipment(maintenance, quality, equipment).collect()}
    assert plain["m4"]["criticality_score"] == 30.0 + 3 * 10
    assert plain["m1"]["criticality_score"] is None
    assert reports.critical_count(views.critical_equipment(maintenance, quality, equipment), 50
                                  ).first()[0] == 1


def test_star_fanout_equals_joined_rows(star):
    production, maintenance, quality, dates, equipment = star
    keys = ["equipment_id", "date_key"]
    p = production.withColumnRenamed("start_date_key", "date_key")
    m = maintenance.withColumnRenamed("start_date_key", "date_key")
    joined = (
        p.join(m, keys, "left").join(quality, keys, "left").join(equipment, "equipment_id")
        .groupBy("equipment_name")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (
            "duration_minutes", "downtime_minutes", "planned_qty", "actual_qty",
            "total_quantity", "failed_quantity")])
    )
    columns = ("equipment_name", "production_time", "downtime", "planned_qty", "actual_qty",
               "inspected_qty", "failed_qty")
    fanout = reports.star_oee_fanout(*star).select(*columns)
    assert {tuple(r) for r in fanout.collect()} == {tuple(r) for r in joined.collect()}


def test_fact_rules(spark):
    orders = spark.createDataFrame(
        [("p1", "m1", "x", DAY, None, 5, 4, "A"), ("p2", "m1", "x", None, DAY, 5, 4, "A"),
         ("p3", "m1", "x", DAY, datetime(2023, 12, 31, 23), 5, None, "A")],
        "production_order_id string, equipment_id string, product_id string,"
        " actual_start timestamp_ntz, actual_end timestamp_ntz, planned_quantity int,"
        " actual_quantity int, status string")
    found = {r["production_key"]: r for r in facts.fact_production(orders).collect()}
    assert set(found) == {"p1", "p3"}
    assert found["p1"]["duration_minutes"] is None and found["p1"]["qty_diff"] == -1
    assert found["p3"]["duration_minutes"] == -60.0 and found["p3"]["start_date_key"] == KEY

    checks = spark.createDataFrame(
        [("i1", None, "m1", None, True, 0, 0, "D001,D002, D001"), ("i2", None, "m1", DAY, None, 8, 2, "")],
        "inspection_id string, production_order_id string, equipment_id string,"
        " inspection_date timestamp_ntz, passed boolean, total_quantity int, failed_quantity int,"
        " defect_codes string")
    rates = {r["inspection_id"]: (r["date_key"], r["rejection_rate_pct"])
             for r in facts.fact_quality(checks).collect()}
    assert rates == {"i1": (None, None), "i2": (KEY, 25.0)}
    bridge = {tuple(r) for r in dimensions.defect_bridge(checks).collect()}
    assert bridge == {("i1", "D001"), ("i1", "D002")}
    assert dimensions.dim_defect(checks).count() == 1
