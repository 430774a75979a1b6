"""Report windows end with the day they are asked for."""

from datetime import date, datetime

from plantlake.plans import reports, views


def test_nothing_after_as_of(spark):
    rows = [("m", date(2024, 1, d), 0.5, 0.5, 0.5) for d in range(1, 31)]
    schema = "equipment_name string, full_date date, availability_rate double, performance_rate double, quality_rate double"
    oee = spark.createDataFrame(rows, schema)
    as_of = datetime(2024, 1, 20, 10)
    days = [r["full_date"] for r in reports.oee_by_day(oee, as_of, 7).collect()]
    assert days == [date(2024, 1, d) for d in range(13, 21)]
    assert reports.last_days(oee, as_of, None).count() == 30


def test_fact_days_and_dates_from_keys(spark):
    fact = spark.createDataFrame([(20240131,), (20240229,), (20240301,), (None,)], "date_key int")
    kept = views.from_day(fact, "date_key", date(2024, 2, 1), date(2024, 2, 29))
    assert [tuple(r) for r in views.dated(kept, None).collect()] == [(20240229, date(2024, 2, 29))]
    assert views.from_day(fact, "date_key", None).count() == 3
    assert views.from_day(fact, "date_key", None, date(2024, 1, 31)).count() == 1
    calendar = spark.createDataFrame([(20240229, date(2024, 2, 29))], "date_key int, full_date date")
    assert views.dated(fact, calendar).count() == 1


def test_one_machine(spark):
    trends = spark.createDataFrame(
        [("a", date(2024, 1, 1), "t", 1.0), ("b", date(2024, 1, 1), "t", 2.0)],
        "equipment_name string, full_date date, sensor_type string, avg_reading double")
    found = reports.sensor_trend(trends, date(2024, 1, 1), 7, "b").collect()
    assert [r["avg_reading"] for r in found] == [2.0]
