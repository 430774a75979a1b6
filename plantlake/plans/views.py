"""Analytic views over the star schema. They are lazy and unsorted; reports sort.

Each fact is aggregated on its own before it meets anything else, so no join multiplies rows and a
machine with a large share of the rows is already reduced, within each task, when it is shuffled.

``since`` and ``until`` (days) cut the facts by their date key before aggregation. On a table
partitioned by that key only the directories of those days are read, which a filter on the calendar's
date alone cannot achieve up front. ``dates`` may be None: the date then follows from the key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.times import date_key_of, sum_minutes


def from_day(
    fact: DataFrame, key: str, since: date | None, until: date | None = None
) -> DataFrame:
    """Rows with a day, from ``since`` to ``until`` where these are given, both included."""
    column = F.col(key)
    rows = fact.where(column.isNotNull() if since is None else column >= date_key_of(since))
    return rows if until is None else rows.where(column <= date_key_of(until))


def dated(daily: DataFrame, dates: DataFrame | None) -> DataFrame:
    """Daily rows with their ``full_date``: from a calendar, which may leave days out, or from the key.

    Without a calendar no fact has to be read again to find the days it must span.
    """
    if dates is not None:
        return daily.join(dates.select("date_key", "full_date"), "date_key")
    key = F.col("date_key")
    day = F.make_date((key / 10000).cast("int"), (key / 100 % 100).cast("int"), key % 100)
    return daily.withColumn("full_date", day)


def _zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0))


def production_daily(fact: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Planned and actual quantity and minutes per equipment and day with any production time."""
    minutes = F.greatest(_zero(sum_minutes(F.col("duration_minutes"))), F.lit(0.0))
    return (
        from_day(fact, "start_date_key", since, until)
        .groupBy("equipment_id", F.col("start_date_key").alias("date_key"))
        .agg(
            _zero(F.sum("planned_qty")).alias("total_planned"),
            _zero(F.sum("actual_qty")).alias("total_produced"),
            minutes.alias("production_minutes"),
        )
        .where("production_minutes > 0")
    )


def downtime_daily(fact: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Downtime minutes per equipment and day."""
    return (
        from_day(fact, "start_date_key", since, until)
        .groupBy("equipment_id", F.col("start_date_key").alias("date_key"))
        .agg(_zero(sum_minutes(F.col("downtime_minutes"))).alias("total_downtime"))
    )


def quality_daily(fact: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Inspected and failed quantity per equipment and day."""
    return (
        from_day(fact, "date_key", since, until)
        .groupBy("equipment_id", "date_key")
        .agg(
            _zero(F.sum("total_quantity")).alias("total_inspected"),
            _zero(F.sum("failed_quantity")).alias("total_failed"),
        )
    )


def oee_daily(
    production: DataFrame,
    maintenance: DataFrame,
    quality: DataFrame,
    dates: DataFrame | None,
    equipment: DataFrame,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Availability, performance and quality per equipment and day of production.

    Without any maintenance row the availability denominator gets 0.01 minutes, with a matched
    zero it gets none. Performance may exceed 1. Without inspected pieces quality is 1.
    The three daily aggregates share their grouping keys, so joining them needs no new shuffle.
    """
    minutes, downtime = F.col("production_minutes"), F.col("total_downtime")
    total_time = minutes + _zero(downtime)
    inspected = _zero(F.col("total_inspected"))
    availability = F.when(
        total_time > 0,
        F.round(F.try_divide(minutes, minutes + F.coalesce(downtime, F.lit(0.01))), 4),
    ).otherwise(0.0)
    performance = F.when(
        F.col("total_planned") > 0,
        F.round(F.try_divide(F.col("total_produced"), F.col("total_planned")), 4),
    ).otherwise(0.0)
    good = F.when(
        inspected > 0,
        F.round(F.try_divide(inspected - _zero(F.col("total_failed")), inspected), 4),
    ).otherwise(1.0)
    keys = ["equipment_id", "date_key"]
    daily = (
        production_daily(production, since, until)
        .join(downtime_daily(maintenance, since, until), keys, "left")
        .join(quality_daily(quality, since, until), keys, "left")
    )
    return (
        dated(daily, dates)
        .join(equipment.select("equipment_id", "equipment_name"), "equipment_id")
        .select(
            "date_key",
            "full_date",
            "equipment_id",
            "equipment_name",
            _zero(downtime).cast("double").alias("downtime_min"),
            "production_minutes",
            total_time.alias("total_time"),
            availability.alias("availability_rate"),
            performance.alias("performance_rate"),
            good.alias("quality_rate"),
        )
    )


def downtime_by_cause(
    maintenance: DataFrame,
    dates: DataFrame | None,
    equipment: DataFrame,
    types: DataFrame,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Downtime, number and mean per day, equipment name and maintenance type.

    Machines with one name are taken together. The fact is reduced to machine, day and type before
    the dimensions join.
    """
    minutes = F.col("downtime_minutes")
    per_machine = (
        from_day(maintenance, "start_date_key", since, until)
        .groupBy("equipment_id", F.col("start_date_key").alias("date_key"), "maintenance_type")
        .agg(
            sum_minutes(minutes).alias("minutes"),
            F.count(minutes).alias("timed"),
            F.count("*").alias("orders"),
        )
    )
    known_types = types.select("maintenance_type", F.col("maintenance_type").alias("known_type"))
    return (
        dated(per_machine, dates)
        .join(equipment.select("equipment_id", "equipment_name"), "equipment_id")
        .join(known_types, "maintenance_type", "left")
        .groupBy("full_date", "equipment_name", F.col("known_type").alias("maintenance_type"))
        .agg(
            sum_minutes(F.col("minutes")).alias("total_downtime_minutes"),
            F.sum("orders").alias("maintenance_count"),
            F.try_divide(sum_minutes(F.col("minutes")), F.sum("timed")).alias(
                "avg_downtime_minutes"
            ),
        )
    )


def _maintenance_per_machine(maintenance: DataFrame) -> DataFrame:
    return maintenance.groupBy("equipment_id").agg(
        sum_minutes(F.col("downtime_minutes")).alias("downtime"),
        F.count("*").alias("maintenance_rows"),
        F.count("maintenance_key").alias("keyed_rows"),
    )


def _failures_per_machine(quality: DataFrame) -> DataFrame:
    return quality.groupBy("equipment_id").agg(
        F.sum("failed_quantity").alias("failures"),
        F.count("*").alias("quality_rows"),
    )


def _with_score(metrics: DataFrame) -> DataFrame:
    score = F.col("total_downtime") + _zero(F.col("total_failures")) * 10
    return metrics.withColumn("criticality_score", score)


def critical_equipment(
    maintenance: DataFrame, quality: DataFrame, equipment: DataFrame
) -> DataFrame:
    """Downtime, number of maintenance orders, failures and score of each machine.

    Score = downtime minutes + 10 per failed piece; NULL without any timed maintenance. Maintenance
    keys are unique in the fact, so counting rows counts distinct orders.
    """
    return _with_score(
        equipment.select("equipment_id", "equipment_name")
        .join(_maintenance_per_machine(maintenance), "equipment_id", "left")
        .join(_failures_per_machine(quality), "equipment_id", "left")
        .select(
            "equipment_id",
            "equipment_name",
            F.col("downtime").alias("total_downtime"),
            _zero(F.col("keyed_rows")).alias("maintenance_count"),
            F.col("failures").alias("total_failures"),
        )
    )


def critical_equipment_fanout(
    maintenance: DataFrame, quality: DataFrame, equipment: DataFrame
) -> DataFrame:
    """The same columns as a join of both facts per machine before aggregation would give.

    In that form each maintenance row counts once per inspection of the machine, and the other way
    round. The result follows from the sums and row counts alone, so the pairs are never made.
    """
    def times(rows: str) -> Column:
        return F.coalesce(F.col(rows), F.lit(1))

    return _with_score(
        equipment.select("equipment_id", "equipment_name")
        .join(_maintenance_per_machine(maintenance), "equipment_id", "left")
        .join(_failures_per_machine(quality), "equipment_id", "left")
        .select(
            "equipment_id",
            "equipment_name",
            (F.col("downtime") * times("quality_rows")).alias("total_downtime"),
            _zero(F.col("keyed_rows")).alias("maintenance_count"),
            (F.col("failures") * times("maintenance_rows")).alias("total_failures"),
        )
    )


def sensor_trends(
    hourly: DataFrame, dates: DataFrame | None, equipment: DataFrame,
    since: date | None = None, until: date | None = None,
) -> DataFrame:
    """Sensor statistics per day, equipment name and sensor type.

    ``avg_reading`` is the mean of the hourly means, each hour with the same weight. It is taken
    over decimals, in two steps with sum and count, so it does not depend on the order of adding.
    """
    per_machine = (
        from_day(hourly, "date_key", since, until)
        .groupBy("equipment_id", "date_key", "sensor_type")
        .agg(
            F.sum(F.col("avg_value").cast("decimal(22,8)")).alias("sum_of_means"),
            F.count("avg_value").alias("hours"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum("reading_count").alias("readings"),
        )
    )
    mean = F.try_divide(F.sum("sum_of_means").cast("decimal(38,8)"), F.sum("hours"))
    return (
        dated(per_machine, dates)
        .join(equipment.select("equipment_id", "equipment_name"), "equipment_id")
        .groupBy("full_date", "equipment_name", "sensor_type")
        .agg(
            F.round(mean, 8).cast("double").alias("avg_reading"),
            F.min("min_value").alias("min_reading"),
            F.max("max_value").alias("max_reading"),
            F.sum("readings").alias("total_readings"),
        )
    )
