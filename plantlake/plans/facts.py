"""Facts of the star schema: narrow projections, and one hourly aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.times import date_key, seconds_between, start_of_hour
from plantlake.operators.filters import require

# How each fact is laid out in directories.
PARTITION_BY = {
    "fact_production": ["start_date_key"],
    "fact_maintenance": ["start_date_key"],
    "fact_quality": ["date_key"],
    "fact_sensor_hourly": ["date_key", "sensor_type"],
}

# Fixed value: cost of one hour of maintenance.
HOURLY_RATE = 100.0


def fact_production(production: DataFrame) -> DataFrame:
    """Orders that started. Without an end the duration is NULL; a negative one stays."""
    seconds = seconds_between(F.col("actual_start"), F.col("actual_end"))
    return require(production, ["actual_start"]).select(
        F.col("production_order_id").alias("production_key"),
        "equipment_id",
        "product_id",
        date_key(F.col("actual_start")).alias("start_date_key"),
        "actual_start",
        "actual_end",
        (seconds / 60).alias("duration_minutes"),
        F.col("planned_quantity").alias("planned_qty"),
        F.col("actual_quantity").alias("actual_qty"),
        F.try_subtract("actual_quantity", "planned_quantity").alias("qty_diff"),
        "status",
    )


def fact_maintenance(maintenance: DataFrame, hourly_rate: float = HOURLY_RATE) -> DataFrame:
    """Maintenance that started, with downtime and its cost at a fixed rate per hour."""
    seconds = seconds_between(F.col("actual_start"), F.col("actual_end"))
    return require(maintenance, ["actual_start"]).select(
        F.col("maintenance_order_id").alias("maintenance_key"),
        "equipment_id",
        date_key(F.col("actual_start")).alias("start_date_key"),
        "maintenance_type",
        "actual_start",
        "actual_end",
        (seconds / 60).alias("downtime_minutes"),
        "technician_id",
        (seconds / 3600 * hourly_rate).alias("cost_estimate"),
    )


def fact_quality(quality: DataFrame) -> DataFrame:
    """All inspections; one without a date has a NULL date key, one of nothing a NULL rate."""
    rate = F.try_divide(F.col("failed_quantity"), F.col("total_quantity")) * 100
    return quality.select(
        "inspection_id",
        "production_order_id",
        "equipment_id",
        date_key(F.col("inspection_date")).alias("date_key"),
        "inspection_date",
        "passed",
        "total_quantity",
        "failed_quantity",
        rate.alias("rejection_rate_pct"),
        "defect_codes",
    )


def fact_sensor_hourly(readings: DataFrame) -> DataFrame:
    """Readings per equipment, sensor type and hour.

    The mean is taken over decimals, so it does not depend on the order of adding.
    """
    value = F.col("reading_value")
    hourly = readings.groupBy(
        "equipment_id",
        "sensor_type",
        start_of_hour(F.col("reading_timestamp")).alias("hour_bucket"),
    ).agg(
        F.avg(value).cast("double").alias("avg_value"),
        F.min(value).cast("double").alias("min_value"),
        F.max(value).cast("double").alias("max_value"),
        F.count("*").alias("reading_count"),
    )
    return hourly.withColumn("date_key", date_key(F.col("hour_bucket")))
