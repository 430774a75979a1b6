"""Dashboard reports over the analytic views.

``as_of`` stands for the current day. Rankings end in the equipment name or id, so a tie at the
limit is cut the same way on every run.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.times import AsOf, day_of, days_before, sum_minutes
from plantlake.plans.views import dated, from_day

# Score above which a machine counts as critical, and the label of a missing cause.
CRITICAL_SCORE = 100
NO_CAUSE = "unspecified"


def last_days(view: DataFrame, as_of: AsOf, days: int | None) -> DataFrame:
    """Rows from ``days`` calendar days before ``as_of`` up to its day; all rows if ``days`` is None."""
    if days is None:
        return view
    return view.where(F.col("full_date").between(F.lit(days_before(as_of, days)), F.lit(day_of(as_of))))


def _oee() -> Column:
    return F.col("availability_rate") * F.col("performance_rate") * F.col("quality_rate")


def _pct(rate: Column) -> Column:
    return F.round(rate * 100, 2)


def mean_oee(oee: DataFrame, as_of: AsOf, days: int | None = 30) -> DataFrame:
    return last_days(oee, as_of, days).agg(_pct(F.avg(_oee())).alias("mean_oee_pct"))


def downtime_of_day(downtime: DataFrame, day: AsOf) -> DataFrame:
    return downtime.where(F.col("full_date") == F.lit(day_of(day))).agg(
        F.coalesce(sum_minutes(F.col("total_downtime_minutes")), F.lit(0.0)).alias("downtime_min")
    )


def critical_count(critical: DataFrame, threshold: float = CRITICAL_SCORE) -> DataFrame:
    return critical.where(F.col("criticality_score") > threshold).agg(
        F.count("*").alias("critical_machines")
    )


def mean_quality(oee: DataFrame, as_of: AsOf, days: int | None = 30) -> DataFrame:
    return last_days(oee, as_of, days).agg(_pct(F.avg("quality_rate")).alias("quality_pct"))


def oee_by_equipment(oee: DataFrame, as_of: AsOf, days: int | None = 7) -> DataFrame:
    return (
        last_days(oee, as_of, days)
        .groupBy("equipment_name")
        .agg(_pct(F.avg(_oee())).alias("oee_pct"))
        .orderBy(F.desc("oee_pct"), "equipment_name")
    )


def oee_by_day(oee: DataFrame, as_of: AsOf, days: int | None = 30) -> DataFrame:
    return (
        last_days(oee, as_of, days)
        .select("full_date", "equipment_name", _pct(_oee()).alias("oee_pct"))
        .orderBy("full_date", "equipment_name", "oee_pct")
    )


def top_critical(critical: DataFrame, limit: int = 10) -> DataFrame:
    return (
        critical.orderBy(F.desc_nulls_last("criticality_score"), "equipment_id")
        .limit(limit)
        .drop("equipment_id")
    )


def downtime_causes(
    downtime: DataFrame, as_of: AsOf, days: int | None = 30, no_cause: str = NO_CAUSE
) -> DataFrame:
    return (
        last_days(downtime, as_of, days)
        .groupBy("maintenance_type")
        .agg(sum_minutes(F.col("total_downtime_minutes")).alias("total_minutes"))
        .select(F.coalesce("maintenance_type", F.lit(no_cause)).alias("cause"), "total_minutes")
        .orderBy(F.desc_nulls_last("total_minutes"), "cause")
    )


def downtime_by_equipment(
    downtime: DataFrame, as_of: AsOf, days: int | None = 30, limit: int = 10
) -> DataFrame:
    return (
        last_days(downtime, as_of, days)
        .groupBy("equipment_name")
        .agg(sum_minutes(F.col("total_downtime_minutes")).alias("total_downtime_min"))
        .orderBy(F.desc_nulls_last("total_downtime_min"), "equipment_name")
        .limit(limit)
    )


def sensor_trend(
    trends: DataFrame, as_of: AsOf, days: int | None = 7, equipment_name: str | None = None
) -> DataFrame:
    """Daily mean readings of all machines, or of one."""
    if equipment_name is not None:
        trends = trends.where(F.col("equipment_name") == equipment_name)
    return (
        last_days(trends, as_of, days)
        .select("full_date", "equipment_name", "sensor_type", "avg_reading")
        .orderBy("full_date", "equipment_name", "sensor_type")
    )


def oee_detail(oee: DataFrame, as_of: AsOf, days: int | None = 7) -> DataFrame:
    return (
        last_days(oee, as_of, days)
        .select(
            "full_date",
            "equipment_name",
            "downtime_min",
            "production_minutes",
            _pct(F.col("availability_rate")).alias("availability_pct"),
            _pct(F.col("performance_rate")).alias("performance_pct"),
            _pct(F.col("quality_rate")).alias("quality_pct"),
            _pct(_oee()).alias("oee_pct"),
        )
        .orderBy(F.desc("full_date"), "oee_pct", "equipment_name")
    )


def downtime_trend(downtime: DataFrame, as_of: AsOf | None = None, days: int | None = None):
    return (
        last_days(downtime, as_of, days)
        .groupBy("full_date", "maintenance_type")
        .agg(sum_minutes(F.col("total_downtime_minutes")).alias("total_downtime_minutes"))
        .orderBy("full_date", "maintenance_type")
    )


def sensor_range(trends: DataFrame, as_of: AsOf | None = None, days: int | None = None):
    """Lowest, mean and highest reading per sensor type; the mean is over the daily means."""
    return (
        last_days(trends, as_of, days)
        .groupBy("sensor_type")
        .agg(
            F.min("min_reading").alias("min_reading"),
            F.round(F.avg(F.col("avg_reading").cast("decimal(22,8)")), 6)
            .cast("double")
            .alias("avg_reading"),
            F.max("max_reading").alias("max_reading"),
        )
        .orderBy("sensor_type")
    )


def oee_listing(oee: DataFrame) -> DataFrame:
    return oee.orderBy("full_date", "equipment_name", "equipment_id")


def downtime_listing(downtime: DataFrame) -> DataFrame:
    return downtime.orderBy(
        F.desc_nulls_last("total_downtime_minutes"),
        "full_date", "equipment_name", "maintenance_type",
    )


# --- one-statement star query -------------------------------------------------------------------

_SUMS = {
    "production_time": "duration",
    "downtime": "down",
    "planned_qty": "planned",
    "actual_qty": "actual",
    "inspected_qty": "inspected",
    "failed_qty": "failed",
}


def _star_cells(
    production: DataFrame,
    maintenance: DataFrame,
    quality: DataFrame,
    since: date | None,
    until: date | None,
) -> DataFrame:
    """Sums and row counts per equipment and day that has a production row."""
    def per_cell(fact: DataFrame, key: str, **sums: Column) -> DataFrame:
        return (
            from_day(fact, key, since, until)
            .groupBy("equipment_id", F.col(key).alias("date_key"))
            .agg(*[c.alias(name) for name, c in sums.items()])
        )

    keys = ["equipment_id", "date_key"]
    rows = F.count("*")
    produced = per_cell(
        production, "start_date_key",
        duration=sum_minutes(F.col("duration_minutes")),
        planned=F.sum("planned_qty"), actual=F.sum("actual_qty"), p_rows=rows,
    )
    repaired = per_cell(
        maintenance, "start_date_key",
        down=sum_minutes(F.col("downtime_minutes")), m_rows=rows,
    )
    checked = per_cell(
        quality, "date_key",
        inspected=F.sum("total_quantity"), failed=F.sum("failed_quantity"), q_rows=rows,
    )
    return produced.join(repaired, keys, "left").join(checked, keys, "left")


def _star_report(
    cells: DataFrame, weights: dict[str, Column], dates: DataFrame | None, equipment: DataFrame
) -> DataFrame:
    sums = cells.select(
        "equipment_id",
        "date_key",
        *[(F.col(c) * weights[c] if c in weights else F.col(c)).alias(c) for c in _SUMS.values()],
    )

    def total(column: str) -> Column:
        c = F.col(column)
        return F.coalesce(sum_minutes(c) if column in ("duration", "down") else F.sum(c), F.lit(0))

    named = (
        dated(sums, dates)
        .join(equipment.select("equipment_id", "equipment_name", "equipment_type"), "equipment_id")
        .groupBy("full_date", "equipment_name", "equipment_type")
        .agg(*[total(source).alias(name) for name, source in _SUMS.items()])
    )
    run, down = F.col("production_time"), F.col("downtime")
    oee = (
        F.try_divide(run, run + down)
        * F.try_divide(F.col("actual_qty"), F.col("planned_qty"))
        * F.try_divide(F.col("inspected_qty") - F.col("failed_qty"), F.col("inspected_qty"))
    )
    return named.withColumn("oee_pct", F.round(F.round(oee, 4) * 100, 2)).orderBy(
        F.desc("full_date"), F.asc_nulls_first("oee_pct"), "equipment_name"
    )


def star_oee(
    production: DataFrame,
    maintenance: DataFrame,
    quality: DataFrame,
    dates: DataFrame | None,
    equipment: DataFrame,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Times, quantities and OEE in percent per day and equipment, straight from the facts.

    OEE is NULL where nothing was planned or inspected.
    """
    cells = _star_cells(production, maintenance, quality, since, until)
    return _star_report(cells, {}, dates, equipment)


def star_oee_fanout(
    production: DataFrame,
    maintenance: DataFrame,
    quality: DataFrame,
    dates: DataFrame | None,
    equipment: DataFrame,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """The same as a join of the three facts before aggregation would give.

    There each row of one fact counts once per matching pair of the other two. Sums and row counts
    per equipment and day say the same without making the combinations.
    """
    cells = _star_cells(production, maintenance, quality, since, until)
    p, m, q = (F.coalesce(F.col(f"{x}_rows"), F.lit(1)) for x in "pmq")
    weights = {
        "duration": m * q, "planned": m * q, "actual": m * q,
        "down": p * q,
        "inspected": p * m, "failed": p * m,
    }
    return _star_report(cells, weights, dates, equipment)


def production_by_calendar(production: DataFrame, dates: DataFrame, first: date, last: date) -> DataFrame:
    """Orders and pieces per calendar day and machine, for days chosen by the calendar.

    The calendar joins before aggregation: over a stored fact its days prune the fact's directories when
    the query runs, which no filter written beforehand has to name.
    """
    day = F.col("full_date")
    chosen = dates.where((day >= F.lit(first)) & (day <= F.lit(last)) & ~F.col("is_weekend"))
    joined = production.join(chosen.select("date_key", "full_date"), production["start_date_key"] == chosen["date_key"])
    return joined.groupBy("full_date", "equipment_id").agg(
        F.count("*").alias("orders"), F.sum("actual_qty").alias("pieces")
    )
