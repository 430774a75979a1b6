"""The calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.functions.times import date_key

# The range of the static calendar, the range used when there is no data, and the
# month and weekday names by number (weekday 1 = Monday).
STATIC_START = date(2023, 1, 1)
STATIC_DAYS = 1096
DEFAULT_START = date(2019, 1, 1)
DEFAULT_END = date(2030, 12, 31)
MONTHS_PT = {
    1: "janeiro", 2: "fevereiro", 3: "março", 4: "abril", 5: "maio", 6: "junho",
    7: "julho", 8: "agosto", 9: "setembro", 10: "outubro", 11: "novembro", 12: "dezembro",
}
WEEKDAYS_PT = {
    1: "segunda", 2: "terça", 3: "quarta", 4: "quinta", 5: "sexta", 6: "sábado", 7: "domingo",
}


def calendar_range(
    df: DataFrame, ts: str, default: tuple[date, date] = (DEFAULT_START, DEFAULT_END)
) -> DataFrame:
    """One row ``(first_day, last_day)``: the days spanned by ``ts``, or the default if it is empty."""
    day = F.col(ts).cast("date")
    return df.agg(
        F.coalesce(F.min(day), F.lit(default[0]).cast("date")).alias("first_day"),
        F.coalesce(F.max(day), F.lit(default[1]).cast("date")).alias("last_day"),
    )


def spanning(
    columns: Sequence[tuple[DataFrame, str]],
    default: tuple[date, date] = (DEFAULT_START, DEFAULT_END),
) -> DataFrame:
    """One row ``(first_day, last_day)`` over several tables, each reduced to one row first."""
    no_default = (None, None)
    rows = [calendar_range(df, ts, no_default) for df, ts in columns]
    return reduce(DataFrame.unionByName, rows).agg(
        F.coalesce(F.min("first_day"), F.lit(default[0])).alias("first_day"),
        F.coalesce(F.max("last_day"), F.lit(default[1])).alias("last_day"),
    )


def days(bounds: DataFrame) -> DataFrame:
    """One row per day of a ``(first_day, last_day)`` row."""
    return bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date")
    )


def day_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to end, both included."""
    count = (end - start).days + 1
    return spark.range(count).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")
    )


def calendar(day_rows: DataFrame) -> DataFrame:
    """Calendar with English names; ``day_of_week`` 1 = Sunday, the weekend is 1 and 7."""
    day = F.col("full_date")
    return day_rows.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def _names(number: Column, names: dict[int, str]) -> Column:
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.element_at(F.create_map(*pairs), number)


def localized_calendar(
    day_rows: DataFrame,
    months: dict[int, str] = MONTHS_PT,
    weekdays: dict[int, str] = WEEKDAYS_PT,
) -> DataFrame:
    """Calendar with names from maps, whatever the locale; ``iso_weekday`` 1 = Monday."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return day_rows.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday.alias("iso_weekday"),
        _names(F.month(day), months).alias("month_name"),
        _names(weekday, weekdays).alias("day_name"),
    )


def static_calendar(spark: SparkSession) -> DataFrame:
    """The fixed three-year calendar. Facts outside it drop out of every inner join with it."""
    end = date.fromordinal(STATIC_START.toordinal() + STATIC_DAYS - 1)
    return calendar(day_range(spark, STATIC_START, end))
