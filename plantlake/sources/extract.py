"""Reading source tables: in full, or only what changed since a watermark."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.functions.parsing import FORMATS_P10, parse_timestamp
from plantlake.functions.times import AsOf, days_before, ntz
from plantlake.sources.schemas import RAW_TABLES

FALLBACK_DAYS = 90


def read_jdbc(
    spark: SparkSession, url: str, schema: str, table: str, properties: dict[str, str],
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A raw table in a database; give disjoint ``predicates`` to read it with that many tasks."""
    source = f"{schema}.{table}"
    if predicates:
        return spark.read.jdbc(url, source, predicates=list(predicates), properties=properties)
    return spark.read.jdbc(url, source, properties=properties)


def event_time(table: str, formats: Sequence[str] = FORMATS_P10):
    return parse_timestamp(RAW_TABLES[table].ts_col, formats)


def high_watermark(df: DataFrame, table: str) -> DataFrame:
    """One row with the latest event time.

    The text is parsed before taking the maximum: as text, ``31/12/2001`` would beat ``2024-01-01``.
    """
    return df.agg(F.max(event_time(table)).alias("high_watermark"))


def watermark_value(df: DataFrame, table: str) -> datetime | None:
    return high_watermark(df, table).first()["high_watermark"]


def has_new_data(source_max: datetime | None, target_max: datetime | None) -> bool:
    """False only if both sides have a time and the source has nothing later."""
    return source_max is None or target_max is None or source_max > target_max


def extract(
    source: DataFrame,
    table: str,
    watermark: AsOf | None = None,
    as_of: AsOf | None = None,
    days_back: int = FALLBACK_DAYS,
    full: bool = False,
    time: Column | None = None,
) -> DataFrame:
    """All rows, or those after ``watermark`` and those without any time.

    Give ``time`` where the source has its event time as a column already.

    Without a watermark the cut-off is ``days_back`` days before ``as_of``, to the moment if
    ``as_of`` has a time of day. A time that cannot be read is not NULL text and not later than
    anything, so such rows only come with a full extract.
    """
    if full:
        return source
    if watermark is None:
        if as_of is None:
            raise ValueError("an incremental extract needs a watermark or as_of")
        watermark = cutoff(as_of, days_back)
    text = F.col(RAW_TABLES[table].ts_col)
    time = event_time(table) if time is None else time
    return source.where(text.isNull() | (time > ntz(watermark)))


def cutoff(as_of: AsOf, days: int) -> AsOf:
    day = days_before(as_of, days)
    return datetime.combine(day, as_of.time()) if isinstance(as_of, datetime) else day
