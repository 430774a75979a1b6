"""Row filters: required columns and time windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.times import AsOf, days_before, ntz


def require(df: DataFrame, columns: Sequence[str], blank_is_null: bool = False) -> DataFrame:
    """Keep rows where all ``columns`` have a value (and, if asked, are not empty text)."""

    def present(name: str) -> Column:
        column = F.col(name)
        return column.isNotNull() & (column != "") if blank_is_null else column.isNotNull()

    return df.where(reduce(lambda a, b: a & b, map(present, columns)))


def recent(df: DataFrame, ts: str, days: int, as_of: AsOf, nulls: str = "drop") -> DataFrame:
    """Keep rows from midnight ``days`` days before ``as_of`` on.

    ``nulls`` says what a missing time means: ``keep`` the row, take it as ``now`` (that is,
    ``as_of``), or ``drop`` the row.
    """
    column = F.col(ts)
    cutoff = ntz(days_before(as_of, days))
    if nulls == "keep":
        return df.where(F.coalesce(column >= cutoff, F.lit(True)))
    if nulls == "now":
        return df.where(F.coalesce(column, ntz(as_of)) >= cutoff)
    if nulls == "drop":
        return df.where(column >= cutoff)
    raise ValueError(f"unknown null policy {nulls!r}")
