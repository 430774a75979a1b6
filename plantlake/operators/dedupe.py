"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the highest ``order`` columns (descending, NULLs last).

    All remaining columns follow as tie-breaks, so rows that still tie are equal in every column.
    Spark keeps only the first row per key of each map task before the shuffle, so a key that
    holds a large share of the rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranking = [F.col(c).desc_nulls_last() for c in [*order, *rest]]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
