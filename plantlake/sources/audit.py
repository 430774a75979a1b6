"""Row counts and reconciliation of tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOTAL = "TOTAL"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for each table, ordered by name."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def reconcile(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Counts on both sides, their difference and a status per table, and a total row.

    A table the target lacks is ``missing``; its rows count in the source total only. Each table
    is counted once: every count goes to the line of its table and to the total.
    """
    sides = [row_counts(t).withColumn("side", F.lit(s)) for s, t in
             (("source", source), ("target", target)) if t]
    lines = reduce(DataFrame.unionByName, sides).withColumn(
        "table_name", F.explode(F.array("table_name", F.lit(TOTAL)))
    )

    def rows_of(side: str):
        return F.sum(F.when(F.col("side") == side, F.col("row_count")))

    is_total = F.col("table_name") == TOTAL
    status = (
        F.when(is_total, "")
        .when(F.col("target_rows").isNull(), "missing")
        .when(F.col("source_rows") == F.col("target_rows"), "ok")
        .otherwise("different")
    )
    return (
        lines.groupBy("table_name")
        .agg(rows_of("source").alias("source_rows"), rows_of("target").alias("target_rows"))
        .withColumn("difference", F.col("source_rows") - F.col("target_rows"))
        .withColumn("status", status)
    )


def missing_tables(spark: SparkSession, expected: Iterable[str], present: DataFrame) -> DataFrame:
    """Expected names that ``present`` (a frame with ``table_name``) does not list."""
    names = spark.createDataFrame([(name,) for name in expected], "table_name string")
    return names.join(present.select("table_name"), "table_name", "left_anti")
