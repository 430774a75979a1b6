"""Dense integer keys without a global sort: counts per part, and offsets from their sums."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART, PLACE = "_part", "_place"


def with_place(rows: DataFrame) -> DataFrame:
    """Each row with its task and its place in it. Only stable once stored, so callers store the result."""
    number = F.monotonically_increasing_id()
    return rows.withColumns({PART: F.shiftright(number, 33), PLACE: number.bitwiseAND((1 << 33) - 1)})


def identity(stored: DataFrame, after: int) -> Column:
    """Keys after + 1, after + 2, ... for stored rows with a place; the driver gets a count per part."""
    counts = stored.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).orderBy(PART).collect()
    starts = accumulate((row["n"] for row in counts), initial=after + 1)
    listed = ", ".join(f"{row[PART]}L, {start}L" for row, start in zip(counts, starts))
    return F.expr(f"map({listed})[{PART}]") + F.col(PLACE) if counts else F.lit(None).cast("long")
