"""Content hashes that tell whether a row changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator between fields, and how each kind of column enters the hash. NULL text
# counts as empty, a NULL number as 0 and a NULL boolean as false; "bare" text that is NULL is
# skipped with its separator.
SEPARATOR = "||"
HASH_TEXT = {
    "text": "coalesce({0}, '')",
    "bare": "{0}",
    "time": "coalesce(cast({0} as string), '')",
    "int": "cast(coalesce({0}, 0) as string)",
    "decimal": "cast(coalesce({0}, cast(0 as decimal(18,4))) as string)",
    "bool": "cast(coalesce({0}, false) as string)",
}


def row_hash(fields: Sequence[tuple[str, str]]) -> Column:
    """SHA-256 in hex over ``(column, kind)`` pairs, in the order given."""
    parts = ", ".join(HASH_TEXT[kind].format(f"`{name}`") for name, kind in fields)
    return F.expr(f"sha2(concat_ws('{SEPARATOR}', {parts}), 256)")


def backfill_hash(
    df: DataFrame, fields: Sequence[tuple[str, str]], hash_col: str = "row_hash"
) -> DataFrame:
    """Fill a missing hash from the row itself; present hashes stay."""
    return df.withColumn(hash_col, F.coalesce(F.col(hash_col), row_hash(fields)))
