"""Upserts as pure functions: (target, source) -> next target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.operators.dedupe import dedupe
from plantlake.operators.filters import require

Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _differs(target_hash: Column, source_hash: Column) -> Column:
    return target_hash.isNull() | (target_hash != source_hash)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: Key,
    hash_col: str | None = None,
    latest_by: Sequence[str] = (),
) -> DataFrame:
    """Target after updating matched rows and inserting new ones.

    With ``hash_col`` a matched row changes only if its hash is missing or differs; without it
    every matched row is overwritten. Of source rows with one key the one with the highest
    ``latest_by`` columns counts. Source rows without a key match nothing and would be inserted again
    on each run, so they are left out. There is no delete.

    Computes each side once, which suits sides that are themselves queries.
    """
    keys = key_columns(key)
    new = dedupe(require(source, keys), keys, latest_by).select(target.columns).alias("s")
    old = target.alias("t")
    joined = old.join(new, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    in_source = F.col(f"s.{keys[0]}").isNotNull()
    if hash_col is None:
        take_source = in_source
    else:
        in_target = F.col(f"t.{keys[0]}").isNotNull()
        changed = _differs(F.col(f"t.{hash_col}"), F.col(f"s.{hash_col}"))
        take_source = in_source & (~in_target | changed)
    return joined.select(
        *[
            F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )


def compared_rows(
    target: DataFrame, source: DataFrame, key: Key, hash_col: str | None = None
) -> DataFrame:
    """Source rows that a hash-guarded upsert would write, with ``is_new`` for unknown keys.

    Only the key and hash of the target are read. They are first cut down to the keys of the source,
    which with a small source is a broadcast, and to one row per key.
    """
    keys = key_columns(key)
    guard = F.col(hash_col) if hash_col else F.lit(None).cast("string")
    seen = target.select(*keys, guard.alias("_old")).join(source.select(*keys), keys, "left_semi")
    # Rows that share a key count as changed if any of them is.
    missing = F.max(F.col("_old").isNull()).alias("_gap")
    ends = seen.groupBy(*keys).agg(F.min("_old").alias("_low"), F.max("_old").alias("_high"), missing)
    compared = source.join(ends, keys, "left")
    is_new = F.col("_gap").isNull()
    if hash_col is None:
        changed = F.lit(True)
    else:
        own = F.col(hash_col)
        changed = F.coalesce(F.col("_gap") | (F.col("_low") != own) | (F.col("_high") != own), F.lit(True))
    return compared.where(is_new | changed).select(*source.columns, is_new.alias("is_new"))


def marked_rows(
    target: DataFrame, source: DataFrame, key: Key, hash_col: str | None = None
) -> DataFrame:
    """The same rows as ``compared_rows``, with ``source`` computed once: for a target bucketed by the key.

    Its keys and hashes are taken as they lie, so only the source is shuffled, by the shuffle that made its keys unique.
    """
    keys = key_columns(key)
    if hash_col is None:
        known = target.select(*keys).distinct().withColumn("_same", F.lit(False))
    else:
        known = target.groupBy(*keys).agg(
            F.min(hash_col).alias("_low"), F.max(hash_col).alias("_high"), F.max(F.col(hash_col).isNull()).alias("_gap")
        )
        ends = [F.col("_low"), F.col("_high")]
        known = known.select(*keys, F.when(~F.col("_gap") & (ends[0] == ends[1]), ends[0]).alias("_old"), F.lit(False).alias("_same"))
    joined = source.join(known, keys, "left")
    is_new = F.col("_same").isNull()
    if hash_col is not None:
        joined = joined.where(is_new | F.coalesce(F.col("_old") != F.col(hash_col), F.lit(True)))
    return joined.select(*source.columns, is_new.alias("is_new"))


def replace_rows(target: DataFrame, source: DataFrame, key: Key) -> DataFrame:
    """Target with each row whose key the source has replaced by the source row."""
    keys = key_columns(key)
    joined = target.alias("t").join(
        source.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left"
    )
    found = F.col(f"s.{keys[0]}").isNotNull()
    return joined.select(
        *[F.when(found, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    )


def merge_insert_only(target: DataFrame, source: DataFrame, key: Key) -> DataFrame:
    """Target plus the source rows whose key it lacks; present rows never change."""
    keys = key_columns(key)
    missing = require(source, keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(missing.select(target.columns))
