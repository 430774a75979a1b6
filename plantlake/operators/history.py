"""Validity-interval history of a keyed table, and lookups in it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.functions.hashing import backfill_hash
from plantlake.functions.times import AsOf, ntz
from plantlake.operators.dedupe import dedupe
from plantlake.operators.filters import require

# Fixed value: the end of a version that is still valid.
OPEN_END = datetime(9999, 12, 31)

VALIDITY = ("effective_start", "effective_end", "is_current")


def surrogate_key(key: str, hash_col: str) -> Column:
    """Key of one version, equal on every run and made without a global sort or counter."""
    return F.xxhash64(F.col(key), F.col("effective_start"), F.col(hash_col))


def first_versions(source: DataFrame, key: str, ts: str, as_of: AsOf) -> DataFrame:
    """Open versions for source rows: valid from their time, or from ``as_of`` without one."""
    return require(source, [key]).select(
        *[c for c in source.columns if c != ts],
        F.coalesce(F.col(ts), ntz(as_of)).alias("effective_start"),
        ntz(OPEN_END).alias("effective_end"),
        F.lit(True).alias("is_current"),
    )


def changes_of(known: DataFrame, opened: DataFrame, key: str, hash_col: str) -> DataFrame:
    """What a batch of ``opened`` versions, one per key, does to a history: one row per changed key.

    Names the version that is cut (``_prior``, by its start), the start of the version after the new one
    (``_next``) and whether the key is new. A row with the hash of the version valid at its start changes
    nothing; nor does one that lies before all versions and has the hash of the first. Versions are
    summed up to one row per key before anything is decided, so a long history is spread like other rows.
    """
    at = opened.select(key, F.col("effective_start").alias("_at"), F.col(hash_col).alias("_hash"))
    start, end = F.col("effective_start"), F.col("effective_end")
    version = F.struct(start.alias("start"), end.alias("end"), F.col(hash_col).alias("hash"))
    versions = known.select(key, version.alias("_v"))
    after = F.col("_v.start") > F.col("_at")
    around = at.join(versions, key, "left").groupBy(key, "_at", "_hash").agg(
        F.min(F.when(after, F.col("_v"))).alias("next"),
        F.max(F.when(~after, F.col("_v"))).alias("prior"),
    )
    covers = F.col("prior.end") > F.col("_at")
    beside = F.when(F.col("prior").isNull(), F.col("next.hash")).when(covers, F.col("prior.hash"))
    return around.where(beside.isNull() | (beside != F.col("_hash"))).select(
        key, "_at", F.col("next.start").alias("_next"), F.col("prior.start").alias("_prior"),
        (F.col("prior").isNull() & F.col("next").isNull()).alias("is_new"),
    )


def cut_versions(known: DataFrame, changes: DataFrame, key: str, how: str) -> DataFrame:
    """Versions of a history (of changed keys, if ``how`` is inner), cut where the changes say so."""
    end = F.col("effective_end")
    cut = F.coalesce((F.col("effective_start") == F.col("_prior")) & (end > F.col("_at")), F.lit(False))
    marks = changes.select(key, "_at", "_prior")
    return known.join(marks, key, how).select(
        *[c for c in known.columns if c not in VALIDITY],
        "effective_start",
        F.when(cut, F.col("_at")).otherwise(end).alias("effective_end"),
        (~cut & F.col("is_current")).alias("is_current"),
    )


def placed_versions(opened: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The new versions: each ends where the next known one starts, or stays open."""
    return opened.join(changes.select(key, "_next", "is_new"), key).select(
        *[c for c in opened.columns if c not in VALIDITY],
        "effective_start",
        F.coalesce("_next", "effective_end").alias("effective_end"),
        F.col("_next").isNull().alias("is_current"),
        "is_new",
    )


def apply_history(
    history: DataFrame,
    source: DataFrame,
    key: str,
    ts: str,
    hash_col: str,
    as_of: AsOf,
    hashed: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """History after one batch, of which the latest row per key counts.

    A row is placed by its time: the version valid then is closed there, and the row ends where the next
    version starts, or stays open. So a late row becomes a closed interval. Equal hashes change nothing;
    versions without a hash are first given that of their ``hashed`` columns, if these are named.
    """
    columns = [c for c in history.columns if c != "version_key"]
    known = (backfill_hash(history, hashed, hash_col) if hashed else history).select(columns)
    batch = dedupe(require(source, [key]), [key], [ts])
    opened = first_versions(batch, key, ts, as_of).select(columns)
    changes = changes_of(known, opened, key, hash_col)
    placed = placed_versions(opened, changes, key).select(columns)
    result = cut_versions(known, changes, key, "left").select(columns).unionByName(placed)
    if "version_key" in history.columns:
        result = with_version_key(result, key, hash_col).select(history.columns)
    return result


def with_version_key(history: DataFrame, key: str, hash_col: str) -> DataFrame:
    return history.withColumn("version_key", surrogate_key(key, hash_col))


def as_of_join(
    events: DataFrame, history: DataFrame, key: str, ts: str, how: str = "left"
) -> DataFrame:
    """Each event with the version valid at its time (start inclusive, end exclusive).

    The equality on ``key`` keeps this a hash or sort-merge join. Versions of one key do not
    overlap, so an event meets at most one.
    """
    versions = history.alias("h")
    matched = events.alias("e").join(
        versions,
        (F.col(f"e.{key}") == F.col(f"h.{key}"))
        & (F.col("h.effective_start") <= F.col(f"e.{ts}"))
        & (F.col(f"e.{ts}") < F.col("h.effective_end")),
        how,
    )
    added = [F.col(f"h.{c}").alias(c) for c in history.columns if c not in events.columns]
    return matched.select(*[F.col(f"e.{c}").alias(c) for c in events.columns], *added)


def as_of_lookup(
    events: DataFrame, history: DataFrame, key: str, ts: str, bucket_days: int | None = None
) -> DataFrame:
    """The rows of ``as_of_join`` (left), in one sorted pass over versions and events of each key.

    For keys with many versions: the last version that has started is carried forward to the events behind
    it, so that no event meets more than one. With few versions the join is faster. Events without key or time have none. With
    ``bucket_days`` a key is split into spans of so many days, each of which starts with the version carried
    into it; that reads key and time of the events once more, and spreads a key with many events.
    """
    added = [c for c in history.columns if c not in events.columns]
    start, end = F.col("effective_start"), F.col("effective_end")
    version = F.struct(start.alias("_start"), end.alias("_end"), *[F.col(c).alias(c) for c in added])
    event = F.struct(*[F.col(c).alias(c) for c in events.columns])
    stream = [F.col(key).alias("_key"), F.col("_at")]
    # Of versions with one start, all but the last have ended there.
    versions = history.withColumn("_at", start).select(*stream, version.alias("_version"))
    found = events.withColumn("_at", F.col(ts))
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    by = ["_key"]
    if bucket_days is not None:
        by = ["_key", "_bucket"]
        bucket = F.floor(F.unix_date(F.col("_at").cast("date")) / bucket_days).alias("_bucket")
        spans = versions.select("_key", bucket, "_version").unionByName(
            found.where(known).select(*stream).select("_key", bucket, F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"))
        )
        last = spans.groupBy(*by).agg(F.max("_version").alias("_last"))
        earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = last.withColumn("_version", F.last("_last", ignorenulls=True).over(earlier)).where("_version IS NOT NULL")
        versions = versions.withColumn("_bucket", bucket).unionByName(
            carried.select("_key", F.col("_version._start").alias("_at"), "_version", "_bucket")
        )
        found = found.withColumn("_bucket", bucket)
    rows = versions.withColumn("_event", F.lit(None).cast(events.select(event.alias("e")).schema["e"].dataType)).unionByName(
        found.where(known).select(*stream, *by[1:], F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"), event.alias("_event"))
    )
    before = Window.partitionBy(*by).orderBy(
        F.col("_at"), F.col("_event").isNotNull(), F.col("_version._end")
    ).rowsBetween(Window.unboundedPreceding, 0)
    seen = rows.withColumn("_seen", F.last("_version", ignorenulls=True).over(before)).where("_event IS NOT NULL")
    valid = F.col("_at") < F.col("_seen._end")
    matched = seen.select("_event.*", *[F.when(valid, F.col(f"_seen.{c}")).alias(c) for c in added])
    unknown = events.where(~known).select(
        *events.columns, *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in added]
    )
    return matched.unionByName(unknown)
