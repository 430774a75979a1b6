"""Runs that cost what changed: curation of new raw rows, and facts by touched days.

Both live on the change log of stored tables (``KeyedTable``). A derived table notes the last batch of its
source that it has seen; a run reads the batches after that one. Every step may be repeated, so a run
that was lost is made good by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, Window
from pyspark.sql import functions as F

from plantlake.functions.times import AsOf, date_key, ntz, start_of_hour
from plantlake.operators.curate import EntitySpec, curate, stage
from plantlake.operators.filters import require
from plantlake.plans import facts
from plantlake.sources.store import BATCH, BEFORE, CHANGE, INSERTED, KeyedTable, Lake, latest_images

SEEN = "seen"
# Rows of a partition that one task puts in place.
HOT_ROWS = 1_000_000


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equality of columns of two aliases, in which NULL equals NULL."""
    met = F.lit(True)
    for c in columns:
        met = met & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return met


def without(rows: DataFrame, gone: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.alias("r").join(gone.alias("g"), same("r", "g", columns), "left_anti")


def only(rows: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.alias("r").join(wanted.alias("g"), same("r", "g", columns), "left_semi")


# --- curation -------------------------------------------------------------------------------------


def new_rows(raw: KeyedTable, spec: EntitySpec, since: int) -> DataFrame:
    """Raw rows that curation has to look at after batch ``since``: the last state of changed keys.

    Where rows of different keys compete for one identity, a corrected row may leave an identity that
    another raw row had lost to it. Only then is the raw table read, for the rows of such identities.
    """
    changes = raw.changes(since)
    # A batch has one row per key; only the rows of several batches need a choice.
    one = raw.done() - since <= 1
    images = changes.where(F.col(CHANGE) != BEFORE).drop(CHANGE, BATCH) if one else latest_images(changes, raw.key)
    if spec.identity == (spec.key,):
        return images
    identity = list(spec.identity)
    before = stage(changes.where(F.col(CHANGE) == BEFORE), spec).select(spec.key, *identity)
    after = stage(images, spec).select(spec.key, *identity)
    left = without(before, after, [spec.key, *identity]).select(*identity).distinct()
    if left.isEmpty():
        return images
    freed = only(stage(raw.read(), spec), left, identity).select(spec.key)
    rows = raw.read().join(freed, spec.key, "left_semi")
    return images.unionByName(without(rows, images, [spec.key]))


def unbeaten(batch: DataFrame, raw: KeyedTable, target: KeyedTable, spec: EntitySpec) -> DataFrame:
    """Batch rows without those that an older row of the same identity beats.

    In a run over all raw rows the two would have competed. The older row is found in the target; its
    raw row must still have that identity, which is looked up for such pairs only.
    """
    if spec.identity == (spec.key,):
        return batch
    identity = list(spec.identity)
    rank = F.struct(*spec.order)
    known = without(target.read(), batch.select(spec.key), [spec.key])
    rivals = only(known, batch, identity).select(*identity, F.col(spec.key).alias("_rival"), rank.alias("_rank"))
    own = batch.select(spec.key, *identity, rank.alias("_own"))
    pairs = own.alias("r").join(rivals.alias("b"), same("r", "b", identity) & (F.col("_rank") > F.col("_own")))
    pairs = pairs.select(F.col(f"r.{spec.key}").alias("_beaten"), "_rival", *[F.col(f"r.{c}").alias(c) for c in identity])
    if pairs.isEmpty():
        return batch
    sought = pairs.select(F.col("_rival").alias(spec.key)).distinct()
    current = stage(raw.read().join(sought, spec.key, "left_semi"), spec)
    current = current.select(F.col(spec.key).alias("_rival"), *identity)
    beaten = only(pairs, current, ["_rival", *identity]).select(F.col("_beaten").alias(spec.key))
    return batch.join(beaten, spec.key, "left_anti")


def curated_batch(
    raw: KeyedTable, target: KeyedTable, spec: EntitySpec, as_of: AsOf, days: int | None, rebuild: bool = False
) -> tuple[DataFrame, int]:
    """The rows a curated table has to take in, and the raw batch it has seen with them.

    A target that has not noted a batch, or ``rebuild``, takes all raw rows. Otherwise only rows that were
    ingested since are read. What has left the time window since then stays in the target, as it does when all
    rows are read, because an upsert deletes nothing; nothing can enter the window but new rows.
    """
    done = raw.done() if raw.exists() else 0
    seen = target.noted(SEEN) if target.exists() else None
    if rebuild or seen is None:
        return curate(raw.read(), spec, as_of, days), done
    batch = curate(new_rows(raw, spec, int(seen)), spec, as_of, days)
    return unbeaten(batch, raw, target, spec), done


# --- facts ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class FactSpec:
    """A fact of which each row comes from one row of its source: how it is made, and its key."""

    name: str
    source: str
    build: Callable[[DataFrame], DataFrame]
    key: str
    source_key: str

    @property
    def by(self) -> list[str]:
        return facts.PARTITION_BY[self.name]


ROW_FACTS = (
    FactSpec("fact_production", "production_orders_clean", facts.fact_production, "production_key", "production_order_id"),
    FactSpec("fact_maintenance", "maintenance_orders_clean", facts.fact_maintenance, "maintenance_key", "maintenance_order_id"),
    FactSpec("fact_quality", "quality_inspections_clean", facts.fact_quality, "inspection_id", "inspection_id"),
)


class Partitions:
    """Some partitions of a fact, by the values of their columns: few, as a batch touches few days."""

    def __init__(self, lake: Lake, fact: str, by: Sequence[str], touched: DataFrame):
        self.lake, self.fact, self.by = lake, fact, list(by)
        self.name = lake.config.qualify(lake.config.gold, fact)
        self.values = self._listed(touched)

    def _listed(self, rows: DataFrame) -> set[Row]:
        return set(rows.select(*self.by).distinct().collect())

    def condition(self) -> Column:
        """What only these partitions meet; by constants alone, so that no other directory is read."""
        groups: dict[tuple, list] = {}
        for first, *rest in self.values:
            groups.setdefault(tuple(rest), []).append(first)
        met = F.lit(False)
        for rest, firsts in groups.items():
            known = [f for f in firsts if f is not None]
            own = F.col(self.by[0]).isin(known)
            if len(known) < len(firsts):
                own = own | F.col(self.by[0]).isNull()
            for c, value in zip(self.by[1:], rest, strict=True):
                own = own & (F.col(c).isNull() if value is None else F.col(c) == value)
            met = met | F.coalesce(own, F.lit(False))
        return met

    def rows(self) -> DataFrame:
        return self.lake.read(self.lake.config.gold, self.fact).where(self.condition())

    def changed(self, key: str, gone: DataFrame, last: DataFrame) -> DataFrame:
        """Rows of these partitions without those that ``gone`` or ``last`` names by partition and key, and with ``last``.

        One shuffle, by partition, serves the choice and the write after it. A partition with very many rows goes to
        several tasks by the hash of the key.
        """
        columns, where = self.rows().columns, [*self.by, key]
        named = gone.select(*where)
        counts = self.rows().select(*self.by).unionByName(named.unionByName(last.select(*where)).select(*self.by))
        hot = counts.groupBy(*self.by).count().where(F.col("count") > HOT_ROWS).collect()
        deal = F.lit(0)
        for row in hot:
            met = F.lit(True)
            for c in self.by:
                met = met & F.col(c).eqNullSafe(F.lit(row[c]))
            deal = F.when(met, F.pmod(F.hash(key), F.lit(row["count"] // HOT_ROWS + 1))).otherwise(deal)
        rows = self.rows().withColumn("_kind", F.lit(0)).unionByName(last.select(columns).withColumn("_kind", F.lit(2)))
        rows = rows.unionByName(named.withColumn("_kind", F.lit(1)), allowMissingColumns=True).withColumn("_deal", deal)
        known = Window.partitionBy(*self.by, "_deal", key)
        rows = rows.repartition(*self.by, "_deal").withColumn("_most", F.max("_kind").over(known))
        return rows.where((F.col("_kind") == 2) | (F.col("_most") == 0)).select(columns)

    def replace(self, rows: DataFrame, as_they_lie: bool = False) -> None:
        """Put ``rows`` in place of these partitions, and drop those for which there are none."""
        stored = self.lake.read(self.lake.config.gold, self.fact).columns
        seen = Observation(f"{self.fact}-{uuid4().hex}")
        kept = rows.select(stored).observe(seen, F.collect_set(F.struct(*self.by)).alias("left"))
        self.lake.overwrite_partitions(kept if as_they_lie else kept.hint("rebalance", *self.by), self.name)
        try:
            left = set(seen.get["left"])
        except Py4JJavaError:
            # Where Spark finds while it runs that there are no rows, it leaves the observation out.
            left = self._listed(rows)
        for gone in self.values - left:
            listed = ", ".join(f"`{c}` = {_literal(gone[c])}" for c in self.by)
            self.lake.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({listed})")


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def _seen(lake: Lake, fact: str) -> int | None:
    gold = lake.config.gold
    if not lake.exists(gold, fact):
        return None
    seen = lake.noted(lake.config.qualify(gold, fact)).get(SEEN)
    return None if seen is None else int(seen)


def refresh_row_fact(lake: Lake, spec: FactSpec, source: KeyedTable, rebuild: bool = False) -> int | None:
    """Bring a fact up to date with its source; how many partitions were replaced, or None for all.

    Old and new states of the changed source rows say which days are touched, and where rows with changed keys
    lie. Of these partitions such rows go and their last states come; no other partition is read or written, nor is
    the source. A repeated run finds the same: keys that are in place already are taken out and put back.
    """
    done, seen, name = source.done(), _seen(lake, spec.name), lake.config.qualify(lake.config.gold, spec.name)
    if rebuild or seen is None:
        lake.overwrite(spec.build(source.read()), lake.config.gold, spec.name, spec.by)
        lake.note(name, **{SEEN: str(done)})
        return None
    if seen >= done:
        return 0
    changes = source.changes(seen)
    touched = Partitions(lake, spec.name, spec.by, spec.build(changes.drop(CHANGE, BATCH)))
    if touched.values:
        # A batch has one row per key; only the rows of several batches need a choice.
        after = changes.where(F.col(CHANGE) != BEFORE)
        one = done - seen == 1
        last = spec.build(after.drop(CHANGE, BATCH) if one else latest_images(changes, spec.source_key))
        gone = spec.build(changes.where(F.col(CHANGE) == BEFORE) if one else changes)
        touched.replace(touched.changed(spec.key, gone, last), as_they_lie=True)
    lake.note(name, **{SEEN: str(done)})
    return len(touched.values)


# --- hourly readings as a state that can be merged ------------------------------------------------

HOURLY = "fact_sensor_hourly"
HOUR = ["equipment_id", "sensor_type", "hour_bucket"]
MERGED = "merged_batch"


def hourly_parts(readings: DataFrame, *more: str) -> DataFrame:
    """Sum, counts and bounds per hour, which can be put together from parts of the readings."""
    value = F.col("reading_value")
    hour = start_of_hour(F.col("reading_timestamp")).alias("hour_bucket")
    return readings.groupBy("equipment_id", "sensor_type", hour, *more).agg(
        F.sum(value).cast("decimal(28,4)").alias("value_sum"),
        F.count(value).alias("value_count"),
        F.min(value).cast("double").alias("min_value"),
        F.max(value).cast("double").alias("max_value"),
        F.count("*").alias("reading_count"),
    )


def with_means(parts: DataFrame) -> DataFrame:
    """The hourly fact with its state: the mean from sum and count, and the day."""
    mean = F.try_divide(F.col("value_sum"), F.col("value_count").cast("decimal(20,0)")).cast("decimal(22,8)").cast("double")
    return parts.select(
        "equipment_id", "sensor_type", "hour_bucket", mean.alias("avg_value"), "min_value", "max_value",
        "reading_count", "value_sum", "value_count", F.col(MERGED).cast("int").alias(MERGED),
        date_key(F.col("hour_bucket")).alias("date_key"),
    )


def merged_hours(state: DataFrame, late: DataFrame, done: int) -> DataFrame:
    """State per hour after taking in ``late`` parts (with ``batch``) that it has not taken in before."""
    columns = [*HOUR, "value_sum", "value_count", "min_value", "max_value", "reading_count"]
    old = state.select(*columns, F.col(MERGED).alias("_mark"), F.lit(True).alias("_old"))
    new = late.select(*columns, F.col(BATCH).alias("_mark"), F.lit(False).alias("_old"))
    known = F.max(F.when(F.col("_old"), F.col("_mark"))).over(Window.partitionBy(*HOUR))
    rows = old.unionByName(new).withColumn("_known", known)
    rows = rows.where(F.col("_old") | F.col("_known").isNull() | (F.col("_mark") > F.col("_known")))
    return rows.groupBy(*HOUR).agg(
        F.sum("value_sum").cast("decimal(28,4)").alias("value_sum"),
        F.sum("value_count").alias("value_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("reading_count").alias("reading_count"),
        F.lit(done).alias(MERGED),
    )


def refresh_hourly(lake: Lake, source: KeyedTable, rebuild: bool = False) -> int | None:
    """Bring the hourly fact up to date with the readings; how many partitions were replaced, or None for all.

    Late readings are merged into the stored sum, counts and bounds of their hours. An hour that had a reading
    which was corrected, or has one now, is counted anew from the source, as bounds cannot be taken
    back. Every hour keeps the last batch merged into it, so that a repeated run adds nothing twice. Only
    partitions with such hours are read and written.
    """
    by, gold = facts.PARTITION_BY[HOURLY], lake.config.gold
    done, seen, name = source.done(), _seen(lake, HOURLY), lake.config.qualify(lake.config.gold, HOURLY)
    if rebuild or seen is None:
        whole = hourly_parts(source.read()).withColumn(MERGED, F.lit(done))
        lake.overwrite(with_means(whole), gold, HOURLY, by)
        lake.note(name, **{SEEN: str(done)})
        return None
    if seen >= done:
        return 0
    changes = source.changes(seen)
    hour = start_of_hour(F.col("reading_timestamp")).alias("hour_bucket")
    corrected = changes.where(F.col(CHANGE) != INSERTED).select("equipment_id", "sensor_type", hour).distinct()
    late = without(hourly_parts(changes.where(F.col(CHANGE) == INSERTED), BATCH), corrected, HOUR)
    day = date_key(F.col("hour_bucket")).alias("date_key")
    touched = Partitions(lake, HOURLY, by, late.select(*HOUR).unionByName(corrected).select(day, "sensor_type"))
    if touched.values:
        state = without(touched.rows(), corrected, HOUR)
        after = merged_hours(state, late, done)
        if not corrected.isEmpty():
            after = after.unionByName(_counted_anew(source, corrected, done))
        touched.replace(with_means(after))
    lake.note(name, **{SEEN: str(done)})
    return len(touched.values)


def _counted_anew(source: KeyedTable, hours: DataFrame, done: int) -> DataFrame:
    first, last = hours.agg(F.min("hour_bucket"), F.max("hour_bucket")).first()
    ts = F.col("reading_timestamp")
    # Bounds for the scan; which hours count is for the join.
    near = require(source.read(), ["reading_timestamp"]).where(
        (ts >= ntz(first)) & (ts < ntz(last + timedelta(hours=1)))
    )
    own = near.withColumn("hour_bucket", start_of_hour(ts))
    return hourly_parts(only(own, hours, HOUR).drop("hour_bucket")).withColumn(MERGED, F.lit(done))
