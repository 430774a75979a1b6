"""One query per operator, over the whole tables of a directory."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.config import LakeConfig, shared_folder
from plantlake.functions import parsing as p
from plantlake.functions.hashing import backfill_hash, row_hash
from plantlake.functions.times import date_key, ntz
from plantlake.operators.curate import EntitySpec, curate, hashed, stage, survivors
from plantlake.operators.filters import recent, require
from plantlake.operators.history import (
    apply_history,
    as_of_join,
    as_of_lookup,
    first_versions,
    with_version_key,
)
from plantlake.operators.merge import merge_insert_only, merge_upsert
from plantlake.plans import calendar as cal
from plantlake.plans import dimensions as dim
from plantlake.plans import facts, reports, views
from plantlake.plans.build import SPLIT, build_lake, curated_table, history_table
from plantlake.plans.entities import (
    EQUIPMENT,
    EQUIPMENT_VERSIONS,
    MAINTENANCE,
    NARROW_LAYOUTS,
    PRODUCTION,
    QUALITY,
    SENSORS,
    TABLE_HASH,
    narrowed,
)
from plantlake.plans.incremental import (
    HOURLY, MERGED, ROW_FACTS, SEEN, curated_batch, refresh_hourly, refresh_row_fact,
)
from plantlake.plans.ingest import all_ingested, ingest_all, raw_table
from plantlake.plans.view_text import publish_views
from plantlake.sources.audit import missing_tables, reconcile, row_counts
from plantlake.sources.extract import event_time, extract, high_watermark
from plantlake.sources.plant_feed import PlantFeed
from plantlake.sources.schemas import RAW_TABLES, as_raw
from plantlake.sources.store import VERSION_ID, KeyedTable, Lake, register_view

# Reference times that lie inside the data.
EQUIPMENT_AS_OF = datetime(2001, 12, 15, 10, 30)
ORDERS_AS_OF = datetime(2001, 11, 4, 10, 30)
MAINTENANCE_AS_OF = datetime(2001, 8, 1, 10, 30)
SENSORS_AS_OF = datetime(2024, 3, 15, 10, 30)
REPORT_DAY = date(2001, 7, 15)
SENSOR_DAY = date(2024, 1, 25)
FIRST_RUN = datetime(2001, 9, 15)
SECOND_RUN = datetime(2001, 12, 15)
BUILD_AS_OF = datetime(2001, 9, 1, 6, 0)
FIRST_EXTRACT = date(2000, 1, 1)
SENSOR_EXTRACT = date(2024, 1, 20)

KEY_GROUPS = 16

AS_OF = {
    EQUIPMENT.name: EQUIPMENT_AS_OF,
    EQUIPMENT_VERSIONS.name: EQUIPMENT_AS_OF,
    SENSORS.name: SENSORS_AS_OF,
    PRODUCTION.name: ORDERS_AS_OF,
    MAINTENANCE.name: MAINTENANCE_AS_OF,
    QUALITY.name: ORDERS_AS_OF,
}


class Frames:
    """The frames the queries share, each built when first used and never collected."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, stored: dict[str, DataFrame] | None = None
    ):
        self.spark = spark
        self.feed = PlantFeed(spark, sf_dir, stored)

    def raw(self, spec: EntitySpec) -> DataFrame:
        return self.feed.raw(spec.raw)

    def staged(self, spec: EntitySpec) -> DataFrame:
        return stage(self.raw(spec), spec)

    def curated(self, spec: EntitySpec) -> DataFrame:
        return curate(self.raw(spec), spec)

    def first_extract(self, spec: EntitySpec) -> DataFrame:
        """What the raw table held earlier: the rows updated before a day.

        Maintenance orders of the two months before that day were still open then.
        """
        if spec.raw == EQUIPMENT.raw:
            # The thirty days younger versions had not arrived, and undated rows had.
            known = event_time(spec.raw) < ntz(date(2001, 9, 20))
            return self.raw(spec).where(F.coalesce(known, F.lit(True)))
        day = SENSOR_EXTRACT if spec is SENSORS else FIRST_EXTRACT
        rows = self.raw(spec).where(event_time(spec.raw) < ntz(day))
        if spec is MAINTENANCE:
            still_open = event_time(spec.raw) >= ntz(date(1999, 11, 1))
            rows = rows.withColumn("actual_end", F.when(~still_open, F.col("actual_end")))
        return rows

    def curated_first(self, spec: EntitySpec) -> DataFrame:
        return curate(self.first_extract(spec), spec)

    @cached_property
    def production(self) -> DataFrame:
        return facts.fact_production(self.curated(PRODUCTION))

    @cached_property
    def maintenance(self) -> DataFrame:
        return facts.fact_maintenance(self.curated(MAINTENANCE))

    @cached_property
    def quality(self) -> DataFrame:
        return facts.fact_quality(self.curated(QUALITY))

    @cached_property
    def hourly(self) -> DataFrame:
        return facts.fact_sensor_hourly(self.curated(SENSORS))

    @cached_property
    def equipment(self) -> DataFrame:
        return dim.dim_equipment(self.curated(EQUIPMENT))

    @cached_property
    def types(self) -> DataFrame:
        return dim.dim_maintenance_type(self.curated(MAINTENANCE))

    def dates(self, *used: tuple[DataFrame, str]) -> DataFrame:
        return cal.calendar(cal.days(cal.spanning(used)))

    @cached_property
    def order_dates(self) -> DataFrame:
        """Days from the first to the last update of production or maintenance orders."""
        return self.dates(
            (self.staged(PRODUCTION), "last_update"), (self.staged(MAINTENANCE), "last_update")
        )

    @cached_property
    def sensor_dates(self) -> DataFrame:
        return self.dates((self.staged(SENSORS), "reading_timestamp"))

    def oee(self, since: date | None = None, until: date | None = None) -> DataFrame:
        return views.oee_daily(
            self.production, self.maintenance, self.quality, None, self.equipment, since, until
        )

    def downtime(self, since: date | None = None, until: date | None = None) -> DataFrame:
        return views.downtime_by_cause(
            self.maintenance, None, self.equipment, self.types, since, until
        )

    @cached_property
    def critical(self) -> DataFrame:
        return views.critical_equipment(self.maintenance, self.quality, self.equipment)

    def trends(self, since: date | None = None, until: date | None = None) -> DataFrame:
        return views.sensor_trends(self.hourly, None, self.equipment, since, until)

    def history(self) -> DataFrame:
        """History after the first run, without a surrogate key."""
        return first_versions(
            self.curated_first(EQUIPMENT_VERSIONS), "equipment_id", "last_update_date", FIRST_RUN
        )

    def next_history(self) -> DataFrame:
        return apply_history(
            self.history(), self.curated(EQUIPMENT_VERSIONS),
            "equipment_id", "last_update_date", TABLE_HASH, SECOND_RUN, EQUIPMENT_VERSIONS.hashed,
        )

    def lake(self) -> Lake:
        """A fresh lake in the shared folder, with schema names of its own."""
        run = uuid4().hex[:12]
        config = LakeConfig(
            root=f"{shared_folder(self.spark)}/lake-{run}",
            raw=f"raw_{run}", curated=f"curated_{run}", gold=f"gold_{run}",
        )
        lake = Lake(self.spark, config)
        for schema in (config.raw, config.curated, config.gold):
            lake.create_schema(schema)
        return lake


# --- parsing ------------------------------------------------------------------------------------


def parse_all(f: Frames) -> DataFrame:
    text = ("planned_start", "planned_end", "actual_start", "actual_end", "last_update")
    return f.raw(PRODUCTION).select(
        "production_order_id", *[p.parse_timestamp(c).alias(c) for c in text]
    )


def parse_profile(spec: EntitySpec, column: str, formats) -> Callable[[Frames], DataFrame]:
    def query(f: Frames) -> DataFrame:
        return f.raw(spec).select(
            spec.key,
            F.col(column).alias("text"),
            p.parse_timestamp(column, formats).alias("parsed"),
        )

    return query


def parse_install_date(f: Frames) -> DataFrame:
    column = "installation_date"
    return f.raw(EQUIPMENT).select(
        "equipment_id",
        F.col(column).alias("text"),
        p.parse_date(column, p.FORMATS_P11_DATE).alias("installation_date"),
        p.parse_date(column).alias("installation_date_any"),
    )


def parse_readings(f: Frames) -> DataFrame:
    return f.raw(SENSORS).select(
        "reading_id", p.parse_decimal("reading_value").alias("reading_value")
    )


def parse_quantities(f: Frames) -> DataFrame:
    columns = ("planned_quantity", "actual_quantity")
    return f.raw(PRODUCTION).select(
        "production_order_id", *[p.parse_int(c).alias(c) for c in columns]
    )


def parse_passed(f: Frames) -> DataFrame:
    return f.raw(QUALITY).select("inspection_id", p.parse_bool("passed").alias("passed"))


def upper_texts(f: Frames) -> DataFrame:
    status = p.norm_upper("status").alias("status")
    codes = p.norm_upper("defect_codes").alias("status")
    sources = [(EQUIPMENT, status), (PRODUCTION, status), (MAINTENANCE, status), (QUALITY, codes)]
    frames = [
        f.raw(spec).groupBy(F.lit(spec.raw).alias("table_name"), text).agg(F.count("*").alias("n"))
        for spec, text in sources
    ]
    return frames[0].unionAll(frames[1]).unionAll(frames[2]).unionAll(frames[3])


def lower_texts(f: Frames) -> DataFrame:
    sources = [
        (SENSORS, "sensor_type"), (MAINTENANCE, "maintenance_type"),
        (MAINTENANCE, "priority"), (QUALITY, "inspection_type"),
    ]
    frames = [
        f.raw(spec)
        .groupBy(F.lit(column).alias("column_name"), p.norm_lower(column).alias("value"))
        .agg(F.count("*").alias("n"))
        for spec, column in sources
    ]
    return frames[0].unionAll(frames[1]).unionAll(frames[2]).unionAll(frames[3])


# --- filters, de-duplication, hashes --------------------------------------------------------------


def required_ids(f: Frames) -> DataFrame:
    return require(f.raw(QUALITY), ["inspection_id"]).select("inspection_id", "defect_codes")


def window_query(spec: EntitySpec, nulls: str) -> Callable[[Frames], DataFrame]:
    def query(f: Frames) -> DataFrame:
        rows = recent(f.staged(spec), spec.ts_col, spec.window_days, AS_OF[spec.name], nulls)
        return rows.select(spec.key, spec.ts_col)

    return query


def started(f: Frames) -> DataFrame:
    columns = ["maintenance_order_id", "actual_start", "actual_end"]
    return require(f.staged(MAINTENANCE), ["actual_start"]).select(columns)


def coded(f: Frames) -> DataFrame:
    return require(f.staged(QUALITY), ["defect_codes"], blank_is_null=True).select(
        "inspection_id", "defect_codes"
    )


def last_calendar_days(f: Frames) -> DataFrame:
    return reports.last_days(f.order_dates, ORDERS_AS_OF, 30).select("date_key", "full_date")


def dedupe_query(spec: EntitySpec) -> Callable[[Frames], DataFrame]:
    def query(f: Frames) -> DataFrame:
        return survivors(f.staged(spec), spec, None, None)

    return query


def hash_query(spec: EntitySpec) -> Callable[[Frames], DataFrame]:
    def query(f: Frames) -> DataFrame:
        hashed = f.staged(spec).withColumn("row_hash", row_hash(spec.hashed))
        return hashed.select(spec.key, "row_hash")

    return query


def hash_backfill(f: Frames) -> DataFrame:
    known = F.when(F.col("location").isNotNull(), F.lit("kept"))
    versions = f.curated(EQUIPMENT_VERSIONS).withColumn("row_hash", known)
    return backfill_hash(versions, EQUIPMENT_VERSIONS.hashed).select("equipment_id", "row_hash")


def curate_window(spec: EntitySpec) -> Callable[[Frames], DataFrame]:
    return lambda f: curate(f.raw(spec), spec, AS_OF[spec.name], spec.window_days)


def curate_narrow(spec: EntitySpec) -> Callable[[Frames], DataFrame]:
    """Curation with the narrow layouts of each column."""
    return lambda f: curate(f.raw(spec), narrowed(spec, NARROW_LAYOUTS[spec.name]))


def curate_full(spec: EntitySpec) -> Callable[[Frames], DataFrame]:
    return lambda f: f.curated(spec)


# --- merges and history ---------------------------------------------------------------------------


def merge_query(spec: EntitySpec) -> Callable[[Frames], DataFrame]:
    return lambda f: merge_upsert(
        f.curated_first(spec), f.curated(spec), spec.key, TABLE_HASH, [spec.ts_col]
    )


def merge_unguarded(f: Frames) -> DataFrame:
    target = f.curated_first(QUALITY).drop("row_hash")
    batch = f.curated(QUALITY).drop("row_hash")
    return merge_upsert(target, batch, QUALITY.key, latest_by=[QUALITY.ts_col])


def merge_calendar(f: Frames) -> DataFrame:
    first = f.dates((stage(f.first_extract(PRODUCTION), PRODUCTION), "last_update"))
    return merge_insert_only(first, f.order_dates, "date_key")


def expired_versions(f: Frames) -> DataFrame:
    return f.next_history().where(~F.col("is_current")).select(
        "equipment_id", "effective_start", "effective_end", "row_hash"
    )


def opened_versions(f: Frames) -> DataFrame:
    return f.next_history().where("is_current").select(
        "equipment_id", "effective_start", "effective_end", "row_hash"
    )


def version_keys(f: Frames) -> DataFrame:
    keyed = with_version_key(f.next_history(), "equipment_id", TABLE_HASH)
    return keyed.agg(
        F.count("*").alias("versions"), F.count_distinct("version_key").alias("keys")
    )


def version_at(f: Frames, look_up=as_of_join) -> DataFrame:
    events = f.curated(PRODUCTION).select("production_order_id", "equipment_id", "actual_start")
    versions = f.next_history().select(
        "equipment_id", F.col("status").alias("equipment_status"), "location",
        "effective_start", "effective_end",
    )
    return look_up(events, versions, "equipment_id", "actual_start")


# --- calendar -------------------------------------------------------------------------------------


def localized_dates(f: Frames) -> DataFrame:
    bounds = cal.calendar_range(f.staged(PRODUCTION), "planned_start")
    return cal.localized_calendar(cal.days(bounds))


def date_keys(f: Frames) -> DataFrame:
    return f.staged(SENSORS).select(
        "reading_id", date_key(F.col("reading_timestamp")).alias("date_key")
    )


# --- dimensions -----------------------------------------------------------------------------------


def equipment_history(f: Frames) -> DataFrame:
    keyed = with_version_key(f.next_history(), "equipment_id", TABLE_HASH)
    return dim.dim_equipment_history(keyed).drop("version_key")


# --- extracts and audits --------------------------------------------------------------------------


def incremental(f: Frames) -> DataFrame:
    rows = extract(f.raw(EQUIPMENT), EQUIPMENT.raw, watermark=datetime(2001, 9, 10))
    return rows.select("equipment_id", "location", "last_update_date")


def fallback(f: Frames) -> DataFrame:
    rows = extract(f.raw(QUALITY), QUALITY.raw, as_of=ORDERS_AS_OF)
    return rows.select("inspection_id", "last_update")


def watermarks(f: Frames) -> DataFrame:
    frames = [
        high_watermark(f.raw(spec), spec.raw).withColumn("table_name", F.lit(spec.raw))
        for spec in (EQUIPMENT, SENSORS, PRODUCTION, MAINTENANCE, QUALITY)
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def new_data(f: Frames) -> DataFrame:
    def row(spec: EntitySpec) -> DataFrame:
        before = high_watermark(f.first_extract(spec), spec.raw).scalar()
        return high_watermark(f.raw(spec), spec.raw).select(
            F.lit(spec.raw).alias("table_name"),
            F.col("high_watermark").alias("source_max"),
            before.alias("target_max"),
            (F.col("high_watermark") > before).alias("has_new_data"),
        )

    rows = row(EQUIPMENT)
    for spec in (PRODUCTION, MAINTENANCE, SENSORS, QUALITY):
        rows = rows.unionByName(row(spec))
    return rows


def raw_tables(f: Frames) -> dict[str, DataFrame]:
    return {table: f.feed.raw(table) for table in RAW_TABLES}


def reconciliation(f: Frames) -> DataFrame:
    cleaned = {
        s.raw: f.curated(s) for s in (EQUIPMENT, PRODUCTION, MAINTENANCE, QUALITY)
    }
    return reconcile(raw_tables(f), cleaned)


def absent_tables(f: Frames) -> DataFrame:
    """What a lake still lacks after all feeds but the sensors' have been loaded, by its catalog."""
    lake = f.lake()
    for spec in (EQUIPMENT, PRODUCTION, MAINTENANCE, QUALITY):
        raw_table(lake, spec.raw).load(as_raw(f.raw(spec), spec.raw))
    listed = lake.tables(lake.config.raw).select(F.col("tableName").alias("table_name"))
    return missing_tables(f.spark, RAW_TABLES, listed)


# --- stored tables --------------------------------------------------------------------------------


def kept(lake: Lake, batch: DataFrame, key: str | None = None) -> DataFrame:
    """A batch that is used more than once, written once; with a ``key`` in the buckets of a large table."""
    if key is None:
        lake.replace(batch, lake.config.raw, "kept_batch")
    else:
        lake.keep(batch, lake.config.raw, "kept_batch", key, KEY_GROUPS * SPLIT)
    return lake.read(lake.config.raw, "kept_batch")


def large_table(lake: Lake, schema: str, name: str, batch: DataFrame, key: str) -> KeyedTable:
    """A table whose batches are about as large as itself: bucketed, so that its rows are not shuffled."""
    return lake.keyed(schema, name, batch.schema, key, KEY_GROUPS, bucketed=True, split=SPLIT)


def stored_first_load(f: Frames) -> DataFrame:
    table = raw_table(f.lake(), PRODUCTION.raw)
    table.load(as_raw(f.raw(PRODUCTION), PRODUCTION.raw))
    return table.read()


def stored_upsert(f: Frames) -> DataFrame:
    batch = f.curated(QUALITY).drop("row_hash")
    lake = f.lake()
    table = large_table(lake, lake.config.raw, "inspections", batch, QUALITY.key)
    table.load(f.curated_first(QUALITY).drop("row_hash"))
    table.upsert(batch, latest_by=["last_update"])
    return table.read()


def stored_guarded_upsert(f: Frames) -> DataFrame:
    lake = f.lake()
    # A hash takes up half of a stored row and is soon made again.
    batch = hashed(kept(lake, f.curated(PRODUCTION).drop(TABLE_HASH), PRODUCTION.key), PRODUCTION)
    table = large_table(lake, lake.config.curated, PRODUCTION.name, batch, PRODUCTION.key)
    table.load(f.curated_first(PRODUCTION))
    for _ in range(2):
        table.upsert(batch, TABLE_HASH, latest_by=["last_update"])
    return table.read()


def bucketed_upsert(f: Frames) -> DataFrame:
    """The guarded upsert into a table bucketed by its key."""
    return stored_guarded_upsert(f)


def stored_history(f: Frames) -> DataFrame:
    batch = f.curated(EQUIPMENT_VERSIONS)
    table = history_table(f.lake(), batch, 16)
    ts = EQUIPMENT_VERSIONS.ts_col
    for rows, as_of in ((f.curated_first(EQUIPMENT_VERSIONS), FIRST_RUN), (batch, SECOND_RUN)):
        table.track(rows, ts, TABLE_HASH, as_of, EQUIPMENT_VERSIONS.hashed)
    return table.read().drop("version_key")


def stored_fact(f: Frames) -> DataFrame:
    lake = f.lake()
    by = facts.PARTITION_BY["fact_quality"]
    lake.overwrite(f.quality, lake.config.gold, "fact_quality", by, 1_000_000)
    return lake.read(lake.config.gold, "fact_quality")


def stored_file_sizes(f: Frames) -> DataFrame:
    """Rows of the files of a stored fact: in all, and whether none holds more than was asked for."""
    lake, most = f.lake(), 5_000
    by = facts.PARTITION_BY["fact_sensor_hourly"]
    lake.overwrite(f.hourly, lake.config.gold, "fact_sensor_hourly", by, most)
    stored = lake.read(lake.config.gold, "fact_sensor_hourly")
    files = stored.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("row_count"), (F.max("n") <= most).alias("within_limit"))


def stored_fact_days(f: Frames) -> DataFrame:
    lake = f.lake()
    by = facts.PARTITION_BY["fact_sensor_hourly"]
    lake.overwrite(f.hourly, lake.config.gold, "fact_sensor_hourly", by)
    return views.from_day(lake.read(lake.config.gold, "fact_sensor_hourly"), "date_key", SENSOR_DAY)


def stored_dimension(f: Frames) -> DataFrame:
    lake = f.lake()
    batch = kept(lake, f.curated(PRODUCTION).select("product_id"))
    for _ in range(2):
        lake.replace(dim.dim_product(batch), lake.config.gold, "dim_product")
    return lake.read(lake.config.gold, "dim_product")


def stored_if_empty(f: Frames) -> DataFrame:
    lake = f.lake()
    for _ in range(2):
        lake.load_if_empty(f.order_dates, lake.config.gold, "dim_date")
    return lake.read(lake.config.gold, "dim_date")


def stored_appends(f: Frames) -> DataFrame:
    lake = f.lake()
    for spec in (PRODUCTION, MAINTENANCE):
        rows = f.staged(spec).select(F.col(spec.key).alias("order_id"), "equipment_id", "status")
        lake.append(rows, lake.config.raw, "orders_seen")
    return lake.read(lake.config.raw, "orders_seen")


def session_view(f: Frames) -> DataFrame:
    register_view("plantlake_oee_daily", f.oee())
    return f.spark.sql(
        "select equipment_id, count(*) as days, round(avg(quality_rate), 4) as mean_quality"
        " from plantlake_oee_daily group by equipment_id"
    )


def stored_reset(f: Frames) -> DataFrame:
    lake = f.lake()
    gold = lake.config.gold
    lake.replace(dim.dim_technician(f.curated(MAINTENANCE)), gold, "dim_technician")
    lake.replace(dim.dim_product(f.curated(PRODUCTION)), gold, "dim_product")
    lake.drop(gold, "dim_product")
    lake.reset_schema(gold)
    lake.replace(dim.dim_maintenance_type(f.curated(MAINTENANCE)), gold, "dim_maintenance_type")
    listed = lake.tables(gold).select(F.col("tableName").alias("table_name"))
    counts = row_counts({"dim_maintenance_type": lake.read(gold, "dim_maintenance_type")})
    return listed.join(counts, "table_name")


def ingest_summary(f: Frames) -> DataFrame:
    lake = f.lake()
    first = {spec.raw: f.first_extract(spec) for spec in (SENSORS, PRODUCTION, MAINTENANCE)}
    all_ingested(ingest_all(lake, first.__getitem__, ORDERS_AS_OF, first))
    return all_ingested(ingest_all(lake, f.feed.raw, ORDERS_AS_OF)).select(
        "table_name", "mode", "rows_read", "rows_written", "status"
    )


def ingested_orders(f: Frames) -> DataFrame:
    lake = f.lake()
    for source_of in (lambda _: f.first_extract(PRODUCTION), f.feed.raw):
        all_ingested(ingest_all(lake, source_of, ORDERS_AS_OF, [PRODUCTION.raw]))
    return raw_table(lake, PRODUCTION.raw).read().groupBy("status").agg(
        F.count("*").alias("rows"), F.count_distinct("production_order_id").alias("orders")
    )


def stored_twice(f: Frames, spec: EntitySpec, after_first: Callable[[Lake, KeyedTable], object]) -> tuple[Lake, KeyedTable]:
    """The curated table of a lake after two runs; ``after_first`` is called between them."""
    lake, batch = f.lake(), f.curated(spec)
    table = curated_table(lake, spec, batch, 16)
    table.load(f.curated_first(spec))
    after_first(lake, table)
    table.upsert(batch, TABLE_HASH, latest_by=[spec.ts_col])
    return lake, table


def touched_days(f: Frames) -> DataFrame:
    """A stored fact after a second run has replaced the days that its batch touched."""
    spec = next(s for s in ROW_FACTS if s.name == "fact_production")
    lake, table = stored_twice(f, PRODUCTION, lambda lake, table: refresh_row_fact(lake, spec, table))
    refresh_row_fact(lake, spec, table)
    return lake.read(lake.config.gold, spec.name)


def moved_days(f: Frames) -> DataFrame:
    """The same for maintenance, of which the batch corrects orders that were still open."""
    spec = next(s for s in ROW_FACTS if s.name == "fact_maintenance")
    lake, table = stored_twice(f, MAINTENANCE, lambda lake, table: refresh_row_fact(lake, spec, table))
    refresh_row_fact(lake, spec, table)
    return lake.read(lake.config.gold, spec.name)


def merged_readings(f: Frames) -> DataFrame:
    """The hourly fact after late readings have been merged into it."""
    lake, table = stored_twice(f, SENSORS, refresh_hourly)
    refresh_hourly(lake, table)
    return lake.read(lake.config.gold, HOURLY).drop("value_sum", "value_count", MERGED)


def curated_in_two_runs(f: Frames) -> DataFrame:
    """Orders in their time window after two runs, of which the second curates newly ingested rows only."""
    lake = f.lake()
    raw = raw_table(lake, PRODUCTION.raw)
    table = curated_table(lake, PRODUCTION, f.curated(PRODUCTION), 16)
    for rows, as_of in ((f.first_extract(PRODUCTION), FIRST_EXTRACT), (f.raw(PRODUCTION), ORDERS_AS_OF)):
        all_ingested(ingest_all(lake, lambda _, rows=rows: rows, as_of, [PRODUCTION.raw]))
        batch, done = curated_batch(raw, table, PRODUCTION, as_of, PRODUCTION.window_days)
        table.upsert(batch, TABLE_HASH, latest_by=[PRODUCTION.ts_col])
        table.note(**{SEEN: str(done)})
    return table.read()


def numbered_history(f: Frames) -> DataFrame:
    """Versions after two runs and whether their keys are dense and those of the first run unchanged."""
    lake, batch = f.lake(), f.curated(EQUIPMENT_VERSIONS)
    table = history_table(lake, batch, 16, numbered=True)
    ts = EQUIPMENT_VERSIONS.ts_col
    table.track(f.curated_first(EQUIPMENT_VERSIONS), ts, TABLE_HASH, FIRST_RUN, EQUIPMENT_VERSIONS.hashed)
    lake.replace(table.read().select(VERSION_ID, "equipment_id", "effective_start"), lake.config.curated, "first_ids")
    for _ in range(2):
        table.track(batch, ts, TABLE_HASH, SECOND_RUN, EQUIPMENT_VERSIONS.hashed)
    ids = [VERSION_ID, "equipment_id", "effective_start"]
    first = lake.read(lake.config.curated, "first_ids").withColumn("was", F.lit(1))
    return table.read().join(first, ids, "left").agg(
        F.count("*").alias("versions"), F.count_distinct(VERSION_ID).alias("keys"),
        F.min(VERSION_ID).alias("lowest"), F.max(VERSION_ID).alias("highest"), F.count("was").alias("unchanged"),
    )


def compacted_fact(f: Frames) -> DataFrame:
    """A fact that came in by many appends, after its small files were merged: same rows, fewer files."""
    lake, by = f.lake(), facts.PARTITION_BY["fact_sensor_hourly"]
    gold, parts = lake.config.gold, 4
    name = lake.config.qualify(gold, "fact_sensor_hourly")
    lake.replace(f.hourly, lake.config.curated, "hourly")
    stored = lake.read(lake.config.curated, "hourly")
    for part in range(parts):
        rows = stored.where(F.pmod(F.xxhash64("equipment_id", "hour_bucket"), F.lit(parts)) == part)
        rows.write.mode("append").partitionBy(*by).saveAsTable(name)
    lake.compact(gold, "fact_sensor_hourly", by, min_files=2)
    if lake.compact(gold, "fact_sensor_hourly", by, min_files=2):
        raise RuntimeError("a second call found something to merge")
    return lake.read(gold, "fact_sensor_hourly")


def pruned_by_calendar(f: Frames) -> DataFrame:
    """Production of some calendar days from a stored fact, of which only those days are read."""
    lake, by = f.lake(), facts.PARTITION_BY["fact_production"]
    gold = lake.config.gold
    lake.overwrite(f.production, gold, "fact_production", by)
    lake.replace(f.order_dates, gold, "dim_date")
    return reports.production_by_calendar(
        lake.read(gold, "fact_production"), lake.read(gold, "dim_date"), DAYS30, REPORT_DAY
    )


def catalog_view(f: Frames) -> DataFrame:
    """A view of the catalog over stored tables, read in another session, after it was replaced."""
    lake = f.lake()
    gold = lake.config.gold
    stored = {
        "fact_production": f.production, "fact_maintenance": f.maintenance, "fact_quality": f.quality,
        "dim_equipment": f.equipment,
    }
    for name, frame in stored.items():
        lake.replace(frame, gold, name)
    lake.replace(f.dates((lake.read(gold, "fact_production"), "actual_start")), gold, "dim_date")
    lake.publish_view(gold, "oee_daily_view", "SELECT 1 AS earlier_definition")
    publish_views(lake)
    return f.spark.newSession().table(lake.config.qualify(gold, "oee_daily_view"))


def built_lake(f: Frames) -> DataFrame:
    lake = f.lake()
    all_ingested(ingest_all(lake, f.feed.raw, BUILD_AS_OF))
    return build_lake(lake, BUILD_AS_OF)["oee_daily"]


# --- the registry ---------------------------------------------------------------------------------

DAYS30 = date(2001, 6, 15)
DAYS7 = date(2001, 7, 8)
SENSOR_DAYS7 = date(2024, 1, 18)

QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    "prs1_timestamp_all": parse_all,
    "prs1_timestamp_p5": parse_profile(PRODUCTION, "last_update", p.FORMATS_P5),
    "prs1_timestamp_p8": parse_profile(SENSORS, "reading_timestamp", p.FORMATS_P8),
    "prs1_timestamp_p9": parse_profile(EQUIPMENT, "last_update_date", p.FORMATS_P9),
    "prs2_date": parse_install_date,
    "prs3_decimal": parse_readings,
    "prs4_int": parse_quantities,
    "prs5_bool": parse_passed,
    "prs6_upper": upper_texts,
    "prs7_lower": lower_texts,
    "prs8_source_timestamp": parse_profile(MAINTENANCE, "scheduled_end", p.FORMATS_P10),
    "flt1_required": required_ids,
    "flt2_window_null_kept": window_query(EQUIPMENT, "keep"),
    "flt2b_window_null_is_now": window_query(EQUIPMENT_VERSIONS, "now"),
    "flt3_window_null_dropped": window_query(SENSORS, "drop"),
    "flt4_started": started,
    "flt5_not_blank": coded,
    "flt6_last_days": last_calendar_days,
    "dup1_equipment": dedupe_query(EQUIPMENT),
    "dup2_equipment_versions": dedupe_query(EQUIPMENT_VERSIONS),
    "dup3_sensor_readings": dedupe_query(SENSORS),
    "dup4_production_orders": dedupe_query(PRODUCTION),
    "dup5_maintenance_orders": dedupe_query(MAINTENANCE),
    "dup6_quality_inspections": dedupe_query(QUALITY),
    "hsh1_equipment": hash_query(EQUIPMENT),
    "hsh2_equipment_versions": hash_query(EQUIPMENT_VERSIONS),
    "hsh3_sensor_readings": hash_query(SENSORS),
    "hsh4_production_orders": hash_query(PRODUCTION),
    "hsh5_maintenance_orders": hash_query(MAINTENANCE),
    "hsh6_quality_inspections": hash_query(QUALITY),
    "hsh7_backfill": hash_backfill,
    "curate_equipment": curate_window(EQUIPMENT),
    "curate_equipment_versions": curate_window(EQUIPMENT_VERSIONS),
    "curate_sensor_readings": curate_window(SENSORS),
    "curate_production_orders": curate_window(PRODUCTION),
    "curate_maintenance_orders": curate_window(MAINTENANCE),
    "curate_quality_inspections": curate_window(QUALITY),
    "curate_production_orders_full": curate_full(PRODUCTION),
    "curate_sensor_readings_full": curate_full(SENSORS),
    "curate_equipment_reference_layouts": curate_narrow(EQUIPMENT),
    "curate_sensor_readings_reference_layouts": curate_narrow(SENSORS),
    "curate_production_orders_reference_layouts": curate_narrow(PRODUCTION),
    "curate_maintenance_orders_reference_layouts": curate_narrow(MAINTENANCE),
    "curate_quality_inspections_reference_layouts": curate_narrow(QUALITY),
    "mrg1_equipment": merge_query(EQUIPMENT),
    "mrg2_sensor_readings": merge_query(SENSORS),
    "mrg3_production_orders": merge_query(PRODUCTION),
    "mrg4_maintenance_orders": merge_query(MAINTENANCE),
    "mrg5_quality_inspections": merge_query(QUALITY),
    "mrg6_calendar_insert_only": merge_calendar,
    "scd1_expired": expired_versions,
    "scd2_history": lambda f: f.next_history(),
    "scd2_current": opened_versions,
    "scd3_version_keys": version_keys,
    "scd4_version_at": version_at,
    "scd4_carried_version": lambda f: version_at(f, as_of_lookup),
    "cal1_calendar": lambda f: f.sensor_dates,
    "cal2_localized_calendar": localized_dates,
    "cal3_date_key": date_keys,
    "dim1_equipment": lambda f: f.equipment,
    "dim2_equipment_history": equipment_history,
    "dim3_product": lambda f: dim.dim_product(f.curated(PRODUCTION)),
    "dim4_technician": lambda f: dim.dim_technician(f.curated(MAINTENANCE)),
    "dim5_maintenance_type": lambda f: f.types,
    "dim6_defect": lambda f: dim.dim_defect(f.curated(QUALITY)),
    "dim7_defect_code": lambda f: dim.dim_defect_code(f.curated(QUALITY)),
    "dim7_defect_bridge": lambda f: dim.defect_bridge(f.curated(QUALITY)),
    "fct1_production": lambda f: f.production,
    "fct2_maintenance": lambda f: f.maintenance,
    "fct3_quality": lambda f: f.quality,
    "fct4_sensor_hourly": lambda f: f.hourly,
    "vw1a_production_daily": lambda f: views.production_daily(f.production),
    "vw1b_downtime_daily": lambda f: views.downtime_daily(f.maintenance),
    "vw1c_quality_daily": lambda f: views.quality_daily(f.quality),
    "vw1_oee_daily": lambda f: f.oee(),
    "vw2_downtime_by_cause": lambda f: f.downtime(),
    "vw3_critical_equipment": lambda f: f.critical,
    "vw3_critical_equipment_fanout": lambda f: views.critical_equipment_fanout(
        f.maintenance, f.quality, f.equipment
    ),
    "vw4_sensor_trends": lambda f: f.trends(),
    "q1_mean_oee": lambda f: reports.mean_oee(f.oee(DAYS30, REPORT_DAY), REPORT_DAY),
    "q2_downtime_of_day": lambda f: reports.downtime_of_day(f.downtime(REPORT_DAY, REPORT_DAY), REPORT_DAY),
    "q3_critical_count": lambda f: reports.critical_count(f.critical),
    "q4_mean_quality": lambda f: reports.mean_quality(f.oee(DAYS30, REPORT_DAY), REPORT_DAY),
    "q5_oee_by_equipment": lambda f: reports.oee_by_equipment(f.oee(DAYS7, REPORT_DAY), REPORT_DAY),
    "q6_oee_by_day": lambda f: reports.oee_by_day(f.oee(DAYS30, REPORT_DAY), REPORT_DAY),
    "q7_top_critical": lambda f: reports.top_critical(f.critical),
    "q8_downtime_causes": lambda f: reports.downtime_causes(f.downtime(DAYS30, REPORT_DAY), REPORT_DAY),
    "q9_downtime_by_equipment": lambda f: reports.downtime_by_equipment(
        f.downtime(DAYS30, REPORT_DAY), REPORT_DAY
    ),
    "q10_sensor_trend": lambda f: reports.sensor_trend(f.trends(SENSOR_DAYS7, SENSOR_DAY), SENSOR_DAY),
    "q11_oee_detail": lambda f: reports.oee_detail(f.oee(DAYS7, REPORT_DAY), REPORT_DAY),
    "q12_downtime_trend": lambda f: reports.downtime_trend(f.downtime()),
    "q13_sensor_range": lambda f: reports.sensor_range(f.trends()),
    "q14_star_oee": lambda f: reports.star_oee(
        f.production, f.maintenance, f.quality, None, f.equipment, DAYS30, REPORT_DAY
    ),
    "q14_star_oee_fanout": lambda f: reports.star_oee_fanout(
        f.production, f.maintenance, f.quality, None, f.equipment, DAYS30, REPORT_DAY
    ),
    "q15_oee_listing": lambda f: reports.oee_listing(f.oee()),
    "q15_downtime_listing": lambda f: reports.downtime_listing(f.downtime()),
    "src1_raw_text": lambda f: as_raw(f.raw(QUALITY), QUALITY.raw),
    "src3_full_extract": lambda f: extract(f.raw(MAINTENANCE), MAINTENANCE.raw, full=True),
    "src4_incremental_extract": incremental,
    "src5_fallback_extract": fallback,
    "src6_high_watermark": watermarks,
    "src7_new_data": new_data,
    "src8_ingested_orders": ingested_orders,
    "snk1_first_load": stored_first_load,
    "snk2_upsert_unguarded": merge_unguarded,
    "snk2_stored_upsert": stored_upsert,
    "snk3_overwrite_fact": stored_fact,
    "snk4_replace_dimension": stored_dimension,
    "snk5_load_if_empty": stored_if_empty,
    "snk6_append": stored_appends,
    "snk7_session_view": session_view,
    "snk8_partitioned_fact": stored_fact_days,
    "snk10_reset": stored_reset,
    "snk11_file_sizes": stored_file_sizes,
    "mrg3_stored_upsert": stored_guarded_upsert,
    "snk2_bucketed_upsert": bucketed_upsert,
    "snk3_touched_days": touched_days,
    "snk3_moved_days": moved_days,
    "snk7_catalog_view": catalog_view,
    "snk8_pruned_by_calendar": pruned_by_calendar,
    "snk11_merged_files": compacted_fact,
    "fct4_merged_readings": merged_readings,
    "flt3_new_rows_only": curated_in_two_runs,
    "scd3_identity_keys": numbered_history,
    "scd2_stored_history": stored_history,
    "aud1_row_counts": lambda f: row_counts(raw_tables(f)),
    "aud2_reconcile": reconciliation,
    "aud3_missing_tables": absent_tables,
    "aud4_ingest_summary": ingest_summary,
    "built_lake_oee": built_lake,
}
