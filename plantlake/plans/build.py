"""The whole lake in one run: raw tables to curated tables, history, star schema and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType, TimestampNTZType

from plantlake.functions.times import AsOf
from plantlake.operators.curate import EntitySpec, curate
from plantlake.operators.history import VALIDITY
from plantlake.plans import calendar, dimensions, views
from plantlake.plans.entities import ENTITIES, EQUIPMENT_VERSIONS, TABLE_HASH
from plantlake.plans.incremental import HOURLY, ROW_FACTS, SEEN, curated_batch, refresh_hourly, refresh_row_fact
from plantlake.plans.ingest import raw_table
from plantlake.sources.schemas import RAW_TABLES
from plantlake.sources.store import VERSION_ID, HistoryTable, KeyedTable, Lake, register_view


# Buckets of a group of a curated table: tasks that compare and rewrite it.
SPLIT = 8

# Curated tables by their stored names.
READERS = {
    "equipment_history" if spec is EQUIPMENT_VERSIONS else name: spec for name, spec in ENTITIES.items()
}


def curated_table(lake: Lake, spec: EntitySpec, batch: DataFrame, key_groups: int) -> KeyedTable:
    """Bucketed, but for a table that was filled without buckets, which stays as it is."""
    found = lake.keyed(
        lake.config.curated, spec.name, batch.schema, spec.key, key_groups, logged=True, bucketed=True, split=SPLIT
    )
    return found.as_stored()


def history_table(lake: Lake, batch: DataFrame, key_groups: int, numbered: bool = False) -> HistoryTable:
    """The equipment history; ``numbered`` gives its versions a dense ``version_id`` as well."""
    spec = EQUIPMENT_VERSIONS
    types = dict(zip(VALIDITY, (TimestampNTZType(), TimestampNTZType(), BooleanType())))
    columns = [f for f in batch.schema.fields if f.name != spec.ts_col]
    columns += [StructField(name, kind) for name, kind in types.items()]
    columns.append(StructField("version_key", LongType()))
    if numbered:
        columns.append(StructField(VERSION_ID, LongType()))
    return lake.history(
        lake.config.curated, "equipment_history", StructType(columns), spec.key, key_groups
    )


def build_curated(
    lake: Lake, as_of: AsOf, full: bool, key_groups: int, rebuild: bool = False
) -> dict[str, KeyedTable]:
    """Curate the raw rows ingested since the last run (``rebuild``: all) and upsert what changed."""
    tables = {}
    for spec in ENTITIES.values():
        raw = raw_table(lake, spec.raw, key_groups)
        days = None if full else spec.window_days
        shape = curate(raw.read().limit(0), spec, as_of, days)
        if spec is EQUIPMENT_VERSIONS:
            table = history_table(lake, shape, key_groups)
            batch, done = curated_batch(raw, table, spec, as_of, days, rebuild)
            table.track(batch, spec.ts_col, TABLE_HASH, as_of, spec.hashed)
        else:
            table = curated_table(lake, spec, shape, key_groups)
            batch, done = curated_batch(raw, table, spec, as_of, days, rebuild)
            table.upsert(batch, TABLE_HASH, latest_by=[spec.ts_col])
        table.note(**{SEEN: str(done)})
        tables[table.table] = table
    return tables


def build_gold(
    lake: Lake, curated: dict[str, KeyedTable], rebuild: bool = False
) -> dict[str, DataFrame]:
    """Publish dimensions and facts; the calendar spans the days the facts use.

    Of facts only the partitions that changes of their source touch are replaced.
    """
    gold = lake.config.gold
    for spec in ROW_FACTS:
        refresh_row_fact(lake, spec, curated[spec.source], rebuild)
    refresh_hourly(lake, curated["sensor_readings_clean"], rebuild)
    production = curated["production_orders_clean"].read()
    maintenance = curated["maintenance_orders_clean"].read()
    quality = curated["quality_inspections_clean"].read()
    equipment = curated["equipment_clean"].read()
    history = curated["equipment_history"].read()
    used = {
        "fact_production": "actual_start",
        "fact_maintenance": "actual_start",
        "fact_quality": "inspection_date",
        "fact_sensor_hourly": "hour_bucket",
    }
    dimension_frames = {
        "dim_date": calendar.calendar(
            calendar.days(calendar.spanning([(lake.read(gold, n), ts) for n, ts in used.items()]))
        ),
        "dim_equipment": dimensions.dim_equipment(equipment),
        "dim_equipment_history": dimensions.dim_equipment_history(history),
        "dim_product": dimensions.dim_product(production),
        "dim_technician": dimensions.dim_technician(maintenance),
        "dim_maintenance_type": dimensions.dim_maintenance_type(maintenance),
        "dim_defect": dimensions.dim_defect(quality),
        "dim_defect_code": dimensions.dim_defect_code(quality),
        "defect_bridge": dimensions.defect_bridge(quality),
    }
    for name, frame in dimension_frames.items():
        lake.replace(frame, gold, name)
    return {name: lake.read(gold, name) for name in (*used, *dimension_frames)}


def build_views(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Define the analytic views over the star schema in the session."""
    production, maintenance = star["fact_production"], star["fact_maintenance"]
    quality, dates, equipment = star["fact_quality"], star["dim_date"], star["dim_equipment"]
    frames = {
        "oee_daily": views.oee_daily(production, maintenance, quality, dates, equipment),
        "downtime_by_cause": views.downtime_by_cause(
            maintenance, dates, equipment, star["dim_maintenance_type"]
        ),
        "critical_equipment": views.critical_equipment(maintenance, quality, equipment),
        "sensor_trends": views.sensor_trends(star["fact_sensor_hourly"], dates, equipment),
    }
    return {name: register_view(name, frame) for name, frame in frames.items()}


def forget_seen(lake: Lake, curated: dict[str, KeyedTable], key_groups: int) -> None:
    """Drop logged changes that every derived table has seen."""
    for table in RAW_TABLES:
        readers = [curated[name] for name, spec in READERS.items() if spec.raw == table]
        raw_table(lake, table, key_groups).forget(min(int(r.noted(SEEN) or 0) for r in readers))
    sources = {spec.name: spec.source for spec in ROW_FACTS} | {HOURLY: "sensor_readings_clean"}
    for fact, source in sources.items():
        seen = lake.noted(lake.config.qualify(lake.config.gold, fact)).get(SEEN)
        curated[source].forget(int(seen or 0))


def build_lake(
    lake: Lake, as_of: AsOf, full: bool = False, key_groups: int = 16, rebuild: bool = False
) -> dict[str, DataFrame]:
    """Build everything above the raw tables, which ``ingest_all`` fills, for one reference time.

    Returns all tables and views by name. ``full`` ignores the time windows of the entities. Only what was
    ingested since the last run is curated, and only partitions of facts that this touches are
    written, unless ``rebuild`` asks for all. A run that was lost is made good by the next one.
    """
    for schema in (lake.config.curated, lake.config.gold):
        lake.create_schema(schema)
    curated = build_curated(lake, as_of, full, key_groups, rebuild)
    star = build_gold(lake, curated, rebuild)
    forget_seen(lake, curated, key_groups)
    return {**{name: table.read() for name, table in curated.items()}, **star, **build_views(star)}
