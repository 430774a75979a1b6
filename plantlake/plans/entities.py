"""The five curated entities and the equipment history batch, as specs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import partial

from plantlake.functions.parsing import (
    FORMATS_ALL,
    FORMATS_P5,
    FORMATS_P8,
    FORMATS_P9,
    FORMATS_P11_DATE,
    norm_lower,
    norm_upper,
    parse_bool,
    parse_date,
    parse_decimal,
    parse_int,
    parse_timestamp,
)
from plantlake.operators.curate import EntitySpec, Field

TABLE_HASH = "row_hash"

# The narrow layouts that each curated table's columns are read with where results must
# equal those of such a pipeline; columns that are not named take the table's general ones ("").
NARROW_LAYOUTS = {
    "equipment_clean": {"": FORMATS_P9, "installation_date": FORMATS_P11_DATE},
    "equipment_versions": {"": FORMATS_P8},
    "sensor_readings_clean": {"": FORMATS_P8},
    "production_orders_clean": {"": FORMATS_P5},
    "maintenance_orders_clean": {"": FORMATS_P5},
    "quality_inspections_clean": {"": FORMATS_P5},
}


def entities(formats: Sequence[str] | None = None) -> dict[str, EntitySpec]:
    """Specs by curated table name.

    Times are read in every known layout. A narrower list of layouts for all columns can be given;
    text in other layouts then becomes NULL, and rows without an update time drop out where the
    window asks for one.
    """
    layouts = tuple(formats) if formats is not None else FORMATS_ALL
    ts = partial(parse_timestamp, formats=layouts)
    day = partial(parse_date, formats=layouts)
    specs = (
        EntitySpec(
            name="equipment_clean",
            raw="equipment_master",
            key="equipment_id",
            ts_col="last_update_date",
            fields=(
                Field("equipment_id"),
                Field("equipment_name", hash_kind="text"),
                Field("equipment_type", hash_kind="text"),
                Field("location", hash_kind="text"),
                Field("installation_date", day, "time"),
                Field("manufacturer", hash_kind="text"),
                Field("model", hash_kind="text"),
                Field("status", norm_upper, "text"),
                Field("last_update_date", ts),
            ),
            required=("equipment_id",),
            identity=("equipment_id",),
            order=("last_update_date", "equipment_name"),
            window_days=90,
            nulls="keep",
        ),
        EntitySpec(
            name="equipment_versions",
            raw="equipment_master",
            key="equipment_id",
            ts_col="last_update_date",
            fields=(
                Field("equipment_id"),
                Field("equipment_name", hash_kind="text"),
                Field("equipment_type", hash_kind="text"),
                Field("location", hash_kind="text"),
                Field("manufacturer", hash_kind="text"),
                Field("model", hash_kind="text"),
                Field("status", norm_upper, "text"),
                Field("last_update_date", ts),
            ),
            required=("equipment_id",),
            identity=("equipment_id",),
            order=("last_update_date", "equipment_name", "location", "status"),
            window_days=90,
            nulls="now",
        ),
        EntitySpec(
            name="sensor_readings_clean",
            raw="iot_sensor_readings",
            key="reading_id",
            ts_col="reading_timestamp",
            fields=(
                Field("reading_id"),
                Field("equipment_id", hash_kind="bare"),
                Field("sensor_id", hash_kind="bare"),
                Field("sensor_type", norm_lower, "bare"),
                Field("reading_value", parse_decimal, "decimal"),
                Field("reading_timestamp", ts, "time"),
                Field("unit", hash_kind="text"),
            ),
            required=("reading_id", "equipment_id", "sensor_id"),
            identity=("equipment_id", "sensor_id", "reading_timestamp"),
            order=("reading_id",),
            window_days=60,
            nulls="drop",
        ),
        EntitySpec(
            name="production_orders_clean",
            raw="production_orders",
            key="production_order_id",
            ts_col="last_update",
            fields=(
                Field("production_order_id"),
                Field("equipment_id", hash_kind="text"),
                Field("product_id", hash_kind="text"),
                Field("planned_start", ts, "time"),
                Field("planned_end", ts, "time"),
                Field("actual_start", ts, "time"),
                Field("actual_end", ts, "time"),
                Field("planned_quantity", parse_int, "int"),
                Field("actual_quantity", parse_int, "int"),
                Field("status", norm_upper, "text"),
                Field("last_update", ts),
            ),
            required=("production_order_id",),
            identity=("production_order_id",),
            order=("last_update",),
            window_days=60,
            nulls="drop",
        ),
        EntitySpec(
            name="maintenance_orders_clean",
            raw="maintenance_orders",
            key="maintenance_order_id",
            ts_col="last_update",
            fields=(
                Field("maintenance_order_id"),
                Field("equipment_id", hash_kind="text"),
                Field("maintenance_type", norm_lower, "text"),
                Field("scheduled_start", ts, "time"),
                Field("scheduled_end", ts, "time"),
                Field("actual_start", ts, "time"),
                Field("actual_end", ts, "time"),
                Field("technician_id", hash_kind="text"),
                Field("status", norm_upper, "text"),
                Field("priority", norm_lower, "text"),
                Field("description"),
                Field("last_update", ts),
            ),
            required=("maintenance_order_id",),
            identity=("maintenance_order_id",),
            order=("last_update",),
            window_days=60,
            nulls="drop",
        ),
        EntitySpec(
            name="quality_inspections_clean",
            raw="quality_inspections",
            key="inspection_id",
            ts_col="last_update",
            fields=(
                Field("inspection_id"),
                Field("production_order_id", hash_kind="text"),
                Field("equipment_id", hash_kind="text"),
                Field("inspection_type", norm_lower, "text"),
                Field("inspection_date", ts, "time"),
                Field("inspector_id", hash_kind="text"),
                Field("passed", parse_bool, "bool"),
                Field("failed_quantity", parse_int, "int"),
                Field("total_quantity", parse_int, "int"),
                Field("defect_codes", norm_upper, "text"),
                Field("notes"),
                Field("last_update", ts),
            ),
            required=("inspection_id",),
            identity=("inspection_id",),
            order=("last_update",),
            window_days=60,
            nulls="drop",
        ),
    )
    return {spec.name: spec for spec in specs}


ENTITIES = entities()
EQUIPMENT = ENTITIES["equipment_clean"]
EQUIPMENT_VERSIONS = ENTITIES["equipment_versions"]
SENSORS = ENTITIES["sensor_readings_clean"]
PRODUCTION = ENTITIES["production_orders_clean"]
MAINTENANCE = ENTITIES["maintenance_orders_clean"]
QUALITY = ENTITIES["quality_inspections_clean"]


def narrowed(spec: EntitySpec, layouts: Mapping[str, Sequence[str]]) -> EntitySpec:
    """A spec whose times are read in the given layouts by column; "" stands for all other columns."""
    def parse(field: Field):
        if not isinstance(field.parse, partial):
            return field.parse
        return partial(field.parse.func, formats=tuple(layouts.get(field.name, layouts[""])))

    return replace(spec, fields=tuple(replace(f, parse=parse(f)) for f in spec.fields))
