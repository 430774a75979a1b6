"""The five raw tables: declared columns, key and event-time column. All columns are text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: str
    ts_col: str
    columns: tuple[str, ...]


# Names and column order of the raw tables.
RAW_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec(
            "equipment_master", "equipment_id", "last_update_date",
            ("equipment_id", "equipment_name", "equipment_type", "location",
             "installation_date", "manufacturer", "model", "status", "last_update_date"),
        ),
        TableSpec(
            "iot_sensor_readings", "reading_id", "reading_timestamp",
            ("reading_id", "equipment_id", "sensor_id", "sensor_type", "reading_value",
             "reading_timestamp", "unit"),
        ),
        TableSpec(
            "production_orders", "production_order_id", "last_update",
            ("production_order_id", "equipment_id", "product_id", "planned_start", "planned_end",
             "actual_start", "actual_end", "planned_quantity", "actual_quantity", "status",
             "last_update"),
        ),
        TableSpec(
            "maintenance_orders", "maintenance_order_id", "last_update",
            ("maintenance_order_id", "equipment_id", "maintenance_type", "scheduled_start",
             "scheduled_end", "actual_start", "actual_end", "technician_id", "status", "priority",
             "description", "last_update"),
        ),
        TableSpec(
            "quality_inspections", "inspection_id", "last_update",
            ("inspection_id", "production_order_id", "equipment_id", "inspection_type",
             "inspection_date", "inspector_id", "passed", "failed_quantity", "total_quantity",
             "defect_codes", "notes", "last_update"),
        ),
    )
}


def raw_schema(table: str) -> StructType:
    """All-string schema of a raw table; only the key is declared as always present."""
    spec = RAW_TABLES[table]
    return StructType([StructField(c, StringType(), c != spec.key) for c in spec.columns])


def as_raw(df: DataFrame, table: str) -> DataFrame:
    """Any frame with the right column names as a raw table: declared order, all text."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in RAW_TABLES[table].columns])
