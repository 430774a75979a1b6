"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.operators.filters import require


def dim_equipment(equipment: DataFrame) -> DataFrame:
    """Current state, one row per equipment."""
    return equipment.select(
        "equipment_id", "equipment_name", "equipment_type", "location", "manufacturer", "model",
        F.col("status").alias("current_status"), "installation_date",
    )


def dim_equipment_history(history: DataFrame) -> DataFrame:
    """All versions of all equipment."""
    return history.select(
        "version_key", "equipment_id", "equipment_name", "status", "location",
        "effective_start", "effective_end", "is_current",
    )


def _members(df: DataFrame, column: str, key: str, label: str, blank_is_null: bool = False):
    found = require(df, [column], blank_is_null).select(F.col(column).alias(key)).distinct()
    return found.withColumn(label, F.col(key))


def dim_product(production: DataFrame) -> DataFrame:
    return _members(production, "product_id", "product_id", "product_name")


def dim_technician(maintenance: DataFrame) -> DataFrame:
    return _members(maintenance, "technician_id", "technician_id", "technician_name")


def dim_maintenance_type(maintenance: DataFrame) -> DataFrame:
    return _members(maintenance, "maintenance_type", "maintenance_type", "description")


def dim_defect(quality: DataFrame) -> DataFrame:
    """Distinct code texts as recorded: a list such as ``D001,D002`` is one member."""
    return _members(quality, "defect_codes", "defect_code", "defect_description", True)


def defect_bridge(quality: DataFrame) -> DataFrame:
    """One row per inspection and single defect code."""
    codes = F.array_distinct(F.transform(F.split("defect_codes", ","), lambda code: F.trim(code)))
    return (
        quality.select("inspection_id", F.explode(codes).alias("defect_code"))
        .where("defect_code <> ''")
    )


def dim_defect_code(quality: DataFrame) -> DataFrame:
    """Distinct single defect codes."""
    return defect_bridge(quality).select("defect_code").distinct()
