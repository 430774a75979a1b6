"""The analytic views as SQL text for the catalog, over the stored star schema.

They say what ``plantlake.plans.views`` says with DataFrames; each fact is aggregated before it meets another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from plantlake.sources.store import Lake

# Durations are summed as whole seconds.
_MINUTES = "sum(floor({0} * 60 + 0.5)) / 60.0D"

TEXTS = {
    "oee_daily": f"""
        WITH made AS (
          SELECT equipment_id, start_date_key AS date_key, coalesce(sum(planned_qty), 0) AS planned,
            coalesce(sum(actual_qty), 0) AS produced,
            greatest(coalesce({_MINUTES.format("duration_minutes")}, 0D), 0D) AS minutes
          FROM {{gold}}.fact_production WHERE start_date_key IS NOT NULL GROUP BY ALL),
        stopped AS (
          SELECT equipment_id, start_date_key AS date_key, coalesce({_MINUTES.format("downtime_minutes")}, 0) AS downtime
          FROM {{gold}}.fact_maintenance WHERE start_date_key IS NOT NULL GROUP BY ALL),
        checked AS (
          SELECT equipment_id, date_key, coalesce(sum(total_quantity), 0) AS seen, coalesce(sum(failed_quantity), 0) AS failed
          FROM {{gold}}.fact_quality WHERE date_key IS NOT NULL GROUP BY ALL),
        joined AS (
          SELECT equipment_id, date_key, planned, produced, minutes, downtime, coalesce(seen, 0) AS seen, coalesce(failed, 0) AS failed
          FROM made LEFT JOIN stopped USING (equipment_id, date_key) LEFT JOIN checked USING (equipment_id, date_key)
          WHERE minutes > 0)
        SELECT j.date_key, d.full_date, j.equipment_id, e.equipment_name,
          CAST(coalesce(downtime, 0) AS double) AS downtime_min, minutes AS production_minutes,
          minutes + coalesce(downtime, 0) AS total_time,
          CASE WHEN minutes + coalesce(downtime, 0) > 0
            THEN round(try_divide(minutes, minutes + coalesce(downtime, 0.01D)), 4) ELSE 0D END AS availability_rate,
          CASE WHEN planned > 0 THEN round(try_divide(produced, planned), 4) ELSE 0D END AS performance_rate,
          CASE WHEN seen > 0 THEN round(try_divide(seen - failed, seen), 4) ELSE 1D END AS quality_rate
        FROM joined j JOIN {{gold}}.dim_date d ON d.date_key = j.date_key JOIN {{gold}}.dim_equipment e ON e.equipment_id = j.equipment_id""",
    "critical_equipment": f"""
        WITH stopped AS (
          SELECT equipment_id, {_MINUTES.format("downtime_minutes")} AS downtime, count(maintenance_key) AS orders
          FROM {{gold}}.fact_maintenance GROUP BY equipment_id),
        checked AS (SELECT equipment_id, sum(failed_quantity) AS failed FROM {{gold}}.fact_quality GROUP BY equipment_id)
        SELECT e.equipment_id, e.equipment_name, s.downtime AS total_downtime, coalesce(s.orders, 0) AS maintenance_count,
          c.failed AS total_failures, s.downtime + coalesce(c.failed, 0) * 10 AS criticality_score
        FROM {{gold}}.dim_equipment e LEFT JOIN stopped s ON s.equipment_id = e.equipment_id
          LEFT JOIN checked c ON c.equipment_id = e.equipment_id""",
}


def publish_views(lake: Lake) -> dict[str, DataFrame]:
    """Put the views into the gold schema of the catalog, in place of earlier definitions."""
    gold = lake.config.qualify(lake.config.gold, "")
    return {f"{name}_view": lake.publish_view(lake.config.gold, f"{name}_view", text.format(gold=gold)) for name, text in TEXTS.items()}
