"""The queries of ``queries.py`` as DuckDB SQL, written apart from the Spark code.

Common table expressions are kept by name; ``sql`` puts those a statement mentions in front of it.
"""

from __future__ import annotations

import re
from functools import partial

ID_DIGITS = 12


def _id(prefix: str, number: str) -> str:
    return f"'{prefix}' || lpad(CAST({number} AS VARCHAR), {ID_DIGITS}, '0')"


def _mix(ts: str, variant: str) -> str:
    formats = (
        "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y %H:%M:%S",
        "%Y-%m-%dT%H:%M:%S",
    )
    cases = " ".join(f"WHEN {i} THEN strftime({ts}, '{f}')" for i, f in enumerate(formats))
    return f"CASE ({variant}) % 6 {cases} END"


def _plus(ts: str, minutes: str) -> str:
    return f"({ts} + to_minutes({minutes}))"


# Layouts each profile reads.
D_T, S_T, E_T, H_T = "%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%d/%m/%Y %H:%M:%S", "%d-%m-%Y %H:%M:%S"
D, S, E, H = "%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y"
ISO, ISO_Z = "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ"
ALL = (D_T, D, S_T, S, E_T, E, H_T, H, ISO, ISO_Z)
P9 = (D_T, ISO, S_T, E_T, H_T, D, S, E, H)
P8 = (D_T, S_T, E_T, H_T, D, S, E, H)
P5 = (D_T, S_T, E_T, D, S)
P11 = (D_T, ISO, H_T, D, S, E, H)


def _ts(text: str, formats=ALL) -> str:
    listed = ", ".join(f"'{f}'" for f in formats)
    return f"try_strptime({text}, [{listed}])"


def _day(text: str, formats=ALL) -> str:
    return f"CAST({_ts(text, formats)} AS DATE)"


def _dec(text: str) -> str:
    return f"TRY_CAST(replace({text}, ',', '.') AS DECIMAL(18,4))"


def _int(text: str) -> str:
    return f"CAST(trunc(TRY_CAST(replace({text}, ',', '.') AS DECIMAL(38,18))) AS INT)"


def _bool(text: str) -> str:
    return (
        f"CASE WHEN lower(trim({text})) IN ('true','1','yes','y','t') THEN true"
        f" WHEN lower(trim({text})) IN ('false','0','no','n','f') THEN false END"
    )


def _upper(text: str) -> str:
    return f"upper(trim({text}))"


def _lower(text: str) -> str:
    return f"lower(trim({text}))"


def _same(text: str) -> str:
    return text


def _key(ts: str) -> str:
    return f"CAST(strftime({ts}, '%Y%m%d') AS INT)"


def _seconds(start: str, end: str) -> str:
    return f"date_diff('second', {start}, {end})"


CTES: dict[str, str] = {}

# --- raw text tables ------------------------------------------------------------------------------

_LINE_ID = "lpad(CAST(l_orderkey AS VARCHAR), 12, '0') || '-' || l_linenumber"
_RUN_START = _plus("l_shipdate", "l_orderkey % 1440")
_RUN_END = _plus("l_shipdate", "l_orderkey % 1440 + 120 + l_partkey % 360")
_OPEN = _plus("o_orderdate", "o_custkey % 600")
_DONE = _plus("o_orderdate", "o_custkey % 600 + 30 + o_custkey % 210")

CTES["machines"] = "SELECT count(*) AS n FROM supplier"
CTES["raw_equipment"] = f"""
    SELECT {_id('EQ', 's_suppkey')} AS equipment_id, s_name AS equipment_name,
      CASE s_suppkey % 6 WHEN 0 THEN 'CNC' WHEN 1 THEN 'Press' WHEN 2 THEN 'Welder'
        WHEN 3 THEN 'Assembly' WHEN 4 THEN 'Packaging' ELSE 'Quality Control' END AS equipment_type,
      CASE WHEN s_suppkey % 20 <> 19 THEN 'Line ' || ((s_nationkey + v) % 3 + 1) END AS location,
      {_mix(_plus("TIMESTAMP '1994-01-01 08:00:00'", "(s_suppkey % 9000) * 1440"), "s_suppkey")}
        AS installation_date,
      'M' || s_nationkey AS manufacturer, 'MOD-' || (s_suppkey % 9) AS model,
      CASE WHEN s_suppkey % 4 = 0 THEN 'operational'
        WHEN v = 1 AND s_suppkey % 4 = 1 THEN ' Broken' ELSE 'IDLE ' END AS status,
      CASE WHEN NOT (s_suppkey % 25 = 7 AND v = 0) THEN
        {_mix(_plus("TIMESTAMP '2001-09-01 00:00:00'", "v * 43200 + (s_suppkey % 240) * 60"),
              "s_suppkey + v")} END AS last_update_date,
      v
    FROM supplier, (VALUES (0), (1)) AS t(v)"""
CTES["raw_sensor"] = f"""
    SELECT {_id('IOT', 'event_id')} AS reading_id,
      {_id('EQ', 'user_id % n')} AS equipment_id,
      'SENS-' || user_id || '-' || event_type AS sensor_id,
      CASE WHEN event_id % 5 = 0 THEN upper(event_type) ELSE event_type END AS sensor_type,
      CASE WHEN event_id % 3 = 0
        THEN replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
        ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS reading_value,
      {_mix('ts', 'event_id')} AS reading_timestamp,
      CASE WHEN event_id % 9 <> 0 THEN 'u' END AS unit
    FROM events, machines"""
CTES["raw_production"] = f"""
    SELECT 'PO' || {_LINE_ID} AS production_order_id, {_id('EQ', 'l_suppkey')} AS equipment_id,
      'PROD-' || l_partkey AS product_id,
      {_mix(_RUN_START, 'l_suppkey')} AS planned_start,
      {_mix(_plus(_RUN_START, '480'), 'l_suppkey + l_linenumber')} AS planned_end,
      CASE WHEN l_partkey % 17 <> 4 THEN {_mix(_RUN_START, 'l_orderkey')} END AS actual_start,
      {_mix(_RUN_END, 'l_orderkey + l_linenumber')} AS actual_end,
      CAST(CAST(l_quantity * 10 AS INT) AS VARCHAR) AS planned_quantity,
      CAST(CAST(floor(l_quantity * 10 * (1 - l_discount)) AS INT) AS VARCHAR)
        || CASE WHEN l_partkey % 7 = 0 THEN ',0' ELSE '' END AS actual_quantity,
      CASE WHEN l_orderkey % 4 = 0 THEN upper(l_linestatus)
        ELSE lower(' ' || l_linestatus) END AS status,
      {_mix(_RUN_START, 'l_partkey')} AS last_update
    FROM lineitem"""
CTES["raw_maintenance"] = f"""
    SELECT {_id('MO', 'o_orderkey')} AS maintenance_order_id,
      {_id('EQ', 'o_orderkey % n')} AS equipment_id,
      CASE WHEN o_orderkey % 4 = 0 THEN upper(o_orderpriority)
        ELSE lower(o_orderpriority) || ' ' END AS maintenance_type,
      {_mix(_OPEN, 'o_orderkey')} AS scheduled_start,
      {_mix(_plus(_OPEN, '240'), 'o_custkey')} AS scheduled_end,
      CASE WHEN o_custkey % 19 <> 7 THEN {_mix(_OPEN, '0')} END AS actual_start,
      CASE WHEN o_orderkey % 11 <> 0 THEN {_mix(_DONE, '0')} END AS actual_end,
      'TECH-' || lpad(CAST(o_custkey % 20 + 1 AS VARCHAR), 3, '0') AS technician_id,
      o_orderstatus AS status, ' P' || substr(o_orderpriority, 1, 1) AS priority,
      CASE WHEN o_orderkey % 3 <> 0 THEN 'order ' || o_orderkey END AS description,
      {_mix('o_orderdate', 'o_custkey')} AS last_update
    FROM orders, machines"""
CTES["raw_quality"] = f"""
    SELECT CASE WHEN l_partkey % 101 <> 7 THEN 'INS' || {_LINE_ID} END AS inspection_id, 'PO' || {_LINE_ID} AS production_order_id,
      {_id('EQ', 'l_suppkey')} AS equipment_id,
      CASE l_linenumber % 3 WHEN 0 THEN ' Visual' WHEN 1 THEN 'DIMENSIONAL' ELSE 'functional '
        END AS inspection_type,
      {_mix(_RUN_END, '0')} AS inspection_date,
      'INSP-' || (l_suppkey % 40) AS inspector_id,
      CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'R' THEN ' f' ELSE 'maybe' END AS passed,
      CAST(CAST(floor(l_quantity * l_discount) AS INT) AS VARCHAR) AS failed_quantity,
      CASE WHEN l_partkey % 50 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END
        AS total_quantity,
      CASE WHEN l_discount = 0 THEN NULL WHEN l_partkey % 103 = 9 THEN '  '
        WHEN l_partkey % 3 = 0 THEN 'd00' || (l_partkey % 6 + 1) || ', d00' || (l_suppkey % 6 + 1)
        ELSE 'D00' || (l_partkey % 6 + 1) END AS defect_codes,
      CASE WHEN l_partkey % 4 <> 0 THEN 'lot ' || l_partkey END AS notes,
      {_mix(_RUN_START, 'l_partkey')} AS last_update
    FROM lineitem"""

# --- curated tables -------------------------------------------------------------------------------


class Entity:
    def __init__(self, raw, key, ts, columns, required, identity, order, hashed, dropped):
        self.raw, self.key, self.ts, self.columns = raw, key, ts, columns
        self.required, self.identity, self.order = required, identity, order
        self.hashed, self.dropped = hashed, dropped

    def staged(self, source: str | None = None) -> str:
        exprs = ", ".join(f"{fn(c)} AS {c}" for c, fn in self.columns.items())
        present = " AND ".join(f"{c} IS NOT NULL" for c in self.required)
        return f"SELECT {exprs} FROM {source or self.raw} WHERE {present}"

    def ranked(self, staged: str, where: str = "true") -> str:
        rest = [c for c in self.columns if c not in self.identity and c not in self.order]
        order = ", ".join(f"{c} DESC NULLS LAST" for c in (*self.order, *rest))
        drop = f" AND {self.ts} IS NOT NULL" if self.dropped else ""
        return (
            f"SELECT * FROM ({staged}) WHERE ({where}){drop} QUALIFY row_number() OVER"
            f" (PARTITION BY {', '.join(self.identity)} ORDER BY {order}) = 1"
        )

    def curated(self, staged: str, where: str = "true") -> str:
        return f"SELECT *, {self.hash()} AS row_hash FROM ({self.ranked(staged, where)})"

    def hash(self) -> str:
        parts = {
            "text": "coalesce({c}, '')",
            "bare": "{c}",
            "day": "coalesce(strftime({c}, '%Y-%m-%d'), '')",
            "time": "coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')",
            "int": "CAST(coalesce({c}, 0) AS VARCHAR)",
            "decimal": "CAST(coalesce({c}, CAST(0 AS DECIMAL(18,4))) AS VARCHAR)",
            "bool": "CAST(coalesce({c}, false) AS VARCHAR)",
        }
        listed = ", ".join(parts[kind].format(c=c) for c, kind in self.hashed.items())
        return f"sha256(concat_ws('||', {listed}))"


EQUIPMENT = Entity(
    "raw_equipment", "equipment_id", "last_update_date",
    {"equipment_id": _same, "equipment_name": _same, "equipment_type": _same, "location": _same,
     "installation_date": _day, "manufacturer": _same, "model": _same, "status": _upper,
     "last_update_date": _ts},
    ["equipment_id"], ["equipment_id"], ["last_update_date", "equipment_name"],
    {"equipment_name": "text", "equipment_type": "text", "location": "text",
     "installation_date": "day", "manufacturer": "text", "model": "text", "status": "text"},
    False,
)
VERSIONS = Entity(
    "raw_equipment", "equipment_id", "last_update_date",
    {"equipment_id": _same, "equipment_name": _same, "equipment_type": _same, "location": _same,
     "manufacturer": _same, "model": _same, "status": _upper, "last_update_date": _ts},
    ["equipment_id"], ["equipment_id"],
    ["last_update_date", "equipment_name", "location", "status"],
    {"equipment_name": "text", "equipment_type": "text", "location": "text",
     "manufacturer": "text", "model": "text", "status": "text"},
    False,
)
SENSOR = Entity(
    "raw_sensor", "reading_id", "reading_timestamp",
    {"reading_id": _same, "equipment_id": _same, "sensor_id": _same, "sensor_type": _lower,
     "reading_value": _dec, "reading_timestamp": _ts, "unit": _same},
    ["reading_id", "equipment_id", "sensor_id"],
    ["equipment_id", "sensor_id", "reading_timestamp"], ["reading_id"],
    {"equipment_id": "bare", "sensor_id": "bare", "sensor_type": "bare",
     "reading_value": "decimal", "reading_timestamp": "time", "unit": "text"},
    True,
)
PRODUCTION = Entity(
    "raw_production", "production_order_id", "last_update",
    {"production_order_id": _same, "equipment_id": _same, "product_id": _same,
     "planned_start": _ts, "planned_end": _ts, "actual_start": _ts, "actual_end": _ts,
     "planned_quantity": _int, "actual_quantity": _int, "status": _upper, "last_update": _ts},
    ["production_order_id"], ["production_order_id"], ["last_update"],
    {"equipment_id": "text", "product_id": "text", "planned_start": "time", "planned_end": "time",
     "actual_start": "time", "actual_end": "time", "planned_quantity": "int",
     "actual_quantity": "int", "status": "text"},
    True,
)
MAINTENANCE = Entity(
    "raw_maintenance", "maintenance_order_id", "last_update",
    {"maintenance_order_id": _same, "equipment_id": _same, "maintenance_type": _lower,
     "scheduled_start": _ts, "scheduled_end": _ts, "actual_start": _ts, "actual_end": _ts,
     "technician_id": _same, "status": _upper, "priority": _lower, "description": _same,
     "last_update": _ts},
    ["maintenance_order_id"], ["maintenance_order_id"], ["last_update"],
    {"equipment_id": "text", "maintenance_type": "text", "scheduled_start": "time",
     "scheduled_end": "time", "actual_start": "time", "actual_end": "time",
     "technician_id": "text", "status": "text", "priority": "text"},
    True,
)
QUALITY = Entity(
    "raw_quality", "inspection_id", "last_update",
    {"inspection_id": _same, "production_order_id": _same, "equipment_id": _same,
     "inspection_type": _lower, "inspection_date": _ts, "inspector_id": _same, "passed": _bool,
     "failed_quantity": _int, "total_quantity": _int, "defect_codes": _upper, "notes": _same,
     "last_update": _ts},
    ["inspection_id"], ["inspection_id"], ["last_update"],
    {"production_order_id": "text", "equipment_id": "text", "inspection_type": "text",
     "inspection_date": "time", "inspector_id": "text", "passed": "bool",
     "failed_quantity": "int", "total_quantity": "int", "defect_codes": "text"},
    True,
)
ENTITIES = {
    "equipment": EQUIPMENT, "versions": VERSIONS, "sensor": SENSOR, "production": PRODUCTION,
    "maintenance": MAINTENANCE, "quality": QUALITY,
}
_NARROW = {
    "equipment": {"": P9, "installation_date": P11}, "sensor": {"": P8}, "production": {"": P5},
    "maintenance": {"": P5}, "quality": {"": P5},
}


def _narrow(name: str) -> Entity:
    """The entity with its times read in few layouts."""
    entity, layouts = ENTITIES[name], _NARROW[name]
    columns = {
        c: partial(fn, formats=layouts.get(c, layouts[""])) if fn in (_ts, _day) else fn
        for c, fn in entity.columns.items()
    }
    return Entity(
        entity.raw, entity.key, entity.ts, columns, entity.required, entity.identity, entity.order,
        entity.hashed, entity.dropped,
    )


BEFORE = {
    "equipment": "v = 0",
    "versions": "v = 0",
    "sensor": f"{_ts('reading_timestamp')} < TIMESTAMP '2024-01-20'",
    "production": f"{_ts('last_update')} < TIMESTAMP '2000-01-01'",
    "quality": f"{_ts('last_update')} < TIMESTAMP '2000-01-01'",
}
CTES["before_maintenance"] = f"""
    SELECT * REPLACE (CASE WHEN {_ts('last_update')} < TIMESTAMP '1999-11-01' THEN actual_end END
      AS actual_end)
    FROM raw_maintenance WHERE {_ts('last_update')} < TIMESTAMP '2000-01-01'"""
for _name, _cut in BEFORE.items():
    CTES[f"before_{_name}"] = f"SELECT * FROM {ENTITIES[_name].raw} WHERE {_cut}"
for _name, _entity in ENTITIES.items():
    CTES[f"staged_{_name}"] = _entity.staged()
    CTES[f"ranked_{_name}"] = _entity.ranked(f"SELECT * FROM staged_{_name}")
    CTES[f"clean_{_name}"] = _entity.curated(f"SELECT * FROM staged_{_name}")
    if _name in _NARROW:
        CTES[f"narrow_{_name}"] = _narrow(_name).curated(_narrow(_name).staged())
    CTES[f"clean_before_{_name}"] = _entity.curated(_entity.staged(f"before_{_name}"))

WINDOWS = {
    "equipment": "last_update_date IS NULL OR last_update_date >= DATE '2001-12-15' - 90",
    "versions": "coalesce(last_update_date, TIMESTAMP '2001-12-15 10:30:00')"
                " >= DATE '2001-12-15' - 90",
    "sensor": "reading_timestamp >= DATE '2024-03-15' - 60",
    "production": "last_update >= DATE '2001-11-04' - 60",
    "maintenance": "last_update >= DATE '2001-08-01' - 60",
    "quality": "last_update >= DATE '2001-11-04' - 60",
}

# --- star schema ----------------------------------------------------------------------------------

CTES["fact_production"] = f"""
    SELECT production_order_id AS production_key, equipment_id, product_id,
      {_key('actual_start')} AS start_date_key, actual_start, actual_end,
      {_seconds('actual_start', 'actual_end')} / 60 AS duration_minutes,
      planned_quantity AS planned_qty, actual_quantity AS actual_qty,
      actual_quantity - planned_quantity AS qty_diff, status
    FROM clean_production WHERE actual_start IS NOT NULL"""
CTES["fact_maintenance"] = f"""
    SELECT maintenance_order_id AS maintenance_key, equipment_id,
      {_key('actual_start')} AS start_date_key, maintenance_type, actual_start, actual_end,
      {_seconds('actual_start', 'actual_end')} / 60 AS downtime_minutes, technician_id,
      {_seconds('actual_start', 'actual_end')} / 3600 * 100 AS cost_estimate
    FROM clean_maintenance WHERE actual_start IS NOT NULL"""
CTES["fact_quality"] = f"""
    SELECT inspection_id, production_order_id, equipment_id, {_key('inspection_date')} AS date_key,
      inspection_date, passed, total_quantity, failed_quantity,
      failed_quantity / nullif(total_quantity, 0) * 100 AS rejection_rate_pct, defect_codes
    FROM clean_quality"""


def _half_up(total: str, count: str, scale: int) -> str:
    """total/count for a non-negative integer total, half up to an integer, as DOUBLE of a scale."""
    return f"CAST((2 * ({total}) + {count}) // (2 * {count}) AS DOUBLE) / 1e{scale}"


CTES["fact_sensor_hourly"] = f"""
    SELECT equipment_id, sensor_type, date_trunc('hour', reading_timestamp) AS hour_bucket,
      {_key("date_trunc('hour', reading_timestamp)")} AS date_key,
      {_half_up("CAST(sum(CAST(reading_value * 10000 AS HUGEINT)) AS HUGEINT) * 10000",
                "count(reading_value)", 8)} AS avg_value,
      CAST(min(reading_value) AS DOUBLE) AS min_value,
      CAST(max(reading_value) AS DOUBLE) AS max_value,
      count(*) AS reading_count
    FROM clean_sensor GROUP BY ALL"""
CTES["dim_equipment"] = """
    SELECT equipment_id, equipment_name, equipment_type, location, manufacturer, model,
      status AS current_status, installation_date FROM clean_equipment"""
CTES["dim_type"] = """
    SELECT DISTINCT maintenance_type, maintenance_type AS description FROM clean_maintenance
    WHERE maintenance_type IS NOT NULL"""
CTES["order_span"] = """
    SELECT min(u) AS first_day, max(u) AS last_day FROM (
      SELECT CAST(last_update AS DATE) AS u FROM staged_production
      UNION ALL SELECT CAST(last_update AS DATE) FROM staged_maintenance)"""
CTES["before_span"] = """
    SELECT min(CAST(last_update AS DATE)) AS first_day, max(CAST(last_update AS DATE)) AS last_day
    FROM clean_before_production"""
CTES["sensor_span"] = """
    SELECT min(CAST(reading_timestamp AS DATE)) AS first_day,
      max(CAST(reading_timestamp AS DATE)) AS last_day FROM staged_sensor"""


def _calendar(span: str) -> str:
    return f"""
    SELECT {_key('d')} AS date_key, d AS full_date, CAST(year(d) AS INT) AS year,
      CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
      CAST(dayofweek(d) + 1 AS INT) AS day_of_week, strftime(d, '%A') AS day_name,
      strftime(d, '%B') AS month_name, dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d
      FROM {span})"""


CTES["order_dates"] = _calendar("order_span")
CTES["sensor_dates"] = _calendar("sensor_span")
CTES["before_dates"] = _calendar("before_span")

# --- merges and history ---------------------------------------------------------------------------


def _merged(target: str, source: str, key: str, guarded: bool = True, columns: str = "*") -> str:
    keep = f"NOT EXISTS (SELECT 1 FROM {source} s WHERE s.{key} = t.{key}"
    keep += " AND (t.row_hash IS NULL OR t.row_hash <> s.row_hash))" if guarded else ")"
    write = (
        f"NOT EXISTS (SELECT 1 FROM {target} t WHERE s.{key} = t.{key}"
        + (" AND t.row_hash = s.row_hash)" if guarded else " AND false)")
    )
    return (
        f"SELECT {columns} FROM {target} t WHERE {keep}"
        f" UNION ALL SELECT {columns} FROM {source} s WHERE {write}"
    )


CTES["history_first"] = """
    SELECT * EXCLUDE (last_update_date),
      coalesce(last_update_date, TIMESTAMP '2001-09-15') AS effective_start,
      TIMESTAMP '9999-12-31' AS effective_end, true AS is_current
    FROM clean_before_versions"""
CTES["history_source"] = """
    SELECT * EXCLUDE (last_update_date),
      coalesce(last_update_date, TIMESTAMP '2001-12-15') AS effective_start,
      TIMESTAMP '9999-12-31' AS effective_end, true AS is_current
    FROM clean_versions"""
CTES["history"] = """
    SELECT h.* REPLACE (
        CASE WHEN s.equipment_id IS NULL THEN h.effective_end ELSE s.effective_start END
          AS effective_end,
        s.equipment_id IS NULL AS is_current)
    FROM history_first h LEFT JOIN history_source s ON h.equipment_id = s.equipment_id
      AND h.row_hash <> s.row_hash AND s.effective_start >= h.effective_start
    UNION ALL
    SELECT s.* FROM history_source s LEFT JOIN history_first h ON h.equipment_id = s.equipment_id
    WHERE h.equipment_id IS NULL
      OR (h.row_hash <> s.row_hash AND s.effective_start >= h.effective_start)"""

# What an incremental ingest reads, and what it leaves of production orders.
for _name in ("sensor", "production", "maintenance"):
    _ts_col = ENTITIES[_name].ts
    CTES[f"newer_{_name}"] = f"""
    SELECT * FROM {ENTITIES[_name].raw} WHERE {_ts_col} IS NULL
      OR {_ts(_ts_col)} > (SELECT max({_ts(_ts_col)}) FROM before_{_name})"""
CTES["batch_production"] = f"""
    SELECT * FROM newer_production QUALIFY row_number() OVER (PARTITION BY production_order_id
      ORDER BY {_ts('last_update')} DESC NULLS LAST,
        {', '.join(f'{c} DESC NULLS LAST' for c in PRODUCTION.columns if c != PRODUCTION.key)}) = 1"""
CTES["ingested_production"] = """
    SELECT coalesce(b.production_order_id, t.production_order_id) AS production_order_id,
      CASE WHEN b.production_order_id IS NULL THEN t.status ELSE b.status END AS status
    FROM before_production t FULL JOIN batch_production b
      ON t.production_order_id = b.production_order_id"""

# --- views ----------------------------------------------------------------------------------------

# One row per machine, day and measure, and from these one row per machine and day.
_MEASURES = {
    "ran": ("production", "start_date_key", "duration_minutes"),
    "planned": ("production", "start_date_key", "planned_qty"),
    "made": ("production", "start_date_key", "actual_qty"),
    "stood": ("maintenance", "start_date_key", "downtime_minutes"),
    "checked": ("quality", "date_key", "total_quantity"),
    "failed": ("quality", "date_key", "failed_quantity"),
}
CTES["measures"] = " UNION ALL ".join(
    f"SELECT equipment_id, {day} AS day_key, '{kind}' AS kind, CAST({amount} AS DOUBLE) AS amount"
    f" FROM fact_{fact} WHERE {day} IS NOT NULL"
    for kind, (fact, day, amount) in _MEASURES.items()
)
CTES["machine_days"] = (
    "SELECT equipment_id, day_key, "
    + ", ".join(f"sum(amount) FILTER (kind = '{kind}') AS {kind}" for kind in _MEASURES)
    + ", "
    + ", ".join(
        f"count(*) FILTER (kind = '{kind}') AS {kind}_rows" for kind in ("ran", "stood", "checked")
    )
    + " FROM measures GROUP BY equipment_id, day_key"
)
_FULL_DATE = "make_date(day_key // 10000, day_key // 100 % 100, day_key % 100) AS full_date"


def _whole(amount: str, name: str) -> str:
    return f"CAST(ifnull({amount}, 0) AS BIGINT) AS {name}"


CTES["production_daily"] = f"""
    SELECT equipment_id, day_key AS date_key, {_whole("planned", "total_planned")},
      {_whole("made", "total_produced")}, ran AS production_minutes
    FROM machine_days WHERE ran > 0"""
CTES["downtime_daily"] = """
    SELECT equipment_id, day_key AS date_key, ifnull(stood, 0) AS total_downtime
    FROM machine_days WHERE stood_rows > 0"""
CTES["quality_daily"] = f"""
    SELECT equipment_id, day_key AS date_key, {_whole("checked", "total_inspected")},
      {_whole("failed", "total_failed")}
    FROM machine_days WHERE checked_rows > 0"""
# A machine without any stop on record is taken to have stood for a hundredth of a minute.
CTES["oee"] = f"""
    WITH shares AS (
      SELECT *, ran + ifnull(stood, 0) AS total_time,
        ran / nullif(ran + if(stood_rows > 0, ifnull(stood, 0), 0.01::DOUBLE), 0) AS up,
        ifnull(made, 0) / nullif(planned, 0) AS speed,
        (checked - ifnull(failed, 0)) / nullif(checked, 0) AS good
      FROM machine_days WHERE ran > 0)
    SELECT day_key AS date_key, {_FULL_DATE}, equipment_id, equipment_name,
      CAST(ifnull(stood, 0) AS DOUBLE) AS downtime_min, ran AS production_minutes, total_time,
      if(total_time > 0, round(up, 4), 0) AS availability_rate,
      if(planned > 0, round(speed, 4), 0) AS performance_rate,
      if(checked > 0, round(good, 4), 1) AS quality_rate
    FROM shares JOIN dim_equipment USING (equipment_id)"""
CTES["downtime"] = f"""
    WITH stops AS (
      SELECT start_date_key AS day_key, equipment_id, downtime_minutes AS minutes,
        if(maintenance_type IN (SELECT maintenance_type FROM dim_type), maintenance_type, NULL)
          AS maintenance_type
      FROM fact_maintenance WHERE start_date_key IS NOT NULL)
    SELECT {_FULL_DATE}, equipment_name, maintenance_type,
      sum(minutes) AS total_downtime_minutes, count(*) AS maintenance_count,
      sum(minutes) / nullif(count(minutes), 0) AS avg_downtime_minutes
    FROM stops JOIN dim_equipment USING (equipment_id)
    GROUP BY day_key, equipment_name, maintenance_type"""
CTES["critical"] = """
    SELECT e.equipment_id, e.equipment_name, m.total_downtime,
      coalesce(m.maintenance_count, 0) AS maintenance_count, q.total_failures,
      m.total_downtime + coalesce(q.total_failures, 0) * 10 AS criticality_score
    FROM dim_equipment e
    LEFT JOIN (SELECT equipment_id, sum(downtime_minutes) AS total_downtime,
        count(DISTINCT maintenance_key) AS maintenance_count
      FROM fact_maintenance GROUP BY ALL) m ON e.equipment_id = m.equipment_id
    LEFT JOIN (SELECT equipment_id, CAST(sum(failed_quantity) AS BIGINT) AS total_failures
      FROM fact_quality GROUP BY ALL) q ON e.equipment_id = q.equipment_id"""
# Joined row by row, a machine's orders would each meet all its inspections, and the other way round.
_OWN = "WHERE equipment_id = machine.equipment_id"
CTES["critical_fanout"] = f"""
    WITH sums AS (
      SELECT equipment_id, equipment_name,
        (SELECT sum(downtime_minutes) FROM fact_maintenance {_OWN})
          * greatest(1, (SELECT count(*) FROM fact_quality {_OWN})) AS total_downtime,
        (SELECT count(DISTINCT maintenance_key) FROM fact_maintenance {_OWN}) AS maintenance_count,
        CAST((SELECT sum(failed_quantity) FROM fact_quality {_OWN})
          * greatest(1, (SELECT count(*) FROM fact_maintenance {_OWN})) AS BIGINT) AS total_failures
      FROM dim_equipment machine)
    SELECT *, total_downtime + ifnull(total_failures, 0) * 10 AS criticality_score FROM sums"""
CTES["trends"] = f"""
    WITH hours AS (
      SELECT date_key AS day_key, equipment_name, sensor_type, min_value, max_value, reading_count,
        CAST(round(avg_value * 1e8) AS HUGEINT) AS scaled
      FROM fact_sensor_hourly JOIN dim_equipment USING (equipment_id) WHERE date_key IS NOT NULL)
    SELECT {_FULL_DATE}, equipment_name, sensor_type,
      {_half_up("sum(scaled)", "count(scaled)", 8)} AS avg_reading,
      min(min_value) AS min_reading, max(max_value) AS max_reading,
      CAST(sum(reading_count) AS BIGINT) AS total_readings
    FROM hours GROUP BY day_key, equipment_name, sensor_type"""


def _star(times: dict[str, str]) -> str:
    """Sums per day and machine name over the days with production, each taken ``times`` often."""
    def total(kind: str) -> str:
        return f"ifnull(sum({kind} * {times.get(kind, '1')}), 0)"

    return f"""
    SELECT {_FULL_DATE}, equipment_name, equipment_type,
      {total("ran")} AS production_time, {total("stood")} AS downtime,
      CAST({total("planned")} AS BIGINT) AS planned_qty, CAST({total("made")} AS BIGINT) AS actual_qty,
      CAST({total("checked")} AS BIGINT) AS inspected_qty,
      CAST({total("failed")} AS BIGINT) AS failed_qty
    FROM machine_days JOIN dim_equipment USING (equipment_id)
    WHERE ran_rows > 0 AND day_key BETWEEN 20010615 AND 20010715
    GROUP BY day_key, equipment_name, equipment_type"""


_MET = {kind: f"greatest(1, {kind}_rows)" for kind in ("ran", "stood", "checked")}
_BY_PRODUCTION = f"{_MET['stood']} * {_MET['checked']}"
CTES["star_cells"] = _star({})
CTES["star_fanout"] = _star({
    "ran": _BY_PRODUCTION, "planned": _BY_PRODUCTION, "made": _BY_PRODUCTION,
    "stood": f"ran_rows * {_MET['checked']}",
    "checked": f"ran_rows * {_MET['stood']}", "failed": f"ran_rows * {_MET['stood']}",
})
# Rounding goes through the digits of the number: on a double it first multiplies, which can reach the
# half that the number itself stays below.
_STAR_OEE = """
    SELECT *, round(CAST(round(CAST(CAST(
        production_time / nullif(production_time + downtime, 0)
        * (actual_qty / nullif(planned_qty, 0))
        * ((inspected_qty - failed_qty) / nullif(inspected_qty, 0))
      AS VARCHAR) AS DECIMAL(38,20)), 4) AS DOUBLE) * 100, 2) AS oee_pct
    FROM """


def sql(statement: str, instead: dict[str, str] | None = None) -> str:
    """The statement with all table expressions it needs, each after those it uses itself."""
    tables = {**CTES, **(instead or {})}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in tables:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                need(tables[name])
                ordered.append(name)

    need(statement)
    listed = ",\n".join(f"{name} AS ({tables[name]})" for name in ordered)
    return f"WITH {listed}\n{statement}" if ordered else statement


def _profile(raw: str, key: str, column: str, formats) -> str:
    return f"SELECT {key}, {column} AS text, {_ts(column, formats)} AS parsed FROM {raw}"


def _counted(label: str, value: str, table: str, column: str, expr: str) -> str:
    return (
        f"SELECT '{label}' AS {table}, {expr} AS {column}, count(*) AS n FROM {value} GROUP BY ALL"
    )


_OEE = "availability_rate * performance_rate * quality_rate"
_OEE30 = "oee WHERE full_date BETWEEN DATE '2001-07-15' - 30 AND DATE '2001-07-15'"
_OEE7 = "oee WHERE full_date BETWEEN DATE '2001-07-15' - 7 AND DATE '2001-07-15'"
_DOWN30 = "downtime WHERE full_date BETWEEN DATE '2001-07-15' - 30 AND DATE '2001-07-15'"

_MONTHS = ("janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto",
           "setembro", "outubro", "novembro", "dezembro")
_WEEKDAYS = ("segunda", "terça", "quarta", "quinta", "sexta", "sábado", "domingo")


def _list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


_WATERMARK_TABLES = {
    "equipment_master": ("raw_equipment", "last_update_date"),
    "iot_sensor_readings": ("raw_sensor", "reading_timestamp"),
    "production_orders": ("raw_production", "last_update"),
    "maintenance_orders": ("raw_maintenance", "last_update"),
    "quality_inspections": ("raw_quality", "last_update"),
}


def _newer(table: str, name: str) -> str:
    raw, ts = _WATERMARK_TABLES[table]
    return (
        f"SELECT '{table}' AS table_name, max({_ts(ts)}) AS source_max,"
        f" (SELECT max({_ts(ts)}) FROM before_{name}) AS target_max,"
        f" max({_ts(ts)}) > (SELECT max({_ts(ts)}) FROM before_{name}) AS has_new_data FROM {raw}"
    )


_CLEANED = {
    "equipment_master": "clean_equipment", "production_orders": "clean_production",
    "maintenance_orders": "clean_maintenance", "quality_inspections": "clean_quality",
}
_COUNT_PAIRS = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {raw}) AS source_rows, "
    + (f"(SELECT count(*) FROM {_CLEANED[table]})" if table in _CLEANED else "NULL")
    + " AS target_rows"
    for table, (raw, _) in _WATERMARK_TABLES.items()
)


def _raw_columns(entity: Entity, source: str | None = None) -> str:
    return f"SELECT {', '.join(entity.columns)} FROM {source or entity.raw}"


STATEMENTS: dict[str, str] = {
    "prs1_timestamp_all": "SELECT production_order_id, " + ", ".join(
        f"{_ts(c)} AS {c}"
        for c in ("planned_start", "planned_end", "actual_start", "actual_end", "last_update")
    ) + " FROM raw_production",
    "prs1_timestamp_p5": _profile("raw_production", "production_order_id", "last_update", P5),
    "prs1_timestamp_p8": _profile("raw_sensor", "reading_id", "reading_timestamp", P8),
    "prs1_timestamp_p9": _profile("raw_equipment", "equipment_id", "last_update_date", P9),
    "prs2_date": f"SELECT equipment_id, installation_date AS text,"
                 f" {_day('installation_date', P11)} AS installation_date,"
                 f" {_day('installation_date')} AS installation_date_any FROM raw_equipment",
    "prs3_decimal": f"SELECT reading_id, {_dec('reading_value')} AS reading_value FROM raw_sensor",
    "prs4_int": f"SELECT production_order_id, {_int('planned_quantity')} AS planned_quantity,"
                f" {_int('actual_quantity')} AS actual_quantity FROM raw_production",
    "prs5_bool": f"SELECT inspection_id, {_bool('passed')} AS passed FROM raw_quality",
    "prs6_upper": " UNION ALL ".join(
        _counted(label, raw, "table_name", "status", _upper(column))
        for label, raw, column in (
            ("equipment_master", "raw_equipment", "status"),
            ("production_orders", "raw_production", "status"),
            ("maintenance_orders", "raw_maintenance", "status"),
            ("quality_inspections", "raw_quality", "defect_codes"),
        )
    ),
    "prs7_lower": " UNION ALL ".join(
        _counted(column, raw, "column_name", "value", _lower(column))
        for raw, column in (
            ("raw_sensor", "sensor_type"), ("raw_maintenance", "maintenance_type"),
            ("raw_maintenance", "priority"), ("raw_quality", "inspection_type"),
        )
    ),
    "prs8_source_timestamp": _profile(
        "raw_maintenance", "maintenance_order_id", "scheduled_end", ALL
    ),
    "flt1_required": "SELECT inspection_id, defect_codes FROM raw_quality"
                     " WHERE inspection_id IS NOT NULL",
    "flt2_window_null_kept": "SELECT equipment_id, last_update_date FROM staged_equipment WHERE "
                             + WINDOWS["equipment"],
    "flt2b_window_null_is_now": "SELECT equipment_id, last_update_date FROM staged_versions WHERE "
                                + WINDOWS["versions"],
    "flt3_window_null_dropped": "SELECT reading_id, reading_timestamp FROM staged_sensor WHERE "
                                + WINDOWS["sensor"],
    "flt4_started": "SELECT maintenance_order_id, actual_start, actual_end FROM staged_maintenance"
                    " WHERE actual_start IS NOT NULL",
    "flt5_not_blank": "SELECT inspection_id, defect_codes FROM staged_quality"
                      " WHERE defect_codes IS NOT NULL AND defect_codes <> ''",
    "flt6_last_days": "SELECT date_key, full_date FROM order_dates"
                      " WHERE full_date BETWEEN DATE '2001-11-04' - 30 AND DATE '2001-11-04'",
    "dup1_equipment": "SELECT * FROM ranked_equipment",
    "dup2_equipment_versions": "SELECT * FROM ranked_versions",
    "dup3_sensor_readings": "SELECT * FROM ranked_sensor",
    "dup4_production_orders": "SELECT * FROM ranked_production",
    "dup5_maintenance_orders": "SELECT * FROM ranked_maintenance",
    "dup6_quality_inspections": "SELECT * FROM ranked_quality",
    **{
        name: f"SELECT {ENTITIES[e].key}, {ENTITIES[e].hash()} AS row_hash FROM staged_{e}"
        for name, e in {
            "hsh1_equipment": "equipment", "hsh2_equipment_versions": "versions",
            "hsh3_sensor_readings": "sensor", "hsh4_production_orders": "production",
            "hsh5_maintenance_orders": "maintenance", "hsh6_quality_inspections": "quality",
        }.items()
    },
    "hsh7_backfill": "SELECT equipment_id, CASE WHEN location IS NOT NULL THEN 'kept'"
                     " ELSE row_hash END AS row_hash FROM clean_versions",
    **{
        name: ENTITIES[e].curated(f"SELECT * FROM staged_{e}", WINDOWS[e])
        for name, e in {
            "curate_equipment": "equipment", "curate_equipment_versions": "versions",
            "curate_sensor_readings": "sensor", "curate_production_orders": "production",
            "curate_maintenance_orders": "maintenance", "curate_quality_inspections": "quality",
        }.items()
    },
    "curate_production_orders_full": "SELECT * FROM clean_production",
    "curate_sensor_readings_full": "SELECT * FROM clean_sensor",
    **{
        name: _merged(f"clean_before_{e}", f"clean_{e}", ENTITIES[e].key)
        for name, e in {
            "mrg1_equipment": "equipment", "mrg2_sensor_readings": "sensor",
            "mrg3_production_orders": "production", "mrg4_maintenance_orders": "maintenance",
            "mrg5_quality_inspections": "quality",
        }.items()
    },
    "mrg6_calendar_insert_only": "SELECT * FROM before_dates UNION ALL SELECT * FROM order_dates"
                                 " WHERE date_key NOT IN (SELECT date_key FROM before_dates)",
    "scd1_expired": "SELECT equipment_id, effective_start, effective_end, row_hash FROM history"
                    " WHERE NOT is_current",
    "scd2_history": "SELECT * FROM history",
    "scd2_current": "SELECT equipment_id, effective_start, effective_end, row_hash FROM history"
                    " WHERE is_current",
    "scd3_version_keys": "SELECT count(*) AS versions,"
                         " count(DISTINCT (equipment_id, effective_start, row_hash)) AS keys"
                         " FROM history",
    "scd4_version_at": "SELECT p.production_order_id, p.equipment_id, p.actual_start,"
                       " h.status AS equipment_status, h.location, h.effective_start,"
                       " h.effective_end FROM clean_production p LEFT JOIN history h"
                       " ON p.equipment_id = h.equipment_id"
                       " AND h.effective_start <= p.actual_start"
                       " AND p.actual_start < h.effective_end",
    "cal1_calendar": "SELECT * FROM sensor_dates",
    "cal2_localized_calendar": f"""
        SELECT {_key('d')} AS date_key, d AS full_date, CAST(year(d) AS INT) AS year,
          CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
          CAST(day(d) AS INT) AS day, CAST(isodow(d) AS INT) AS iso_weekday,
          {_list(_MONTHS)}[month(d)] AS month_name, {_list(_WEEKDAYS)}[isodow(d)] AS day_name
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (
          SELECT min(CAST(planned_start AS DATE)) AS lo, max(CAST(planned_start AS DATE)) AS hi
          FROM staged_production))""",
    "cal3_date_key": f"SELECT reading_id, {_key('reading_timestamp')} AS date_key"
                     " FROM staged_sensor",
    "dim1_equipment": "SELECT * FROM dim_equipment",
    "dim2_equipment_history": "SELECT equipment_id, equipment_name, status, location,"
                              " effective_start, effective_end, is_current FROM history",
    "dim3_product": "SELECT DISTINCT product_id, product_id AS product_name FROM clean_production"
                    " WHERE product_id IS NOT NULL",
    "dim4_technician": "SELECT DISTINCT technician_id, technician_id AS technician_name"
                       " FROM clean_maintenance WHERE technician_id IS NOT NULL",
    "dim5_maintenance_type": "SELECT * FROM dim_type",
    "dim6_defect": "SELECT DISTINCT defect_codes AS defect_code,"
                   " defect_codes AS defect_description FROM clean_quality"
                   " WHERE defect_codes IS NOT NULL AND defect_codes <> ''",
    "dim7_defect_code": "SELECT DISTINCT trim(c) AS defect_code FROM"
                        " (SELECT unnest(string_split(defect_codes, ',')) AS c FROM clean_quality)"
                        " WHERE trim(c) <> ''",
    "dim7_defect_bridge": "SELECT DISTINCT inspection_id, trim(c) AS defect_code FROM"
                          " (SELECT inspection_id, unnest(string_split(defect_codes, ',')) AS c"
                          " FROM clean_quality) WHERE trim(c) <> ''",
    "fct1_production": "SELECT * FROM fact_production",
    "fct2_maintenance": "SELECT * FROM fact_maintenance",
    "fct3_quality": "SELECT * FROM fact_quality",
    "fct4_sensor_hourly": "SELECT * FROM fact_sensor_hourly",
    "vw1a_production_daily": "SELECT * FROM production_daily",
    "vw1b_downtime_daily": "SELECT * FROM downtime_daily",
    "vw1c_quality_daily": "SELECT * FROM quality_daily",
    "vw1_oee_daily": "SELECT * FROM oee",
    "vw2_downtime_by_cause": "SELECT * FROM downtime",
    "vw3_critical_equipment": "SELECT * FROM critical",
    "vw3_critical_equipment_fanout": "SELECT * FROM critical_fanout",
    "vw4_sensor_trends": "SELECT * FROM trends",
    "q1_mean_oee": f"SELECT round(avg({_OEE}) * 100, 2) AS mean_oee_pct FROM {_OEE30}",
    "q2_downtime_of_day": "SELECT coalesce(sum(total_downtime_minutes), 0) AS downtime_min"
                          " FROM downtime WHERE full_date = DATE '2001-07-15'",
    "q3_critical_count": "SELECT count(*) AS critical_machines FROM critical"
                         " WHERE criticality_score > 100",
    "q4_mean_quality": f"SELECT round(avg(quality_rate) * 100, 2) AS quality_pct FROM {_OEE30}",
    "q5_oee_by_equipment": f"SELECT equipment_name, round(avg({_OEE}) * 100, 2) AS oee_pct"
                           f" FROM {_OEE7} GROUP BY ALL",
    "q6_oee_by_day": f"SELECT full_date, equipment_name, round({_OEE} * 100, 2) AS oee_pct"
                     f" FROM {_OEE30}",
    "q7_top_critical": "SELECT equipment_name, total_downtime, maintenance_count, total_failures,"
                       " criticality_score FROM critical"
                       " ORDER BY criticality_score DESC NULLS LAST, equipment_id LIMIT 10",
    "q8_downtime_causes": "SELECT coalesce(maintenance_type, 'unspecified') AS cause,"
                          f" sum(total_downtime_minutes) AS total_minutes FROM {_DOWN30}"
                          " GROUP BY maintenance_type",
    "q9_downtime_by_equipment": "SELECT equipment_name,"
                                f" sum(total_downtime_minutes) AS total_downtime_min FROM {_DOWN30}"
                                " GROUP BY ALL ORDER BY total_downtime_min DESC NULLS LAST,"
                                " equipment_name LIMIT 10",
    "q10_sensor_trend": "SELECT full_date, equipment_name, sensor_type, avg_reading FROM trends"
                        " WHERE full_date BETWEEN DATE '2024-01-25' - 7 AND DATE '2024-01-25'",
    "q11_oee_detail": "SELECT full_date, equipment_name, downtime_min, production_minutes,"
                      " round(availability_rate * 100, 2) AS availability_pct,"
                      " round(performance_rate * 100, 2) AS performance_pct,"
                      " round(quality_rate * 100, 2) AS quality_pct,"
                      f" round({_OEE} * 100, 2) AS oee_pct FROM {_OEE7}",
    "q12_downtime_trend": "SELECT full_date, maintenance_type,"
                          " sum(total_downtime_minutes) AS total_downtime_minutes FROM downtime"
                          " GROUP BY ALL",
    "q13_sensor_range": "SELECT sensor_type, min(min_reading) AS min_reading,"
                        + _half_up("sum(CAST(round(avg_reading * 1e8) AS HUGEINT))",
                                   "(count(*) * 100)", 6)
                        + " AS avg_reading, max(max_reading) AS max_reading FROM trends"
                          " GROUP BY sensor_type",
    "q14_star_oee": _STAR_OEE + "star_cells",
    "q14_star_oee_fanout": _STAR_OEE + "star_fanout",
    "q15_oee_listing": "SELECT * FROM oee",
    "q15_downtime_listing": "SELECT * FROM downtime",
    "src1_raw_text": _raw_columns(QUALITY),
    "src3_full_extract": _raw_columns(MAINTENANCE),
    "src4_incremental_extract": "SELECT equipment_id, location, last_update_date"
                                " FROM raw_equipment WHERE last_update_date IS NULL"
                                f" OR {_ts('last_update_date')} > TIMESTAMP '2001-09-10'",
    "src5_fallback_extract": "SELECT inspection_id, last_update FROM raw_quality"
                             " WHERE last_update IS NULL OR"
                             f" {_ts('last_update')} > TIMESTAMP '2001-11-04 10:30:00'"
                             " - INTERVAL 90 DAY",
    "src6_high_watermark": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, max({_ts(ts)}) AS high_watermark FROM {raw}"
        for table, (raw, ts) in _WATERMARK_TABLES.items()
    ),
    "src7_new_data": " UNION ALL ".join(
        _newer(t, n) for t, n in (("equipment_master", "equipment"),
                                  ("production_orders", "production"),
                                  ("maintenance_orders", "maintenance"),
                                  ("iot_sensor_readings", "sensor"),
                                  ("quality_inspections", "quality"))
    ),
    "snk1_first_load": _raw_columns(PRODUCTION),
    "snk11_file_sizes": "SELECT CAST(count(*) AS BIGINT) AS row_count, true AS within_limit"
                        " FROM fact_sensor_hourly",
    "curate_equipment_reference_layouts": "SELECT * FROM narrow_equipment",
    "curate_sensor_readings_reference_layouts": "SELECT * FROM narrow_sensor",
    "curate_production_orders_reference_layouts": "SELECT * FROM narrow_production",
    "curate_maintenance_orders_reference_layouts": "SELECT * FROM narrow_maintenance",
    "curate_quality_inspections_reference_layouts": "SELECT * FROM narrow_quality",
    "snk2_upsert_unguarded": _merged(
        "(SELECT * EXCLUDE (row_hash) FROM clean_before_quality)",
        "(SELECT * EXCLUDE (row_hash) FROM clean_quality)", "inspection_id", guarded=False,
    ),
    "snk3_overwrite_fact": "SELECT * FROM fact_quality",
    "snk4_replace_dimension": "SELECT DISTINCT product_id, product_id AS product_name"
                              " FROM clean_production WHERE product_id IS NOT NULL",
    "snk5_load_if_empty": "SELECT * FROM order_dates",
    "snk6_append": "SELECT production_order_id AS order_id, equipment_id, status"
                   " FROM staged_production UNION ALL SELECT maintenance_order_id, equipment_id,"
                   " status FROM staged_maintenance",
    "snk7_session_view": "SELECT equipment_id, count(*) AS days,"
                         " round(avg(quality_rate), 4) AS mean_quality FROM oee"
                         " GROUP BY equipment_id",
    "snk8_partitioned_fact": "SELECT * FROM fact_sensor_hourly WHERE date_key >= 20240125",
    "snk10_reset": "SELECT 'dim_maintenance_type' AS table_name, count(*) AS row_count"
                   " FROM dim_type",
    "aud1_row_counts": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {raw}"
        for table, (raw, _) in _WATERMARK_TABLES.items()
    ),
    "aud2_reconcile": f"""
        SELECT table_name, source_rows, target_rows, source_rows - target_rows AS difference,
          CASE WHEN target_rows IS NULL THEN 'missing' WHEN source_rows = target_rows THEN 'ok'
            ELSE 'different' END AS status FROM ({_COUNT_PAIRS})
        UNION ALL
        SELECT 'TOTAL', CAST(sum(source_rows) AS BIGINT), CAST(sum(target_rows) AS BIGINT),
          CAST(sum(source_rows) - sum(target_rows) AS BIGINT), '' FROM ({_COUNT_PAIRS})""",
    "aud3_missing_tables": "SELECT 'iot_sensor_readings' AS table_name"
                           " WHERE (SELECT count(*) FROM raw_sensor) > 0",
}
STATEMENTS["src8_ingested_orders"] = (
    "SELECT status, count(*) AS rows, count(DISTINCT production_order_id) AS orders"
    " FROM ingested_production GROUP BY status"
)
STATEMENTS["aud4_ingest_summary"] = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{mode}' AS mode, count(*) AS rows_read,"
    f" {written} AS rows_written, 'ok' AS status FROM {source}"
    for table, mode, source, written in (
        ("equipment_master", "full", "raw_equipment", "count(*)"),
        ("quality_inspections", "full", "raw_quality", "count(*)"),
        ("iot_sensor_readings", "incremental", "newer_sensor", "count(DISTINCT reading_id)"),
        ("production_orders", "incremental", "newer_production",
         "count(DISTINCT production_order_id)"),
        ("maintenance_orders", "incremental", "newer_maintenance",
         "count(DISTINCT maintenance_order_id)"),
    )
)
STATEMENTS["snk2_stored_upsert"] = STATEMENTS["snk2_upsert_unguarded"]
STATEMENTS["mrg3_stored_upsert"] = STATEMENTS["mrg3_production_orders"]
STATEMENTS["snk2_bucketed_upsert"] = STATEMENTS["mrg3_production_orders"]
STATEMENTS["scd4_carried_version"] = STATEMENTS["scd4_version_at"]
STATEMENTS["scd2_stored_history"] = STATEMENTS["scd2_history"]

STATEMENTS["snk8_pruned_by_calendar"] = (
    "SELECT full_date, equipment_id, count(*) AS orders, CAST(sum(actual_qty) AS BIGINT) AS pieces"
    " FROM fact_production JOIN order_dates ON date_key = start_date_key"
    " WHERE full_date BETWEEN DATE '2001-06-15' AND DATE '2001-07-15' AND NOT is_weekend GROUP BY ALL"
)
STATEMENTS["snk7_catalog_view"] = "SELECT * FROM oee"
STATEMENTS["snk11_merged_files"] = "SELECT * FROM fact_sensor_hourly"
STATEMENTS["scd3_identity_keys"] = (
    "SELECT count(*) AS versions, count(*) AS keys, CAST(1 AS BIGINT) AS lowest, count(*) AS highest,"
    " (SELECT count(*) FROM history_first) AS unchanged FROM history"
)

ORACLE_SQL = {name: sql(statement) for name, statement in STATEMENTS.items()}
ORACLE_SQL["built_lake_oee"] = sql(
    "SELECT * FROM oee",
    {
        f"clean_{e}": ENTITIES[e].curated(
            f"SELECT * FROM staged_{e}", "last_update >= DATE '2001-09-01' - 60"
        )
        for e in ("production", "maintenance", "quality")
    },
)

# After two runs a fact stands as one built from the merged table.
for _query, _fact, _name in (
    ("snk3_touched_days", "fact_production", "production"),
    ("snk3_moved_days", "fact_maintenance", "maintenance"),
    ("fct4_merged_readings", "fact_sensor_hourly", "sensor"),
):
    _made = re.sub(rf"\bclean_{_name}\b", "merged", CTES[_fact])
    _both = _merged(f"clean_before_{_name}", f"clean_{_name}", ENTITIES[_name].key)
    ORACLE_SQL[_query] = sql(f"SELECT * FROM {_fact}", {"merged": _both, _fact: _made})
_both = _merged("first_window", "second_window", "production_order_id")
ORACLE_SQL["flt3_new_rows_only"] = sql(
    "SELECT * FROM merged",
    {
        "first_window": PRODUCTION.curated(
            PRODUCTION.staged("before_production"), "last_update >= DATE '2000-01-01' - 60"
        ),
        "second_window": PRODUCTION.curated("SELECT * FROM staged_production", WINDOWS["production"]),
        "merged": _both,
    },
)
