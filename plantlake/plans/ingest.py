"""Raw ingest: full on the first run, then incremental by watermark, with a summary per table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from plantlake.functions.times import AsOf
from plantlake.operators.curate import compiled
from plantlake.sources.extract import (
    FALLBACK_DAYS,
    event_time,
    extract,
    has_new_data,
    watermark_value,
)
from plantlake.sources.schemas import RAW_TABLES, as_raw, raw_schema
from plantlake.sources.store import KeyedTable, Lake

LATEST = "latest_time"
TIME = "_time"
SUMMARY_SCHEMA = (
    "table_name string, mode string, rows_read long, rows_written long, status string, error string"
)


def raw_table(lake: Lake, table: str, key_groups: int = 16) -> KeyedTable:
    """Bucketed, but for a table that was filled without buckets, which stays as it is."""
    spec = RAW_TABLES[table]
    found = lake.keyed(lake.config.raw, table, raw_schema(table), spec.key, key_groups, logged=True, bucketed=True)
    return found.as_stored()


def _keep_latest(target: KeyedTable, latest: datetime | None) -> None:
    if latest is not None:
        target.note(**{LATEST: latest.isoformat()})


def ingest(
    lake: Lake,
    table: str,
    source: DataFrame,
    as_of: AsOf,
    days_back: int = FALLBACK_DAYS,
    key_groups: int = 16,
) -> tuple[str, int, int]:
    """Bring one raw table up to date; returns ``(mode, rows read, rows written)``.

    A missing target takes all rows. Otherwise, unless the source has nothing later than the target,
    rows after the target's latest time are upserted by key, overwriting what is there. Only the two
    latest times reach the driver; the source's is observed while the batch is written, so the source
    is read once, and the target's is kept with the table, and read from its rows only where it is missing.
    Of several batch rows with one key the latest is taken.
    """
    compiled(lake.spark)
    target = raw_table(lake, table, key_groups)
    # Each time is parsed once: what is observed stays below the filter of the batch.
    source = as_raw(source, table).withColumn(TIME, event_time(table))
    whole, seen = (Observation(f"{table}-{uuid4().hex}") for _ in range(2))
    latest = F.max(TIME).alias("latest")
    facts = F.count(F.lit(1)).alias("rows_read"), latest
    if not target.exists():
        written = target.load(source.observe(seen, *facts), direct=True)
        _keep_latest(target, seen.get["latest"])
        return "full", seen.get["rows_read"], written
    noted = target.noted(LATEST)
    # A target filled by other means than this function, or by a run that was lost, has no note.
    target_max = datetime.fromisoformat(noted) if noted else watermark_value(target.read(), table)
    timed = source.observe(whole, latest)
    batch = extract(timed, table, target_max, as_of, days_back, time=F.col(TIME)).observe(seen, *facts)
    is_new: list[bool] = []

    def newer() -> bool:
        is_new.append(has_new_data(whole.get["latest"], target_max))
        return is_new[0]

    written = target.upsert(batch, latest_by=[TIME], when=newer)
    if not is_new[0]:
        return "skipped", 0, 0
    _keep_latest(target, seen.get["latest"])
    return "incremental", seen.get["rows_read"], written


def ingest_all(
    lake: Lake,
    source_of: Callable[[str], DataFrame],
    as_of: AsOf,
    tables: Iterable[str] = tuple(RAW_TABLES),
    days_back: int = FALLBACK_DAYS,
    key_groups: int = 16,
) -> DataFrame:
    """Ingest several tables and report on each; one that fails does not stop the others.

    What goes on from the tables has to pass the report through ``all_ingested`` first.
    """
    rows = []
    for table in tables:
        try:
            mode, read, written = ingest(
                lake, table, source_of(table), as_of, days_back, key_groups
            )
            rows.append((table, mode, read, written, "ok", None))
        except Exception as error:
            rows.append((table, None, 0, 0, "failed", str(error)))
    return lake.spark.createDataFrame(rows, SUMMARY_SCHEMA)


class IngestError(RuntimeError):
    """Tables that could not be brought up to date, with the reasons."""


def all_ingested(summary: DataFrame) -> DataFrame:
    """The report of ``ingest_all`` if no table of it failed; else an error, as the tables then lack rows."""
    failed = [f"{row.table_name}: {row.error}" for row in summary.collect() if row.status != "ok"]
    if failed:
        raise IngestError("; ".join(failed))
    return summary
