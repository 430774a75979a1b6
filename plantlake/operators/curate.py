"""Raw text table to curated table: parse, filter, window, de-duplicate, hash. One code path."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from plantlake.functions.hashing import row_hash
from plantlake.functions.parsing import as_is
from plantlake.functions.times import AsOf
from plantlake.operators.dedupe import dedupe
from plantlake.operators.filters import recent, require


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
# Fixed value: the JVM interprets methods of more bytes than this and never compiles them.
COMPILED_BYTES = 8000


@dataclass(frozen=True)
class Field:
    """A curated column: the parser of its raw text and, if hashed, its kind of hash input."""

    name: str
    parse: Callable[[str], Column] = as_is
    hash_kind: str | None = None


@dataclass(frozen=True)
class EntitySpec:
    """What distinguishes one curated table from another.

    ``identity`` is what a row is unique by within a batch, ``order`` what decides among its
    candidates; ``key`` is what the stored table is merged on.
    """

    name: str
    raw: str
    key: str
    ts_col: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    identity: tuple[str, ...]
    order: tuple[str, ...]
    window_days: int
    nulls: str

    @property
    def hashed(self) -> list[tuple[str, str]]:
        return [(f.name, f.hash_kind) for f in self.fields if f.hash_kind]


def compiled(spark: SparkSession) -> None:
    """Let Spark fuse steps, for the session, only into methods that the JVM compiles.

    The parsers of a wide table give one method of more bytes, which then runs interpreted; with this
    limit each step has code of its own, in small methods. A lower limit stays.
    """
    if int(spark.conf.get(HUGE_METHOD)) > COMPILED_BYTES:
        spark.conf.set(HUGE_METHOD, COMPILED_BYTES)


def stage(raw: DataFrame, spec: EntitySpec) -> DataFrame:
    """Parsed columns of the rows that have their required ids.

    The ids are checked on the raw text, where the check can reach the file scan.
    """
    compiled(raw.sparkSession)
    return require(raw, spec.required).select(
        *[f.parse(f.name).alias(f.name) for f in spec.fields]
    )


def windowed(staged: DataFrame, spec: EntitySpec, as_of: AsOf | None, days: int | None) -> DataFrame:
    """The rows in the time window of the entity; ``days=None`` takes all times (full load)."""
    if days is not None:
        staged = recent(staged, spec.ts_col, days, as_of, spec.nulls)
    elif spec.nulls == "drop":
        staged = require(staged, [spec.ts_col])
    return staged


def latest(staged: DataFrame, spec: EntitySpec) -> DataFrame:
    return dedupe(staged, spec.identity, spec.order)


def survivors(staged: DataFrame, spec: EntitySpec, as_of: AsOf | None, days: int | None) -> DataFrame:
    """One row per identity among those in the time window.

    Where the time ranks first, an identity keeps a row without one only if it has no other. For all times such
    rows may then go afterwards, which spares the scan a filter that would parse the time a second time.
    """
    if days is None and spec.nulls == "drop" and spec.order[:1] == (spec.ts_col,):
        return require(latest(staged, spec), [spec.ts_col])
    return latest(windowed(staged, spec, as_of, days), spec)


def curate(
    raw: DataFrame, spec: EntitySpec, as_of: AsOf | None = None, days: int | None = None
) -> DataFrame:
    """Curated rows of a raw batch with ``row_hash``; pass ``spec.window_days`` for the usual window.

    The hash is computed after de-duplication, for the surviving rows only.
    """
    return hashed(survivors(stage(raw, spec), spec, as_of, days), spec)


def hashed(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    return rows.withColumn("row_hash", row_hash(spec.hashed))
