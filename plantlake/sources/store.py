"""Tables on shared storage: ordinary catalog tables, written by Spark.

Raw appends, dimensions and facts are written whole. Tables that take upserts are ``KeyedTable``:
partitioned by a hash of the key, so that new keys are appended and an update rewrites the partitions
that hold the changed keys, and no other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from plantlake.config import LakeConfig
from plantlake.operators.dedupe import dedupe
from plantlake.operators.filters import require
from plantlake.functions.hashing import backfill_hash
from plantlake.operators.history import (
    changes_of,
    cut_versions,
    first_versions,
    placed_versions,
    with_version_key,
)
from plantlake.operators.identity import identity, with_place
from plantlake.operators.merge import compared_rows, marked_rows, replace_rows

VERSION_ID = "version_id"
GROUP = "key_group"
BATCH, CHANGE = "batch", "change"
BEFORE, INSERTED, UPDATED = "before", "inserted", "updated"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# A task that holds few groups writes them side by side; it need not sort its rows by group.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
# Changed rows of a group are hashed up to this many shuffled bytes, which spares the stored rows a sort.
HASHED_BYTES = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
HASHED_LIMIT = 256 << 20
SHUFFLES = "spark.sql.shuffle.partitions"


class KeyedTable:
    """A catalog table that takes upserts by ``key``. One writer at a time.

    ``key_groups`` is chosen once, about table size / 10 GB for large tables. A partition is replaced by
    Spark's dynamic overwrite, which moves complete files into place when the job has ended.

    With ``logged`` an upsert first writes what it will change to a table beside this one, as a batch with a
    number: rows as they were before, updated rows and inserted ones. Then it changes the table, then it
    notes the batch as done. A run that is lost in between is finished by the next one from the log. Who
    derives tables from this one reads ``changes`` since the last batch they saw, not the table.

    With ``bucketed`` the groups are Spark's buckets of the key too: a join by the key takes the table as it
    lies, and only the batch is shuffled. A rewritten group then stays in the task that has joined it. It is
    chosen when the table is created, like ``key_groups``. The duplicates of a batch go, it is compared and what
    changes is written once by one shuffle: with ``logged`` to the log, else to a table that is dropped again.

    With ``split`` a group consists of that many buckets, so that no task has to sort a whole group. What a
    batch changes is then written in the same buckets, and neither side of the rewrite is shuffled. A batch that
    lies by these buckets already, as ``Lake.keep`` leaves it, is not shuffled at all.
    """

    def __init__(
        self,
        lake: Lake,
        schema: str,
        table: str,
        columns: StructType,
        key: str,
        key_groups: int = 16,
        logged: bool = False,
        bucketed: bool = False,
        split: int = 1,
    ):
        self.lake = lake
        self.spark = lake.spark
        self.schema = schema
        self.table = table
        self.name = lake.config.qualify(schema, table)
        self.log_name = lake.config.qualify(schema, f"{table}_changes")
        self.staged_table = f"{table}_staged"
        self.columns = columns
        self.key = key
        self.key_groups = key_groups
        self.logged = logged
        self.bucketed = bucketed
        self.split = split if bucketed else 1

    @property
    def buckets(self) -> int:
        return self.key_groups * self.split

    def exists(self) -> bool:
        """False also for a table whose first load was lost: it is then loaded again."""
        if not self.spark.catalog.tableExists(self.name):
            return False
        noted = self.all_noted()
        return "key_groups" in noted and noted.get("loading") != "true"

    def as_stored(self) -> KeyedTable:
        """The table with the layout it was created with, where it is stored already."""
        if self.exists():
            noted = self.all_noted()
            self.bucketed, self.split = noted.get("bucketed") == "true", int(noted.get("split", 1))
        return self

    def note(self, **properties: str) -> None:
        """Keep small facts about the table in the catalog."""
        self.lake.note(self.name, **properties)

    def noted(self, name: str) -> str | None:
        return self.all_noted().get(name)

    def all_noted(self) -> dict[str, str]:
        return self.lake.noted(self.name)

    def _stored(self) -> DataFrame:
        noted = self.all_noted()
        groups = noted.get("key_groups")
        if groups != str(self.key_groups):
            raise ValueError(f"{self.name} has {groups} key groups, not {self.key_groups}")
        if (noted.get("bucketed") == "true") != self.bucketed or int(noted.get("split", 1)) != self.split:
            raise ValueError(f"{self.name} was created with another choice of buckets")
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.columns)
        return self._stored().drop(GROUP)

    def _group(self) -> Column:
        # Buckets go by Spark's 32-bit hash, so that group and bucket are one.
        hashed = F.hash(F.col(self.key)) if self.bucketed else F.xxhash64(F.col(self.key))
        return F.pmod(hashed, F.lit(self.key_groups)).cast("int").alias(GROUP)

    def _grouped(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns.names, self._group())

    def _counted(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation(f"{self.table}-{uuid4().hex}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

    def load(self, df: DataFrame, direct: bool = False) -> int:
        """First load: all rows as they are, also those that share a key. Returns their number.

        The table is created empty, with its notes, and filled by one write; rebalancing puts a group into
        few files and still splits one that is too large. With ``split`` rows go by bucket, and those that do so
        already, as after de-duplication by the key, are not shuffled. With ``direct`` nothing is shuffled: each task has an
        open file per group, which suits a source of few large tasks, as the scan of a large table. A load that
        is lost leaves a table that is still marked as loading, and is repeated from the start.
        """
        if self.exists():
            raise ValueError(f"{self.name} already has data")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.log_name}")
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.columns)
        buckets = f" CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS" if self.bucketed else ""
        self.spark.sql(
            f"CREATE TABLE {self.name} ({listed}, {GROUP} int) USING parquet OPTIONS (compression 'zstd')"
            f" PARTITIONED BY ({GROUP}){buckets}"
            f" TBLPROPERTIES ('plantlake.key_groups' = '{self.key_groups}', 'plantlake.loading' = 'true',"
            f" 'plantlake.bucketed' = '{str(self.bucketed).lower()}', 'plantlake.split' = '{self.split}')"
        )
        counted, seen = self._counted(self._grouped(df))
        if direct:
            with self.lake.setting({OPEN_FILES: self.buckets}):
                self._append(counted, as_they_lie=True)
        elif self.split > 1:
            with self._in_place():
                self._append(counted.repartition(self.key), as_they_lie=True)
        else:
            self._append(counted)
        self.note(loading="false", done="0")
        return seen.get["rows"]

    @contextmanager
    def _in_place(self) -> Iterator[None]:
        """Settings for a write of rows that lie by bucket: as many shuffle partitions as buckets, no sorts of stored rows."""
        if not self.bucketed:
            yield
            return
        with self.lake.setting({SHUFFLES: self.buckets, OPEN_FILES: self.buckets, HASHED_BYTES: HASHED_LIMIT}):
            yield

    def _stage(self, df: DataFrame, what: str = "compared") -> DataFrame:
        """Write what is compared once; its size is then known to the joins that follow."""
        path = f"{self.lake.config.location(self.schema)}/_stage/{self.table}/{what}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _stage_marked(self, marked: DataFrame) -> DataFrame:
        """Write the changed and new rows once, by the buckets of the table; dropped when they are in it."""
        self.lake.drop(self.schema, self.staged_table)
        with self._in_place():
            self.lake.keep(marked, self.schema, self.staged_table, self.key, self.buckets)
        return self.lake.read(self.schema, self.staged_table)

    def _append(self, new: DataFrame, as_they_lie: bool = False) -> None:
        rows = new if as_they_lie else new.hint("rebalance", GROUP)
        rows.write.mode("append").insertInto(self.name)

    def _overwrite(self, rows: DataFrame) -> None:
        """Replace the partitions that occur in ``rows``. Rows read by bucket are in their groups' tasks already."""
        with self._in_place():
            self.lake.overwrite_partitions(rows if self.bucketed else rows.hint("rebalance", GROUP), self.name)

    def _groups_of(self, df: DataFrame) -> list[int]:
        """Groups that occur in ``df``: at most ``key_groups`` numbers."""
        return sorted(row[GROUP] for row in df.select(GROUP).distinct().collect())

    def _in_groups_of(self, changed: DataFrame) -> tuple[list[int], DataFrame]:
        groups = self._groups_of(changed)
        return groups, self._stored().where(F.col(GROUP).isin(groups))

    def upsert(
        self,
        source: DataFrame,
        hash_col: str | None = None,
        latest_by: Sequence[str] = (),
        when: Callable[[], bool] | None = None,
    ) -> int:
        """Insert new keys and update present ones (with ``hash_col``: only changed ones).

        The batch is first reduced to one row per key, the one with the highest ``latest_by``
        columns, and written once, as it is read more than once. New keys go to new files; a batch that
        changes nothing leaves the table as it is. Returns the number of batch rows. ``when`` is asked once the
        batch is written, so that what was observed of its source can decide; if it says no, nothing happens.
        """
        batch = dedupe(require(source, [self.key]), [self.key], latest_by)
        if not self.exists():
            return self.load(batch)
        self.finish()
        counted, seen = self._counted(self._grouped(batch))
        if self.bucketed:
            marked = marked_rows(self._stored().drop(GROUP), counted, self.key, hash_col)
            if self.logged:
                number = self._log(marked, when)
                if number is not None:
                    self._apply(number)
                return seen.get["rows"]
            staged = self._stage_marked(marked)
            decided = when is None or when()
            if decided:
                changed, new = (staged.where(F.col("is_new") == flag).drop("is_new") for flag in (False, True))
                self._update(changed)
                if not new.isEmpty():
                    with self._in_place():
                        self._append(new, as_they_lie=True)
            self.lake.drop(self.schema, self.staged_table)
            return seen.get["rows"] if decided else 0
        staged = self._stage(counted, "batch")
        if when is not None and not when():
            return 0
        compared = self._stage(compared_rows(self._stored().drop(GROUP), staged, self.key, hash_col))
        if self.logged:
            number = self._log(compared)
            if number is not None:
                self._apply(number)
        else:
            changed, new = (compared.where(F.col("is_new") == flag).drop("is_new") for flag in (False, True))
            self._update(changed)
            if not new.isEmpty():
                self._append(new)
        return seen.get["rows"]

    def _update(self, changed: DataFrame) -> None:
        groups, old = self._in_groups_of(changed)
        if groups:
            self._overwrite(replace_rows(old, changed, self.key))

    # --- the log of changes ---

    def done(self) -> int:
        """Number of the last batch that is wholly in the table; 0 after the first load."""
        return int(self.noted("done") or 0)

    def _log(self, compared: DataFrame, when: Callable[[], bool] | None = None) -> int | None:
        """Write the next batch to the log, if it changes anything; its number.

        Noted when complete; one that is not is written again. Rows of a bucketed table are compared as they are
        written, and ``when`` is asked after that.
        """
        if self.bucketed:
            number = self._log_marked(compared)
            if (when is not None and not when()) or self._logged(number).isEmpty():
                return None
            self._log_before(number)
            return number
        if compared.isEmpty():
            return None
        changed, new = (compared.where(F.col("is_new") == flag).drop("is_new") for flag in (False, True))
        number = self.done() + 1
        groups, old = self._in_groups_of(changed)
        before = old.join(changed.select(self.key), self.key, "left_semi").select(changed.columns)
        rows = [(before, BEFORE), (changed, UPDATED), (new, INSERTED)] if groups else [(new, INSERTED)]
        parts = [
            df.select(*self.columns.names, GROUP, F.lit(kind).alias(CHANGE), F.lit(number).alias(BATCH))
            for df, kind in rows
        ]
        logged = parts[0]
        for part in parts[1:]:
            logged = logged.unionByName(part)
        if not self.spark.catalog.tableExists(self.log_name):
            logged.limit(0).write.option("compression", "zstd").partitionBy(BATCH).saveAsTable(self.log_name)
        self.lake.overwrite_partitions(logged, self.log_name)
        self.note(logged=str(number))
        return number

    def _logged(self, number: int) -> DataFrame:
        return self.spark.table(self.log_name).where(F.col(BATCH) == number)

    def _log_marked(self, marked: DataFrame) -> int:
        """Write the changed and new rows of the next batch to the log, each task the rows of a group.

        The batch does not count before it is noted. What a lost run has left of it goes first.
        """
        number = self.done() + 1
        change = F.when(F.col("is_new"), INSERTED).otherwise(UPDATED).alias(CHANGE)
        rows = marked.select(*self.columns.names, GROUP, change, F.lit(number).alias(BATCH))
        if self.spark.catalog.tableExists(self.log_name):
            self.spark.sql(f"ALTER TABLE {self.log_name} DROP IF EXISTS PARTITION ({BATCH} = {number})")
        else:
            empty = self.spark.createDataFrame([], rows.schema).write.option("compression", "zstd").partitionBy(BATCH)
            (empty.bucketBy(self.buckets, self.key) if self.split > 1 else empty).saveAsTable(self.log_name)
        with self._in_place():
            self.lake.overwrite_partitions(rows, self.log_name)
        return number

    def _log_before(self, number: int) -> None:
        """Add the stored rows that the batch replaces to its log, and note it as complete."""
        changed = self._logged(number).where(F.col(CHANGE) == UPDATED)
        groups, old = self._in_groups_of(changed)
        if groups:
            before = old.join(changed.select(self.key), self.key, "left_semi")
            marks = F.lit(BEFORE).alias(CHANGE), F.lit(number).alias(BATCH)
            with self._in_place():
                before.select(*self.columns.names, GROUP, *marks).write.mode("append").insertInto(self.log_name)
        self.note(logged=str(number))

    def finish(self) -> None:
        """Finish a batch that a lost run has logged; nothing to do if there is none."""
        number = int(self.noted("logged") or 0)
        if number > self.done():
            self._apply(number, again=True)

    def _apply(self, number: int, again: bool = False) -> None:
        """Bring a logged batch into the table.

        May be repeated: updated rows are put in place ``again``, and only keys still missing are inserted.
        """
        rows = self._logged(number)
        kinds = {kind: rows.where(F.col(CHANGE) == kind).drop(CHANGE, BATCH) for kind in (UPDATED, INSERTED)}
        self._update(kinds[UPDATED])
        new = kinds[INSERTED]
        if again:
            present = self._stored().select(self.key)
            new = new.join(present, self.key, "left_anti").select(*self.columns.names, GROUP)
        if not new.isEmpty():
            # The log of a bucketed table has files of one group each.
            self._append(new, as_they_lie=self.bucketed)
        self.note(done=str(number))

    def changes(self, since: int) -> DataFrame:
        """Log rows of the batches after ``since`` that are in the table, with ``change`` and ``batch``."""
        if not self.spark.catalog.tableExists(self.log_name):
            marks = [StructField(CHANGE, StringType()), StructField(BATCH, IntegerType())]
            return self.spark.createDataFrame([], StructType([*self.columns.fields, *marks]))
        done = self.done()
        rows = self.spark.table(self.log_name).where((F.col(BATCH) > since) & (F.col(BATCH) <= done))
        return rows.drop(GROUP)

    def forget(self, up_to: int) -> None:
        """Drop batches of the log that all who read it have seen."""
        if self.spark.catalog.tableExists(self.log_name):
            for row in self.spark.sql(f"SHOW PARTITIONS {self.log_name}").collect():
                number = int(row["partition"].split("=")[1])
                if number <= up_to:
                    self.spark.sql(f"ALTER TABLE {self.log_name} DROP IF EXISTS PARTITION ({BATCH} = {number})")


def latest_images(changes: DataFrame, key: str) -> DataFrame:
    """Of logged changes, the last state of every changed key."""
    after = changes.where(F.col(CHANGE) != BEFORE)
    return dedupe(after, [key], [BATCH]).drop(CHANGE, BATCH)


class HistoryTable(KeyedTable):
    """A ``KeyedTable`` of validity intervals.

    Where its columns have ``version_id``, every new version gets a number that follows the highest
    stored one. Numbers are dense and never change; only a run that is lost between two of its writes
    leaves out those it did not get to store.
    """

    def _numbered(self, placed: DataFrame) -> DataFrame:
        """Stored rows with a place, with their ``version_id``."""
        if VERSION_ID not in self.columns.names:
            return placed
        highest = self._stored().agg(F.max(VERSION_ID)).first()[0] if self.exists() else None
        return placed.withColumn(VERSION_ID, identity(placed, highest or 0))

    def track(
        self,
        source: DataFrame,
        ts: str,
        hash_col: str,
        as_of,
        hashed: Sequence[tuple[str, str]] = (),
    ) -> int:
        """Bring the history up to date with a batch, of which the latest row per key counts.

        Missing hashes of stored versions are first taken to be those of their ``hashed`` columns. Keys
        not seen before are appended; keys whose history changes have their partition rewritten.
        """
        batch = dedupe(require(source, [self.key]), [self.key], [ts])
        counted, seen = self._counted(first_versions(batch, self.key, ts, as_of))
        if not self.exists():
            first = with_version_key(counted, self.key, hash_col)
            if VERSION_ID in self.columns.names:
                first = self._numbered(self._stage(with_place(first), "first"))
            return self.load(first)
        known = self.read().drop("version_key")
        known = backfill_hash(known, hashed, hash_col) if hashed else known
        opened = self._stage(counted, "batch")
        # One row per changed key, and so per new version.
        changes = self._stage(with_place(changes_of(known, opened, self.key, hash_col)), "changes")
        new_versions = placed_versions(opened, changes, self.key)
        if VERSION_ID in self.columns.names:
            new_versions = new_versions.join(self._numbered(changes).select(self.key, VERSION_ID), self.key)
        placed = self._grouped(with_version_key(new_versions, self.key, hash_col))
        seen_before = changes.where(~F.col("is_new"))
        groups = self._groups_of(seen_before.select(self._group()))
        if groups:
            old = self._stored().where(F.col(GROUP).isin(groups)).drop(GROUP, "version_key")
            old = backfill_hash(old, hashed, hash_col) if hashed else old
            cut = with_version_key(cut_versions(old, changes, self.key, "left"), self.key, hash_col)
            late = placed.join(seen_before.select(self.key), self.key, "left_semi")
            self._overwrite(self._grouped(cut).unionByName(late.select(*self.columns.names, GROUP)))
        new = placed.join(changes.where("is_new").select(self.key), self.key, "left_semi")
        new = new.select(*self.columns.names, GROUP)
        if not new.isEmpty():
            self._append(new)
        return seen.get["rows"]


class Lake:
    """The schemas of one lake and the ordinary tables in them."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark = spark
        self.config = config

    # --- schemas ---

    def _schema_name(self, schema: str) -> str:
        return self.config.qualify(schema, "")

    def create_schema(self, schema: str) -> None:
        location = self.config.location(schema)
        self.spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {self._schema_name(schema)} LOCATION '{location}'"
        )

    def reset_schema(self, schema: str) -> None:
        """Drop a schema with everything in it and create it empty."""
        self.spark.sql(f"DROP SCHEMA IF EXISTS {self._schema_name(schema)} CASCADE")
        self.create_schema(schema)

    def drop(self, schema: str, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.config.qualify(schema, table)}")

    def tables(self, schema: str) -> DataFrame:
        """The tables and views of a schema; Spark lists the session's temporary views with those of any schema."""
        return self.spark.sql(f"SHOW TABLES IN {self._schema_name(schema)}").where("not isTemporary")

    def exists(self, schema: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.config.qualify(schema, table))

    def note(self, name: str, **properties: str) -> None:
        """Keep small facts about a table (qualified name) in the catalog."""
        listed = ", ".join(f"'plantlake.{k}' = '{v}'" for k, v in properties.items())
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")

    def noted(self, name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        prefix = "plantlake."
        return {r["key"].removeprefix(prefix): r["value"] for r in rows if r["key"].startswith(prefix)}

    def overwrite_partitions(self, rows: DataFrame, name: str) -> None:
        """Replace those partitions of a table (qualified name) that occur in ``rows``; columns by position.

        Complete files are moved into place when the job has ended; what a lost job leaves is replaced by
        the next one.
        """
        with self._overwriting("dynamic"):
            rows.write.mode("overwrite").insertInto(name)

    @contextmanager
    def setting(self, values: dict[str, object]) -> Iterator[None]:
        """Settings of the session for the length of a block."""
        before = {name: self.spark.conf.get(name) for name in values}
        try:
            for name, value in values.items():
                self.spark.conf.set(name, str(value))
            yield
        finally:
            for name, value in before.items():
                self.spark.conf.set(name, value)

    def _overwriting(self, mode: str):
        """Inserts into a catalog table take the mode from the session alone."""
        return self.setting({OVERWRITE_MODE: mode})

    # --- ordinary tables ---

    def read(self, schema: str, table: str) -> DataFrame:
        return self.spark.table(self.config.qualify(schema, table))

    def append(self, df: DataFrame, schema: str, table: str) -> None:
        """Add all rows. Columns go by name, whatever their order."""
        if self.exists(schema, table):
            df = df.select(self.read(schema, table).columns)
        df.write.mode("append").saveAsTable(self.config.qualify(schema, table))

    def overwrite(
        self,
        df: DataFrame,
        schema: str,
        table: str,
        partition_by: Sequence[str] = (),
        max_records_per_file: int | None = None,
    ) -> None:
        """Replace all rows, in one directory per value of ``partition_by``.

        Rebalancing by those columns gives each directory few files of even size; a directory with
        a large share of the rows is spread over several tasks.
        """
        writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.option("compression", "zstd")
        if max_records_per_file is not None:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        # Not as an option, which would stay with the table.
        with self._overwriting("static"):
            writer.mode("overwrite").saveAsTable(self.config.qualify(schema, table))

    def keep(self, df: DataFrame, schema: str, table: str, key: str, buckets: int) -> None:
        """Write rows that are used more than once, in buckets of ``key``; a join or a choice by the key takes them as they lie.

        They are shuffled by the key, unless they lie by it already, as after de-duplication by it.
        """
        with self.setting({SHUFFLES: buckets, OPEN_FILES: buckets}):
            writer = df.repartition(key).write.mode("overwrite").option("compression", "zstd")
            writer.bucketBy(buckets, key).saveAsTable(self.config.qualify(schema, table))

    def compact(
        self, schema: str, table: str, partition_by: Sequence[str], file_bytes: int = 128 << 20, min_files: int = 8
    ) -> int:
        """Merge small files of a partitioned table; returns how many partitions were rewritten.

        A partition is rewritten if it has at least ``min_files`` files below half of ``file_bytes`` and
        would end with fewer files. Its files are dealt to new ones of about that size. Other partitions are
        neither read, but for the footers of their files, nor written; a second call finds nothing to do.
        """
        name, by = self.config.qualify(schema, table), list(partition_by)
        path, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
        files = self.spark.table(name).select(*by, path.alias("_path"), size.alias("_size")).distinct()
        small = F.count(F.when(F.col("_size") < file_bytes // 2, True))
        wanted = F.ceil(F.sum("_size") / file_bytes).cast("int")
        crowded = files.groupBy(*by).agg(small.alias("_small"), F.count("*").alias("_n"), wanted.alias("_files"))
        crowded = crowded.where((F.col("_small") >= min_files) & (F.col("_files") < F.col("_n")))
        found = crowded.select(*by, "_files").collect()
        if not found:
            return 0
        chosen = self.spark.createDataFrame(found, crowded.select(*by, "_files").schema).alias("c")
        rows = self.spark.table(name).withColumn("_path", path).alias("r")
        met = F.lit(True)
        for c in by:
            met = met & F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}"))
        dealt = F.pmod(F.xxhash64("_path"), F.col("_files")).alias("_deal")
        columns = self.spark.table(name).columns
        packed = rows.join(F.broadcast(chosen), met).select(*[F.col(f"r.{c}").alias(c) for c in columns], dealt)
        packed = packed.repartition(sum(r["_files"] for r in found), *by, "_deal").drop("_deal")
        self.overwrite_partitions(packed, name)
        return len(found)

    def publish_view(self, schema: str, view: str, text: str) -> DataFrame:
        """Define or replace a view in the catalog, where every session and tool finds it."""
        name = self.config.qualify(schema, view)
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
        return self.spark.table(name)

    def replace(self, df: DataFrame, schema: str, table: str) -> None:
        """Replace a dimension by the result of a query."""
        self.overwrite(df, schema, table)

    def load_if_empty(self, df: DataFrame, schema: str, table: str) -> bool:
        """Fill a table that is missing or empty; say whether that was so."""
        if self.exists(schema, table) and not self.read(schema, table).isEmpty():
            return False
        self.append(df, schema, table)
        return True

    def keyed(
        self, schema: str, table: str, columns: StructType, key: str, key_groups: int = 16,
        logged: bool = False, bucketed: bool = False, split: int = 1,
    ) -> KeyedTable:
        return KeyedTable(self, schema, table, columns, key, key_groups, logged, bucketed, split)

    def history(
        self, schema: str, table: str, columns: StructType, key: str, key_groups: int = 16
    ) -> HistoryTable:
        return HistoryTable(self, schema, table, columns, key, key_groups)


def register_view(name: str, df: DataFrame) -> DataFrame:
    """Define or replace a session view; it stays lazy."""
    df.createOrReplaceTempView(name)
    return df
