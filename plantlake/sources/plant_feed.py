"""The five raw plant tables, derived from the order, line, supplier and event tables.

The text is derived as part of each query, so column pruning and filters reach the files below.

Gives every raw column as text with the irregularities a plant feed has: several date layouts,
decimal commas, mixed case, stray blanks, several spellings of a boolean and repeated keys.
See FIXTURES.md for the mapping in words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID_DIGITS = 12


def _text(column: Column) -> Column:
    return column.cast("string")


def _id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_text(number), ID_DIGITS, "0"))


def _plus(ts: Column, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, ts)


# The layouts a feed mixes, by variant, cut from "yyyy-MM-dd HH:mm:ss" text.
LAYOUTS = (
    "{0}",
    "left({0}, 10)",
    "replace(left({0}, 10), '-', '/')",
    "concat_ws('/', substring({0}, 9, 2), substring({0}, 6, 2), left({0}, 4))",
    "concat(substring({0}, 9, 2), '-', substring({0}, 6, 2), '-', left({0}, 4), right({0}, 9))",
    "replace({0}, ' ', 'T')",
)


def mixed_time(text: str, variant: str) -> Column:
    """The time in column ``text`` in one of six layouts, chosen by the SQL expression ``variant``."""
    cases = " ".join(f"WHEN {i} THEN {layout.format(text)}" for i, layout in enumerate(LAYOUTS))
    return F.expr(f"CASE ({variant}) % 6 {cases} END")


def with_times(df: DataFrame, **times: Column) -> DataFrame:
    """Add times as text to the second."""
    return df.withColumns({name: F.left(_text(ts), F.lit(19)) for name, ts in times.items()})


class PlantFeed:
    """Raw frames over one directory of parquet tables.

    ``stored`` has raw tables that were written as text before; they are used as they are.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.stored = stored or {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _equipment_count(self) -> Column:
        return self.table("supplier").agg(F.count("*")).scalar()

    def equipment_master(self) -> DataFrame:
        """One row per supplier and version; version 1 is thirty days younger."""
        number, nation = F.col("s_suppkey"), F.col("s_nationkey")
        v = F.col("v")
        kinds = ("CNC", "Press", "Welder", "Assembly", "Packaging", "Quality Control")
        kind = F.element_at(F.array(*map(F.lit, kinds)), (number % 6 + 1).cast("int"))
        installed = _plus(
            F.lit("1994-01-01 08:00:00").cast("timestamp_ntz"), (number % 9000) * 1440
        )
        updated = _plus(
            F.lit("2001-09-01 00:00:00").cast("timestamp_ntz"), v * 43200 + (number % 240) * 60
        )
        rows = self.table("supplier").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
        return with_times(rows, installed=installed, updated=updated).select(
            _id("EQ", number).alias("equipment_id"),
            F.col("s_name").alias("equipment_name"),
            kind.alias("equipment_type"),
            F.when(number % 20 != 19, F.concat(F.lit("Line "), _text((nation + v) % 3 + 1))).alias(
                "location"
            ),
            mixed_time("installed", "s_suppkey").alias("installation_date"),
            F.concat(F.lit("M"), _text(nation)).alias("manufacturer"),
            F.concat(F.lit("MOD-"), _text(number % 9)).alias("model"),
            F.when(number % 4 == 0, "operational")
            .when((v == 1) & (number % 4 == 1), " Broken")
            .otherwise("IDLE ")
            .alias("status"),
            F.when(~((number % 25 == 7) & (v == 0)), mixed_time("updated", "s_suppkey + v")).alias(
                "last_update_date"
            ),
        )

    def iot_sensor_readings(self) -> DataFrame:
        number, kind = F.col("event_id"), F.col("event_type")
        value = _text(F.col("value").cast("decimal(18,2)"))
        return with_times(self.table("events"), read=F.col("ts")).select(
            _id("IOT", number).alias("reading_id"),
            _id("EQ", F.col("user_id") % self._equipment_count()).alias("equipment_id"),
            F.concat(F.lit("SENS-"), _text(F.col("user_id")), F.lit("-"), kind).alias("sensor_id"),
            F.when(number % 5 == 0, F.upper(kind)).otherwise(kind).alias("sensor_type"),
            F.when(number % 3 == 0, F.replace(value, F.lit("."), F.lit(",")))
            .otherwise(value)
            .alias("reading_value"),
            mixed_time("read", "event_id").alias("reading_timestamp"),
            F.when(number % 9 != 0, "u").alias("unit"),
        )

    @staticmethod
    def _line_id(prefix: str) -> Column:
        return F.concat(_id(prefix, F.col("l_orderkey")), F.lit("-"), _text(F.col("l_linenumber")))

    @staticmethod
    def _run_start() -> Column:
        return _plus(F.col("l_shipdate"), F.col("l_orderkey") % 1440)

    @staticmethod
    def _run_end() -> Column:
        minutes = F.col("l_orderkey") % 1440 + 120 + F.col("l_partkey") % 360
        return _plus(F.col("l_shipdate"), minutes)

    def production_orders(self) -> DataFrame:
        order, part = F.col("l_orderkey"), F.col("l_partkey")
        start, end = self._run_start(), self._run_end()
        planned = (F.col("l_quantity") * 10).cast("int")
        actual = F.floor(F.col("l_quantity") * 10 * (1 - F.col("l_discount"))).cast("int")
        state = F.col("l_linestatus")
        lines = with_times(
            self.table("lineitem"), run_start=start, run_end=end, due=_plus(start, F.lit(480))
        )
        return lines.select(
            self._line_id("PO").alias("production_order_id"),
            _id("EQ", F.col("l_suppkey")).alias("equipment_id"),
            F.concat(F.lit("PROD-"), _text(part)).alias("product_id"),
            mixed_time("run_start", "l_suppkey").alias("planned_start"),
            mixed_time("due", "l_suppkey + l_linenumber").alias("planned_end"),
            # A planned run has not started.
            F.when(part % 17 != 4, mixed_time("run_start", "l_orderkey")).alias("actual_start"),
            mixed_time("run_end", "l_orderkey + l_linenumber").alias("actual_end"),
            _text(planned).alias("planned_quantity"),
            F.when(part % 7 == 0, F.concat(_text(actual), F.lit(",0")))
            .otherwise(_text(actual))
            .alias("actual_quantity"),
            F.when(order % 4 == 0, F.upper(state))
            .otherwise(F.lower(F.concat(F.lit(" "), state)))
            .alias("status"),
            mixed_time("run_start", "l_partkey").alias("last_update"),
        )

    def maintenance_orders(self) -> DataFrame:
        order, customer = F.col("o_orderkey"), F.col("o_custkey")
        day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
        start = _plus(day, customer % 600)
        end = _plus(day, customer % 600 + 30 + customer % 210)
        times = {"run_start": start, "run_end": end, "due": _plus(start, F.lit(240)), "day": day}
        return with_times(self.table("orders"), **times).select(
            _id("MO", order).alias("maintenance_order_id"),
            _id("EQ", order % self._equipment_count()).alias("equipment_id"),
            F.when(order % 4 == 0, F.upper(priority))
            .otherwise(F.concat(F.lower(priority), F.lit(" ")))
            .alias("maintenance_type"),
            mixed_time("run_start", "o_orderkey").alias("scheduled_start"),
            mixed_time("due", "o_custkey").alias("scheduled_end"),
            F.when(customer % 19 != 7, F.col("run_start")).alias("actual_start"),
            F.when(order % 11 != 0, F.col("run_end")).alias("actual_end"),
            F.concat(F.lit("TECH-"), F.lpad(_text(customer % 20 + 1), 3, "0")).alias(
                "technician_id"
            ),
            F.col("o_orderstatus").alias("status"),
            F.concat(F.lit(" P"), F.substring(priority, 1, 1)).alias("priority"),
            F.when(order % 3 != 0, F.concat(F.lit("order "), _text(order))).alias("description"),
            mixed_time("day", "o_custkey").alias("last_update"),
        )

    def quality_inspections(self) -> DataFrame:
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        flag, quantity, discount = F.col("l_returnflag"), F.col("l_quantity"), F.col("l_discount")
        first, second = _text(part % 6 + 1), _text(supplier % 6 + 1)
        kinds = F.array(F.lit(" Visual"), F.lit("DIMENSIONAL"), F.lit("functional "))
        lines = with_times(self.table("lineitem"), run_start=self._run_start(), run_end=self._run_end())
        return lines.select(
            F.when(part % 101 != 7, self._line_id("INS")).alias("inspection_id"),
            self._line_id("PO").alias("production_order_id"),
            _id("EQ", supplier).alias("equipment_id"),
            F.element_at(kinds, F.col("l_linenumber") % 3 + 1).alias("inspection_type"),
            F.col("run_end").alias("inspection_date"),
            F.concat(F.lit("INSP-"), _text(supplier % 40)).alias("inspector_id"),
            F.when(flag == "A", "Yes").when(flag == "R", " f").otherwise("maybe").alias("passed"),
            _text(F.floor(quantity * discount).cast("int")).alias("failed_quantity"),
            F.when(part % 50 == 0, "0").otherwise(_text(quantity.cast("int"))).alias(
                "total_quantity"
            ),
            F.when(discount == 0, None)
            .when(part % 103 == 9, F.lit("  "))
            .when(part % 3 == 0, F.concat(F.lit("d00"), first, F.lit(", d00"), second))
            .otherwise(F.concat(F.lit("D00"), first))
            .alias("defect_codes"),
            F.when(part % 4 != 0, F.concat(F.lit("lot "), _text(part))).alias("notes"),
            mixed_time("run_start", "l_partkey").alias("last_update"),
        )

    def raw(self, table: str) -> DataFrame:
        """A raw table, all columns text."""
        return self.stored[table] if table in self.stored else getattr(self, table)()
