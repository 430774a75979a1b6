"""What a curation costs: compiled code, and stored batches that are not derived again."""

import re
from itertools import product

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from plantlake.functions import parsing as p
from plantlake.operators.curate import COMPILED_BYTES, HUGE_METHOD, curate, latest, stage, survivors, windowed
from plantlake.plans.entities import PRODUCTION, QUALITY, SENSORS
from plantlake.queries import QUERIES, Frames


def orders(spark, rows=20):
    """Raw orders of a feed; every second one is a second state of the one before."""
    names = [f.name for f in PRODUCTION.fields]
    values = {
        "production_order_id": "concat('PO', id div 2)", "equipment_id": "'EQ1'", "product_id": "concat('P', id % 3)",
        "planned_quantity": "'10'", "actual_quantity": "'9'", "status": "'done'",
    }
    time = "concat(1998 + id % 4, '-01-02 03:04:05')"
    return spark.range(rows).selectExpr(*[f"{values.get(name, time)} AS {name}" for name in names])


def test_staging_limits_methods_to_what_the_jvm_compiles(spark):
    before = spark.conf.get(HUGE_METHOD)
    try:
        for limit, kept in ((65535, COMPILED_BYTES), (4000, 4000)):
            spark.conf.set(HUGE_METHOD, limit)
            stage(orders(spark), PRODUCTION)
            assert int(spark.conf.get(HUGE_METHOD)) == kept
    finally:
        spark.conf.set(HUGE_METHOD, before)


@pytest.mark.parametrize(
    "query, times", [("mrg3_stored_upsert", 2), ("snk2_bucketed_upsert", 2), ("snk4_replace_dimension", 1)]
)
def test_a_batch_used_twice_is_curated_once(spark, query, times):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    raw = orders(spark).withColumn("status", counted.asNondeterministic()("status"))
    result = QUERIES[query](Frames(spark, "/none", {PRODUCTION.raw: raw}))
    assert not result.isEmpty()
    assert seen.value == 20 * times


@pytest.mark.parametrize("query", ["mrg3_stored_upsert", "snk2_bucketed_upsert", "snk2_stored_upsert"])
def test_an_upsert_shuffles_what_it_curates_only(spark, monkeypatch, query):
    shuffles = []

    def recorded(write):
        def run(self, *args, **kwargs):
            plan = self._df._jdf.queryExecution().executedPlan().toString()
            shuffles.append(sum("Exchange " in line for line in plan.splitlines()))
            return write(self, *args, **kwargs)

        return run

    values = {"inspection_id": "concat('I', id div 2)", "passed": "'yes'"}
    time = "concat(1998 + id % 4, '-01-02 03:04:05')"
    raw = {PRODUCTION.raw: orders(spark)} | {QUALITY.raw: spark.range(20).selectExpr(*[f"{values.get(f.name, time)} AS {f.name}" for f in QUALITY.fields])}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("insertInto", "saveAsTable", "parquet"):
        monkeypatch.setattr(DataFrameWriter, name, recorded(getattr(DataFrameWriter, name)))
    try:
        result = QUERIES[query](Frames(spark, "/none", raw))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert result.count() == 10
    # That of the first load and that of the batch, to choose one row per key.
    assert sum(shuffles) == 2, shuffles


def test_a_full_curation_parses_no_time_in_a_filter(spark):
    plan = curate(orders(spark), PRODUCTION)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("RLIKE" in line for line in filters)


def test_rows_without_a_time_may_go_after_duplicates(spark):
    times = [None, "", "unreadable", "2001-01-02", "02/01/2001 03:04:05", "2001/01/03"]
    pairs = [(f"PO{i}", a, b) for i, (a, b) in enumerate(product(times, repeat=2))]
    rows = [(key, t, str(n)) for key, a, b in pairs for n, t in enumerate((a, b))] + [(None, "2001-01-02", "0")]
    names = [f.name for f in PRODUCTION.fields]
    found = spark.createDataFrame(rows, "production_order_id string, last_update string, status string")
    raw = found.select(*[F.col(n) if n in found.columns else F.lit("1").alias(n) for n in names])
    staged = stage(raw, PRODUCTION)
    expected = latest(windowed(staged, PRODUCTION, None, None), PRODUCTION)
    result = survivors(staged, PRODUCTION, None, None)
    assert sorted(result.collect()) == sorted(expected.collect())
    assert result.count() == sum(any(t in times[3:] for t in pair[1:]) for pair in pairs)
    # Where the time does not rank first, such rows go before they can win.
    assert SENSORS.order[0] != SENSORS.ts_col


@pytest.mark.parametrize("formats", [p.FORMATS_ALL, p.FORMATS_P5, p.FORMATS_P8, p.FORMATS_P9, p.FORMATS_P11_DATE])
def test_shared_date_part_fits_the_same_texts(formats):
    filled = [p._plain(f).translate(str.maketrans("yMdHms", "201345")) for f in p.FORMATS_ALL]
    texts = {""} | {t[:i] + c + t[j:] for t in filled for i in range(len(t) + 1) for j in (i, i + 1) for c in "-/ TZ:x7\n"}
    whole = re.compile(p._patterns(formats))
    single = [re.compile(p._pattern(f)) for f in formats]
    assert any(map(whole.fullmatch, filled))
    for text in texts | set(filled):
        assert bool(whole.fullmatch(text)) == any(one.fullmatch(text) for one in single), text
    assert len(p._patterns(formats)) < len("|".join(map(p._pattern, formats)))
