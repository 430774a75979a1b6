"""Parsers, filters, de-duplication and hashes on hand-made rows."""

from contextlib import redirect_stdout
from datetime import date, datetime
from hashlib import sha256
from io import StringIO

from pyspark.sql import functions as F

from plantlake.functions import parsing as p
from plantlake.functions.hashing import backfill_hash, row_hash
from plantlake.functions.times import date_key, start_of_hour
from plantlake.operators.dedupe import dedupe
from plantlake.operators.filters import recent, require

TEXTS = [
    "2024-02-29 13:14:15", "2024-02-29T13:14:15", "2024-02-29T13:14:15Z", "2024-02-29",
    "2024/02/29 13:14:15", "2024/02/29", "29/02/2024 13:14:15", "29/02/2024",
    "29-02-2024 13:14:15", "29-02-2024", "", " ", None, "31/02/2024", "2023-02-29", "2024-2-9",
    "2024-02-29 13:14:15 x", "2024-02-29 24:00:00", "2024-02-29 13:60:00", " 2024-02-29",
    "2024-02-29 1:14:15", "2024-13-01", "99/99/2024", "2024-02-29 13:14:5Z", "2024-02-29\n",
    "29/02-2024", "2024-02/29", "20240229", "now", "2024-02-29 13:14",
]
PROFILES = {
    "all": p.FORMATS_ALL, "p5": p.FORMATS_P5, "p8": p.FORMATS_P8, "p9": p.FORMATS_P9,
    "p10": p.FORMATS_P10, "p11": p.FORMATS_P11_DATE,
}


def test_parse_timestamp_equals_trying_each_layout(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for profile, formats in PROFILES.items():
        tried = F.coalesce(*[F.try_to_timestamp("text", F.lit(f)) for f in formats])
        rows = df.select(
            "text", p.parse_timestamp("text", formats).alias("got"),
            tried.cast("timestamp_ntz").alias("wanted"),
        ).collect()
        assert all(r["got"] == r["wanted"] for r in rows), (profile, rows)
        assert any(r["got"] is not None for r in rows)
    parsed = df.select(p.parse_timestamp("text").alias("t")).where("t is not null").count()
    assert parsed == 10


def test_narrow_profile_misses_layouts(spark):
    df = spark.createDataFrame([("2024-02-29T01:02:03",), ("29/02/2024",)], "text string")
    assert df.where(p.parse_timestamp("text", p.FORMATS_P5).isNotNull()).isEmpty()


def test_numbers_booleans_and_dates(spark):
    rows = [("12,7", " YES"), ("-3.99", "f"), ("12.99999", "0"), ("x", "maybe"), (None, None),
            ("99999999999", "T")]
    df = spark.createDataFrame(rows, "n string, b string")
    got = df.select(p.parse_int("n"), p.parse_bool("b"), p.parse_decimal("n").cast("string"))
    assert [tuple(r) for r in got.collect()] == [
        (12, True, "12.7000"), (-3, False, "-3.9900"), (12, False, "13.0000"),
        (None, None, None), (None, None, None), (None, True, "99999999999.0000"),
    ]


def test_window_policies(spark):
    times = [None, datetime(2024, 3, 1), datetime(2024, 2, 29, 23, 59, 59)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    as_of = datetime(2024, 3, 31, 17)
    sizes = {n: recent(df, "ts", 30, as_of, n).count() for n in ("keep", "now", "drop")}
    assert sizes == {"keep": 2, "now": 2, "drop": 1}


def test_require_blank(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "c string")
    assert require(df, ["c"]).count() == 2
    assert require(df, ["c"], blank_is_null=True).count() == 1


def test_dedupe_hot_key_and_ties(spark):
    """A third of the rows share a key; ties go by the remaining columns, whatever the layout."""
    hot = [("hot", datetime(2024, 1, 1), i % 7) for i in range(3000)]
    cold = [(f"k{i}", None if i % 2 else datetime(2024, 1, 1), i) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "k string, ts timestamp_ntz, v int")
    expected = {("hot", 6)} | {(f"k{i}", i) for i in range(6000)}
    for parts in (1, 5):
        rows = dedupe(df.repartition(parts), ["k"], ["ts"]).collect()
        assert {(r["k"], r["v"]) for r in rows} == expected
        assert len(rows) == 6001
    with redirect_stdout(StringIO()) as plan:
        dedupe(df, ["k"], ["ts"]).explain()
    assert plan.getvalue().count("WindowGroupLimit") == 2


def test_hash_rules(spark):
    df = spark.createDataFrame(
        [("a", None, None, datetime(2024, 1, 2, 3, 4, 5), None, "old"),
         ("a", 0, False, datetime(2024, 1, 2, 3, 4, 5), "", None)],
        "t string, n int, b boolean, ts timestamp_ntz, bare string, row_hash string",
    )
    kinds = [("t", "text"), ("n", "int"), ("b", "bool"), ("ts", "time")]
    first, second = [r[0] for r in df.select(row_hash(kinds)).collect()]
    assert first == second == sha256(b"a||0||false||2024-01-02 03:04:05").hexdigest()
    skipped = [r[0] for r in df.select(row_hash([("t", "text"), ("bare", "bare")])).collect()]
    assert skipped == [sha256(b"a").hexdigest(), sha256(b"a||").hexdigest()]
    assert [r["row_hash"] for r in backfill_hash(df, kinds).collect()] == ["old", first]


def test_times(spark):
    df = spark.createDataFrame([(datetime(2021, 3, 28, 2, 30, 1),)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        row = df.select(start_of_hour(F.col("ts")), date_key(F.col("ts"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (datetime(2021, 3, 28, 2), 20210328)


def test_calendars(spark):
    from plantlake.plans.calendar import (
        calendar_range, day_range, days, localized_calendar, static_calendar,
    )

    fixed = static_calendar(spark)
    span = fixed.agg(F.count("*"), F.min("full_date"), F.max("full_date")).first()
    assert tuple(span) == (1096, date(2023, 1, 1), date(2025, 12, 31))
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert days(calendar_range(empty, "ts")).count() == 4383
    row = localized_calendar(day_range(spark, date(2024, 3, 3), date(2024, 3, 3))).first()
    assert (row["iso_weekday"], row["day_name"], row["month_name"]) == (7, "domingo", "março")
