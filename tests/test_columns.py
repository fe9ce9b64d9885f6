"""Golden rows for the date, rounding and string helpers (traps of FIXTURES.md section 2)."""

import datetime as dt
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yieldspark.functions import columns as C
from yieldspark.operators.tpy import half_even_div


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys())) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_weekend_fold_goldens(spark):
    days = ["2025-06-20", "2025-06-21", "2025-06-22", "2025-06-23"]
    df = spark.createDataFrame([(dt.datetime.fromisoformat(d + " 10:00:00"),) for d in days], ["t"])
    got = sorted((r.f, r.n) for r in df.groupBy(C.weekend_fold("t").alias("f")).agg(F.count("*").alias("n")).collect())
    assert got == [(dt.date(2025, 6, 20), 3), (dt.date(2025, 6, 23), 1)]


def test_iso_week_labels_at_year_end(spark):
    cases = {dt.date(2024, 12, 30): "2025-W01", dt.date(2021, 1, 3): "2020-W53", dt.date(2020, 12, 31): "2020-W53",
             dt.date(2025, 5, 14): "2025-W20", dt.date(2025, 6, 15): "2025-W24"}
    df = spark.createDataFrame([(d,) for d in cases], ["d"])
    got = {r.d: r.w for r in df.select("d", C.iso_week_label("d").alias("w")).collect()}
    assert got == cases


def test_week_from_label_and_bounds(spark):
    df = spark.createDataFrame([("2025-W27",), ("2020-W53",), ("2025-W01",)], ["w"])
    s, e = C.week_from_label("w")
    got = {r.w: (r.s, r.e) for r in df.select("w", s.alias("s"), e.alias("e")).collect()}
    assert got["2025-W27"] == (dt.date(2025, 6, 30), dt.date(2025, 7, 6))
    assert got["2020-W53"] == (dt.date(2020, 12, 28), dt.date(2021, 1, 3))
    assert got["2025-W01"] == (dt.date(2024, 12, 30), dt.date(2025, 1, 5))
    d = spark.createDataFrame([(dt.date(2025, 5, 14),)], ["d"])
    r = d.select(C.week_start("d").alias("s"), C.week_end("d").alias("e")).first()
    assert (r.s, r.e) == (dt.date(2025, 5, 12), dt.date(2025, 5, 18))


def test_label_roundtrip_over_ship_dates(spark):
    from yieldspark.sources import fixtures as fx
    d = fx.ship_dates(spark, "/root/testdata/sf0.001").select("d", C.iso_week_label("d").alias("w"))
    s, e = C.week_from_label("w")
    bad = d.filter(~F.col("d").between(s, e)).count()
    assert bad == 0


def test_pct2_half_even_and_zero(spark):
    df = spark.createDataFrame([(1, 32), (0, 0), (547, 567), (1, 8), (2, 3), (3, 3)], ["p", "t"])
    got = [r.x for r in df.select(C.pct2("p", "t").alias("x")).collect()]
    assert got == [3.12, 0.0, 96.47, 12.5, 66.67, 100.0]


def test_frac3_half_up(spark):
    df = spark.createDataFrame([(1, 32), (1, 16), (0, 5), (1, 0)], ["f", "t"])
    got = [r.x for r in df.select(C.frac3("f", "t").alias("x")).collect()]
    assert [None if x is None else float(x) for x in got] == [0.031, 0.063, 0.0, None]


def test_mdy_unpadded(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 12, 25),)], ["d"])
    assert [r.x for r in df.select(C.mdy("d").alias("x")).collect()] == ["1/5/2024", "12/25/2024"]


def test_production_filter_null_and_excluded(spark):
    df = spark.createDataFrame([(None,), ("NC Sort",), ("RO",), ("NORMAL",)], "f string")
    assert df.filter(C.is_production("f")).count() == 1


def test_null_status_counting(spark):
    df = spark.createDataFrame([("Pass",), ("Fail",), (None,)], "s string")
    r = df.agg(F.count("*").alias("t"), C.count_if(C.passed("s")).alias("p"),
               C.count_if(C.not_pass("s")).alias("f")).first()
    assert (r.t, r.p, r.f) == (3, 1, 1)


def test_string_cleaners(spark):
    df = spark.createDataFrame([(" a ",), ("   ",), ("nan",), (None,)], "s string")
    kept = [r.x for r in df.select(C.blank_to_null("s").alias("x")).collect()]
    stripped = [r.x for r in df.select(C.strip_to_null("s", ("nan",)).alias("x")).collect()]
    assert kept == [" a ", None, "nan", None]
    assert stripped == ["a", None, None, None]


def test_ordered_product(spark):
    df = spark.createDataFrame([([96.47, 100.0, 100.0, 84.91],), ([100.0, 100.0, 100.0, 98.28],), ([],)],
                               "y array<double>")
    got = [r.x for r in df.select(C.ordered_product_pct(F.col("y")).alias("x")).collect()]
    assert got == [81.91, 98.28, 100.0]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=20))
def test_half_even_div_matches_exact_fraction(pairs):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.x for r in df.select(half_even_div(F.col("n"), F.col("d")).alias("x")).collect()]
    assert got == [round(Fraction(n, d)) for n, d in pairs]  # Python rounds Fractions half to even


@settings(max_examples=15, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31)), min_size=1, max_size=30))
def test_fold_never_lands_on_weekend_and_keeps_totals(days):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(d,) for d in days], "d date").select(C.weekend_fold("d").alias("f"), "d")
    rows = df.collect()
    assert all(r.f.weekday() < 5 for r in rows)
    assert all(0 <= (r.d - r.f).days <= 2 for r in rows)
    assert len(rows) == len(days)
