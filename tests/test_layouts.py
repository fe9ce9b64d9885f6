"""Sketches merged upwards, the log in buckets by unit, the weekly record read back."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from yieldspark import schemas
from yieldspark.operators import profile, sketches, tpy
from yieldspark.sources import bucketed
from yieldspark.sources import fixtures as fx
from yieldspark.sources.sinks import PeriodTable

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_day_sketches_are_stored_and_merged(spark, scratch):
    wl = fx.workstation_log(spark, SF)
    t = PeriodTable(spark, os.path.join(scratch, "days"), ("test_date",), "test_date")
    cut = dt.datetime(2024, 1, 12)
    t.upsert(sketches.unit_sketches(wl.where(F.col("history_station_end_time") < F.lit(cut))))
    t.upsert(sketches.unit_sketches(wl.where(F.col("history_station_end_time") >= F.lit(cut))))
    assert rows(sketches.unit_ranges(t.read())) == rows(sketches.unit_ranges(sketches.unit_sketches(wl)))
    days = {r.test_date: r.unique_parts for r in profile.date_profile(wl).where("test_date is not null").collect()}
    got = t.read().select("test_date", F.theta_sketch_estimate("units").cast("long").alias("n")).collect()
    assert {r.test_date: r.n for r in got} == days


def test_sketch_error_is_within_its_bound(spark):
    n, lg_k = 60_000, 11
    d = spark.range(n * 3).select(
        F.concat(F.lit("S"), (F.col("id") % n).cast("string")).alias("sn"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval((F.hash("id") % 14 + 14).cast("int") % 14)).toDF(
            "sn", "history_station_end_time").withColumns({
                "service_flow": F.lit("NORMAL"), "workstation_name": F.lit("VI2"), "model": F.lit("Tesla SXM4")})
    exact = {(r.k, r.s): r.n for k in ("week", "month") for r in d.groupBy(F.lit(k).alias("k"), F.trunc(
        "history_station_end_time", k).alias("s")).agg(F.countDistinct("sn").alias("n")).collect()}
    got = sketches.unit_ranges(sketches.unit_sketches(d, lg_k), lg_k=lg_k).collect()
    assert len(got) == len(exact) == 3
    for r in got:  # four standard errors
        assert abs(r.unique_parts / exact[r.range_kind, r.range_start] - 1) < 4 * 2 ** (-lg_k / 2)


def test_unit_figures_over_buckets_need_no_exchange(spark, scratch):
    wl, name = fx.workstation_log(spark, SF), f"log_{uuid.uuid4().hex}"
    path = os.path.join(scratch, "log")
    half = F.col("history_station_end_time") < F.lit(dt.datetime(2024, 1, 12))
    bucketed.write(wl.where(half), name, path, 4)
    bucketed.append(wl.where(~half), name, path, 4)
    log = spark.table(name)
    assert rows(log) == rows(wl)
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        first = tpy.first_activity(tpy.prod(log))
        assert exchanges(first) == 0 and rows(first) == rows(tpy.first_activity(tpy.prod(wl)))
        assert exchanges(tpy.unit_day(log)) == 0 and exchanges(tpy.unit_day(wl)) > 0
        units = wl.where("pn = 'PN1'").select("sn").distinct()
        bucketed.write(units, f"{name}_units", os.path.join(scratch, "units"), 4)
        found = profile.unit_lookup(log, spark.table(f"{name}_units"))
        assert exchanges(found) == 0 and rows(found) == rows(profile.unit_lookup(wl, units))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
    again = bucketed.attach(spark, f"{name}_again", path, log.schema, 4)
    assert exchanges(tpy.first_activity(tpy.prod(again))) == 0 and rows(again) == rows(wl)
    for t in (name, f"{name}_units", f"{name}_again"):
        spark.sql(f"DROP TABLE {t}")


def test_station_yields_come_back_from_the_record(spark):
    wl = fx.workstation_log(spark, SF)
    sd = tpy.station_day(wl)
    record = tpy.tpy_weekly(tpy.unit_day(wl), sd)
    want = tpy.weekly_station_yield(sd)
    assert rows(tpy.station_yield_from_record(record).select(*want.columns)) == rows(want)
    none = record.withColumn("weekly_throughput_yield_model_specific", F.lit("{}"))
    assert tpy.station_yield_from_record(none).count() == 0


def test_log_schema_covers_the_bucket_column():
    assert all(bucketed.UNIT in schemas.LOGS[k][0].fieldNames() for k in schemas.LOGS)
