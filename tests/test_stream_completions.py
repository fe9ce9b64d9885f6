"""Completions against starters as a join of two streams: equal to the batch result in any order of rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.helpers import wl_rows
from yieldspark.operators import tpy
from yieldspark.sources import fixtures as fx
from yieldspark.sources.sinks import PeriodTable
from yieldspark.streaming import completions

SF = "/root/testdata/sf0.001"
END = "history_station_end_time"


def _far(log):
    """One row long after all others, so that every day before it is closed."""
    late = F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz")
    return log.limit(1).withColumn(END, late).withColumn("service_flow", F.lit("NORMAL"))


def _run(spark, scratch, parts, firsts, name, **how):
    """Stream the parts of the log, one file after the other, and the first activities; the table's rows."""
    log, starters, out = (os.path.join(scratch, f"{name}-{x}") for x in ("log", "first", "kpi"))
    for i, p in enumerate([*parts, _far(parts[0])]):
        p.coalesce(1).write.mode("append").parquet(log)
    for p in firsts:
        p.coalesce(1).write.mode("append").parquet(starters)
    for _ in range(2):  # the second run starts from the checkpoint and finds nothing new
        q = completions.start_daily_completions(spark, log, starters, out, os.path.join(scratch, f"{name}-ck"), **how)
        q.awaitTermination(300)
    table = PeriodTable(spark, f"{out}/daily_completions", ["date_id", "model"], "date_id").read_or_none()
    cols = ["date_id", "model", "completed_today", "first_pass_today", "model_fpy"]
    return [] if table is None else sorted((tuple(r) for r in table.select(*cols).collect()), key=str)


def _batch(log):
    return sorted((tuple(r) for r in tpy.daily_completions(tpy.unit_day(log), tpy.first_activity(tpy.prod(log))).collect()), key=str)


@pytest.mark.parametrize("order", ["forward", "backward"])
def test_equal_to_batch_in_any_order(spark, scratch, order):
    log = fx.workstation_log(spark, SF)
    cut = F.lit(dt.datetime(2024, 1, 17)).cast("timestamp_ntz")
    parts = [log.where(F.col(END) < cut), log.where(F.col(END) >= cut)]
    firsts = tpy.first_activity(tpy.prod(log))
    halves = [firsts.where(F.crc32("sn") % 2 == i) for i in (0, 1)]
    far = firsts.limit(1).withColumn("first_activity_time", F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz"))
    if order == "backward":
        parts, halves = parts[::-1], halves[::-1]
    got = _run(spark, scratch, parts, [*halves, far], order, delay="400 days", max_files_per_trigger=1)
    want = _batch(log)
    assert want and got == want


def test_rules_of_the_match(spark, scratch):
    log = wl_rows(spark, [
        # started on Wednesday, packed on Monday of that week as another model: the serial number alone is matched
        {"sn": "A", "model": "M1", END: "2024-01-03 10:00:00"},
        {"sn": "A", "model": "M2", "workstation_name": "PACKING", END: "2024-01-01 09:00:00"},
        # packed a week after its start, on the same weekday
        {"sn": "B", END: "2024-01-03 10:00:00"}, {"sn": "B", "workstation_name": "PACKING", END: "2024-01-10 10:00:00"},
        # a failure on the day of packing, and one on another day
        {"sn": "C", END: "2024-01-04 08:00:00", "history_station_passing_status": "Fail"},
        {"sn": "C", "workstation_name": "PACKING", END: "2024-01-04 09:00:00"},
        {"sn": "D", END: "2024-01-04 08:00:00", "history_station_passing_status": "Fail"},
        {"sn": "D", "workstation_name": "PACKING", END: "2024-01-05 23:59:59"},
        # Sunday's last second and Monday's first; no end; no production
        {"sn": "E", END: "2024-01-07 23:59:59"}, {"sn": "E", "workstation_name": "PACKING", END: "2024-01-08 00:00:00"},
        {"sn": "F", "workstation_name": "PACKING"},
        {"sn": "G", "workstation_name": "PACKING", END: "2024-01-04 09:00:00", "service_flow": "RO"},
        {"sn": None, "model": "M3", "workstation_name": "PACKING", END: "2024-01-04 09:00:00"}])
    firsts = tpy.first_activity(tpy.prod(log))
    far = firsts.limit(1).withColumn("first_activity_time", F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz"))
    got = _run(spark, scratch, [log], [firsts.unionByName(far)], "rules")
    assert got == _batch(log)
    assert [(str(r[0]), r[1], r[2], r[3]) for r in got] == [
        ("2024-01-01", "M2", 1, 1), ("2024-01-04", "M3", 1, 1), ("2024-01-04", "Tesla SXM4", 1, 0), ("2024-01-05", "Tesla SXM4", 1, 1)]


def test_rows_behind_the_watermark_are_left_out(spark, scratch):
    early = wl_rows(spark, [{"sn": "A", "workstation_name": "PACKING", END: "2024-01-03 10:00:00"}])
    mid = wl_rows(spark, [{"sn": "B", "workstation_name": "PACKING", END: "2024-03-06 10:00:00"}])
    next_ = wl_rows(spark, [{"sn": "B", END: "2024-03-07 10:00:00"}])  # a batch later the watermark holds
    late = wl_rows(spark, [{"sn": "C", "workstation_name": "PACKING", END: "2024-01-03 11:00:00"}])
    log = early.unionByName(mid).unionByName(late)
    firsts = tpy.first_activity(tpy.prod(log))
    far = firsts.limit(1).withColumn("first_activity_time", F.lit(dt.datetime(2031, 1, 1)).cast("timestamp_ntz"))
    got = _run(spark, scratch, [early, mid, next_, late], [firsts.unionByName(far)], "late", max_files_per_trigger=1)
    assert [(str(r[0]), r[2]) for r in got] == [("2024-01-03", 1), ("2024-03-06", 1)]
