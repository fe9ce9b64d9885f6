"""Job chains K1-K3 end to end on the smallest fixture."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests import helpers
from yieldspark import schemas, session
from yieldspark.operators import packing, tpy
from yieldspark.plans import catalog, jobs
from yieldspark.sources import fixtures as fx
from yieldspark.sources.logstore import LogStore
from yieldspark.streaming import stream

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2024, 1, 20, 6)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_daily_and_weekly_chain(spark, scratch):
    wl, tb = fx.workstation_log(spark, SF), fx.testboard_log(spark, SF)
    v = jobs.daily(spark, wl, scratch, NOW, tb=tb)
    assert set(v) >= {"daily_tpy_metrics", "packing_daily_summary", "station_hourly_summary",
                      "testboard_station_performance_daily", "fixture_performance_daily"}
    daily = stream.kpi_table(spark, scratch, "daily_tpy_metrics").read().drop("created_at")
    ud = tpy.unit_day(wl)
    ref = tpy.tpy_daily(tpy.station_day(wl), tpy.starters_by_week(tpy.first_activity(ud)))
    written = rows(daily)
    assert written == rows(ref.select(*daily.columns))
    # recent mode re-runs only as_of and the two days before, others stay
    jobs.daily(spark, wl, scratch, NOW, tb=tb, as_of=dt.date(2024, 1, 19))
    assert rows(stream.kpi_table(spark, scratch, "daily_tpy_metrics").read().drop("created_at")) \
        == written
    pk = stream.kpi_table(spark, scratch, "packing_daily_summary").read()
    assert rows(pk) == rows(packing.packing_daily(wl).select(*pk.columns))
    jobs.weekly(spark, wl, scratch, NOW, tb=tb)
    wk = stream.kpi_table(spark, scratch, "weekly_tpy_metrics").read()
    assert wk.count() == 5 and wk.select("week_id").distinct().count() == 5
    assert len(wk.columns) == 36 and {r.created_at for r in wk.collect()} == {NOW}  # 35 columns and the run time
    rep = jobs.report(spark, wl, tb, scratch, dt.date(2024, 1, 19))
    assert {r.table_name for r in rep.collect()} >= {"daily_tpy_metrics", "workstation_master_log"}


def test_health_gate_rejects_empty(spark):
    empty = fx.workstation_log(spark, SF).limit(0)
    with pytest.raises(jobs.HealthCheckError):
        jobs.health_gate({"workstation_master_log": empty}, ("workstation_master_log",))
    with pytest.raises(jobs.HealthCheckError):
        jobs.health_gate({"workstation_master_log": None}, ("workstation_master_log",))


def test_weekly_current_week_reads_one_week_and_matches_full(spark, scratch):
    wl = fx.workstation_log(spark, SF)
    full_root, week_root = os.path.join(scratch, "full"), os.path.join(scratch, "week")
    jobs.weekly(spark, wl, full_root, NOW)
    jobs.weekly(spark, wl, week_root, NOW, as_of=dt.date(2024, 1, 19))
    cols = lambda df: [c for c in df.columns if c != "created_at"]
    full = stream.kpi_table(spark, full_root, "weekly_tpy_metrics").read()
    one = stream.kpi_table(spark, week_root, "weekly_tpy_metrics").read()
    assert one.count() == 1
    assert rows(one.select(*cols(one))) == rows(full.filter("week_id = '2024-W03'").select(*cols(one)))


KPIS = ("daily_tpy_metrics", "daily_completions", "station_hourly_summary", "packing_daily_summary", "weekly_tpy_metrics")


def kpi(spark, root, name):
    df = stream.kpi_table(spark, root, name).read()
    return rows(df.select(*sorted(c for c in df.columns if c != "created_at")))


def full(spark, wl, root):
    jobs.daily(spark, wl, root, NOW)
    jobs.weekly(spark, wl, root, NOW)
    return root


@pytest.mark.parametrize("days", [(10, 19), (16, 17, 19)])
def test_incremental_daily_equals_full_rebuild_after_any_gap(spark, scratch, days):
    wl = fx.workstation_log(spark, SF).withColumn("created_at", F.col("history_station_end_time"))
    inc = os.path.join(scratch, "inc")
    for d in days:
        known = wl.filter(F.col("history_station_end_time") < F.lit(dt.datetime(2024, 1, d + 1)))
        jobs.daily(spark, known, inc, NOW, as_of=dt.date(2024, 1, d), incremental=True)
    ref = full(spark, known, os.path.join(scratch, "full"))
    fa = stream.first_activity_table(spark, inc)
    assert rows(fa.read()) == rows(tpy.first_activity(tpy.unit_day(known)))
    for name in KPIS:
        assert kpi(spark, inc, name) == kpi(spark, ref, name), name


def test_an_upsert_of_recent_days_leaves_other_files_alone(spark, scratch):
    wl = fx.workstation_log(spark, SF)
    jobs.daily(spark, wl, scratch, NOW)

    def files(name):
        top = os.path.join(scratch, name)
        return {os.path.relpath(os.path.join(d, f), top): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet")}

    before = {n: files(n) for n in ("daily_tpy_metrics", "daily_completions", "station_hourly_summary")}
    jobs.daily(spark, wl, scratch, NOW, as_of=dt.date(2024, 1, 19))
    for name, was in before.items():
        now = files(name)
        changed = {f.split("=")[1][:10] for f, t in set(was.items()) ^ set(now.items())}
        assert changed and changed <= {"2024-01-17", "2024-01-18", "2024-01-19"}, name
        assert len(was) > 20  # one file per day


def test_cuts_belong_to_their_run(spark, scratch):
    wl = fx.workstation_log(spark, SF)
    with session.Cuts(spark) as mine:
        kept = mine.cut(tpy.station_day(wl), "mine")
        jobs.weekly(spark, wl, scratch, NOW)
        assert kept.count() == tpy.station_day(wl).count()
    assert catalog.queries()["tpy_weekly"](spark, SF).count() == 5


def test_checkpoint_dir_must_be_set_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda k, d=None: None)

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_chains_load_aggregate_clean_and_count(spark, scratch):
    drops = {k: os.path.join(scratch, "drop", k) for k in ("workstation", "testboard")}
    fx.workstation_report(spark, SF).drop("source_file", "row_ordinal").coalesce(2).write.option("header", True).csv(
        drops["workstation"])
    helpers.testboard_report(spark, SF).coalesce(1).write.option("header", True).csv(drops["testboard"])
    logs, out = os.path.join(scratch, "logs"), os.path.join(scratch, "out")
    day = dt.date(2024, 1, 19)
    r = jobs.daily_chain(spark, drops, logs, out, day, NOW)
    n_wl, n_tb = fx.workstation_log(spark, SF).count(), fx.testboard_log(spark, SF).count()
    assert r["load"]["workstation"]["added"] == n_wl and r["load"]["testboard"]["added"] == n_tb
    assert r["counts"]["workstation_master_log"] == n_wl and r["counts"]["total"] == n_wl + n_tb
    assert r["counts"]["daily_tpy_metrics"] > 0 and r["dedup"]["workstation"]["removed"] == 0
    again = jobs.daily_chain(spark, drops, logs, out, day, NOW)
    assert again["load"]["workstation"]["added"] == 0 and again["counts"]["total"] == n_wl + n_tb
    w = jobs.weekly_chain(spark, logs, out, day, NOW)["tables"]
    assert {"weekly_tpy_metrics", "packing_daily_summary", "testboard_station_performance_daily"} <= set(w)
    rep = {x.table_name: x for x in jobs.report(spark, fx.workstation_log(spark, SF), None, out, day).collect()}
    assert rep["weekly_tpy_metrics"].rows_on_as_of == 1


def test_log_dedup_rewrites_only_days_with_copies(spark, scratch):
    log = LogStore(spark, os.path.join(scratch, "log"), schemas.WORKSTATION_KEY)
    wl = fx.workstation_log(spark, SF)
    log.append(wl)
    copies = wl.filter("history_station_end_time < '2024-01-04'").withColumn("id", F.col("id") + 10_000_000)
    copies.withColumn("end_date", F.to_date("history_station_end_time")).write.mode("append").partitionBy(
        "end_date").parquet(log.path)
    assert log.dedup() == {"removed": copies.count(), "days": copies.select(F.to_date("history_station_end_time")).distinct().count()}
    assert rows(log.read().select("id")) == rows(wl.select("id"))
    assert log.dedup() == {"removed": 0, "days": 0}
