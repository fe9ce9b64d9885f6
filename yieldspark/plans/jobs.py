"""Daily and weekly job chains with a health gate (K1-K3).

One Spark session runs the whole chain. The two base aggregates of the log
(unit-day and station-day) are computed once per run and written to the
shared ``spark.checkpoint.dir``, so every KPI table derives from them without
rescanning the log, and a lost executor never forces a recomputation from the
raw log. Jobs never read a clock: the run time is an argument (A10).
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas, session
from ..config import DEFAULT, YieldConfig
from ..functions import columns as C
from ..operators import dedup, packing, profile, station, tpy
from ..sources import reports
from ..sources.logstore import LogStore
from ..sources.sinks import PeriodTable
from ..streaming import stream

LOG_NAMES = {"workstation": "workstation_master_log", "testboard": "testboard_master_log", "snfn": "snfn_master_log"}


class HealthCheckError(RuntimeError):
    pass


def health_gate(tables: dict[str, DataFrame | None], required: tuple[str, ...] = (),
                kpis: dict[str, DataFrame] | None = None) -> DataFrame:
    """Raise when a required table is missing or empty; otherwise return the record counts (K3).

    Emptiness is tested with ``limit(1)`` per table, not a full count.
    """
    for name in required:
        df = tables.get(name)
        if df is None:
            raise HealthCheckError(f"required table {name} is missing")
        if not df.limit(1).take(1):
            raise HealthCheckError(f"required table {name} is empty")
    present = {k: v for k, v in tables.items() if v is not None and "sn" in v.columns}
    return profile.record_counts(present, kpis=kpis)


def _kpi(spark: SparkSession, root: str, name: str) -> PeriodTable:
    return stream.kpi_table(spark, root, name)


def kpis(spark: SparkSession, root: str, names=("daily_tpy_metrics", "weekly_tpy_metrics")) -> dict[str, DataFrame]:
    """The KPI tables that exist."""
    return {n: t.read() for n in names if (t := _kpi(spark, root, n)).exists()}


def daily(spark: SparkSession, wl: DataFrame, out_root: str, now: _dt.datetime, tb: DataFrame | None = None,
          as_of: _dt.date | None = None, cfg: YieldConfig = DEFAULT, incremental: bool = False) -> dict[str, int]:
    """K1: daily TPY (all dates, or as_of and the two days before), packing, hourly counts,
    daily completions / FPY and the test-board tables. Returns table -> rows written.

    ``incremental`` recomputes what changed since the last run instead: rows
    that came into the log since then (by ``created_at``) are merged into the
    kept first activities, and every week that they touch is recomputed. A
    missed run or rows older than the window lose nothing.
    """
    health_gate({"workstation_master_log": wl, "testboard_master_log": tb}, ("workstation_master_log",))
    if incremental:
        out = _incremental(spark, wl, out_root, now, as_of, cfg)
    else:
        with session.Cuts(spark) as cuts:
            out = _daily(spark, wl, out_root, now, as_of, cfg, cuts)
    out |= testboard(spark, tb, out_root, cfg, as_of) if tb is not None else {}
    return out


def recent_rows(wl: DataFrame, as_of: _dt.date, days: int = 3) -> DataFrame:
    """Log rows of ``as_of`` and the ``days-1`` days before it; the bounds reach the scan."""
    lo = _dt.datetime.combine(as_of - _dt.timedelta(days=days - 1), _dt.time())
    hi = _dt.datetime.combine(as_of + _dt.timedelta(days=1), _dt.time())
    return wl.filter(C.in_range(C.END, C.ts_lit(lo), C.ts_lit(hi)))


def _mark(spark: SparkSession, out_root: str) -> PeriodTable:
    """The newest ``created_at`` of the last run; while there is none, all rows count as new."""
    return PeriodTable(spark, os.path.join(out_root, "ingest_mark"))


def _incremental(spark, wl, out_root, now, as_of, cfg) -> dict[str, int]:
    """Refresh from the rows that came in since the stored mark; rows without an ingest time count as new."""
    mark, new = _mark(spark, out_root), wl
    if mark.exists():
        last = mark.read().first()["created_at"]
        if last is not None:
            new = wl.filter((F.col("created_at") > C.ts_lit(last)) | F.col("created_at").isNull())
    latest = wl.agg(F.max("created_at").alias("created_at"))
    weeks = [as_of - _dt.timedelta(days=as_of.weekday())] if as_of else []
    with session.Cuts(spark) as cuts:
        upto = cuts.cut(latest, "mark")  # taken before the refresh: rows that come in meanwhile are new to the next run
        last = upto.first()["created_at"]
        known = wl if last is None else wl.filter((F.col("created_at") <= C.ts_lit(last)) | F.col("created_at").isNull())
        if last is not None:
            new = new.filter((F.col("created_at") <= C.ts_lit(last)) | F.col("created_at").isNull())
        out = stream.refresh_kpis(new, known, out_root, cfg, now, weeks)
        mark.replace(upto)
    return out


def _daily(spark, wl, out_root, now, as_of, cfg, cuts) -> dict[str, int]:
    if as_of is None:
        part, week = wl, None
    else:  # only the days and the week that the recent mode writes; starters need the week's first activities
        week = {d - _dt.timedelta(days=d.weekday()) for d in (as_of - _dt.timedelta(days=i) for i in range(3))}
        part = recent_rows(wl, as_of)
    ud, sd = cuts.cut(tpy.unit_day(part, cfg), "unit_day"), cuts.cut(tpy.station_day(part, cfg), "station_day")
    # First activities are over all history: one minimum by unit.
    fa = tpy.first_activity(ud) if as_of is None else cuts.cut(tpy.first_activity(tpy.prod(wl, cfg)), "first_activity")
    starters = tpy.starters_by_week(fa)
    if week:
        starters = starters.filter(F.col("week_start").isin(sorted(week)))
    daily_kpi = tpy.tpy_daily(sd, starters)
    dc = tpy.daily_completions(ud, None if as_of is None else fa)
    # created_at is touched on every upsert, like the source's ON CONFLICT ... created_at = NOW() (A10)
    out = {
        "daily_tpy_metrics": _kpi(spark, out_root, "daily_tpy_metrics").upsert(daily_kpi.withColumn("created_at", C.ts_lit(now))),
        "daily_completions": _kpi(spark, out_root, "daily_completions").upsert(dc),
        "station_hourly_summary": _kpi(spark, out_root, "station_hourly_summary").upsert(station.station_hourly(part)),
    }
    pk = _kpi(spark, out_root, "packing_daily_summary")
    out["packing_daily_summary"] = (pk.replace(packing.packing_daily(wl, cfg)) if as_of is None
                                    else pk.upsert(packing.packing_recent(wl, as_of, 7, cfg)))
    return out


def testboard(spark: SparkSession, tb: DataFrame, out_root: str, cfg: YieldConfig = DEFAULT,
              as_of: _dt.date | None = None) -> dict[str, int]:
    """The test-board tables, all time or the recent days."""
    src = tb if as_of is None else recent_rows(tb, as_of)
    return {
        "testboard_station_performance_daily": _kpi(spark, out_root, "testboard_station_performance_daily").upsert(
            station.testboard_station_daily(src, cfg)),
        "fixture_performance_daily": _kpi(spark, out_root, "fixture_performance_daily").upsert(station.fixture_daily(src, cfg)),
    }


def weekly(spark: SparkSession, wl: DataFrame, out_root: str, now: _dt.datetime, as_of: _dt.date | None = None,
           cfg: YieldConfig = DEFAULT, tb: DataFrame | None = None) -> dict[str, int]:
    """K2: the weekly KPI record (all weeks, or the week of ``as_of``), packing of the last 7 days, the sort-test
    counts and the test-board tables over all time."""
    health_gate({"workstation_master_log": wl}, ("workstation_master_log",))
    with session.Cuts(spark) as cuts:
        out = _weekly(spark, wl, out_root, now, as_of, cfg, cuts)
    if tb is not None:
        out |= testboard(spark, tb, out_root, cfg)
    return out


def _weekly(spark, wl, out_root, now, as_of, cfg, cuts) -> dict[str, int]:
    src = wl if as_of is None else tpy.week_rows(wl, as_of)  # current week: read one week of the log
    ud, sd = cuts.cut(tpy.unit_day(src, cfg), "unit_day"), cuts.cut(tpy.station_day(src, cfg), "station_day")
    rec = tpy.tpy_weekly(ud, sd, cfg)
    st = packing.sort_test_daily(wl, cfg) if as_of is None else packing.sort_test_recent(wl, as_of, 7, cfg)
    pk = _kpi(spark, out_root, "packing_daily_summary")
    return {
        "weekly_tpy_metrics": _kpi(spark, out_root, "weekly_tpy_metrics").upsert(rec.withColumn("created_at", C.ts_lit(now))),
        "sort_test_daily": _kpi(spark, out_root, "sort_test_daily").upsert(st),
        "packing_daily_summary": pk.upsert(packing.packing_daily(wl, cfg) if as_of is None
                                           else packing.packing_recent(wl, as_of, 7, cfg)),
    }


def report(spark: SparkSession, wl: DataFrame, tb: DataFrame | None, out_root: str,
           as_of: _dt.date) -> DataFrame:
    """K3 report after a run: data range per log, the KPI rows of ``as_of`` and the weekly rows created since."""
    logs = {"workstation_master_log": wl}
    if tb is not None:
        logs["testboard_master_log"] = tb
    have = kpis(spark, out_root)
    return profile.freshness_report(logs, have["daily_tpy_metrics"], as_of, have.get("weekly_tpy_metrics"))


# ------------------------------------------------------------------ chains
def load(spark: SparkSession, drops: dict[str, str], logs_root: str, now: _dt.datetime,
         cfg: YieldConfig = DEFAULT) -> dict[str, dict[str, int]]:
    """Every report in the drop directories into its log; counts per kind."""
    out = {}
    for kind, drop in drops.items():
        log = LogStore(spark, os.path.join(logs_root, LOG_NAMES[kind]), schemas.LOGS[kind][1])
        out[kind] = stream.ingest_files(spark, reports.list_files(spark, drop), log, f"{log.path}_quarantine", cfg, kind, now)
    return out


def _logs(spark: SparkSession, logs_root: str) -> dict[str, DataFrame]:
    found = {n: LogStore(spark, os.path.join(logs_root, n), schemas.LOGS[k][1]).read() for k, n in LOG_NAMES.items()}
    return {n: df for n, df in found.items() if df is not None}


def daily_chain(spark: SparkSession, drops: dict[str, str], logs_root: str, out_root: str, as_of: _dt.date,
                now: _dt.datetime, cfg: YieldConfig = DEFAULT) -> dict:
    """K1 as one run: load the reports, daily TPY and packing of the recent days, clean duplicates, count records."""
    out: dict = {"load": load(spark, drops, logs_root, now, cfg)}
    logs = _logs(spark, logs_root)
    out["tables"] = daily(spark, logs.get("workstation_master_log"), out_root, now, logs.get("testboard_master_log"), as_of, cfg)
    out["dedup"] = {k: LogStore(spark, os.path.join(logs_root, n), schemas.LOGS[k][1]).dedup()
                    for k, n in LOG_NAMES.items() if n in logs}
    counts = health_gate(_logs(spark, logs_root), ("workstation_master_log",), kpis(spark, out_root))
    out["counts"] = {r["table_name"]: r["total_records"] for r in counts.collect()}  # one row per table
    return out


def weekly_chain(spark: SparkSession, logs_root: str, out_root: str, as_of: _dt.date, now: _dt.datetime,
                 cfg: YieldConfig = DEFAULT) -> dict:
    """K2 as one run: weekly TPY of the current week, packing of 7 days, test board over all time."""
    logs = _logs(spark, logs_root)
    return {"tables": weekly(spark, logs.get("workstation_master_log"), out_root, now, as_of, cfg,
                             logs.get("testboard_master_log"))}


def dedup_copy(log: DataFrame, to: str, kind: str) -> None:
    """The first row of every business key as a new log folder."""
    key = schemas.LOGS[kind][1]
    order = [c for c in ("id", "created_at") if c in log.columns][:1]
    kept = dedup.keep_first(log, key, order=order) if order else log.dropDuplicates(list(key))
    kept.write.partitionBy(*[c for c in ("end_date",) if c in log.columns]).parquet(to)
