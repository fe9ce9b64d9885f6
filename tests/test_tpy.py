"""Hand-written golden rows for the yield semantics (FIXTURES.md section 2, traps Q5-Q16)."""

import datetime as dt

from pyspark.sql import functions as F

from yieldspark.operators import packing, tpy
from tests.helpers import wl_rows

MON = "2025-06-16"  # ISO week 2025-W25 runs Mon 16 .. Sun 22 June


def at(day, hh=10, mm=0):
    return f"{day} {hh:02d}:{mm:02d}:00"


def test_fixed_tpy_golden_and_missing_station(spark):
    # SXM4 yields 96.47, 100, 100, 84.91 -> 81.91; SXM5 100, 100, 100, 98.28 -> 98.28
    rows = []
    def visits(model, station, passed, total):
        for i in range(total):
            rows.append({"sn": f"{model}{station}{i}", "model": model, "workstation_name": station,
                         "history_station_end_time": at("2025-06-17"),
                         "history_station_passing_status": "Pass" if i < passed else "Fail"})
    visits("Tesla SXM4", "VI2", 547, 567)
    visits("Tesla SXM4", "ASSY2", 10, 10)
    visits("Tesla SXM4", "FI", 10, 10)
    visits("Tesla SXM4", "FQC", 45, 53)
    visits("Tesla SXM5", "BBD", 5, 5)
    visits("Tesla SXM5", "ASSY2", 5, 5)
    visits("Tesla SXM5", "FI", 5, 5)
    visits("Tesla SXM5", "FQC", 57, 58)
    wl = wl_rows(spark, rows)
    wsy = tpy.weekly_station_yield(tpy.station_day(wl))
    got = {r.model: r.tpy for r in tpy.tpy_fixed(wsy).collect()}
    assert got == {"Tesla SXM4": 81.91, "Tesla SXM5": 98.28}
    no_fqc = wl.filter(~((F.col("model") == "Tesla SXM4") & (F.col("workstation_name") == "FQC")))
    got = {r.model: (r.tpy, r.stations_found) for r in
           tpy.tpy_fixed(tpy.weekly_station_yield(tpy.station_day(no_fqc))).collect()}
    assert got["Tesla SXM4"] == (None, 3)


def test_dynamic_tpy_model_without_rows(spark):
    wl = wl_rows(spark, [{"sn": "A", "model": "Tesla SXM4", "workstation_name": "VI2",
                          "history_station_end_time": at("2025-06-17")}])
    got = {r.model: (r.tpy, r.station_count) for r in
           tpy.tpy_dynamic(tpy.weekly_station_yield(tpy.station_day(wl))).collect()}
    assert got["Tesla SXM5"] == (100.0, 0)
    assert got["Tesla SXM4"] == (100.0, 1)


def test_unit_semantics_weekly_fpy(spark):
    rows = [
        # reworked: fail then pass at PACKING -> completed and failed, not first pass
        {"sn": "R", "workstation_name": "PACKING", "history_station_end_time": at("2025-06-17", 9),
         "history_station_passing_status": "Fail"},
        {"sn": "R", "workstation_name": "PACKING", "history_station_end_time": at("2025-06-17", 11)},
        # limbo: passes only, never PACKING
        {"sn": "L", "workstation_name": "VI2", "history_station_end_time": at("2025-06-17")},
        # clean unit
        {"sn": "C", "workstation_name": "VI2", "history_station_end_time": at("2025-06-18")},
        {"sn": "C", "workstation_name": "PACKING", "history_station_end_time": at("2025-06-19")},
        # non-production flow is ignored
        {"sn": "X", "workstation_name": "PACKING", "history_station_end_time": at("2025-06-19"),
         "service_flow": "RO"},
    ]
    r = tpy.weekly_fpy(tpy.unit_day(wl_rows(spark, rows))).first()
    assert (r.parts_started, r.first_pass_success, r.parts_completed, r.parts_failed,
            r.parts_stuck_in_limbo, r.active_parts) == (3, 1, 2, 1, 1, 3)
    assert r.traditional_fpy == 33.33 and r.completed_only_fpy == 33.33


def test_starters_and_daily_completions(spark):
    rows = [
        # started the week before, packs this week: not a starter, not a daily completion
        {"sn": "OLD", "workstation_name": "VI2", "history_station_end_time": at("2025-06-12")},
        {"sn": "OLD", "workstation_name": "PACKING", "history_station_end_time": at("2025-06-17")},
        # one sn under two models: two units; the semi join on sn keeps both
        {"sn": "TWO", "model": "Tesla SXM4", "workstation_name": "VI2", "history_station_end_time": at("2025-06-16")},
        {"sn": "TWO", "model": "Tesla SXM5", "workstation_name": "PACKING",
         "history_station_end_time": at("2025-06-17")},
        {"sn": "TWO", "model": "Tesla SXM4", "workstation_name": "PACKING",
         "history_station_end_time": at("2025-06-17")},
    ]
    wl = wl_rows(spark, rows)
    ud = tpy.unit_day(wl)
    fa = tpy.first_activity(ud)
    st = {(r.week_start, r.model, r.level): r.starters for r in tpy.weekly_starters(fa).collect()}
    assert st[(dt.date(2025, 6, 16), None, 1)] == 2
    assert st[(dt.date(2025, 6, 9), None, 1)] == 1
    dc = {(r.date_id, r.model): (r.completed_today, r.first_pass_today)
          for r in tpy.daily_completions(ud, fa).collect()}
    assert dc == {(dt.date(2025, 6, 17), "Tesla SXM4"): (1, 1), (dt.date(2025, 6, 17), "Tesla SXM5"): (1, 1)}
    daily = tpy.tpy_daily(tpy.station_day(wl), tpy.starters_by_week(fa)).collect()
    assert {r.total_starters for r in daily if r.week_start == dt.date(2025, 6, 16)} == {2}


def test_best_worst_tie_rule(spark):
    # two stations at 100.00: the one seen first (lowest model, most visits) is named
    rows = []
    for i in range(3):
        rows.append({"sn": f"a{i}", "model": "Tesla SXM4", "workstation_name": "ZED",
                     "history_station_end_time": at("2025-06-17")})
    for i in range(2):
        rows.append({"sn": f"b{i}", "model": "Tesla SXM4", "workstation_name": "ALPHA",
                     "history_station_end_time": at("2025-06-17")})
    rows.append({"sn": "c", "model": "Tesla SXM5", "workstation_name": "MID",
                 "history_station_end_time": at("2025-06-17"), "history_station_passing_status": "Fail"})
    s = tpy.weekly_station_summary(tpy.weekly_station_yield(tpy.station_day(wl_rows(spark, rows)))).first()
    assert (s.best_station_name, s.best_station_yield) == ("ZED", 100.0)
    assert (s.worst_station_name, s.worst_station_yield) == ("MID", 0.0)
    assert s.total_stations == 3 and s.average_yield == 66.67


def test_packing_fold_and_rolling_window_widening(spark):
    rows = [{"sn": f"u{i}", "workstation_name": "PACKING", "history_station_end_time": at(d)}
            for i, d in enumerate(["2025-06-20", "2025-06-21", "2025-06-22", "2025-06-23"])]
    wl = wl_rows(spark, rows)
    full = {r.pack_date: r.packed_count for r in packing.packing_daily(wl).collect()}
    assert full == {dt.date(2025, 6, 20): 3, dt.date(2025, 6, 23): 1}
    # as_of Sat 2025-06-28: the 7-day window starts Sun 22; Friday 20 must keep 3, not 1
    recent = {r.pack_date: r.packed_count for r in packing.packing_recent(wl, dt.date(2025, 6, 28)).collect()}
    assert recent[dt.date(2025, 6, 20)] == 3
    lo, hi = packing.recent_bounds(dt.date(2025, 6, 28), 7)
    assert lo == dt.datetime(2025, 6, 20) and hi == dt.datetime(2025, 6, 29)


def test_all_time_equals_union_of_recent_windows(spark):
    from yieldspark.sources import fixtures as fx
    wl = fx.workstation_log(spark, "/root/testdata/sf0.001")
    full = packing.packing_daily(wl)
    parts = None
    for as_of in [dt.date(2024, 1, 7), dt.date(2024, 1, 14), dt.date(2024, 1, 21), dt.date(2024, 1, 28),
                  dt.date(2024, 2, 4)]:
        lo, hi = packing.recent_bounds(as_of, 7)
        p = packing.packing_recent(wl, as_of).filter(F.col("pack_date") >= F.lit(lo.date()))
        parts = p if parts is None else parts.unionByName(p)
    key = lambda r: (r.pack_date, r.model, r.part_number)
    merged = {key(r): r.packed_count for r in parts.collect()}
    assert merged == {key(r): r.packed_count for r in full.collect()}


def test_fold_keeps_packing_total(spark):
    from yieldspark.sources import fixtures as fx
    wl = fx.workstation_log(spark, "/root/testdata/sf0.01")
    folded = packing.packing_daily(wl).agg(F.sum("packed_count")).first()[0]
    raw = wl.filter((F.col("workstation_name") == "PACKING")
                    & (F.col("history_station_passing_status") == "Pass")).count()
    assert folded == raw
    assert packing.packing_daily(wl).filter(F.dayofweek("pack_date").isin(1, 7)).count() == 0
