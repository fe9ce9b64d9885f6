"""Ingest, de-duplication and sink behaviour."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from yieldspark import schemas
from yieldspark.functions import columns as C
from yieldspark.operators import dedup, ingest, packing
from yieldspark.sources import fixtures as fx
from yieldspark.sources import reports, sinks
from yieldspark.sources.logstore import LogStore
from tests.helpers import wl_rows

KEY = list(schemas.WORKSTATION_KEY)
SF = "/root/testdata/sf0.001"


def test_header_normalisation():
    assert reports.normalize_header("History Station End-Time") == "history_station_end_time"
    assert reports.normalize_header("Customer P/N (v2)") == "customer_pn_v2"
    assert reports.normalize_header("Customer P/N", strict=False) == "customer_p/n"


def test_reload_same_rows_adds_nothing_with_null_keys(spark):
    wl = wl_rows(spark, [{"sn": "A", "history_station_end_time": "2025-06-17 10:00:00", "customer_pn": None},
                         {"sn": "B", "history_station_end_time": "2025-06-17 11:00:00", "customer_pn": None}])
    assert ingest.new_rows(wl, wl, KEY).count() == 0  # NULL-safe: a reload adds nothing
    plain = wl.join(wl.select(*KEY), KEY, "left_anti")  # USING keys compare with plain "="
    assert plain.count() == 2  # the trap: NULL never equals NULL


def test_infile_dedup_ignores_day_column(spark):
    report = fx.workstation_report(spark, SF)
    conformed = ingest.conform(report, schemas.WORKSTATION_LOG, "workstation", start_falls_back_to_end=True)
    first = ingest.infile_dedup(conformed, KEY)
    # every re-exported copy differs only in Day and sits in the same weekly file
    assert first.count() == fx.workstation_log(spark, SF).count()
    assert first.filter(F.col("row_ordinal") >= fx.REISSUE_ID_OFFSET).count() == 0


def test_conform_round_trip_equals_log(spark):
    report = fx.workstation_report(spark, SF)
    conformed = ingest.conform(report, schemas.WORKSTATION_LOG, "workstation", start_falls_back_to_end=True)
    wl = fx.workstation_raw(spark, SF).withColumn(
        "history_station_start_time",
        F.when(F.col("first_station_start_time").isNull(), F.col("history_station_end_time"))
        .otherwise(F.col("history_station_start_time")))
    a = sorted(tuple(r) for r in conformed.select(*KEY).collect())
    b = sorted(tuple(r) for r in wl.select(*KEY).collect())
    assert a == b


def test_conform_missing_and_extra_columns(spark):
    df = spark.createDataFrame([(" SN9 ", "x", "2024-01-02 03:04:05")], ["SN", "Unknown Col", "History Station End Time"])
    out = ingest.conform(df, schemas.WORKSTATION_LOG, "workstation", start_falls_back_to_end=True).first()
    assert out.sn == "SN9" and out.model is None and out.data_source == "workstation"
    assert out.history_station_start_time == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_quarantine_row_and_file_scope(spark):
    df = spark.createDataFrame([("f1", 1, "a"), ("f1", 2, None), ("f2", 3, "b")], "source_file string, r int, sn string")
    good, bad = ingest.quarantine_split(df, ["sn"])
    assert good.count() == 2 and bad.count() == 1 and bad.first().reason == "null sn"
    good, bad = ingest.quarantine_split(df, ["sn"], file_atomic=True)
    assert sorted(r.r for r in good.collect()) == [3]
    assert sorted(r.r for r in bad.collect()) == [1, 2]


def test_keep_first_matches_row_number_and_is_idempotent(spark):
    raw = fx.workstation_raw(spark, SF)
    kept = dedup.keep_first(raw, KEY)
    assert kept.count() == raw.select(*KEY).distinct().count()
    assert kept.filter(F.col("id") >= fx.REISSUE_ID_OFFSET).count() == 0
    again = dedup.keep_first(kept, KEY)
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in kept.collect())


def test_keep_first_hot_key(spark):
    # one key holds a third of all rows: the aggregate-based keep-first still returns one row
    hot = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string"))
                                    .alias("k"), F.col("id"))
    out = dedup.keep_first(hot, ["k"])
    assert out.filter("k = 'HOT'").first().id == 0
    assert out.count() == 20001


def test_dedup_report_counts(spark):
    rep = {r.table_name: (r.before_count, r.removed, r.after_count) for r in dedup.dedup_report([
        dedup.duplicate_counts(fx.workstation_raw(spark, SF), KEY, "wl")]).collect()}
    before, removed, after = rep["wl"]
    assert before - removed == after and removed > 0 and rep["total"] == rep["wl"]


def test_period_upsert_replace_append(spark, scratch):
    t = sinks.PeriodTable(spark, os.path.join(scratch, "pk"), schemas.PACKING_DAILY_KEY, "pack_date", null_keys="keep")
    old = packing.packing_daily(fx.workstation_old(spark, SF))
    new = packing.packing_daily(fx.workstation_new(spark, SF))
    assert not t.exists() and t.upsert(old) == old.count()
    n_old = t.read().count()
    t.upsert(new)
    merged = t.read()
    n_merged = merged.count()
    assert n_merged == merged.select(*schemas.PACKING_DAILY_KEY).distinct().count()
    assert n_merged >= n_old  # keys not in the update stay (Q19)
    rows = sorted(map(str, merged.collect()))
    t.upsert(new)  # idempotent
    assert sorted(map(str, t.read().collect())) == rows
    assert t.replace(new) == new.count() == t.read().count()
    assert dict(t.read().dtypes)["pack_date"] == "date"
    with pytest.raises(FileNotFoundError):
        sinks.PeriodTable(spark, os.path.join(scratch, "none")).read()


D1, D2, D3 = (dt.date(2024, 1, i) for i in (1, 2, 3))


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "d date, k string, v int")


def stored(t):
    return sorted(((r.d, r.k, r.v) for r in t.read().collect()), key=str)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def test_upsert_reads_and_writes_the_touched_periods_only(spark, scratch):
    t = sinks.PeriodTable(spark, os.path.join(scratch, "t"), ("d", "k"), "d", null_keys="keep")
    t.upsert(days(spark, (D1, "a", 1), (D2, "a", 1), (D2, "b", 1), (None, "a", 1), (D3, None, 1)))
    before = files(t.root)
    assert t.upsert(days(spark, (D2, "b", 2), (D2, "c", 2))) == 3  # a day is written whole
    after = files(t.root)
    assert {f.split("/d=")[1][:10] for f, _ in set(before.items()) ^ set(after.items())} == {"2024-01-02"}
    assert stored(t) == sorted([(D1, "a", 1), (D2, "a", 1), (D2, "b", 2), (D2, "c", 2), (None, "a", 1), (D3, None, 1)], key=str)
    t.upsert(days(spark, (None, "a", 5), (D3, None, 5)))  # NULL periods and keys are equal to themselves
    assert {(None, "a", 5), (D3, None, 5)} < set(stored(t)) and len(stored(t)) == 6
    plan = t._touched(days(spark, (D1, "x", 0)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-01" in plan or "19723" in plan


def test_a_write_that_fails_while_computing_changes_nothing(spark, scratch):
    t = sinks.PeriodTable(spark, os.path.join(scratch, "t"), ("d", "k"), "d")
    t.upsert(days(spark, (D1, "a", 1), (D2, "b", 1)))
    before = files(t.root)
    bad = days(spark, (D1, "a", 2), (D2, "x", 2)).withColumn(
        "v", F.when(F.col("k") == "x", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    for write in (t.upsert, t.replace, t.insert_ignore):
        with pytest.raises(Exception, match="lost"):
            write(bad)
    assert files(t.root) == before and stored(t) == [(D1, "a", 1), (D2, "b", 1)]


def test_a_period_that_was_lost_is_mended_by_the_same_upsert(spark, scratch):
    import shutil
    t = sinks.PeriodTable(spark, os.path.join(scratch, "t"), ("d", "k"), "d")
    rows = days(spark, (D1, "a", 1), (D2, "b", 1))
    t.upsert(rows)
    shutil.move(os.path.join(t.root, "d=2024-01-02"), os.path.join(scratch, "lost"))  # a driver died between delete and rename
    t.upsert(rows)
    assert stored(t) == [(D1, "a", 1), (D2, "b", 1)]


def test_append_and_insert_ignore(spark, scratch):
    for period in (None, "d"):
        t = sinks.PeriodTable(spark, os.path.join(scratch, f"t{period}"), ("k",), period)
        t.insert_ignore(days(spark, (D1, "a", 1), (D1, "a", 1)))
        before = files(t.root)
        t.append(days(spark, (D1, None, 2)))
        assert t.insert_ignore(days(spark, (D1, "a", 9), (D1, None, 9), (D1, "b", 3))) == 1
        assert before.items() <= files(t.root).items()  # rows are added as files
        assert stored(t) == sorted([(D1, "a", 1), (D1, "b", 3), (D1, None, 2)], key=str)


def test_first_activity_moves(spark, scratch):
    t = sinks.FirstActivity(spark, os.path.join(scratch, "fa"))
    at = lambda day: dt.datetime(2024, 1, day, 8)

    def first(*rows):
        return spark.createDataFrame(list(rows), "sn string, model string, first_activity_time timestamp_ntz")

    def batch(name, *rows):
        with_moves = spark.createDataFrame(t.moves(first(*rows)).collect(), t.COLUMNS)
        seen = sorted(map(tuple, t.read(None, with_moves, name).collect()), key=str)
        t.add(with_moves, name)
        assert sorted(map(tuple, t.read().collect()), key=str) == seen
        return sorted((r.sign, r.first_activity_time.day) for r in with_moves.collect())

    assert batch("0", ("A", "m", at(17)), ("B", None, at(9))) == [(1, 9), (1, 17)]
    assert batch("1", ("A", "m", at(18)), ("B", None, at(9))) == []                       # later or equal: nothing moves
    assert batch("2", ("A", "m", at(3)), ("A", None, at(17))) == [(-1, 17), (1, 3), (1, 17)]
    weeks = {d: sorted((r.sn, r.model) for r in t.read([dt.date(2024, 1, d)]).collect()) for d in (1, 8, 15)}
    assert weeks == {1: [("A", "m")], 8: [("B", None)], 15: [("A", None)]}
    # The same batch again replaces its own folders; a stale row of a write cut short is taken out.
    again = spark.createDataFrame([("C", "m", at(10), 1)], t.COLUMNS)
    t.add(again, "3")
    t.add(again, "3")
    t.add(spark.createDataFrame([("C", "m", at(18), 1)], t.COLUMNS), "4")
    assert t.read().where("sn = 'C'").count() == 2
    assert batch("5", ("C", "m", at(20))) == [(-1, 18)]


def test_a_log_compared_with_itself_has_no_new_rows(spark):
    wl = fx.workstation_log(spark, SF)
    for c in KEY:
        nulled = wl.withColumn(c, F.when(F.col("id") % 2 == 0, F.col(c)))
        assert ingest.new_rows(nulled, nulled, KEY).count() == 0, c
    day = wl.withColumn("end_date", F.to_date("history_station_end_time"))
    assert ingest.new_rows(wl, day, KEY).count() == 0


def test_null_violations_and_day_filter(spark):
    from yieldspark.functions import columns as C
    df = spark.createDataFrame([("a", None), (None, None), ("b", 1)], "k string, v int")
    got = {r[0]: r[1] for r in dedup.null_violations(df, ["k", "v"]).collect()}
    assert got == {"k": 1, "v": 2}
    wl = fx.workstation_log(spark, SF)
    day = wl.filter(C.on_date(C.END, dt.date(2024, 1, 10)))
    assert day.count() == wl.filter(F.to_date(C.END) == F.lit(dt.date(2024, 1, 10))).count() > 0
    assert "date(" not in day._jdf.queryExecution().optimizedPlan().toString().lower()  # a range, so it can be pushed


def test_slash_and_am_pm_times(spark):
    from yieldspark.functions import columns as C
    cells = [("1/5/2024 3:04:05 PM", dt.datetime(2024, 1, 5, 15, 4, 5)), ("01/05/2024 12:00:00 AM", dt.datetime(2024, 1, 5)),
             ("1/5/2024 15:04", dt.datetime(2024, 1, 5, 15, 4)), ("2024/01/05 15:04:05", dt.datetime(2024, 1, 5, 15, 4, 5))]
    got = spark.createDataFrame([(c,) for c, _ in cells], "t string").select("t", C.parse_ts("t").alias("v")).collect()
    assert {r.t: r.v for r in got} == dict(cells)


def test_null_key_policy(spark, scratch):
    t = sinks.PeriodTable(spark, os.path.join(scratch, "nk"), ("k",))
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    with pytest.raises(sinks.NullKeyError):
        t.upsert(df)
    t.upsert(df, null_keys="drop")
    assert t.read().count() == 1
    t.upsert(df, null_keys="keep")
    t.upsert(df, null_keys="keep")  # NULL-safe merge: the NULL-key row is not added twice
    assert t.read().count() == 2


def test_logstore_append_is_idempotent(spark, scratch):
    log = LogStore(spark, os.path.join(scratch, "log"), KEY)
    wl = fx.workstation_log(spark, SF).drop("id")
    n1 = log.append(wl)
    n2 = log.append(wl)
    assert n1 == wl.count() and n2 == 0
    assert log.read().count() == n1


def test_scan_reports_from_csv_drop(spark, scratch):
    drop = os.path.join(scratch, "drop")
    rep = fx.workstation_report(spark, SF).drop("source_file", "row_ordinal")
    rep.coalesce(2).write.option("header", True).csv(drop)
    scanned = reports.scan_reports(spark, drop, glob="*.csv")
    assert "history_station_end_time" in scanned.columns and "source_file" in scanned.columns
    conformed = ingest.conform(scanned, schemas.WORKSTATION_LOG, "workstation", start_falls_back_to_end=True)
    assert conformed.filter(F.col("history_station_end_time").isNull()).count() == 0
    assert conformed.count() == rep.count()


def test_renormalize_drops_and_adds_columns(spark):
    df = spark.createDataFrame([("S1", "x", "2024-01-01")], "sn string, day string, model string")
    out = ingest.renormalize(df, schemas.SNFN_LOG)
    assert out.columns == [f.name for f in schemas.SNFN_LOG.fields]
    assert out.first().sn == "S1" and out.first().model == "2024-01-01" and out.first().fixture_no is None


def test_old_and_new_layouts_are_read_together_without_a_rewrite(spark, scratch):
    log = LogStore(spark, os.path.join(scratch, "log"), schemas.SNFN_KEY)
    old = spark.createDataFrame([("S1", "M1", "7/7/2025", 3, dt.date(2025, 7, 7))],
                                "sn string, model string, day string, number_of_times_baseboard_is_used int, end_date date")
    new = spark.createDataFrame([("S2", "F2", "W", dt.date(2025, 7, 8))],
                                "sn string, fixture_no string, workstation_name string, end_date date")
    for part in (old, new):
        part.write.mode("append").partitionBy("end_date").parquet(log.path)
    before = files(log.path)
    got = log.read(schemas.SNFN_LOG)
    assert got.columns == [*[f.name for f in schemas.SNFN_LOG.fields], "end_date"]
    assert {r.sn: (r.model, r.fixture_no, r.workstation_name, r.end_date.day) for r in got.collect()} == {
        "S1": ("M1", None, None, 7), "S2": (None, "F2", "W", 8)}
    assert files(log.path) == before and LogStore(spark, os.path.join(scratch, "none"), ()).read(schemas.SNFN_LOG) is None
    assert sorted(map(str, ingest.renormalize(old, schemas.SNFN_LOG).collect())) == sorted(
        map(str, got.where("sn = 'S1'").drop("end_date").collect()))


def test_insert_ignore_adds_the_first_row_of_each_unknown_key(spark):
    at = dt.datetime(2024, 1, 17, 8)
    schema = f"sn string, {C.END} timestamp_ntz, note string, id long"
    incoming = spark.createDataFrame([("a", at, "later", 2), ("a", at, None, 1), (None, at, "x", 3), (None, None, None, None),
                                      ("b", None, "known", 4), ("c", at, "y", 5), ("c", None, "z", 6)], schema)
    log = spark.createDataFrame([("b", None, "old", 1), ("b", None, "old", 2), ("c", at, "old", 3), ("d", at, "old", 4)], schema)
    got = sorted(map(tuple, ingest.insert_ignore(incoming, log, ("sn", C.END)).collect()), key=str)
    assert got == sorted([("a", at, None, 1), (None, at, "x", 3), (None, None, None, None), ("c", None, "z", 6)], key=str)
    assert ingest.insert_ignore(incoming, log, ("sn", C.END)).columns == incoming.columns
    assert ingest.insert_ignore(incoming.limit(0), log, ("sn", C.END)).count() == 0
    assert ingest.insert_ignore(incoming, log.limit(0), ("sn", C.END)).count() == 6
