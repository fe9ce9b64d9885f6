"""Streaming forms (I1-I4): stream result = batch result, replay is idempotent."""

import datetime as dt
import os

from pyspark.sql import functions as F

from yieldspark import schemas
from yieldspark.operators import packing, station
from yieldspark.sources import fixtures as fx
from yieldspark.streaming import stream

SF = "/root/testdata/sf0.001"


def _drop_reports(spark, drop):
    rep = fx.workstation_report(spark, SF)
    # one CSV folder per weekly file, as the exporter drops them
    rep.drop("row_ordinal").repartition("source_file").write.partitionBy("source_file") \
        .option("header", True).csv(drop + "_staging")
    import glob
    import shutil
    os.makedirs(drop, exist_ok=True)
    for i, f in enumerate(sorted(glob.glob(drop + "_staging/*/*.csv"))):
        shutil.copy(f, os.path.join(drop, f"report_{i:03d}.csv"))
    return rep


def test_file_drop_ingest_equals_batch_and_replays_idempotently(spark, scratch):
    drop, log_path = os.path.join(scratch, "drop"), os.path.join(scratch, "log")
    _drop_reports(spark, drop)
    q = stream.start_report_ingest(spark, drop, log_path, os.path.join(scratch, "ckpt1"))
    q.awaitTermination(300)
    log = spark.read.parquet(log_path)
    expected = fx.workstation_log(spark, SF)
    assert log.count() == expected.count()
    # packing from the streamed log equals packing from the batch log
    a = sorted(tuple(r) for r in packing.packing_daily(log).collect())
    b = sorted(tuple(r) for r in packing.packing_daily(expected).collect())
    assert a == b
    # replay all files from a fresh checkpoint: nothing is added
    q2 = stream.start_report_ingest(spark, drop, log_path, os.path.join(scratch, "ckpt2"))
    q2.awaitTermination(300)
    assert spark.read.parquet(log_path).count() == expected.count()


def test_kpi_refresh_with_late_and_null_rows_equals_full_rebuild(spark, scratch):
    """Two batches; the second holds old rows (first activities move to an earlier week) and rows without a part number."""
    from yieldspark.plans import jobs
    from yieldspark.sources.logstore import LogStore
    now = dt.datetime(2024, 2, 1)
    log_path, out = os.path.join(scratch, "log"), os.path.join(scratch, "out")
    wl = fx.workstation_log(spark, SF).drop("id")
    late = (F.crc32(F.col("sn").cast("binary")) % 3 == 0) & (F.hour("history_station_end_time") < 12)
    log = LogStore(spark, log_path, schemas.WORKSTATION_KEY)
    log.append(wl.filter(~late))
    run = lambda: stream.start_kpi_refresh(spark, log_path, out, os.path.join(scratch, "ckpt"), now=now).awaitTermination(300)
    run()
    odd = wl.filter(late).withColumn("pn", F.when(F.col("operator").endswith("1"), F.col("pn"))).withColumn(
        "model", F.when(F.col("operator").endswith("2"), F.lit(None)).otherwise(F.col("model")))
    log.append(odd)
    run()
    ref = os.path.join(scratch, "ref")
    jobs.daily(spark, log.read(), ref, now)
    jobs.weekly(spark, log.read(), ref, now)
    for name in ("daily_tpy_metrics", "daily_completions", "weekly_tpy_metrics", "station_hourly_summary",
                 "packing_daily_summary"):
        a, b = (stream.kpi_table(spark, r, name).read() for r in (out, ref))
        cols = sorted(a.columns)
        assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect())), name


def test_first_activities_are_stream_state(spark, scratch):
    """Late rows, a restart per batch and batches that run again: moves sum up to the batch result."""
    from yieldspark.operators import tpy
    from yieldspark.sources.sinks import FirstActivity
    from yieldspark.streaming import units
    src, wl = os.path.join(scratch, "log"), fx.workstation_log(spark, SF)
    h = F.pmod(F.hash("sn", "history_station_end_time"), F.lit(3))
    firsts = FirstActivity(spark, os.path.join(scratch, "moves"))
    seen = {}

    def fn(events, batch_id):
        events = events.persist()
        for _ in range(2):  # as after a crash behind the write
            firsts.add(units.moves(events), str(batch_id))
        seen[batch_id] = {r[0] for r in units.touched_days(events).collect()}
        events.unpersist()

    for i in (2, 0, 1):  # no order of time
        part = wl.where(h == i)
        part.write.mode("append").parquet(src)
        s = spark.readStream.schema(wl.schema).parquet(src)
        q = (units.unit_events(s).writeStream.outputMode("update").foreachBatch(fn)
             .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert seen[max(seen)] == {r[0] for r in part.select(F.to_date("history_station_end_time")).distinct().collect()}
    want = tpy.first_activity(tpy.prod(wl))
    assert sorted(map(str, firsts.read().collect())) == sorted(map(str, want.collect()))
    week = dt.date(2024, 1, 8)
    assert firsts.read([week]).count() == want.where(F.col("first_activity_time").between("2024-01-08", "2024-01-14 23:59:59")).count()


def test_hourly_stream_is_written_and_survives_restarts(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("log", "out", "ck"))
    wl = fx.workstation_log(spark, SF)
    lo, hi = (dt.datetime(2024, 1, d) for d in (10, 12))
    end = F.col("history_station_end_time")
    # The second part reaches back into hours of the first one, less than the watermark's delay.
    odd = F.pmod(F.hash("id"), F.lit(2)) == 0
    for part in (wl.where((end < lo) | ((end < hi) & odd)), wl.where((end >= hi) | ((end >= lo) & ~odd))):
        part.write.mode("append").parquet(src)
        stream.start_station_hourly(spark, src, out, ck, delay="5 days").awaitTermination(300)
    got = stream.kpi_table(spark, out, "station_hourly_summary").read()
    want = station.station_hourly(wl)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # The whole log again from a new checkpoint changes nothing.
    stream.start_station_hourly(spark, src, out, ck + "2", max_files_per_trigger=100).awaitTermination(300)
    again = stream.kpi_table(spark, out, "station_hourly_summary").read()
    assert sorted(map(str, again.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def _csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(",".join(r) for r in [header, *rows]) + "\n")


T1 = "2024-01-05 10:00:00"


def test_columns_are_bound_by_name_and_rejected_rows_are_kept(spark, scratch):
    drop, log_path = os.path.join(scratch, "drop"), os.path.join(scratch, "log")
    _csv(f"{drop}/a.csv", ["SN", "Model", "Workstation Name", "History Station End Time"],
         [["S1", "M1", "VI2", T1], ["", "M1", "VI2", T1], ["S9", "M1", "VI2", "not a time"]])
    _csv(f"{drop}/b.csv", ["Model", "Größe", "History-Station End Time", "SN", "Workstation Name"],
         [["M2", "x", T1, "S2", "FQC"]])
    _csv(f"{drop}/c.csv", ["Workstation Name", "SN"], [["VI2", "S3"]])
    from tests.xlsx_writer import write_xlsx
    write_xlsx(f"{drop}/d.xlsx", [["SN", "Workstation Name", "Model", "History Station End Time"],
                                  ["S4", "FI", "M4", dt.datetime(2024, 1, 6)]])
    with open(f"{drop}/e.xlsx", "wb") as f:
        f.write(b"no workbook")
    counts = {}
    stream.start_report_ingest(spark, drop, log_path, os.path.join(scratch, "ck"),
                               on_batch=lambda _, n: counts.update(n)).awaitTermination(300)
    assert counts == {"rows_read": 6, "added": 3, "quarantined": 4}
    got = {r.sn: (r.model, r.workstation_name) for r in spark.read.parquet(log_path).collect()}
    assert got == {"S1": ("M1", "VI2"), "S2": ("M2", "FQC"), "S4": ("M4", "FI")}
    q = spark.read.parquet(f"{log_path}_quarantine").collect()
    assert sorted(r.reason.split(":")[0] for r in q) == [
        "null history_station_start_time", "null history_station_start_time", "null sn", "unreadable"]
    assert all(r.source_file for r in q)


def test_file_atomic_ingest_rejects_the_whole_file(spark, scratch):
    drop, log_path = os.path.join(scratch, "drop"), os.path.join(scratch, "log")
    head = ["SN", "Workstation Name", "History Station End Time"]
    _csv(f"{drop}/a.csv", head, [["S1", "VI2", T1], ["", "VI2", T1]])
    _csv(f"{drop}/b.csv", head, [["S2", "VI2", T1]])
    stream.start_report_ingest(spark, drop, log_path, os.path.join(scratch, "ck"), file_atomic=True).awaitTermination(300)
    assert [r.sn for r in spark.read.parquet(log_path).collect()] == ["S2"]
    assert sorted(r.reason for r in spark.read.parquet(f"{log_path}_quarantine").collect()) == ["file rejected", "null sn"]


def _damage(src, to, how):
    with open(src, "rb") as f:
        data = bytearray(f.read())
    if how == "tail":      # no footer
        data = data[:len(data) // 2]
    elif how == "page":    # the footer is whole, a data page is not
        data[60:len(data) // 3] = b"\xff" * (len(data) // 3 - 60)
    with open(to, "wb") as f:
        f.write(data)


def test_broken_files_do_not_stop_the_others(spark, scratch):
    import glob
    drop, log_path = os.path.join(scratch, "drop"), os.path.join(scratch, "log")
    head = ["SN", "Model", "Workstation Name", "History Station End Time"]
    _csv(f"{drop}/good 1.csv", head, [["S1", "M1", "VI2", T1], ["S2", "M1", "VI2", T1, "too", "many"], ["S3", "M1", "VI2", T1]])
    with open(f"{drop}/rubbish.csv", "wb") as f:
        f.write(bytes(range(256)) * 20)
    with open(f"{drop}/empty.csv", "w") as f:
        f.write("\n \n")
    cols = ["SN", "Workstation Name", "History Station End Time"]

    def parquet(name, rows, names=cols):
        spark.createDataFrame(rows, names).coalesce(1).write.parquet(os.path.join(scratch, name))
        return glob.glob(os.path.join(scratch, name, "*.parquet"))[0]

    import shutil
    many = [(f"P{i:05d}{i * i * 7919 % 100003}", "FQC", T1) for i in range(20_000)]
    shutil.copy(parquet("a", many[:10]), f"{drop}/a.parquet")
    shutil.copy(parquet("b", [("FI", T1, "x", "Q1")], ["Workstation Name", "History-Station End Time", "Other", "sn"]), f"{drop}/b.parquet")
    _damage(parquet("c", many), f"{drop}/no footer.parquet", "tail")
    _damage(parquet("d", many), f"{drop}/bad page.parquet", "page")
    shutil.copy(parquet("e", [], "SN string"), f"{drop}/no rows.parquet")
    with open(f"{drop}/text.parquet", "w") as f:
        f.write("no parquet at all")
    counts = {}
    for ck in ("ck1", "ck2"):  # the second time nothing is new
        stream.start_report_ingest(spark, drop, log_path, os.path.join(scratch, ck),
                                   on_batch=lambda _, n: counts.update(n)).awaitTermination(300)
    assert counts["added"] == 0 and counts["quarantined"] == 6
    assert sorted(r.sn[:2] for r in spark.read.parquet(log_path).collect()) == ["P0"] * 10 + ["Q1", "S1", "S3"]
    q = spark.read.parquet(f"{log_path}_quarantine").dropDuplicates(["source_file", "reason"]).collect()
    assert sorted((os.path.basename(r.source_file).replace("%20", " "), r.reason.split(" of ")[0][:23]) for r in q) == [
        ("bad page.parquet", "unreadable: 0"), ("empty.csv", "unreadable: no header"), ("good 1.csv", "malformed row"),
        ("no footer.parquet", "unreadable: no Parquet "), ("rubbish.csv", "unreadable: no text"),
        ("text.parquet", "unreadable: no Parquet ")]


def test_parquet_files_whose_types_differ(spark, scratch):
    import glob
    import shutil
    from yieldspark.sources import reports
    drop = os.path.join(scratch, "drop")
    os.makedirs(drop)
    for i, (row, names) in enumerate([((1, "a"), ["SN", "Model"]), (("x", 2), ["SN", "Model"])]):
        spark.createDataFrame([row], names).coalesce(1).write.parquet(os.path.join(scratch, str(i)))
        shutil.copy(glob.glob(os.path.join(scratch, str(i), "*.parquet"))[0], f"{drop}/{i}.parquet")
    assert sorted((r.sn, r.model) for r in reports.scan_reports(spark, drop).collect()) == [("1", "a"), ("x", "2")]


def test_windowed_hourly_counts_equal_batch(spark, scratch):
    src = os.path.join(scratch, "wl")
    fx.workstation_log(spark, SF).write.parquet(src)
    sdf = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (stream.windowed_station_counts(sdf, "1 hour").writeStream.outputMode("complete").format("memory")
         .queryName("hourly_counts").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("hourly_counts").select(
        F.to_date("window_start").alias("date"), F.hour("window_start").alias("hour"), "workstation_name", "part_count")
    batch = station.station_hourly(fx.workstation_log(spark, SF))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in batch.collect())


def test_weekly_windows_start_on_monday(spark, scratch):
    src = os.path.join(scratch, "wl")
    fx.workstation_log(spark, SF).write.parquet(src)
    sdf = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (stream.windowed_station_counts(sdf, "7 days").writeStream.outputMode("complete").format("memory")
         .queryName("weekly_counts").trigger(availableNow=True).start())
    q.awaitTermination(300)
    starts = {r.window_start.date() for r in spark.table("weekly_counts").collect()}
    assert starts and all(d.weekday() == 0 for d in starts)
    assert dt.date(2024, 1, 1) in starts


def test_dedup_within_watermark(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.workstation_raw(spark, SF).drop("id").write.parquet(src)
    sdf = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = (stream.dedup_within_watermark(sdf).writeStream.format("memory").queryName("dedup_out")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("dedup_out").count() == fx.workstation_log(spark, SF).count()


def test_testboard_drop_ingest_with_extra_usage_column(spark, scratch):
    from yieldspark.functions import columns as C
    tb = fx.testboard_log(spark, SF)
    usage = (F.col("id") % 5).cast("string").alias("Number of Times Baseboard is Used")
    drop = os.path.join(scratch, "tbdrop")
    names = [f.name for f in schemas.TESTBOARD_LOG.fields if f.name not in ("id", "created_at", "data_source")]
    cells = [F.coalesce(F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS") if n.endswith("_time") else F.col(n), F.lit("")).alias(
        n.replace("_", " ").title()) for n in names]
    tb.select(usage, *cells[::-1]).coalesce(2).write.option("header", True).csv(drop)
    q = stream.start_report_ingest(spark, drop, os.path.join(scratch, "tblog"), os.path.join(scratch, "ck"), kind="testboard")
    q.awaitTermination(300)
    log = spark.read.parquet(os.path.join(scratch, "tblog"))
    assert log.count() == tb.count()
    assert "number_of_times_baseboard_is_used" not in log.columns
    key = list(schemas.TESTBOARD_KEY)
    assert sorted(tuple(r) for r in log.select(*key).collect()) == sorted(tuple(r) for r in tb.select(*key).collect())
    got = spark.createDataFrame([("3",), ("3.0",), ("x",), (None,)], "s string").select(C.safe_int("s").alias("n"))
    assert [r.n for r in got.collect()] == [3, 3, None, None]
