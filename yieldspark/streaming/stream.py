"""Structured Streaming forms of the file-drop import and the incremental KPIs.

* ``start_report_ingest`` (I1, I2): the polling loop over a drop directory
  becomes a file-source stream of file names; each micro-batch reads its files
  by header, conforms them, sends rejected rows to a quarantine table and
  appends new rows to the log through a NULL-safe anti join. The checkpoint
  replaces deleting imported files; replaying from a fresh checkpoint adds
  nothing to the log.
* ``dedup_within_watermark`` (I2): bounded-state de-duplication of a
  re-delivered stream, for keys that recur only within the watermark.
* ``start_kpi_refresh`` (I3): late data re-computes only the affected days /
  weeks from the log and upserts them into the KPI tables; first activities
  are the stream's state.
* ``windowed_station_counts``, ``start_station_hourly`` (I4): hourly and
  ISO-week tumbling windows with a watermark, for a continuously growing log,
  and their upsert into the hourly table.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .. import schemas, session
from ..config import DEFAULT, YieldConfig
from ..functions import columns as C
from ..operators import ingest, packing, station, tpy
from ..sources import reports
from ..sources.logstore import LogStore
from ..sources.reports import FILE_COL, ROW_COL
from ..sources.sinks import FirstActivity, PeriodTable
from . import units


# NOT NULL columns of each log (rows missing one go to quarantine, Q21).
REQUIRED = {
    "workstation": ("sn", "workstation_name", C.START, C.END),
    "testboard": ("sn", "workstation_name", C.START, C.END),
    "snfn": ("workstation_name", "sn", C.START, C.END),
}
QUARANTINE_SCHEMA = f"{FILE_COL} string, reason string, row string"


def column_names(kind: str) -> list[str]:
    return [f.name for f in schemas.LOGS[kind][0].fields if f.name not in ("id", "created_at", "data_source")]


def conform_report(rows: DataFrame, kind: str, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Report rows as log rows of their kind (A4).

    Only the workstation report lets a missing start time fall back to the
    end time (B25); the other logs quarantine such rows.
    """
    return ingest.conform(rows, schemas.LOGS[kind][0], kind, cfg, start_falls_back_to_end=(kind == "workstation"))


def ingest_rows(rows: DataFrame, log: LogStore, quarantine: str, cfg: YieldConfig = DEFAULT, kind: str = "workstation",
                now: _dt.datetime | None = None, file_atomic: bool = False, expected: DataFrame | None = None) -> dict[str, int]:
    """One batch of report rows: conform -> quarantine -> first row per key -> anti join against the log -> append.

    Rejected rows are appended to the quarantine table with file, reason and
    the row as JSON. ``file_atomic``: one bad row rejects its whole file, as
    the row-by-row loader with its per-file rollback does. ``expected``: file
    and number of rows; a file that came up short is damaged, none of its rows
    is loaded and the file is one quarantine row. The marked rows are written
    once and all that follows reads that table; counts are taken by the writes
    themselves (A15), no job only counts.
    """
    schema, _ = schemas.LOGS[kind]
    spark = rows.sparkSession
    with session.Cuts(spark) as cuts:
        seen = Observation()
        marked = ingest.mark_rejected(conform_report(rows, kind, cfg), list(REQUIRED[kind]))
        marked = cuts.cut(marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count("reason").alias("bad")), "ingest")
        out = {"rows_read": seen.get["n"], "added": 0, "quarantined": 0}
        n_bad = seen.get["bad"]
        if expected is not None:
            damaged = cuts.cut(reports.short_files(marked, expected), "damaged")
            if damaged.take(1):
                out["quarantined"] += _quarantine(damaged.withColumn("row", F.lit(None).cast("string")), quarantine)
                marked = marked.join(damaged.select(FILE_COL), FILE_COL, "left_anti")
        good, bad = ingest.split_marked(marked, file_atomic=file_atomic)
        if n_bad:
            cells = [c for c in good.columns if c not in (FILE_COL, ROW_COL)]
            out["quarantined"] += _quarantine(bad.select(FILE_COL, "reason", F.to_json(F.struct(*cells)).alias("row")), quarantine)
        stamped = good.drop(FILE_COL)
        if "created_at" in schema.fieldNames():
            at = C.ts_lit(now) if now else F.current_timestamp().cast("timestamp_ntz")
            stamped = stamped.withColumn("created_at", at)
        out["added"] = log.append(stamped)
        return out


def _quarantine(rows: DataFrame, path: str) -> int:
    """Append to the quarantine table; how many rows."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def ingest_files(spark: SparkSession, files: list[str], log: LogStore, quarantine: str, cfg: YieldConfig = DEFAULT,
                 kind: str = "workstation", now: _dt.datetime | None = None, file_atomic: bool = False) -> dict[str, int]:
    """Report files of any kind into the log; a file that cannot be read is one quarantine row, the others are loaded."""
    scan = reports.scan_files(spark, files, column_names(kind))
    out = {"rows_read": 0, "added": 0, "quarantined": 0}
    if scan.errors is not None:
        broken = scan.errors.select(FILE_COL, "reason", F.lit(None).cast("string").alias("row"))
        with session.Cuts(spark) as cuts:
            broken = cuts.cut(broken, "broken")
            if broken.take(1):
                out["quarantined"] = _quarantine(broken, quarantine)
    if scan.rows is not None:
        for k, v in ingest_rows(scan.rows, log, quarantine, cfg, kind, now, file_atomic, scan.expected).items():
            out[k] += v
    return out


def file_stream(spark: SparkSession, drop_dir: str, max_files_per_trigger: int = 100) -> DataFrame:
    """New file names in the drop directory; the contents are read by each batch, by header."""
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp, length long, content binary")
            .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", str(max_files_per_trigger))
            .load(drop_dir).select("path"))


def start_report_ingest(spark: SparkSession, drop_dir: str, log_path: str, checkpoint: str,
                        available_now: bool = True, processing_time: str = "10 seconds",
                        on_batch: Callable[[int, dict[str, int]], None] | None = None, kind: str = "workstation",
                        quarantine: str | None = None, max_files_per_trigger: int = 100, file_atomic: bool = False,
                        now: _dt.datetime | None = None):
    """Start the file-drop import stream for one log kind (I1); returns the StreamingQuery.

    ``on_batch`` gets the batch number and its counts; rejected rows go to
    ``quarantine`` (by default the log's folder name with ``_quarantine``).
    """
    log = LogStore(spark, log_path, schemas.LOGS[kind][1])
    rejected = quarantine or f"{log.path}_quarantine"

    def fn(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.collect()]  # at most max_files_per_trigger names
        n = ingest_files(spark, files, log, rejected, kind=kind, file_atomic=file_atomic, now=now) if files else {}
        if on_batch:
            on_batch(batch_id, n)

    w = (file_stream(spark, drop_dir, max_files_per_trigger).writeStream.foreachBatch(fn)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def dedup_within_watermark(stream: DataFrame, keys=schemas.WORKSTATION_KEY, delay: str = "2 days") -> DataFrame:
    """Drop re-delivered copies that arrive within ``delay`` of each other (I2), bounded state.

    Watermarks need TIMESTAMP (not NTZ); with the session zone at UTC the
    cast keeps the wall-clock value.
    """
    ev = stream.withColumn("event_time", F.col(C.END).cast("timestamp"))
    return ev.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_station_counts(stream: DataFrame, size: str = "1 hour", delay: str = "2 days") -> DataFrame:
    """Station visits per tumbling window (I4). ``size='7 days'`` gives ISO weeks (windows start Mondays)."""
    ev = stream.withColumn("event_time", F.col(C.END).cast("timestamp")).withWatermark("event_time", delay)
    start = "4 days" if size == "7 days" else None  # the epoch was a Thursday
    win = F.window("event_time", size, startTime=start) if start else F.window("event_time", size)
    return ev.groupBy(win.alias("w"), C.STATION).agg(F.count(F.lit(1)).alias("part_count")).select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), C.STATION, "part_count")


def _source_days(touched_days: list) -> list:
    """Log days needed to recompute the folded packing days of ``touched_days``: a touched
    Friday, Saturday or Sunday needs all three (the fold maps them onto Friday, Q5)."""
    out = set()
    for d in touched_days:
        friday = d - _dt.timedelta(days=max(d.weekday() - 4, 0))
        if friday.weekday() == 4:
            out.update(friday + _dt.timedelta(days=i) for i in range(3))
        else:
            out.add(d)
    return sorted(out)


def on_days(log: DataFrame, days: list[_dt.date]) -> DataFrame:
    from ..sources.logstore import PARTITION_COL
    day = F.col(PARTITION_COL) if PARTITION_COL in log.columns else C.to_day(C.END)
    return log.filter(day.isin(days))


def kpi_table(spark: SparkSession, root: str, name: str) -> PeriodTable:
    period, kind = schemas.KPI_PERIODS[name]
    return PeriodTable(spark, f"{root.rstrip('/')}/{name}", schemas.KPI_TABLES[name], period, kind, schemas.KPI_NULL_KEYS)


def first_activity_table(spark: SparkSession, root: str) -> FirstActivity:
    return FirstActivity(spark, f"{root.rstrip('/')}/first_activity")


def refresh_kpis(batch: DataFrame, log: DataFrame, out_root: str, cfg: YieldConfig = DEFAULT,
                 now: _dt.datetime | None = None, also_weeks: Sequence[_dt.date] = ()) -> dict[str, int]:
    """Late data (I3): recompute what ``batch`` (rows already in ``log``) can change, and upsert it; rows written per table.

    The moves of first activities are found by a join with the kept ones and written last, so a run that fails finds the
    same moves again. ``start_kpi_refresh`` keeps them as state of a stream instead.
    """
    spark = log.sparkSession
    firsts = first_activity_table(spark, out_root)
    with session.Cuts(spark) as cuts:
        moves = cuts.cut(firsts.moves(cuts.cut(tpy.first_activity(tpy.prod(batch, cfg)), "first")), "moves")
        days = [r[0] for r in batch.select(C.to_day(C.END)).distinct().collect() if r[0] is not None]
        name = uuid.uuid4().hex
        out = refresh_touched(log, out_root, days, moves, firsts, name, cfg, now, also_weeks)
        if moves.take(1):
            firsts.add(moves, name)
    return out


def refresh_touched(log: DataFrame, out_root: str, days: Sequence[_dt.date], moves: DataFrame, firsts: FirstActivity,
                    batch: str, cfg: YieldConfig = DEFAULT, now: _dt.datetime | None = None,
                    also_weeks: Sequence[_dt.date] = ()) -> dict[str, int]:
    """Recompute the KPI rows that depend on ``days`` and on first activities that ``moves`` changes.

    * The weeks are those of the days, and both weeks of every first activity that moves. The log is read for them alone
      (partition pruning on ``end_date``), and so are the first activities (folders by week); lists of days and weeks are
      bounded by the calendar.
    * Packing re-computes a touched weekend together with its Friday, so the upsert never replaces a full count with a
      partial one (Q5).
    """
    spark = log.sparkSession
    at = C.ts_lit(now) if now else F.current_timestamp().cast("timestamp_ntz")
    moved = [r[0] for r in moves.select(C.week_start("first_activity_time")).distinct().collect()]
    days = sorted(days)
    weeks = sorted({*moved, *also_weeks, *(tpy.week_of(d) for d in days)})
    if not weeks:
        return {}
    with session.Cuts(spark) as cuts:
        week_days = [w + _dt.timedelta(days=i) for w in weeks for i in range(7)]
        part = on_days(log, week_days)
        ud, sd = cuts.cut(tpy.unit_day(part, cfg), "unit_day"), cuts.cut(tpy.station_day(part, cfg), "station_day")
        kept = cuts.cut(firsts.read(weeks, moves, batch), "first_activity")
        daily = cuts.cut(tpy.tpy_daily(sd, tpy.starters_by_week(kept)), "daily")
        folded = {d - _dt.timedelta(days=max(d.weekday() - 4, 0)) for d in week_days if d in set(days)}
        out = {
            "daily_tpy_metrics": kpi_table(spark, out_root, "daily_tpy_metrics").upsert(daily.withColumn("created_at", at)),
            "daily_completions": kpi_table(spark, out_root, "daily_completions").upsert(tpy.daily_completions(ud, kept)),
            "weekly_tpy_metrics": kpi_table(spark, out_root, "weekly_tpy_metrics").upsert(
                tpy.tpy_weekly(ud, sd, cfg).withColumn("created_at", at)),
        }
        if days:
            out["station_hourly_summary"] = kpi_table(spark, out_root, "station_hourly_summary").upsert(
                station.station_hourly(on_days(log, days)))
            out["packing_daily_summary"] = kpi_table(spark, out_root, "packing_daily_summary").upsert(
                packing.packing_daily(on_days(log, _source_days(days)), cfg).filter(F.col("pack_date").isin(sorted(folded))))
    return out


def _log_stream(spark: SparkSession, log_path: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(spark.read.parquet(log_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(log_path)


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = writer.option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def start_kpi_refresh(spark: SparkSession, log_path: str, out_root: str, checkpoint: str, available_now: bool = True,
                      cfg: YieldConfig = DEFAULT, now: _dt.datetime | None = None, max_files_per_trigger: int | None = None):
    """Stream over the log directory; each batch refreshes the KPI rows that it can change.

    First activities are the state of the stream, one value per unit: a batch looks up its own units, however many there
    are in all. Their moves are written beside the state, in the checkpoint folder, as both live and die together; a batch
    that runs again writes the same moves in the same place.
    """
    firsts = FirstActivity(spark, f"{checkpoint.rstrip('/')}/first_activity_moves")

    def fn(events: DataFrame, batch_id: int) -> None:
        with session.Cuts(spark) as cuts:
            events = cuts.cut(events, "events")
            moves, days = units.moves(events), [r[0] for r in units.touched_days(events).collect()]
            refresh_touched(spark.read.parquet(log_path), out_root, days, moves, firsts, str(batch_id), cfg, now)
            if moves.take(1):
                firsts.add(moves, str(batch_id))

    events = units.unit_events(_log_stream(spark, log_path, max_files_per_trigger), cfg)
    return _start(events.writeStream.outputMode("update").foreachBatch(fn), checkpoint, available_now)


def start_station_hourly(spark: SparkSession, log_path: str, out_root: str, checkpoint: str, available_now: bool = True,
                         delay: str = "2 days", name: str = "station_hourly_summary", max_files_per_trigger: int | None = None):
    """Hourly station counts from a growing log into their KPI table.

    Update mode: a batch hands over the windows that it changed, with their whole counts, and these are upserted, so a
    batch that runs again changes nothing. Rows later than ``delay`` behind the newest are not counted by the stream;
    ``start_kpi_refresh`` counts their days again from the log.
    """
    def fn(windows: DataFrame, batch_id: int) -> None:
        rows = windows.select(F.to_date("window_start").alias("date"), F.hour("window_start").cast("int").alias("hour"),
                              C.STATION, "part_count")
        kpi_table(spark, out_root, name).upsert(rows)

    counts = windowed_station_counts(_log_stream(spark, log_path, max_files_per_trigger), "1 hour", delay)
    return _start(counts.writeStream.outputMode("update").foreachBatch(fn), checkpoint, available_now)
