"""Adapter views: the driver's ``events`` / ``lineitem`` tables re-shaped into
the three master logs (FIXTURES.md section 3).

Eight consecutive events form one unit's route (``sn`` = event_id div 8), so
every station, status and flow rule of the yield jobs is exercised at every
scale factor. Pure projections of the source scan: Spark prunes the unused
event columns and the adapters add no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ts_lit
from . import tables

# The re-export window that the duplicate-laden raw logs repeat,
# and the overlapping halves used as "old log" and "new report".
REEXPORT_FROM = _dt.datetime(2024, 1, 15)
REEXPORT_TO = _dt.datetime(2024, 1, 22)
OLD_BEFORE = _dt.datetime(2024, 1, 20)
NEW_FROM = _dt.datetime(2024, 1, 16)
REISSUE_ID_OFFSET = 1_000_000_000


def _unit(e: DataFrame) -> DataFrame:
    return e.withColumn("u", F.floor(F.col("event_id") / 8).cast("bigint"))


def _model(u: Column) -> Column:
    return (F.when(u % 3 == 0, "Tesla SXM4").when(u % 3 == 1, "Tesla SXM5").otherwise("OTHER"))


def _sn(u: Column) -> Column:
    return F.concat(F.lit("SN"), F.lpad(u.cast("string"), 8, "0"))


def workstation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _unit(tables.read(spark, sf_dir, "events"))
    u, k, ts = F.col("u"), (F.col("event_id") % 8).cast("int"), F.col("ts")
    station = (F.when(k == 0, "RECEIVE").when(k == 1, "VI2").when(k == 2, "ASSY2").when(k == 3, "BBD")
               .when(k == 4, "TEST").when(k == 5, "FI").when(k == 6, "FQC")
               .otherwise(F.when(u % 7 == 3, "REWORK").otherwise("PACKING")))
    status = (F.when(F.col("event_type") == "error", "Fail")
              .when((F.col("event_type") == "signup") & (F.col("value") < 2), F.lit(None))
              .otherwise("Pass"))
    flow = (F.when(u % 11 == 0, "NC Sort").when(u % 11 == 1, "RO").when(u % 11 == 2, F.lit(None))
            .otherwise("NORMAL"))
    return e.select(
        F.col("event_id").alias("id"),
        _sn(u).alias("sn"),
        F.concat(F.lit("PN"), (u % 5).cast("string")).alias("pn"),
        _model(u).alias("model"),
        station.alias("workstation_name"),
        (ts - F.expr("INTERVAL 5 MINUTES")).alias("history_station_start_time"),
        ts.alias("history_station_end_time"),
        status.cast("string").alias("history_station_passing_status"),
        F.concat(F.lit("OP"), F.col("user_id").cast("string")).alias("operator"),
        F.when(u % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), (u % 5).cast("string")))
        .cast("string").alias("customer_pn"),
        F.concat(F.lit("V"), (u % 3).cast("string")).alias("outbound_version"),
        k.cast("string").alias("hours"),
        flow.cast("string").alias("service_flow"),
        F.when(F.col("user_id") % 2 == 0, "AUTO").otherwise("MANUAL").alias("passing_station_method"),
        F.when(u % 6 == 0, F.lit(None)).otherwise(ts - F.expr("INTERVAL 1 HOUR"))
        .cast("timestamp_ntz").alias("first_station_start_time"),
        F.lit("workstation").alias("data_source"),
        (ts + F.expr("INTERVAL 1 DAY")).alias("created_at"),
    )


def testboard_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _unit(tables.read(spark, sf_dir, "events"))
    u, eid, uid, ts = F.col("u"), F.col("event_id"), F.col("user_id"), F.col("ts")
    is_err = F.col("event_type") == "error"
    return e.select(
        eid.alias("id"),
        _sn(u).alias("sn"),
        F.concat(F.lit("PN"), (u % 5).cast("string")).alias("pn"),
        _model(u).alias("model"),
        F.when(uid % 3 == 0, "FT").when(uid % 3 == 1, "BI").otherwise("PT").alias("work_station_process"),
        F.concat(F.lit("BB"), u.cast("string")).alias("baseboard_sn"),
        F.when(u % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit("BP"), (u % 4).cast("string")))
        .cast("string").alias("baseboard_pn"),
        F.concat(F.lit("TB"), (eid % 4).cast("string")).alias("workstation_name"),
        (ts - F.expr("INTERVAL 5 MINUTES")).alias("history_station_start_time"),
        ts.alias("history_station_end_time"),
        F.when(is_err, "Fail").when((F.col("event_type") == "signup") & (F.col("value") < 2), "Abort")
        .otherwise("Pass").alias("history_station_passing_status"),
        F.concat(F.lit("OP"), uid.cast("string")).alias("operator"),
        F.when(is_err, F.concat(F.lit("reason "), (eid % 7).cast("string"))).cast("string").alias("failure_reasons"),
        F.lit(None).cast("string").alias("failure_note"),
        F.when(is_err, F.concat(F.lit("E"), (eid % 7).cast("string"))).cast("string").alias("failure_code"),
        F.concat(F.lit("D"), (u % 2).cast("string")).alias("diag_version"),
        F.when(uid % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit("FX"), (uid % 12).cast("string")))
        .cast("string").alias("fixture_no"),
        F.lit("testboard").alias("data_source"),
        (ts + F.expr("INTERVAL 1 DAY")).alias("created_at"),
    )


def snfn_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    tb = testboard_log(spark, sf_dir)
    return tb.filter(F.col("history_station_passing_status") == "Fail").select(
        "id", "workstation_name", "fixture_no",
        F.col("failure_code").alias("error_code"), F.col("failure_reasons").alias("error_disc"),
        "model", "sn", "pn", "history_station_start_time", "history_station_end_time",
        F.lit("snfn").alias("data_source"),
    )


def _with_reexport(log: DataFrame) -> DataFrame:
    """The log plus a second copy of one re-exported week, under fresh ids."""
    end = F.col("history_station_end_time")
    again = (log.filter((end >= ts_lit(REEXPORT_FROM)) & (end < ts_lit(REEXPORT_TO)))
             .withColumn("id", F.col("id") + REISSUE_ID_OFFSET))
    return log.unionByName(again)


def workstation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reexport(workstation_log(spark, sf_dir))


def testboard_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reexport(testboard_log(spark, sf_dir))


def workstation_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows already in the log: everything that ended before OLD_BEFORE."""
    return workstation_log(spark, sf_dir).filter(F.col("history_station_end_time") < ts_lit(OLD_BEFORE))


def workstation_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incoming report that overlaps the log by four days."""
    return workstation_log(spark, sf_dir).filter(F.col("history_station_end_time") >= ts_lit(NEW_FROM))


def ship_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct calendar dates spanning several year ends (week-label checks)."""
    return tables.read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()


# Column headers of the exported workstation report, in export order.
WORKSTATION_REPORT_HEADERS = {
    "sn": "SN", "pn": "PN", "model": "Model", "workstation_name": "Workstation Name",
    "history_station_start_time": "History Station Start Time",
    "history_station_end_time": "History Station End Time",
    "history_station_passing_status": "History Station Passing Status",
    "operator": "Operator", "customer_pn": "Customer PN", "outbound_version": "Outbound Version",
    "hours": "Hours", "service_flow": "Service-Flow", "passing_station_method": "Passing Station Method",
    "first_station_start_time": "First Station Start Time",
}
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def workstation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log rendered as an exported report: text cells, human headers, one file per ISO week.

    Export artefacts reproduced: empty cells for NULL, the text ``nan`` for a
    missing service flow (old exports, Q1), padded operator cells, a blank
    start-time cell whenever the unit has no first-station time (start falls
    back to end, B25), and a ``Day`` column that differs between the two
    copies of re-exported rows (ignored by the in-file de-duplication, E4).
    """
    raw = workstation_raw(spark, sf_dir)
    end = F.col("history_station_end_time")
    cells = []
    for name, header in WORKSTATION_REPORT_HEADERS.items():
        c = F.col(name)
        if name.endswith("_time"):
            text = F.date_format(c, TS_TEXT)
            if name == "history_station_start_time":
                text = F.when(F.col("first_station_start_time").isNull(), F.lit("")).otherwise(text)
        elif name == "service_flow":
            text = F.coalesce(c, F.lit("nan"))
        elif name == "operator":
            text = F.concat(F.lit(" "), c, F.lit("  "))
        else:
            text = c
        cells.append(F.coalesce(text, F.lit("")).alias(header))
    day = F.when(F.col("id") >= REISSUE_ID_OFFSET, F.date_format("created_at", "yyyy-MM-dd")) \
        .otherwise(F.date_format(end, "yyyy-MM-dd"))
    from ..functions.columns import iso_week_label
    return raw.select(*cells, day.alias("Day"),
                      F.concat(F.lit("workstation_"), iso_week_label(end), F.lit(".csv")).alias("source_file"),
                      F.col("id").alias("row_ordinal"))


def _text_report(log: DataFrame, schema, kind: str) -> DataFrame:
    """A log rendered as an exported report: text cells under human headers, one file per ISO week."""
    from ..functions.columns import iso_week_label
    names = [f.name for f in schema.fields if f.name not in ("id", "created_at", "data_source")]
    cells = [F.coalesce(F.date_format(n, TS_TEXT) if n.endswith("_time") else F.concat(F.lit(" "), n), F.lit("")).alias(
        n.replace("_", " ").title()) for n in names]
    return log.select(*cells, F.concat(F.lit(f"{kind}_"), iso_week_label("history_station_end_time"), F.lit(".csv")).alias(
        "source_file"), F.col("id").alias("row_ordinal"))


def testboard_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .. import schemas
    return _text_report(testboard_log(spark, sf_dir), schemas.TESTBOARD_LOG, "testboard")


def snfn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .. import schemas
    return _text_report(snfn_log(spark, sf_dir), schemas.SNFN_LOG, "snfn")
