"""Registered queries: report ingest, de-duplication, key checks, schema evolution, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as C
from ..operators import dedup, ingest, packing
from ..sources import fixtures as fx
from ..sources import sinks
from .catalog import register
from .oracle_views import with_views

KEY = list(schemas.WORKSTATION_KEY)
TB_KEY = list(schemas.TESTBOARD_KEY)
_K = ", ".join(KEY)
_TBK = ", ".join(TB_KEY)


def _nse(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


def _conformed(spark, sf_dir, fallback: bool = True):
    return ingest.conform(fx.workstation_report(spark, sf_dir), schemas.WORKSTATION_LOG, "workstation",
                          start_falls_back_to_end=fallback)


@register("ingest_conform", with_views("wl_conf", "SELECT * FROM wl_conf"))
def q_ingest_conform(spark, sf_dir):
    return _conformed(spark, sf_dir)


@register("clean_strings", with_views("wl_report", """
SELECT row_ordinal,
  CASE WHEN trim("Operator") = '' THEN NULL ELSE "Operator" END AS operator_kept,
  NULLIF(trim("Operator"), '') AS operator,
  NULLIF(trim("Customer PN"), '') AS customer_pn,
  CASE WHEN trim("Service-Flow") IN ('', 'nan', 'NaT', 'None') THEN NULL ELSE trim("Service-Flow") END AS service_flow
FROM wl_report"""))
def q_clean_strings(spark, sf_dir):
    r = fx.workstation_report(spark, sf_dir)
    return r.select("row_ordinal",
                    C.blank_to_null("Operator").alias("operator_kept"),
                    C.strip_to_null("Operator").alias("operator"),
                    C.strip_to_null("Customer PN").alias("customer_pn"),
                    C.strip_to_null("Service-Flow", ("nan", "NaT", "None")).alias("service_flow"))


@register("parse_times", with_views("wl_report", """
SELECT row_ordinal,
  TRY_CAST(NULLIF(trim("History Station Start Time"), '') AS TIMESTAMP) AS history_station_start_time,
  TRY_CAST(NULLIF(trim("History Station End Time"), '') AS TIMESTAMP) AS history_station_end_time,
  TRY_CAST(NULLIF(trim("First Station Start Time"), '') AS TIMESTAMP) AS first_station_start_time
FROM wl_report"""))
def q_parse_times(spark, sf_dir):
    r = fx.workstation_report(spark, sf_dir)
    return r.select("row_ordinal",
                    C.parse_ts("History Station Start Time").alias("history_station_start_time"),
                    C.parse_ts("History Station End Time").alias("history_station_end_time"),
                    C.parse_ts("First Station Start Time").alias("first_station_start_time"))


@register("clean_start_time", with_views("wl_conf", """
SELECT row_ordinal, history_station_start_time FROM wl_conf"""))
def q_clean_start_time(spark, sf_dir):
    return _conformed(spark, sf_dir).select("row_ordinal", C.START)


@register("ingest_infile_dedup", with_views("wl_conf", f"""
SELECT * FROM wl_conf
QUALIFY row_number() OVER (PARTITION BY source_file, {_K} ORDER BY row_ordinal) = 1"""))
def q_ingest_infile_dedup(spark, sf_dir):
    return ingest.infile_dedup(_conformed(spark, sf_dir), KEY)


@register("ingest_quarantine", with_views("wl_conf_raw", """
SELECT *, CASE WHEN sn IS NULL THEN 'null sn' WHEN workstation_name IS NULL THEN 'null workstation_name'
               WHEN history_station_start_time IS NULL THEN 'null history_station_start_time'
               WHEN history_station_end_time IS NULL THEN 'null history_station_end_time' END AS reason
FROM wl_conf_raw
WHERE sn IS NULL OR workstation_name IS NULL OR history_station_start_time IS NULL OR history_station_end_time IS NULL"""))
def q_ingest_quarantine(spark, sf_dir):
    # Without the start-time fallback, blank start cells break NOT NULL (Q21).
    _, bad = ingest.quarantine_split(_conformed(spark, sf_dir, fallback=False),
                                     ["sn", "workstation_name", C.START, C.END])
    return bad


@register("quarantine_file_scope", with_views("wl_conf_raw", """
t AS (SELECT *, CASE WHEN sn IS NULL THEN 'null sn' WHEN workstation_name IS NULL THEN 'null workstation_name'
               WHEN history_station_start_time IS NULL THEN 'null history_station_start_time'
               WHEN history_station_end_time IS NULL THEN 'null history_station_end_time' END AS why FROM wl_conf_raw)
SELECT * EXCLUDE (why), coalesce(why, 'file rejected') AS reason FROM t
WHERE source_file IN (SELECT source_file FROM t WHERE why IS NOT NULL)"""))
def q_quarantine_file_scope(spark, sf_dir):
    # One bad row rejects its file: what a loader with a rollback per file keeps out.
    return ingest.quarantine_split(_conformed(spark, sf_dir, fallback=False),
                                   ["sn", "workstation_name", C.START, C.END], file_atomic=True)[1]


def _log_as_report(view: str, kind: str, schema) -> str:
    names = ", ".join(f.name for f in schema.fields if f.name not in ("id", "created_at", "data_source"))
    return with_views(view, f"""
SELECT {names}, '{kind}' AS data_source, '{kind}_' || concat(CAST(isoyear(history_station_end_time) AS VARCHAR), '-W',
  lpad(CAST(week(history_station_end_time) AS VARCHAR), 2, '0')) || '.csv' AS source_file, id AS row_ordinal FROM {view}""")


@register("ingest_conform_testboard", _log_as_report("tb", "testboard", schemas.TESTBOARD_LOG))
def q_ingest_conform_testboard(spark, sf_dir):
    return ingest.conform(fx.testboard_report(spark, sf_dir), schemas.TESTBOARD_LOG, "testboard")


@register("ingest_conform_snfn", _log_as_report("sf", "snfn", schemas.SNFN_LOG))
def q_ingest_conform_snfn(spark, sf_dir):
    return ingest.conform(fx.snfn_report(spark, sf_dir), schemas.SNFN_LOG, "snfn")


@register("parse_time_shapes", with_views("wl", """
SELECT id, CASE id % 4 WHEN 0 THEN date_trunc('second', history_station_end_time)
  WHEN 1 THEN date_trunc('minute', history_station_end_time) WHEN 2 THEN date_trunc('second', history_station_end_time)
  ELSE history_station_end_time END AS parsed FROM wl"""))
def q_parse_time_shapes(spark, sf_dir):
    # The end time written with AM/PM, month first, year first with slashes, and ISO.
    end, k = F.col(C.END), F.col("id") % 4
    text = (F.when(k == 0, F.date_format(end, "M/d/yyyy h:mm:ss a")).when(k == 1, F.date_format(end, "M/d/yyyy HH:mm"))
            .when(k == 2, F.date_format(end, "yyyy/MM/dd HH:mm:ss")).otherwise(F.date_format(end, fx.TS_TEXT)))
    return fx.workstation_log(spark, sf_dir).select("id", C.parse_ts(text).alias("parsed"))


@register("ingest_new_rows", with_views("wl_old wl_new", f"""
SELECT * FROM wl_new n WHERE NOT EXISTS (SELECT 1 FROM wl_old o WHERE {_nse('o', 'n', KEY)})"""))
def q_ingest_new_rows(spark, sf_dir):
    return ingest.new_rows(fx.workstation_new(spark, sf_dir), fx.workstation_old(spark, sf_dir), KEY)


@register("ingest_insert_ignore", with_views("wl_conf wl_old", f"""
SELECT * FROM wl_conf c
WHERE NOT EXISTS (SELECT 1 FROM wl_old o WHERE {_nse('o', 'c', KEY)})
QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY row_ordinal) = 1"""))
def q_ingest_insert_ignore(spark, sf_dir):
    return ingest.insert_ignore(_conformed(spark, sf_dir), fx.workstation_old(spark, sf_dir), KEY)


@register("ingest_load_report", with_views("wl_conf wl_old", f"""
lk AS (SELECT DISTINCT {_K} FROM wl_old)
SELECT source_file, count(*) AS rows_read,
  count(*) FILTER (WHERE EXISTS (SELECT 1 FROM lk WHERE {_nse('lk', 'c', KEY)})) AS existing_rows,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM lk WHERE {_nse('lk', 'c', KEY)})) AS new_rows
FROM wl_conf c GROUP BY source_file"""))
def q_ingest_load_report(spark, sf_dir):
    return ingest.load_report(_conformed(spark, sf_dir), fx.workstation_old(spark, sf_dir), KEY)


@register("dedup_workstation", with_views("wl_raw", f"""
SELECT * FROM wl_raw QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY id) = 1"""))
def q_dedup_workstation(spark, sf_dir):
    return dedup.keep_first(fx.workstation_raw(spark, sf_dir), KEY)


@register("dedup_testboard", with_views("tb_raw", f"""
SELECT * FROM tb_raw QUALIFY row_number() OVER (PARTITION BY {_TBK} ORDER BY id) = 1"""))
def q_dedup_testboard(spark, sf_dir):
    return dedup.keep_first(fx.testboard_raw(spark, sf_dir), TB_KEY)


@register("dedup_report", with_views("wl_raw tb_raw", f"""
per AS (
  SELECT 'workstation_master_log' AS table_name, count(*) AS before_count,
         (SELECT count(*) FROM (SELECT DISTINCT {_K} FROM wl_raw)) AS after_count FROM wl_raw
  UNION ALL
  SELECT 'testboard_master_log', count(*), (SELECT count(*) FROM (SELECT DISTINCT {_TBK} FROM tb_raw)) FROM tb_raw)
SELECT table_name, before_count, before_count - after_count AS removed, after_count FROM per
UNION ALL
SELECT 'total', CAST(sum(before_count) AS BIGINT), CAST(sum(before_count - after_count) AS BIGINT),
       CAST(sum(after_count) AS BIGINT) FROM per"""))
def q_dedup_report(spark, sf_dir):
    return dedup.dedup_report([
        dedup.duplicate_counts(fx.workstation_raw(spark, sf_dir), KEY, "workstation_master_log"),
        dedup.duplicate_counts(fx.testboard_raw(spark, sf_dir), TB_KEY, "testboard_master_log"),
    ])


@register("key_violations", with_views("wl_raw", f"""
SELECT {_K}, count(*) AS n FROM wl_raw GROUP BY {_K} HAVING count(*) > 1"""))
def q_key_violations(spark, sf_dir):
    return dedup.key_violations(fx.workstation_raw(spark, sf_dir), KEY)


# The first layout of the log lacked four columns; old rows come back with NULLs there.
_LATE_COLUMNS = ("customer_pn", "outbound_version", "passing_station_method", "first_station_start_time")


@register("schema_evolve", with_views("wl_old wl_new", f"""
SELECT sn, pn, model, workstation_name, history_station_start_time, history_station_end_time,
  history_station_passing_status, operator, NULL::VARCHAR AS customer_pn, NULL::VARCHAR AS outbound_version, hours,
  service_flow, NULL::VARCHAR AS passing_station_method, NULL::TIMESTAMP AS first_station_start_time, data_source
FROM wl_old
UNION ALL BY NAME
SELECT {_K} FROM wl_new"""))
def q_schema_evolve(spark, sf_dir):
    old = fx.workstation_old(spark, sf_dir).drop(*_LATE_COLUMNS, "id", "created_at")
    new = fx.workstation_new(spark, sf_dir).drop("id", "created_at")
    merged = old.unionByName(new, allowMissingColumns=True)
    return ingest.conform(merged, schemas.WORKSTATION_LOG, keep=()).select(*[
        c for c in ("sn", "pn", "model", "workstation_name", "history_station_start_time",
                    "history_station_end_time", "history_station_passing_status", "operator", "customer_pn",
                    "outbound_version", "hours", "service_flow", "passing_station_method",
                    "first_station_start_time", "data_source")])


_PACK = """SELECT CAST(history_station_end_time AS DATE)
    - CAST(greatest(isodow(history_station_end_time) - 5, 0) AS INTEGER) AS pack_date,
  model, pn AS part_number, count(*) AS packed_count
FROM {src} WHERE workstation_name = 'PACKING' AND history_station_passing_status = 'Pass' GROUP BY ALL"""


@register("upsert_summary", with_views("wl_old wl_new", f"""
tgt AS ({_PACK.format(src='wl_old')}),
upd AS ({_PACK.format(src='wl_new')})
SELECT * FROM upd
UNION ALL
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE {_nse('u', 't', ['pack_date', 'model', 'part_number'])})"""))
def q_upsert_summary(spark, sf_dir):
    target = packing.packing_daily(fx.workstation_old(spark, sf_dir))
    updates = packing.packing_daily(fx.workstation_new(spark, sf_dir))
    return sinks.merge_upsert(target, updates, schemas.PACKING_DAILY_KEY)


@register("required_fields", with_views("wl", """
SELECT * FROM (VALUES ('sn', true, 'string'), ('model', true, 'string'), ('workstation_name', true, 'string'),
  ('history_station_end_time', true, 'timestamp_ntz'), ('history_station_passing_status', true, 'string'),
  ('service_flow', true, 'string')) f(field, present, data_type)
JOIN (SELECT 'sn' AS field, count(sn) AS non_null_rows FROM wl
      UNION ALL SELECT 'model', count(model) FROM wl
      UNION ALL SELECT 'workstation_name', count(workstation_name) FROM wl
      UNION ALL SELECT 'history_station_end_time', count(history_station_end_time) FROM wl
      UNION ALL SELECT 'history_station_passing_status', count(history_station_passing_status) FROM wl
      UNION ALL SELECT 'service_flow', count(service_flow) FROM wl) c USING (field)"""))
def q_required_fields(spark, sf_dir):
    from ..operators import profile
    return profile.required_fields(fx.workstation_log(spark, sf_dir), schemas.REQUIRED_WORKSTATION_FIELDS)

