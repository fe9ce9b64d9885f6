"""Registered queries: profiles, health, freshness and diagnostics."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from .. import config, schemas
from ..functions import columns as C
from ..operators import profile, sketches, tpy
from ..sources import fixtures as fx
from .catalog import register
from .oracle_views import with_views
from .sqltext import END, pct2

AS_OF = config.FIXTURE_AS_OF
NOW = _dt.datetime.combine(AS_OF, _dt.time(12, 0))  # "NOW()" of the recency report


def _logs(spark, sf_dir):
    return {"workstation_master_log": fx.workstation_log(spark, sf_dir),
            "testboard_master_log": fx.testboard_log(spark, sf_dir),
            "snfn_master_log": fx.snfn_log(spark, sf_dir)}


@register("record_counts", with_views("wl tb sf prod", f"""
logs AS (SELECT 'workstation_master_log' AS table_name, count(*) AS total_records, count(DISTINCT sn) AS unique_sn FROM wl
UNION ALL SELECT 'testboard_master_log', count(*), count(DISTINCT sn) FROM tb
UNION ALL SELECT 'snfn_master_log', count(*), count(DISTINCT sn) FROM sf)
SELECT * FROM logs
UNION ALL SELECT 'total', CAST(sum(total_records) AS BIGINT), NULL FROM logs
UNION ALL SELECT 'daily_tpy_metrics', count(*), NULL FROM (
  SELECT DISTINCT CAST({END} AS DATE), model, workstation_name FROM prod WHERE model IN ('Tesla SXM4', 'Tesla SXM5'))
UNION ALL SELECT 'weekly_tpy_metrics', count(DISTINCT date_trunc('week', {END})), NULL FROM prod
  WHERE model IN ('Tesla SXM4', 'Tesla SXM5')"""))
def q_record_counts(spark, sf_dir):
    daily = tpy.station_day(fx.workstation_log(spark, sf_dir))  # the rows of the daily and weekly KPI tables
    weekly = daily.select(C.week_start("date_id")).distinct()
    return profile.record_counts(_logs(spark, sf_dir), kpis={"daily_tpy_metrics": daily, "weekly_tpy_metrics": weekly})


@register("recent_activity", with_views("wl tb", """
SELECT 'workstation_master_log' AS table_name, count(*) AS recent_records FROM wl
  WHERE created_at >= TIMESTAMP '2024-01-19 12:00:00' - INTERVAL 24 HOURS
UNION ALL SELECT 'testboard_master_log', count(*) FROM tb
  WHERE created_at >= TIMESTAMP '2024-01-19 12:00:00' - INTERVAL 24 HOURS"""))
def q_recent_activity(spark, sf_dir):
    logs = _logs(spark, sf_dir)
    logs.pop("snfn_master_log")  # the snfn log carries no created_at
    return profile.recent_activity(logs, NOW)


@register("freshness_report", with_views("wl tb sf prod", f"""
sd AS (SELECT DISTINCT CAST({END} AS DATE) AS date_id, model, workstation_name FROM prod
       WHERE model IN ('Tesla SXM4', 'Tesla SXM5'))
SELECT 'daily_tpy_metrics' AS table_name, CAST(min(date_id) AS TIMESTAMP) AS earliest,
  CAST(max(date_id) AS TIMESTAMP) AS latest, count(*) FILTER (WHERE date_id = DATE '2024-01-19') AS rows_on_as_of
FROM sd
UNION ALL SELECT 'weekly_tpy_metrics', CAST(min(date_trunc('week', date_id)) AS TIMESTAMP), CAST(max(date_trunc('week', date_id)) AS TIMESTAMP),
  count(DISTINCT date_trunc('week', date_id)) FILTER (WHERE date_trunc('week', date_id) + INTERVAL 7 DAY >= TIMESTAMP '2024-01-19') FROM sd
UNION ALL SELECT 'workstation_master_log', min({END}), max({END}),
  count(*) FILTER (WHERE CAST({END} AS DATE) = DATE '2024-01-19') FROM wl WHERE {END} IS NOT NULL
UNION ALL SELECT 'testboard_master_log', min({END}), max({END}),
  count(*) FILTER (WHERE CAST({END} AS DATE) = DATE '2024-01-19') FROM tb WHERE {END} IS NOT NULL
UNION ALL SELECT 'snfn_master_log', min({END}), max({END}),
  count(*) FILTER (WHERE CAST({END} AS DATE) = DATE '2024-01-19') FROM sf WHERE {END} IS NOT NULL"""))
def q_freshness_report(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    daily = tpy.station_day(wl)  # the daily KPI table's rows (date, model, station)
    # weekly rows as if each were created on the Monday after its week
    weekly = daily.select(C.week_start("date_id").alias("week_start")).distinct().withColumn(
        "created_at", F.date_add("week_start", 7).cast("timestamp_ntz"))
    return profile.freshness_report(_logs(spark, sf_dir), daily, AS_OF, weekly)


@register("date_profile", with_views("prod", f"""
SELECT CAST({END} AS DATE) AS test_date, count(*) AS production_records,
  count(CASE WHEN workstation_name = 'PACKING' THEN 1 END) AS packing_records,
  count(DISTINCT sn) AS unique_parts, count(DISTINCT workstation_name) AS unique_stations
FROM prod GROUP BY 1"""))
def q_date_profile(spark, sf_dir):
    return profile.date_profile(fx.workstation_log(spark, sf_dir))


@register("unit_ranges", with_views("prod", f"""
r AS (SELECT DISTINCT k.kind AS range_kind, CAST(date_trunc(k.kind, {END}) AS DATE) AS range_start, sn
  FROM prod, (VALUES ('week'), ('month')) k(kind) WHERE {END} IS NOT NULL AND sn IS NOT NULL),
n AS (SELECT k.kind AS range_kind, CAST(date_trunc(k.kind, {END}) AS DATE) AS range_start, count(*) AS production_records,
    count(CASE WHEN workstation_name = 'PACKING' THEN 1 END) AS packing_records
  FROM prod, (VALUES ('week'), ('month')) k(kind) WHERE {END} IS NOT NULL GROUP BY ALL),
u AS (SELECT r.range_kind, r.range_start, count(*) AS unique_parts, count(b.sn) AS returning_parts
  FROM r LEFT JOIN r b ON b.sn = r.sn AND b.range_kind = r.range_kind AND r.range_start =
    CASE b.range_kind WHEN 'week' THEN b.range_start + 7 ELSE CAST(b.range_start + INTERVAL 1 MONTH AS DATE) END
  GROUP BY ALL)
SELECT range_kind, range_start, production_records, packing_records, unique_parts, returning_parts
FROM n JOIN u USING (range_kind, range_start)"""))
def q_unit_ranges(spark, sf_dir):
    # A sketch is exact up to 65,536 units a range; beyond, this query is an estimate (0.4 % standard error).
    return sketches.unit_ranges(sketches.unit_sketches(fx.workstation_log(spark, sf_dir)))


@register("date_top_stations", with_views("prod", f"""
SELECT CAST({END} AS DATE) AS test_date, workstation_name, count(*) AS n,
  row_number() OVER (PARTITION BY CAST({END} AS DATE) ORDER BY count(*) DESC, workstation_name) AS rank
FROM prod GROUP BY 1, 2 QUALIFY rank <= {config.TOP_STATIONS_DATE}"""))
def q_date_top_stations(spark, sf_dir):
    return profile.date_top_stations(fx.workstation_log(spark, sf_dir), config.TOP_STATIONS_DATE)


@register("date_model_counts", with_views("prod", f"""
SELECT CAST({END} AS DATE) AS test_date, model, count(*) AS record_count FROM prod GROUP BY ALL"""))
def q_date_model_counts(spark, sf_dir):
    return profile.date_model_counts(fx.workstation_log(spark, sf_dir))


@register("busy_dates", with_views("prod", f"""
SELECT CAST({END} AS DATE) AS test_date, count(*) AS record_count, count(DISTINCT sn) AS unique_parts,
  count(CASE WHEN workstation_name = 'PACKING' THEN 1 END) AS packing_records
FROM prod WHERE {END} IS NOT NULL GROUP BY 1 HAVING count(*) >= {config.BUSY_DATE_MIN_ROWS}
ORDER BY record_count DESC, test_date LIMIT {config.TOP_BUSY_DATES}"""))
def q_busy_dates(spark, sf_dir):
    return profile.busy_dates(fx.workstation_log(spark, sf_dir), config.BUSY_DATE_MIN_ROWS, config.TOP_BUSY_DATES)


@register("flow_station_profile", with_views("wl", """
SELECT service_flow, workstation_name, count(*) AS record_count FROM wl WHERE service_flow IS NOT NULL GROUP BY ALL"""))
def q_flow_station_profile(spark, sf_dir):
    return profile.flow_station_profile(fx.workstation_log(spark, sf_dir))


@register("day_flow_profile", with_views("wl", f"""
SELECT CAST({END} AS DATE) AS test_date, service_flow, count(*) AS record_count
FROM wl WHERE service_flow IS NOT NULL GROUP BY ALL"""))
def q_day_flow_profile(spark, sf_dir):
    return profile.day_flow_profile(fx.workstation_log(spark, sf_dir))


@register("top_station_yield", with_views("prod", f"""
a AS (
SELECT CAST({END} AS DATE) AS test_date, workstation_name, model, count(*) AS total_parts,
  count(CASE WHEN history_station_passing_status = 'Pass' THEN 1 END) AS passed_parts,
  count(CASE WHEN history_station_passing_status <> 'Pass' THEN 1 END) AS failed_parts
FROM prod GROUP BY ALL HAVING count(*) >= {config.MIN_STATION_YIELD_ROWS})
SELECT *, {pct2('passed_parts', 'total_parts')} AS throughput_yield,
  row_number() OVER (PARTITION BY test_date ORDER BY total_parts DESC, workstation_name, model) AS rank
FROM a QUALIFY rank <= {config.TOP_STATION_YIELD}"""))
def q_top_station_yield(spark, sf_dir):
    return profile.top_station_yield(fx.workstation_log(spark, sf_dir), config.TOP_STATION_YIELD,
                                     config.MIN_STATION_YIELD_ROWS)


_QP = """
SELECT 'model' AS field, model AS value, count(*) AS record_count FROM wl WHERE model IS NOT NULL GROUP BY 2
UNION ALL
SELECT 'service_flow', service_flow, count(*) FROM wl
  WHERE service_flow IS NOT NULL AND service_flow NOT IN ('NC Sort', 'RO') GROUP BY 2
UNION ALL
SELECT 'workstation_name', workstation_name, count(*) FROM wl
  WHERE workstation_name IS NOT NULL AND service_flow NOT IN ('NC Sort', 'RO') GROUP BY 2
UNION ALL
SELECT 'history_station_passing_status', history_station_passing_status, count(*) FROM wl
  WHERE history_station_passing_status IS NOT NULL AND service_flow NOT IN ('NC Sort', 'RO') GROUP BY 2"""


@register("quality_profile", with_views("wl", f"""
f AS ({_QP})
SELECT field, value, record_count, row_number() OVER (PARTITION BY field ORDER BY record_count DESC, value) AS rank
FROM f
QUALIFY (field = 'service_flow' AND rank <= {config.TOP_FLOWS})
     OR (field = 'workstation_name' AND rank <= {config.TOP_PROFILE_STATIONS})
     OR field IN ('model', 'history_station_passing_status')"""))
def q_quality_profile(spark, sf_dir):
    return profile.quality_profile(fx.workstation_log(spark, sf_dir), config.TOP_FLOWS, config.TOP_PROFILE_STATIONS)


@register("profile_stations", with_views("wl", f"""
SELECT workstation_name, count(*) AS record_count FROM wl
WHERE workstation_name IS NOT NULL AND service_flow NOT IN ('NC Sort', 'RO')
GROUP BY 1 ORDER BY record_count DESC, workstation_name LIMIT {config.TOP_PROFILE_STATIONS}"""))
def q_profile_stations(spark, sf_dir):
    qp = profile.quality_profile(fx.workstation_log(spark, sf_dir), config.TOP_FLOWS, config.TOP_PROFILE_STATIONS)
    return (qp.filter(F.col("field") == C.STATION)
            .select(F.col("value").alias(C.STATION), "record_count"))


@register("service_flows", with_views("wl", """
SELECT DISTINCT service_flow FROM wl WHERE service_flow IS NOT NULL"""))
def q_service_flows(spark, sf_dir):
    return fx.workstation_log(spark, sf_dir).filter(F.col(C.FLOW).isNotNull()).select(C.FLOW).distinct()


@register("receive_by_hour", with_views("wl", f"""
SELECT sn, {END}, CAST(hour({END}) AS INTEGER) AS hour FROM wl
WHERE workstation_name = 'RECEIVE' AND hour({END}) >= 20 AND hour({END}) < 24"""))
def q_receive_by_hour(spark, sf_dir):
    return profile.receive_by_hour(fx.workstation_log(spark, sf_dir), config.RECEIVE_BAND_HOURS)


@register("unit_lookup", with_views("wl sf", """
SELECT * FROM wl WHERE sn IN (SELECT sn FROM sf)"""))
def q_unit_lookup(spark, sf_dir):
    # Units with a test-board failure: their full workstation history.
    return profile.unit_lookup(fx.workstation_log(spark, sf_dir), fx.snfn_log(spark, sf_dir))


def _nse(a, b, keys):
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


_KEY = list(schemas.WORKSTATION_KEY)
_FOUR = ["sn", "pn", "model", "workstation_name"]


@register("match_diagnostics", with_views("wl_old wl_new", f"""
SELECT n.id,
  (SELECT count(*) FROM wl_old o WHERE {_nse('o', 'n', _KEY)}) AS exact_matches,
  (SELECT count(*) FROM wl_old o WHERE o.sn IS NOT DISTINCT FROM n.sn) AS sn_matches,
  (SELECT count(*) FROM wl_old o WHERE {_nse('o', 'n', _FOUR)}) AS four_col_matches
FROM wl_new n"""))
def q_match_diagnostics(spark, sf_dir):
    from .. import schemas
    return profile.match_diagnostics(fx.workstation_new(spark, sf_dir), fx.workstation_old(spark, sf_dir),
                                     schemas.WORKSTATION_KEY)


@register("sample_station_yield", with_views("prod", f"""
a AS (
SELECT workstation_name, model, count(*) AS total_parts,
  count(CASE WHEN history_station_passing_status = 'Pass' THEN 1 END) AS passed_parts,
  count(CASE WHEN history_station_passing_status <> 'Pass' THEN 1 END) AS failed_parts
FROM prod WHERE model IN ('Tesla SXM4', 'Tesla SXM5') GROUP BY ALL)
SELECT *, {pct2('passed_parts', 'total_parts')} AS throughput_yield FROM a
ORDER BY total_parts DESC, workstation_name, model LIMIT {config.TOP_SAMPLE_YIELD}"""))
def q_sample_station_yield(spark, sf_dir):
    # Top-k is the feature here: the sample of the tracked models' busiest stations.
    return profile.top_station_yield(fx.workstation_log(spark, sf_dir), config.TOP_SAMPLE_YIELD, 1, per_date=False,
                                     tracked_only=True)


def _lookup_oracle(keys):
    return with_views("wl sf", f"SELECT * FROM wl WHERE ({', '.join(keys)}) IN (SELECT {', '.join(keys)} FROM sf)")


@register("unit_lookup_3", _lookup_oracle(["sn", "pn", "model"]))
def q_unit_lookup_3(spark, sf_dir):
    return profile.unit_lookup(fx.workstation_log(spark, sf_dir), fx.snfn_log(spark, sf_dir), ("sn", "pn", "model"))


@register("unit_lookup_4", with_views("wl wl_new", f"""
SELECT * FROM wl WHERE ({', '.join(_FOUR)}) IN (SELECT {', '.join(_FOUR)} FROM wl_new)"""))
def q_unit_lookup_4(spark, sf_dir):
    return profile.unit_lookup(fx.workstation_log(spark, sf_dir), fx.workstation_new(spark, sf_dir), _FOUR)
