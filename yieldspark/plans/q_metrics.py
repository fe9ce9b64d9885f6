"""Registered queries: station, fixture, packing, sort-test metrics and date helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import FIXTURE_AS_OF
from ..functions import columns as C
from ..operators import packing, station
from ..sources import fixtures as fx
from .catalog import register
from .oracle_views import with_views

AS_OF = FIXTURE_AS_OF.isoformat()

# DuckDB: isodow Mon=1..Sun=7, so Saturday steps back 1 and Sunday 2.
_FOLD = "CAST(history_station_end_time AS DATE) - CAST(greatest(isodow(history_station_end_time) - 5, 0) AS INTEGER)"


@register("testboard_station_daily", with_views("tb", """
SELECT CAST(history_station_end_time AS DATE) AS end_date, model, work_station_process, workstation_name,
  count(*) AS total,
  count(CASE WHEN history_station_passing_status = 'Pass' THEN 1 END) AS pass,
  count(CASE WHEN history_station_passing_status = 'Fail' THEN 1 END) AS fail,
  CAST(round(CAST(count(CASE WHEN history_station_passing_status = 'Fail' THEN 1 END) AS DECIMAL(18,0))
       / count(*), 3) AS DECIMAL(5,3)) AS failurerate
FROM tb WHERE history_station_end_time IS NOT NULL
GROUP BY ALL"""))
def q_testboard_station_daily(spark, sf_dir):
    return station.testboard_station_daily(fx.testboard_log(spark, sf_dir))


@register("fixture_daily", with_views("tb", """
SELECT CAST(history_station_end_time AS DATE) AS day, fixture_no, model, pn, workstation_name,
  count(*) AS total,
  count(CASE WHEN history_station_passing_status = 'Pass' THEN 1 END) AS pass,
  count(CASE WHEN history_station_passing_status = 'Fail' THEN 1 END) AS fail
FROM tb WHERE history_station_end_time IS NOT NULL
GROUP BY ALL"""))
def q_fixture_daily(spark, sf_dir):
    return station.fixture_daily(fx.testboard_log(spark, sf_dir))


@register("station_hourly", with_views("wl", """
SELECT CAST(history_station_end_time AS DATE) AS date, CAST(hour(history_station_end_time) AS INTEGER) AS hour,
  workstation_name, count(*) AS part_count
FROM wl WHERE history_station_end_time IS NOT NULL
GROUP BY ALL"""))
def q_station_hourly(spark, sf_dir):
    return station.station_hourly(fx.workstation_log(spark, sf_dir))


@register("packing_daily", with_views("wl", f"""
SELECT {_FOLD} AS pack_date, model, pn AS part_number, count(*) AS packed_count
FROM wl WHERE workstation_name = 'PACKING' AND history_station_passing_status = 'Pass'
GROUP BY ALL"""))
def q_packing_daily(spark, sf_dir):
    return packing.packing_daily(fx.workstation_log(spark, sf_dir))


# as_of Friday 2024-01-19: window 2024-01-13 (Sat) .. 2024-01-19, widened back to Fri 2024-01-12.
@register("packing_recent", with_views("wl", f"""
SELECT {_FOLD} AS pack_date, model, pn AS part_number, count(*) AS packed_count
FROM wl WHERE workstation_name = 'PACKING' AND history_station_passing_status = 'Pass'
  AND history_station_end_time >= TIMESTAMP '2024-01-12' AND history_station_end_time < TIMESTAMP '2024-01-20'
GROUP BY ALL"""))
def q_packing_recent(spark, sf_dir):
    return packing.packing_recent(fx.workstation_log(spark, sf_dir), FIXTURE_AS_OF)


@register("packing_proof", with_views("wl", """
SELECT CAST(history_station_end_time AS DATE) AS pack_day, model, pn,
  CAST(grouping(CAST(history_station_end_time AS DATE), model, pn) AS BIGINT) AS level, count(*) AS packed_count
FROM wl WHERE workstation_name = 'PACKING' AND history_station_passing_status = 'Pass'
GROUP BY GROUPING SETS ((CAST(history_station_end_time AS DATE), model, pn),
                        (CAST(history_station_end_time AS DATE), model),
                        (CAST(history_station_end_time AS DATE)))"""))
def q_packing_proof(spark, sf_dir):
    return packing.packing_proof(fx.workstation_log(spark, sf_dir))


_SORT = f"""
SELECT CASE WHEN model = 'Tesla SXM4' THEN '506' WHEN model = 'Tesla SXM5' THEN '520' END AS sort_code,
  {_FOLD} AS test_date, count(*) AS test_count
FROM wl WHERE workstation_name = 'TEST' AND history_station_passing_status = 'Pass'
  AND model IN ('Tesla SXM4', 'Tesla SXM5') {{extra}}
GROUP BY ALL"""


@register("sort_test_daily", with_views("wl", _SORT.format(extra="")))
def q_sort_test_daily(spark, sf_dir):
    return packing.sort_test_daily(fx.workstation_log(spark, sf_dir))


@register("sort_test_recent", with_views("wl", _SORT.format(
    extra="AND history_station_end_time >= TIMESTAMP '2024-01-13' AND history_station_end_time < TIMESTAMP '2024-01-20'")))
def q_sort_test_recent(spark, sf_dir):
    return packing.sort_test_recent(fx.workstation_log(spark, sf_dir), FIXTURE_AS_OF)


@register("sort_test_pivot", with_views("wl", f"""
s AS ({_SORT.format(extra="")})
SELECT sort_code, count(*) AS n_days, CAST(sum(test_count) AS BIGINT) AS total_tests,
  '{{' || string_agg('"' || strftime(test_date, '%-m/%-d/%Y') || '":' || CAST(test_count AS VARCHAR), ','
                     ORDER BY test_date) || '}}' AS counts_json
FROM s GROUP BY sort_code"""))
def q_sort_test_pivot(spark, sf_dir):
    return packing.sort_test_pivot(packing.sort_test_daily(fx.workstation_log(spark, sf_dir)))


# ------------------------------------------------------------- date helpers
@register("weekend_fold", with_views("wl", f"""
SELECT CAST(history_station_end_time AS DATE) AS day, {_FOLD} AS folded_day, count(*) AS n_rows
FROM wl GROUP BY ALL"""))
def q_weekend_fold(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    return (wl.groupBy(C.to_day(C.END).alias("day"), C.weekend_fold(C.END).alias("folded_day"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("iso_week_label", with_views("dates", """
SELECT d, concat(CAST(isoyear(d) AS VARCHAR), '-W', lpad(CAST(week(d) AS VARCHAR), 2, '0')) AS week_id FROM dates"""))
def q_iso_week_label(spark, sf_dir):
    return fx.ship_dates(spark, sf_dir).select("d", C.iso_week_label("d").alias("week_id"))


@register("week_bounds", with_views("dates", """
SELECT d, CAST(date_trunc('week', d) AS DATE) AS week_start,
  CAST(date_trunc('week', d) AS DATE) + 6 AS week_end FROM dates"""))
def q_week_bounds(spark, sf_dir):
    d = fx.ship_dates(spark, sf_dir)
    return d.select("d", C.week_start("d").alias("week_start"), C.week_end("d").alias("week_end"))


@register("week_from_label", with_views("dates", """
labels AS (SELECT DISTINCT concat(CAST(isoyear(d) AS VARCHAR), '-W', lpad(CAST(week(d) AS VARCHAR), 2, '0')) AS week_id
           FROM dates)
SELECT week_id,
  CAST(date_trunc('week', make_date(CAST(split_part(week_id, '-W', 1) AS INTEGER), 1, 4)) AS DATE)
    + 7 * (CAST(split_part(week_id, '-W', 2) AS INTEGER) - 1) AS week_start,
  CAST(date_trunc('week', make_date(CAST(split_part(week_id, '-W', 1) AS INTEGER), 1, 4)) AS DATE)
    + 7 * (CAST(split_part(week_id, '-W', 2) AS INTEGER) - 1) + 6 AS week_end
FROM labels"""))
def q_week_from_label(spark, sf_dir):
    labels = fx.ship_dates(spark, sf_dir).select(C.iso_week_label("d").alias("week_id")).distinct()
    start, end = C.week_from_label("week_id")
    return labels.select("week_id", start.alias("week_start"), end.alias("week_end"))
