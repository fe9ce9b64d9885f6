"""Registered queries: daily and weekly TPY / FPY."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import FIXTURE_AS_OF, FIXTURE_PROFILE_DATE, LATEST_DAILY_ROWS, LATEST_WEEKS, TOP_STATIONS_DATE
from ..functions import columns as C
from ..operators import tpy
from ..sources import fixtures as fx
from .catalog import register
from .oracle_views import with_views
from .sqltext import END, NOT_PASS, PASS, TRACKED, iso_label, monday, pct2

AS_OF = FIXTURE_AS_OF


def _unit_day(spark, sf_dir):
    return tpy.unit_day(fx.workstation_log(spark, sf_dir))


def _first_activity(spark, sf_dir):
    # one minimum by unit straight from the log: the day level is not needed
    return tpy.first_activity(tpy.prod(fx.workstation_log(spark, sf_dir)))


def _daily_kpi(spark, sf_dir):
    sd = tpy.station_day(fx.workstation_log(spark, sf_dir))
    return tpy.tpy_daily(sd, tpy.starters_by_week(_first_activity(spark, sf_dir)))


# Oracle building blocks (DuckDB), written from the report definitions.
_FA = f"fa AS (SELECT sn, model, min({END}) AS first_activity_time FROM prod GROUP BY sn, model)"
_SBW = f"sbw AS (SELECT {monday('first_activity_time')} AS week_start, count(*) AS total_starters FROM fa GROUP BY 1)"
_SD = f"""sd AS (
SELECT CAST({END} AS DATE) AS date_id, model, workstation_name, count(*) AS total_parts,
  count(CASE WHEN {PASS} THEN 1 END) AS passed_parts, count(CASE WHEN {NOT_PASS} THEN 1 END) AS failed_parts
FROM prod WHERE {TRACKED} GROUP BY ALL)"""
_DAILY = f"""daily AS (
SELECT date_id, model, workstation_name, total_parts, passed_parts, failed_parts,
  {pct2('passed_parts', 'total_parts')} AS throughput_yield, {iso_label('date_id')} AS week_id,
  {monday('date_id')} AS week_start, {monday('date_id')} + 6 AS week_end,
  coalesce(sbw.total_starters, 0) AS total_starters
FROM sd LEFT JOIN sbw ON sbw.week_start = {monday('sd.date_id')})"""
# Per (week, model, station) straight from the log, and the all-model rows.
_WSY = f"""wm AS (
SELECT {monday(END)} AS week_start, model, workstation_name, count(*) AS total_parts,
  count(CASE WHEN {PASS} THEN 1 END) AS passed_parts, count(CASE WHEN {NOT_PASS} THEN 1 END) AS failed_parts
FROM prod WHERE {TRACKED} GROUP BY ALL),
wo AS (
SELECT week_start, workstation_name, CAST(sum(total_parts) AS BIGINT) AS total_parts,
  CAST(sum(passed_parts) AS BIGINT) AS passed_parts, CAST(sum(failed_parts) AS BIGINT) AS failed_parts
FROM wm GROUP BY ALL),
wmy AS (SELECT *, {pct2('passed_parts', 'total_parts')} AS throughput_yield FROM wm),
woy AS (SELECT *, {pct2('passed_parts', 'total_parts')} AS throughput_yield FROM wo)"""
_WEEKS = "weeks AS (SELECT DISTINCT week_start FROM wm)"
_SPINE = "spine AS (SELECT week_start, m.model FROM weeks, (VALUES ('Tesla SXM4'), ('Tesla SXM5')) m(model))"
_FIXED = f"""fixed_list AS (SELECT * FROM (VALUES ('Tesla SXM4', 'VI2', 0), ('Tesla SXM4', 'ASSY2', 1),
  ('Tesla SXM4', 'FI', 2), ('Tesla SXM4', 'FQC', 3), ('Tesla SXM5', 'BBD', 0), ('Tesla SXM5', 'ASSY2', 1),
  ('Tesla SXM5', 'FI', 2), ('Tesla SXM5', 'FQC', 3)) t(model, workstation_name, ord)),
fx AS (
SELECT w.week_start, w.model, count(*) AS n,
  list_reduce(list_prepend(CAST(1.0 AS DOUBLE), list(w.throughput_yield / 100.0 ORDER BY f.ord)), lambda a, x: a * x) AS p,
  '{{' || string_agg('"' || w.workstation_name || '":' || printf('%.2f', w.throughput_yield), ',' ORDER BY f.ord)
    || '}}' AS stations_json
FROM wmy w JOIN fixed_list f ON f.model = w.model AND f.workstation_name = w.workstation_name
GROUP BY w.week_start, w.model),
fixed AS (
SELECT {iso_label('s.week_start')} AS week_id, s.week_start, s.model, coalesce(fx.n, 0) AS stations_found,
  CASE WHEN fx.n = 4 THEN round_even(fx.p * 100, 2) END AS tpy, coalesce(fx.stations_json, '{{}}') AS stations_json
FROM spine s LEFT JOIN fx ON fx.week_start = s.week_start AND fx.model = s.model)"""
_DYN = f"""dx AS (
SELECT week_start, model, count(*) AS n,
  list_reduce(list_prepend(CAST(1.0 AS DOUBLE),
    list(throughput_yield / 100.0 ORDER BY total_parts DESC, workstation_name)), lambda a, x: a * x) AS p,
  '{{' || string_agg('"' || workstation_name || '":' || printf('%.2f', throughput_yield), ','
                     ORDER BY total_parts DESC, workstation_name) || '}}' AS stations_json
FROM wmy GROUP BY week_start, model),
dyn AS (
SELECT {iso_label('s.week_start')} AS week_id, s.week_start, s.model, coalesce(dx.n, 0) AS station_count,
  coalesce(round_even(dx.p * 100, 2), 100.0) AS tpy, coalesce(dx.stations_json, '{{}}') AS stations_json
FROM spine s LEFT JOIN dx ON dx.week_start = s.week_start AND dx.model = s.model)"""
_FPY = f"""uw AS (
SELECT {monday(END)} AS week_start, sn, model,
  count(CASE WHEN workstation_name = 'PACKING' THEN 1 END) AS reached,
  count(CASE WHEN {NOT_PASS} THEN 1 END) AS failures
FROM prod GROUP BY ALL),
fpy0 AS (
SELECT week_start, count(*) AS parts_started,
  count(CASE WHEN reached > 0 AND failures = 0 THEN 1 END) AS first_pass_success,
  count(CASE WHEN reached > 0 THEN 1 END) AS parts_completed,
  count(CASE WHEN failures > 0 THEN 1 END) AS parts_failed,
  count(CASE WHEN reached = 0 AND failures = 0 THEN 1 END) AS parts_stuck_in_limbo
FROM uw GROUP BY week_start),
fpy AS (
SELECT *, parts_completed + parts_failed AS active_parts,
  {pct2('first_pass_success', 'parts_started')} AS traditional_fpy,
  {pct2('first_pass_success', 'parts_completed + parts_failed')} AS completed_only_fpy,
  {iso_label('week_start')} AS week_id
FROM fpy0)"""
_SUMMARY = f"""fs AS (
SELECT week_start, workstation_name, min(model) AS first_model FROM wm GROUP BY ALL),
ranked AS (
SELECT o.*, row_number() OVER (PARTITION BY o.week_start
                               ORDER BY fs.first_model, m.total_parts DESC, o.workstation_name) AS ord
FROM woy o JOIN fs ON fs.week_start = o.week_start AND fs.workstation_name = o.workstation_name
JOIN wm m ON m.week_start = o.week_start AND m.workstation_name = o.workstation_name AND m.model = fs.first_model),
summary AS (
SELECT week_start, count(*) AS total_stations,
  CAST((sum(CAST(round(throughput_yield * 100) AS BIGINT)) // count(*)
        + CASE WHEN 2 * (sum(CAST(round(throughput_yield * 100) AS BIGINT)) % count(*)) > count(*)
                 OR (2 * (sum(CAST(round(throughput_yield * 100) AS BIGINT)) % count(*)) = count(*)
                     AND (sum(CAST(round(throughput_yield * 100) AS BIGINT)) // count(*)) % 2 = 1)
               THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS average_yield,
  max(throughput_yield) AS best_station_yield, min(throughput_yield) AS worst_station_yield,
  arg_min(workstation_name, ord) FILTER (WHERE best_rank = 1) AS best_station_name,
  arg_min(workstation_name, ord) FILTER (WHERE worst_rank = 1) AS worst_station_name
FROM (SELECT *, rank() OVER (PARTITION BY week_start ORDER BY throughput_yield DESC) AS best_rank,
             rank() OVER (PARTITION BY week_start ORDER BY throughput_yield ASC) AS worst_rank FROM ranked) r
GROUP BY week_start)"""


@register("first_activity", with_views("prod", f"""
SELECT sn, model, min({END}) AS first_activity_time FROM prod GROUP BY sn, model"""))
def q_first_activity(spark, sf_dir):
    return _first_activity(spark, sf_dir)


@register("weekly_starters", with_views("prod", f"""
{_FA}
SELECT {iso_label('week_start')} AS week_id, week_start, model, CAST(grouping(week_start, model) AS BIGINT) AS level,
  count(*) AS starters
FROM (SELECT {monday('first_activity_time')} AS week_start, model FROM fa) s
GROUP BY GROUPING SETS ((week_start, model), (week_start))"""))
def q_weekly_starters(spark, sf_dir):
    return tpy.weekly_starters(_first_activity(spark, sf_dir))


_COMPLETIONS = f"""
{_FA},
starters AS (SELECT DISTINCT sn, {monday('first_activity_time')} AS week_start FROM fa),
cc AS (
SELECT CAST(p.{END} AS DATE) AS date_id, p.sn, p.model,
  count(CASE WHEN p.workstation_name = 'PACKING' THEN 1 END) AS reached_packing,
  count(CASE WHEN p.{NOT_PASS} THEN 1 END) AS failure_count
FROM prod p SEMI JOIN starters s ON s.sn = p.sn AND s.week_start = {monday('p.' + END)}
GROUP BY ALL),
dc AS (
SELECT date_id, model, count(*) AS completed_today,
  count(CASE WHEN failure_count = 0 THEN 1 END) AS first_pass_today
FROM cc WHERE reached_packing > 0 GROUP BY date_id, model)"""


@register("daily_completions", with_views("prod", f"""
{_COMPLETIONS}
SELECT *, {pct2('first_pass_today', 'completed_today')} AS model_fpy FROM dc"""))
def q_daily_completions(spark, sf_dir):
    return tpy.daily_completions(_unit_day(spark, sf_dir))


@register("daily_fpy", with_views("prod", f"""
{_COMPLETIONS}
SELECT date_id, CAST(sum(completed_today) AS BIGINT) AS completed_today,
  CAST(sum(first_pass_today) AS BIGINT) AS first_pass_today,
  {pct2('sum(first_pass_today)', 'sum(completed_today)')} AS daily_fpy
FROM dc GROUP BY date_id"""))
def q_daily_fpy(spark, sf_dir):
    return tpy.daily_fpy(tpy.daily_completions(_unit_day(spark, sf_dir)))


@register("tpy_daily", with_views("prod", f"{_FA}, {_SBW}, {_SD}, {_DAILY} SELECT * FROM daily"))
def q_tpy_daily(spark, sf_dir):
    return _daily_kpi(spark, sf_dir)


@register("tpy_daily_recent", with_views("prod", f"""{_FA}, {_SBW}, {_SD}, {_DAILY}
SELECT * FROM daily WHERE date_id >= DATE '2024-01-17' AND date_id < DATE '2024-01-20'"""))
def q_tpy_daily_recent(spark, sf_dir):
    return _daily_kpi(spark, sf_dir).filter(tpy.recent_dates_filter("date_id", AS_OF))


@register("tpy_daily_latest", with_views("prod", f"""{_FA}, {_SBW}, {_SD}, {_DAILY}
SELECT date_id, model, workstation_name, throughput_yield FROM daily
ORDER BY date_id DESC, throughput_yield DESC, model, workstation_name LIMIT {LATEST_DAILY_ROWS}"""))
def q_tpy_daily_latest(spark, sf_dir):
    # Top-k is the feature here (the post-load sample), planned as TakeOrderedAndProject.
    return (_daily_kpi(spark, sf_dir)
            .orderBy(F.desc("date_id"), F.desc("throughput_yield"), "model", "workstation_name")
            .select("date_id", "model", "workstation_name", "throughput_yield")
            .limit(LATEST_DAILY_ROWS))


@register("active_dates", with_views("prod", f"""
SELECT DISTINCT CAST({END} AS DATE) AS test_date FROM prod WHERE {END} IS NOT NULL"""))
def q_active_dates(spark, sf_dir):
    return tpy.active_dates(fx.workstation_log(spark, sf_dir))


@register("active_weeks", with_views("prod", f"""{_FA}, {_SBW}, {_SD}, {_DAILY}
SELECT DISTINCT week_id FROM daily"""))
def q_active_weeks(spark, sf_dir):
    return _daily_kpi(spark, sf_dir).select(C.iso_week_label("date_id").alias("week_id")).distinct()


@register("weekly_fpy", with_views("prod", f"{_FPY} SELECT * FROM fpy"))
def q_weekly_fpy(spark, sf_dir):
    return tpy.weekly_fpy(_unit_day(spark, sf_dir))


_STATION_YIELD = with_views("prod", f"""{_WSY}
SELECT week_start, model, workstation_name, total_parts, passed_parts, failed_parts, CAST(0 AS BIGINT) AS level,
  throughput_yield, {iso_label('week_start')} AS week_id FROM wmy
UNION ALL
SELECT week_start, NULL, workstation_name, total_parts, passed_parts, failed_parts, CAST(1 AS BIGINT),
  throughput_yield, {iso_label('week_start')} FROM woy""")


@register("weekly_station_yield", _STATION_YIELD)
def q_weekly_station_yield(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    return tpy.weekly_station_yield(tpy.station_day(wl))


@register("tpy_fixed", with_views("prod", f"{_WSY}, {_WEEKS}, {_SPINE}, {_FIXED} SELECT * FROM fixed"))
def q_tpy_fixed(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    return tpy.tpy_fixed(tpy.weekly_station_yield(tpy.station_day(wl)))


@register("tpy_dynamic", with_views("prod", f"{_WSY}, {_WEEKS}, {_SPINE}, {_DYN} SELECT * FROM dyn"))
def q_tpy_dynamic(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    return tpy.tpy_dynamic(tpy.weekly_station_yield(tpy.station_day(wl)))


_OVERALL = f"""ovr AS (
SELECT week_start, CAST(sum(total_parts) AS BIGINT) AS total_parts, CAST(sum(passed_parts) AS BIGINT) AS completed_parts,
  {pct2('sum(passed_parts)', 'sum(total_parts)')} AS overall_yield, {iso_label('week_start')} AS week_id
FROM daily WHERE date_id BETWEEN week_start AND week_end GROUP BY week_start)"""


@register("weekly_overall_yield", with_views("prod", f"""{_FA}, {_SBW}, {_SD}, {_DAILY}, {_OVERALL}
SELECT * FROM ovr"""))
def q_weekly_overall_yield(spark, sf_dir):
    return tpy.weekly_overall_yield(_daily_kpi(spark, sf_dir))


@register("weekly_station_summary", with_views("prod", f"""{_WSY}, {_SUMMARY}
SELECT *, {iso_label('week_start')} AS week_id FROM summary"""))
def q_weekly_station_summary(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    return tpy.weekly_station_summary(tpy.weekly_station_yield(tpy.station_day(wl)))


_STATION_JSON = """allrows AS (SELECT week_start, model, workstation_name, total_parts, passed_parts, failed_parts, throughput_yield FROM wmy
  UNION ALL
  SELECT week_start, NULL, workstation_name, total_parts, passed_parts, failed_parts, throughput_yield FROM woy),
sjson AS (SELECT week_start, model, count(*) AS n_stations,
  '{' || string_agg('"' || workstation_name || '":{"totalParts":' || CAST(total_parts AS VARCHAR)
    || ',"passedParts":' || CAST(passed_parts AS VARCHAR) || ',"failedParts":' || CAST(failed_parts AS VARCHAR)
    || ',"throughputYield":' || printf('%.2f', throughput_yield) || '}', ',' ORDER BY workstation_name)
    || '}' AS station_metrics_json
FROM allrows GROUP BY week_start, model)"""


def _weekly_record_sql(where: str = "") -> str:
    cols = []
    for m, s in (("Tesla SXM4", "sxm4"), ("Tesla SXM5", "sxm5")):
        cols.append(f"""(SELECT stations_json FROM fixed x WHERE x.week_start = w.week_start AND x.model = '{m}')
                        AS weekly_tpy_hardcoded_{s}_stations""")
        cols.append(f"""(SELECT tpy FROM fixed x WHERE x.week_start = w.week_start AND x.model = '{m}')
                        AS weekly_tpy_hardcoded_{s}_tpy""")
        cols.append(f"""(SELECT stations_json FROM dyn x WHERE x.week_start = w.week_start AND x.model = '{m}')
                        AS weekly_tpy_dynamic_{s}_stations""")
        cols.append(f"""(SELECT tpy FROM dyn x WHERE x.week_start = w.week_start AND x.model = '{m}')
                        AS weekly_tpy_dynamic_{s}_tpy""")
        cols.append(f"""(SELECT station_count FROM dyn x WHERE x.week_start = w.week_start AND x.model = '{m}')
                        AS weekly_tpy_dynamic_{s}_station_count""")
    return f"""{_FA}, {_SBW}, {_SD}, {_DAILY}, {_OVERALL}, {_WSY}, {_WEEKS}, {_SPINE}, {_FIXED}, {_DYN}, {_FPY},
{_SUMMARY},
{_STATION_JSON},
kweeks AS (SELECT DISTINCT week_start FROM daily)
SELECT {iso_label('w.week_start')} AS week_id, w.week_start, w.week_start + 6 AS week_end, 7 AS days_in_week,
  coalesce(fpy.parts_started, 0) AS weekly_first_pass_yield_traditional_parts_started,
  coalesce(fpy.first_pass_success, 0) AS weekly_first_pass_yield_traditional_first_pass_success,
  coalesce(fpy.traditional_fpy, 0.0) AS weekly_first_pass_yield_traditional_first_pass_yield,
  coalesce(fpy.active_parts, 0) AS weekly_first_pass_yield_completed_only_active_parts,
  coalesce(fpy.first_pass_success, 0) AS weekly_first_pass_yield_completed_only_first_pass_success,
  coalesce(fpy.completed_only_fpy, 0.0) AS weekly_first_pass_yield_completed_only_first_pass_yield,
  coalesce(fpy.parts_completed, 0) AS weekly_first_pass_yield_breakdown_parts_completed,
  coalesce(fpy.parts_failed, 0) AS weekly_first_pass_yield_breakdown_parts_failed,
  coalesce(fpy.parts_stuck_in_limbo, 0) AS weekly_first_pass_yield_breakdown_parts_stuck_in_limbo,
  coalesce(fpy.parts_started, 0) AS weekly_first_pass_yield_breakdown_total_parts,
  coalesce(ovr.total_parts, 0) AS weekly_overall_yield_total_parts,
  coalesce(ovr.completed_parts, 0) AS weekly_overall_yield_completed_parts,
  coalesce(ovr.overall_yield, 0.0) AS weekly_overall_yield_overall_yield,
  coalesce(summary.average_yield, 0.0) AS weekly_throughput_yield_average_yield,
  coalesce((SELECT station_metrics_json FROM sjson x WHERE x.week_start = w.week_start AND x.model IS NULL), '{{}}')
    AS weekly_throughput_yield_station_metrics,
  (SELECT CASE WHEN count(*) = 0 THEN '{{}}' ELSE '{{"Tesla SXM4":' || coalesce(max(CASE WHEN model = 'Tesla SXM4' THEN station_metrics_json END), '{{}}')
     || ',"Tesla SXM5":' || coalesce(max(CASE WHEN model = 'Tesla SXM5' THEN station_metrics_json END), '{{}}')
     || ',"overall":' || coalesce(max(CASE WHEN model IS NULL THEN station_metrics_json END), '{{}}') || '}}' END
   FROM sjson x WHERE x.week_start = w.week_start) AS weekly_throughput_yield_model_specific,
  {', '.join(cols)},
  coalesce(summary.total_stations, 0) AS total_stations,
  summary.best_station_name, summary.best_station_yield, summary.worst_station_name, summary.worst_station_yield
FROM kweeks w
LEFT JOIN fpy ON fpy.week_start = w.week_start
LEFT JOIN ovr ON ovr.week_start = w.week_start
LEFT JOIN summary ON summary.week_start = w.week_start
{where}"""


def _weekly(spark, sf_dir, week=None):
    # Lazy: nothing is written when the query is built. The job chain derives the same record from its cut bases.
    wl = fx.workstation_log(spark, sf_dir)
    if week is not None:
        wl = tpy.week_rows(wl, week)
    ud, sd = tpy.unit_day(wl), tpy.station_day(wl)
    return tpy.tpy_weekly(ud, sd)


@register("tpy_weekly", with_views("prod", _weekly_record_sql()))
def q_tpy_weekly(spark, sf_dir):
    return _weekly(spark, sf_dir)


@register("tpy_weekly_recent", with_views("prod", _weekly_record_sql("WHERE w.week_start = DATE '2024-01-15'")))
def q_tpy_weekly_recent(spark, sf_dir):
    return _weekly(spark, sf_dir, tpy.week_of(AS_OF))


@register("tpy_weekly_json", with_views("prod", f"""{_WSY}, {_STATION_JSON}
SELECT {iso_label('week_start')} AS week_id, coalesce(model, 'overall') AS scope, n_stations, station_metrics_json
FROM sjson"""))
def q_tpy_weekly_json(spark, sf_dir):
    wl = fx.workstation_log(spark, sf_dir)
    return tpy.station_metrics_json(tpy.weekly_station_yield(tpy.station_day(wl)))


@register("weekly_record_read_back", _STATION_YIELD)
def q_weekly_record_read_back(spark, sf_dir):
    return tpy.station_yield_from_record(_weekly(spark, sf_dir))


@register("tpy_weekly_latest", f"""SELECT week_id, week_start, weekly_first_pass_yield_traditional_first_pass_yield AS fpy,
  weekly_overall_yield_overall_yield AS overall_yield, total_stations
FROM ({with_views("prod", _weekly_record_sql())}) ORDER BY week_start DESC LIMIT {LATEST_WEEKS}""")
def q_tpy_weekly_latest(spark, sf_dir):
    # Top-k is the feature here (the post-load sample of the weekly record).
    return (_weekly(spark, sf_dir).orderBy(F.desc("week_start")).limit(LATEST_WEEKS)
            .select("week_id", "week_start", F.col("weekly_first_pass_yield_traditional_first_pass_yield").alias("fpy"),
                    F.col("weekly_overall_yield_overall_yield").alias("overall_yield"), "total_stations"))


@register("tpy_date_sample", with_views("prod", f"""{_FA}, {_SBW}, {_SD}, {_DAILY}
SELECT model, workstation_name, total_parts, passed_parts, throughput_yield FROM daily
WHERE date_id = DATE '{FIXTURE_PROFILE_DATE}' ORDER BY total_parts DESC, model, workstation_name LIMIT {TOP_STATIONS_DATE}"""))
def q_tpy_date_sample(spark, sf_dir):
    # Top-k is the feature here: the busiest stations of one date.
    return (_daily_kpi(spark, sf_dir).filter(F.col("date_id") == F.lit(FIXTURE_PROFILE_DATE))
            .orderBy(F.desc("total_parts"), "model", "workstation_name").limit(TOP_STATIONS_DATE)
            .select("model", "workstation_name", "total_parts", "passed_parts", "throughput_yield"))
