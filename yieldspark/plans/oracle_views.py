"""DuckDB text of the adapter views, prepended as CTEs to every oracle query.

Written independently of the Spark adapters in ``sources/fixtures.py``; the
oracle check compares the two engines end to end.
"""

from __future__ import annotations

WL = """
wl AS (
SELECT event_id AS id,
  concat('SN', lpad(CAST(u AS VARCHAR), 8, '0')) AS sn,
  concat('PN', CAST(u % 5 AS VARCHAR)) AS pn,
  CASE WHEN u % 3 = 0 THEN 'Tesla SXM4' WHEN u % 3 = 1 THEN 'Tesla SXM5' ELSE 'OTHER' END AS model,
  CASE k WHEN 0 THEN 'RECEIVE' WHEN 1 THEN 'VI2' WHEN 2 THEN 'ASSY2' WHEN 3 THEN 'BBD' WHEN 4 THEN 'TEST'
         WHEN 5 THEN 'FI' WHEN 6 THEN 'FQC' ELSE CASE WHEN u % 7 = 3 THEN 'REWORK' ELSE 'PACKING' END END
    AS workstation_name,
  ts - INTERVAL 5 MINUTES AS history_station_start_time,
  ts AS history_station_end_time,
  CASE WHEN event_type = 'error' THEN 'Fail' WHEN event_type = 'signup' AND value < 2 THEN NULL ELSE 'Pass' END
    AS history_station_passing_status,
  concat('OP', CAST(user_id AS VARCHAR)) AS operator,
  CASE WHEN u % 4 = 0 THEN NULL ELSE concat('C', CAST(u % 5 AS VARCHAR)) END AS customer_pn,
  concat('V', CAST(u % 3 AS VARCHAR)) AS outbound_version,
  CAST(k AS VARCHAR) AS hours,
  CASE WHEN u % 11 = 0 THEN 'NC Sort' WHEN u % 11 = 1 THEN 'RO' WHEN u % 11 = 2 THEN NULL ELSE 'NORMAL' END
    AS service_flow,
  CASE WHEN user_id % 2 = 0 THEN 'AUTO' ELSE 'MANUAL' END AS passing_station_method,
  CASE WHEN u % 6 = 0 THEN NULL ELSE ts - INTERVAL 1 HOUR END AS first_station_start_time,
  'workstation' AS data_source,
  ts + INTERVAL 1 DAY AS created_at
FROM (SELECT *, CAST(floor(event_id / 8) AS BIGINT) AS u, CAST(event_id % 8 AS INTEGER) AS k FROM events) e
)"""

TB = """
tb AS (
SELECT event_id AS id,
  concat('SN', lpad(CAST(u AS VARCHAR), 8, '0')) AS sn,
  concat('PN', CAST(u % 5 AS VARCHAR)) AS pn,
  CASE WHEN u % 3 = 0 THEN 'Tesla SXM4' WHEN u % 3 = 1 THEN 'Tesla SXM5' ELSE 'OTHER' END AS model,
  CASE user_id % 3 WHEN 0 THEN 'FT' WHEN 1 THEN 'BI' ELSE 'PT' END AS work_station_process,
  concat('BB', CAST(u AS VARCHAR)) AS baseboard_sn,
  CASE WHEN u % 9 = 0 THEN NULL ELSE concat('BP', CAST(u % 4 AS VARCHAR)) END AS baseboard_pn,
  concat('TB', CAST(event_id % 4 AS VARCHAR)) AS workstation_name,
  ts - INTERVAL 5 MINUTES AS history_station_start_time,
  ts AS history_station_end_time,
  CASE WHEN event_type = 'error' THEN 'Fail' WHEN event_type = 'signup' AND value < 2 THEN 'Abort' ELSE 'Pass' END
    AS history_station_passing_status,
  concat('OP', CAST(user_id AS VARCHAR)) AS operator,
  CASE WHEN event_type = 'error' THEN concat('reason ', CAST(event_id % 7 AS VARCHAR)) ELSE NULL END AS failure_reasons,
  CAST(NULL AS VARCHAR) AS failure_note,
  CASE WHEN event_type = 'error' THEN concat('E', CAST(event_id % 7 AS VARCHAR)) ELSE NULL END AS failure_code,
  concat('D', CAST(u % 2 AS VARCHAR)) AS diag_version,
  CASE WHEN user_id % 10 = 0 THEN NULL ELSE concat('FX', CAST(user_id % 12 AS VARCHAR)) END AS fixture_no,
  'testboard' AS data_source,
  ts + INTERVAL 1 DAY AS created_at
FROM (SELECT *, CAST(floor(event_id / 8) AS BIGINT) AS u FROM events) e
)"""

SF = """
sf AS (
SELECT id, workstation_name, fixture_no, failure_code AS error_code, failure_reasons AS error_disc, model, sn, pn,
  history_station_start_time, history_station_end_time, 'snfn' AS data_source
FROM tb WHERE history_station_passing_status = 'Fail'
)"""

WL_RAW = """
wl_raw AS (
SELECT * FROM wl
UNION ALL
SELECT * REPLACE (id + 1000000000 AS id) FROM wl
WHERE history_station_end_time >= TIMESTAMP '2024-01-15' AND history_station_end_time < TIMESTAMP '2024-01-22'
)"""

TB_RAW = """
tb_raw AS (
SELECT * FROM tb
UNION ALL
SELECT * REPLACE (id + 1000000000 AS id) FROM tb
WHERE history_station_end_time >= TIMESTAMP '2024-01-15' AND history_station_end_time < TIMESTAMP '2024-01-22'
)"""

WL_OLD = """
wl_old AS (SELECT * FROM wl WHERE history_station_end_time < TIMESTAMP '2024-01-20')"""

WL_NEW = """
wl_new AS (SELECT * FROM wl WHERE history_station_end_time >= TIMESTAMP '2024-01-16')"""

DATES = """
dates AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""

PROD = """
prod AS (SELECT * FROM wl WHERE service_flow NOT IN ('NC Sort', 'RO') AND service_flow IS NOT NULL)"""

def _report_sql() -> str:
    from ..sources.fixtures import WORKSTATION_REPORT_HEADERS as H
    cells = []
    for name, header in H.items():
        if name.endswith("_time"):
            text = f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"
            if name == "history_station_start_time":
                text = f"CASE WHEN first_station_start_time IS NULL THEN '' ELSE {text} END"
        elif name == "service_flow":
            text = "coalesce(service_flow, 'nan')"
        elif name == "operator":
            text = "' ' || operator || '  '"
        else:
            text = name
        cells.append(f'coalesce({text}, \'\') AS "{header}"')
    day = ("CASE WHEN id >= 1000000000 THEN strftime(created_at, '%Y-%m-%d') "
           "ELSE strftime(history_station_end_time, '%Y-%m-%d') END AS \"Day\"")
    label = ("concat(CAST(isoyear(history_station_end_time) AS VARCHAR), '-W', "
             "lpad(CAST(week(history_station_end_time) AS VARCHAR), 2, '0'))")
    return ("wl_report AS (SELECT " + ", ".join(cells) + ", " + day
            + f", 'workstation_' || {label} || '.csv' AS source_file, id AS row_ordinal FROM wl_raw)")


def _conf_sql(fallback: bool) -> str:
    from ..sources.fixtures import WORKSTATION_REPORT_HEADERS as H
    out = []
    for name, header in H.items():
        t = f'trim("{header}")'
        if name.endswith("_time"):
            v = f"TRY_CAST(NULLIF({t}, '') AS TIMESTAMP)"
            if name == "history_station_start_time" and fallback:
                end = H["history_station_end_time"]
                v = f"coalesce({v}, TRY_CAST(NULLIF(trim(\"{end}\"), '') AS TIMESTAMP))"
        else:
            v = f"CASE WHEN {t} IN ('', 'nan', 'NaT', 'None') THEN NULL ELSE {t} END"
        out.append(f"{v} AS {name}")
    view = "wl_conf" if fallback else "wl_conf_raw"
    return (f"{view} AS (SELECT " + ", ".join(out)
            + ", 'workstation' AS data_source, source_file, row_ordinal FROM wl_report)")


WL_REPORT = _report_sql()
WL_CONF = _conf_sql(True)
WL_CONF_RAW = _conf_sql(False)

_ORDER = [("wl", WL), ("tb", TB), ("sf", SF), ("wl_raw", WL_RAW), ("tb_raw", TB_RAW),
          ("wl_old", WL_OLD), ("wl_new", WL_NEW), ("dates", DATES), ("prod", PROD),
          ("wl_report", WL_REPORT), ("wl_conf", WL_CONF), ("wl_conf_raw", WL_CONF_RAW)]
_DEPS = {"sf": {"tb"}, "tb_raw": {"tb"}, "wl_raw": {"wl"}, "wl_old": {"wl"}, "wl_new": {"wl"}, "prod": {"wl"},
         "wl_report": {"wl_raw", "wl"}, "wl_conf": {"wl_report", "wl_raw", "wl"},
         "wl_conf_raw": {"wl_report", "wl_raw", "wl"}}


def with_views(names: str, body: str) -> str:
    """``WITH <views...>, <body>``: body may start with further CTEs (``x AS (...)``) or a SELECT."""
    want = set(names.split())
    for n in list(want):
        want |= _DEPS.get(n, set())
    ctes = [sql.strip() for n, sql in _ORDER if n in want]
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return "WITH " + ",\n".join(ctes) + "\n" + body
    return "WITH " + ",\n".join(ctes) + ",\n" + body
