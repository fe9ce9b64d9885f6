"""Table schemas and natural keys of the master logs and KPI tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, D, L, I = T.StringType(), T.TimestampNTZType(), T.DateType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Business key of the workstation log (NULL-safe equality everywhere).
WORKSTATION_KEY = (
    "sn", "pn", "customer_pn", "outbound_version", "workstation_name",
    "history_station_start_time", "history_station_end_time", "hours",
    "service_flow", "model", "history_station_passing_status",
    "passing_station_method", "operator", "first_station_start_time", "data_source",
)

TESTBOARD_KEY = (
    "sn", "pn", "model", "work_station_process", "baseboard_sn", "baseboard_pn",
    "workstation_name", "history_station_start_time", "history_station_end_time",
    "history_station_passing_status", "operator", "failure_reasons", "failure_note",
    "failure_code", "diag_version", "fixture_no", "data_source",
)

# Intended key of the snfn log (model included, see SURVEY Q4).
SNFN_KEY = (
    "workstation_name", "fixture_no", "error_code", "error_disc", "model", "sn", "pn",
    "history_station_start_time", "history_station_end_time", "data_source",
)

WORKSTATION_LOG = _struct(
    ("id", L, True),
    ("sn", S, False),
    ("pn", S, True),
    ("model", S, True),
    ("workstation_name", S, False),
    ("history_station_start_time", TS, False),
    ("history_station_end_time", TS, False),
    ("history_station_passing_status", S, True),
    ("operator", S, True),
    ("customer_pn", S, True),
    ("outbound_version", S, True),
    ("hours", S, True),
    ("service_flow", S, True),
    ("passing_station_method", S, True),
    ("first_station_start_time", TS, True),
    ("data_source", S, False),
    ("created_at", TS, True),
)

TESTBOARD_LOG = _struct(
    ("id", L, True),
    ("sn", S, False),
    ("pn", S, True),
    ("model", S, True),
    ("work_station_process", S, True),
    ("baseboard_sn", S, True),
    ("baseboard_pn", S, True),
    ("workstation_name", S, False),
    ("history_station_start_time", TS, False),
    ("history_station_end_time", TS, False),
    ("history_station_passing_status", S, True),
    ("operator", S, True),
    ("failure_reasons", S, True),
    ("failure_note", S, True),
    ("failure_code", S, True),
    ("diag_version", S, True),
    ("fixture_no", S, True),
    ("data_source", S, False),
    ("created_at", TS, True),
)

SNFN_LOG = _struct(
    ("id", L, True),
    ("workstation_name", S, False),
    ("fixture_no", S, True),
    ("error_code", S, True),
    ("error_disc", S, True),
    ("model", S, True),
    ("sn", S, False),
    ("pn", S, True),
    ("history_station_start_time", TS, False),
    ("history_station_end_time", TS, False),
    ("data_source", S, False),
)

# KPI tables: schema and primary key.
TESTBOARD_STATION_DAILY_KEY = ("end_date", "model", "work_station_process", "workstation_name")
FIXTURE_DAILY_KEY = ("day", "fixture_no", "model", "pn", "workstation_name")
PACKING_DAILY_KEY = ("pack_date", "model", "part_number")
STATION_HOURLY_KEY = ("date", "hour", "workstation_name")
TPY_DAILY_KEY = ("date_id", "model", "workstation_name")
TPY_WEEKLY_KEY = ("week_id",)

LOGS = {
    "workstation": (WORKSTATION_LOG, WORKSTATION_KEY),
    "testboard": (TESTBOARD_LOG, TESTBOARD_KEY),
    "snfn": (SNFN_LOG, SNFN_KEY),
}

# Fields a workstation log must carry for the yield jobs to run.
REQUIRED_WORKSTATION_FIELDS = (
    "sn", "model", "workstation_name", "history_station_end_time",
    "history_station_passing_status", "service_flow",
)

# NULL-key policy of every KPI table: key columns such as the part number may be NULL in the logs, and such rows count.
KPI_TABLES = {
    "daily_tpy_metrics": TPY_DAILY_KEY,
    "weekly_tpy_metrics": TPY_WEEKLY_KEY,
    "daily_completions": ("date_id", "model"),
    "station_hourly_summary": STATION_HOURLY_KEY,
    "packing_daily_summary": PACKING_DAILY_KEY,
    "sort_test_daily": ("sort_code", "test_date"),
    "testboard_station_performance_daily": TESTBOARD_STATION_DAILY_KEY,
    "fixture_performance_daily": FIXTURE_DAILY_KEY,
}
KPI_NULL_KEYS = "keep"
# The key column by whose values a KPI table lies in folders, and its type.
KPI_PERIODS = {
    "daily_tpy_metrics": ("date_id", "date"),
    "weekly_tpy_metrics": ("week_id", "string"),
    "daily_completions": ("date_id", "date"),
    "station_hourly_summary": ("date", "date"),
    "packing_daily_summary": ("pack_date", "date"),
    "sort_test_daily": ("test_date", "date"),
    "testboard_station_performance_daily": ("end_date", "date"),
    "fixture_performance_daily": ("day", "date"),
}
