"""Domain constants and job parameters.

Jobs never read these as literals sprinkled through SQL: every metric takes a
``YieldConfig`` so a plant with other models / stations passes its own.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# --- Fixed values (must equal the source system's for identical results) ---
# Service flows that are not production traffic (NULL is also excluded).
NON_PRODUCTION_FLOWS = ("NC Sort", "RO")
# Models tracked by the yield reports.
TRACKED_MODELS = ("Tesla SXM4", "Tesla SXM5")
# Short names used in the weekly KPI record, by tracked model.
MODEL_SHORT_NAMES = {"Tesla SXM4": "SXM4", "Tesla SXM5": "SXM5"}
# Terminal station of the route; a unit is complete once it reaches it.
PACKING_STATION = "PACKING"
# Station whose passes are reported as sort-test counts.
TEST_STATION = "TEST"
# Station listed by the receive-by-hour report.
RECEIVE_STATION = "RECEIVE"
PASS_STATUS = "Pass"
FAIL_STATUS = "Fail"
# Sort code per model for the sort-test report.
SORT_CODES = {"Tesla SXM4": "506", "Tesla SXM5": "520"}
# Fixed four-station throughput-yield formula per model, in multiplication order.
FIXED_TPY_STATIONS = {
    "Tesla SXM4": ("VI2", "ASSY2", "FI", "FQC"),
    "Tesla SXM5": ("BBD", "ASSY2", "FI", "FQC"),
}
# Tokens that an upstream spreadsheet export writes for an empty cell.
NULL_TOKENS = ("nan", "NaT", "None", "")
# Recent-mode horizons.
DAILY_RECENT_DAYS = 3  # today and the two days before
PACKING_RECENT_DAYS = 7  # today and the six days before
# Receive-by-hour band: [20:00, 24:00).
RECEIVE_BAND_HOURS = (20, 24)
# Top-k sizes of the profile reports.
TOP_STATIONS_DATE = 10
TOP_BUSY_DATES = 10
BUSY_DATE_MIN_ROWS = 100
TOP_FLOWS = 10
TOP_PROFILE_STATIONS = 15
TOP_STATION_YIELD = 20
TOP_SAMPLE_YIELD = 10
MIN_STATION_YIELD_ROWS = 5
LATEST_DAILY_ROWS = 5
LATEST_WEEKS = 3
# --- end of fixed values ---


@dataclass(frozen=True)
class YieldConfig:
    non_production_flows: tuple[str, ...] = NON_PRODUCTION_FLOWS
    tracked_models: tuple[str, ...] = TRACKED_MODELS
    packing_station: str = PACKING_STATION
    test_station: str = TEST_STATION
    receive_station: str = RECEIVE_STATION
    pass_status: str = PASS_STATUS
    fail_status: str = FAIL_STATUS
    sort_codes: dict = field(default_factory=lambda: dict(SORT_CODES))
    fixed_tpy_stations: dict = field(default_factory=lambda: dict(FIXED_TPY_STATIONS))
    model_short_names: dict = field(default_factory=lambda: dict(MODEL_SHORT_NAMES))
    null_tokens: tuple[str, ...] = NULL_TOKENS


DEFAULT = YieldConfig()

# Fixture parameters for the driver tables (see FIXTURES.md): a Friday, so the
# rolling packing window begins on a Saturday and exercises the weekend fold.
FIXTURE_AS_OF = _dt.date(2024, 1, 19)
# The day profiled by the single-date reports.
FIXTURE_PROFILE_DATE = _dt.date(2024, 1, 10)
