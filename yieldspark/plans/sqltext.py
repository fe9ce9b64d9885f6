"""Small DuckDB text builders shared by oracle queries."""

from __future__ import annotations


def pct2(p: str, t: str) -> str:
    """round(p / t * 100, 2), half-even on the exact ratio, 0 when t = 0 (DOUBLE)."""
    n = f"(({p}) * 10000)"
    q, r = f"({n} // ({t}))", f"({n} % ({t}))"
    return (f"(CASE WHEN ({t}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({q} + CASE WHEN 2 * {r} > ({t}) "
            f"OR (2 * {r} = ({t}) AND {q} % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100 END)")


def iso_label(d: str) -> str:
    return f"concat(CAST(isoyear({d}) AS VARCHAR), '-W', lpad(CAST(week({d}) AS VARCHAR), 2, '0'))"


def monday(d: str) -> str:
    return f"CAST(date_trunc('week', {d}) AS DATE)"


PASS = "history_station_passing_status = 'Pass'"
NOT_PASS = "history_station_passing_status <> 'Pass'"
END = "history_station_end_time"
TRACKED = "model IN ('Tesla SXM4', 'Tesla SXM5')"
