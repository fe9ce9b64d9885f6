"""Packing counts (D3-D5, D28) and sort-test counts.

Hot keys (PACKING is the busiest station, one model may dominate) are safe
here: every metric is a plain ``groupBy().agg()``, so Spark combines map-side
before the shuffle and each reducer sees at most one row per key per mapper.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C


def _packed(wl: DataFrame, cfg: YieldConfig) -> DataFrame:
    return wl.filter((F.col(C.STATION) == cfg.packing_station) & C.passed(cfg=cfg))


def packing_daily(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Passed PACKING visits per weekend-folded day, model and part number."""
    return (_packed(wl, cfg)
            .groupBy(C.weekend_fold(C.END).alias("pack_date"), "model", F.col("pn").alias("part_number"))
            .agg(F.count(F.lit(1)).alias("packed_count")))


def recent_bounds(as_of: _dt.date, days: int) -> tuple[_dt.datetime, _dt.datetime]:
    """``[as_of - (days-1), as_of + 1)`` widened back to a Friday when it starts on a weekend (Q5).

    The fold moves Saturday and Sunday onto Friday, so a window that starts on
    a weekend would recompute Friday from a fraction of its rows and the
    upsert would overwrite the full count with the partial one.
    """
    lo = as_of - _dt.timedelta(days=days - 1)
    lo -= _dt.timedelta(days=max(lo.weekday() - 4, 0))
    hi = as_of + _dt.timedelta(days=1)
    return (_dt.datetime.combine(lo, _dt.time()), _dt.datetime.combine(hi, _dt.time()))


def packing_recent(wl: DataFrame, as_of: _dt.date, days: int = 7, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Rolling-window packing counts for an upsert (D4); the time predicate reaches the scan."""
    lo, hi = recent_bounds(as_of, days)
    return packing_daily(wl.filter(C.in_range(C.END, C.ts_lit(lo), C.ts_lit(hi))), cfg)


def packing_proof(wl: DataFrame, day: _dt.date | None = None, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Unfolded packed counts per calendar date: total, per model, per (model, pn).

    One ``ROLLUP(model, pn)`` per date instead of three queries per date;
    ``level`` = grouping_id (0 = model+pn, 1 = model, 3 = date total).
    """
    src = _packed(wl, cfg)
    if day is not None:
        src = src.filter(C.on_date(C.END, day))
    day_, model, pn = C.to_day(C.END).alias("pack_day"), F.col("model"), F.col("pn")
    sets = [[F.col("pack_day"), model, pn], [F.col("pack_day"), model], [F.col("pack_day")]]
    return (src.select(day_, model, pn)
            .groupingSets(sets, "pack_day", "model", "pn")
            .agg(F.count(F.lit(1)).alias("packed_count"), F.grouping_id().alias("gid"))
            .select("pack_day", "model", "pn", (F.col("gid") % 4).cast("long").alias("level"), "packed_count"))


# ------------------------------------------------------------------ sort test
def _sort_code(cfg: YieldConfig):
    expr = None
    for model, code in cfg.sort_codes.items():
        expr = (F.when(F.col("model") == model, code) if expr is None
                else expr.when(F.col("model") == model, code))
    return expr.otherwise(F.lit(None))


def sort_test_daily(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Passed TEST visits of tracked models per sort code and folded day."""
    return (wl.filter((F.col(C.STATION) == cfg.test_station) & C.passed(cfg=cfg)
                      & F.col("model").isin(*cfg.tracked_models))
            .groupBy(_sort_code(cfg).alias("sort_code"), C.weekend_fold(C.END).alias("test_date"))
            .agg(F.count(F.lit(1)).alias("test_count")))


def sort_test_recent(wl: DataFrame, as_of: _dt.date, days: int = 7, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Sort-test counts of ``as_of`` and the ``days - 1`` days before it (D7): a report, never upserted, so not widened."""
    lo = _dt.datetime.combine(as_of - _dt.timedelta(days=days - 1), _dt.time())
    hi = _dt.datetime.combine(as_of + _dt.timedelta(days=1), _dt.time())
    return sort_test_daily(wl.filter(C.in_range(C.END, C.ts_lit(lo), C.ts_lit(hi))), cfg)


def sort_test_pivot(counts: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """``{code: {M/D/YYYY: n}}`` as one row per code with a sorted map.

    Grouped by sort code, so the map of one code holds one entry per day
    (bounded by the calendar, not by the data volume).
    """
    codes = list(cfg.sort_codes.values())
    per_code = (counts.filter(F.col("sort_code").isin(*codes))
                .groupBy("sort_code")
                .agg(F.array_sort(F.collect_list(F.struct("test_date", C.mdy("test_date").alias("day"),
                                                           "test_count"))).alias("e"),
                     F.count(F.lit(1)).alias("n_days"),
                     F.sum("test_count").cast("long").alias("total_tests")))
    by_day = F.map_from_arrays(F.transform("e", lambda x: x["day"]), F.transform("e", lambda x: x["test_count"]))
    return per_code.select("sort_code", "n_days", "total_tests", F.to_json(by_day).alias("counts_json"))
