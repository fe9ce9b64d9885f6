"""Throughput yield (TPY) and first-pass yield (FPY), daily and per ISO week
(D10-D24, C1, C4-C6, A16, G1, G2, G4).

Plan shape, chosen for a log of billions of station visits:

* ``unit_day``: ONE hash aggregate of the production log by (sn, model, day)
  carrying PACKING visits, non-pass visits and the first end time. Every
  unit-level metric (first activity, starters, daily completions, weekly FPY)
  is a re-aggregation of this table, so the raw log is shuffled once for all
  of them, after map-side combining. A unit cannot hold more than one row per
  model and day, so a "hot" serial number is bounded by the calendar.
* ``station_day``: ONE hash aggregate by (day, model, station) for tracked
  models. Weekly station yields are sums of it (counts are additive), so the
  weekly jobs never rescan the log for station metrics.
* Week attributes are one row per week, bounded by the calendar.

The per-date / per-week loops of a client-driven implementation become group
keys; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C


def half_even_div(num: Column, den: Column) -> Column:
    """Integer ``num / den`` rounded half to even (den > 0, num >= 0)."""
    r = num % den
    q = ((num - r) / den).cast("long")
    up = (r * 2 > den) | ((r * 2 == den) & (q % 2 == 1))
    return q + F.when(up, F.lit(1)).otherwise(F.lit(0))


def prod(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Production rows (B1) that have ended: every yield is counted over a range of end times."""
    return wl.filter(C.is_production(cfg=cfg) & F.col(C.END).isNotNull())


# --------------------------------------------------------------- unit level
def unit_day(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """(sn, model, day) -> reached_packing, failure_count, first_end (the unit-level base table)."""
    return (prod(wl, cfg)
            .groupBy("sn", "model", C.to_day(C.END).alias("day"))
            .agg(C.count_if(F.col(C.STATION) == cfg.packing_station).alias("reached_packing"),
                 C.count_if(C.not_pass(cfg=cfg)).alias("failure_count"),
                 F.min(C.END).alias("first_end")))


def first_activity(rows: DataFrame) -> DataFrame:
    """First production activity per unit (sn, model) over all history.

    ``rows``: production log rows (one aggregate, one shuffle), or unit-day rows where these are at hand.
    """
    end = "first_end" if "first_end" in rows.columns else C.END
    return rows.groupBy("sn", "model").agg(F.min(end).alias("first_activity_time"))


def weekly_starters(fa: DataFrame) -> DataFrame:
    """Units whose first activity falls in each ISO week, per model and in total.

    ``level`` 0 = per model, 1 = all models of the week (model NULL). The
    serial-number list is not materialised: consumers use the semi join of
    ``daily_completions`` instead of shipping an unbounded array around.
    """
    ws = C.week_start("first_activity_time").alias("week_start")
    return (fa.select(ws, "model")
            .groupingSets([[F.col("week_start"), F.col("model")], [F.col("week_start")]], "week_start", "model")
            .agg(F.count(F.lit(1)).alias("starters"), F.grouping_id().cast("long").alias("level"))
            .select(C.iso_week_label("week_start").alias("week_id"), "week_start", "model", "level", "starters"))


def starters_by_week(fa: DataFrame) -> DataFrame:
    """total_starters per week (C5 input): one row per week."""
    return (fa.groupBy(C.week_start("first_activity_time").alias("week_start"))
            .agg(F.count(F.lit(1)).alias("total_starters")))


def completions_by_unit(ud: DataFrame, fa: DataFrame | None = None) -> DataFrame:
    """Unit-days of units that started in that day's week (C1: match on sn only, Q10).

    Without ``fa`` the starters test runs on ``ud`` itself: ``ud`` is
    re-partitioned by sn (a unit holds at most one row per model and day, so
    no group is hot) and two windows over it give each unit's first week per
    model and the set of those weeks per sn; one log scan serves both sides.
    With ``fa`` (a kept first-activity table, incremental mode) it is a semi
    join on (sn, week).
    """
    ud = ud.withColumn("week_start", C.week_start("day"))
    if fa is not None:
        starters = fa.select("sn", C.week_start("first_activity_time").alias("week_start")).distinct()
        return ud.join(starters, C.null_safe_key(ud, starters, ["sn", "week_start"]), "left_semi")
    first_week = C.week_start(F.min("first_end").over(Window.partitionBy("sn", "model")))
    return (ud.repartition("sn")
            .withColumn("_first_week", first_week)
            .withColumn("_start_weeks", F.collect_set("_first_week").over(Window.partitionBy("sn")))
            .filter(F.array_contains("_start_weeks", F.col("week_start")))
            .drop("_first_week", "_start_weeks"))


def daily_completions(ud: DataFrame, fa: DataFrame | None = None) -> DataFrame:
    """Per day and model: week starters that reached PACKING that day, and those without a failure that day."""
    return (completions_by_unit(ud, fa)
            .filter(F.col("reached_packing") > 0)
            .groupBy(F.col("day").alias("date_id"), "model")
            .agg(F.count(F.lit(1)).alias("completed_today"),
                 C.count_if(F.col("failure_count") == 0).alias("first_pass_today"))
            .withColumn("model_fpy", C.pct2("first_pass_today", "completed_today")))


def daily_fpy(dc: DataFrame) -> DataFrame:
    """Daily first-pass yield over all models."""
    return (dc.groupBy("date_id")
            .agg(F.sum("completed_today").cast("long").alias("completed_today"),
                 F.sum("first_pass_today").cast("long").alias("first_pass_today"))
            .withColumn("daily_fpy", C.pct2("first_pass_today", "completed_today")))


def weekly_fpy(ud: DataFrame) -> DataFrame:
    """Weekly FPY: traditional, completed-only and the unit breakdown.

    A unit is (sn, model) within one ISO week; its week counts are sums of its days.
    """
    unit_week = (ud.groupBy(C.week_start("day").alias("week_start"), "sn", "model")
                 .agg(F.sum("reached_packing").alias("reached"), F.sum("failure_count").alias("failures")))
    r, f = F.col("reached"), F.col("failures")
    out = (unit_week.groupBy("week_start")
           .agg(F.count(F.lit(1)).alias("parts_started"),
                C.count_if((r > 0) & (f == 0)).alias("first_pass_success"),
                C.count_if(r > 0).alias("parts_completed"),
                C.count_if(f > 0).alias("parts_failed"),
                C.count_if((r == 0) & (f == 0)).alias("parts_stuck_in_limbo")))
    return (out.withColumn("active_parts", F.col("parts_completed") + F.col("parts_failed"))
            .withColumn("traditional_fpy", C.pct2("first_pass_success", "parts_started"))
            .withColumn("completed_only_fpy", C.pct2("first_pass_success", "active_parts"))
            .withColumn("week_id", C.iso_week_label("week_start")))


# ------------------------------------------------------------ station level
def station_day(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """(date_id, model, station) -> total, passed, failed for tracked models (D13 base)."""
    return (prod(wl, cfg).filter(F.col("model").isin(*cfg.tracked_models))
            .groupBy(C.to_day(C.END).alias("date_id"), "model", "workstation_name")
            .agg(F.count(F.lit(1)).alias("total_parts"),
                 C.count_if(C.passed(cfg=cfg)).alias("passed_parts"),
                 C.count_if(C.not_pass(cfg=cfg)).alias("failed_parts")))


def tpy_daily(sd: DataFrame, sbw: DataFrame) -> DataFrame:
    """Daily station throughput yield with week attributes and the week's starters.

    ``sbw`` has one row per ISO week, a size bounded by the calendar, so
    Spark's own size check broadcasts it.
    """
    return (sd.withColumn("throughput_yield", C.pct2("passed_parts", "total_parts"))
            .withColumn("week_start", C.week_start("date_id"))
            .join(sbw, "week_start", "left")
            .select("date_id", "model", "workstation_name", "total_parts", "passed_parts", "failed_parts",
                    "throughput_yield", C.iso_week_label("date_id").alias("week_id"), "week_start",
                    F.date_add("week_start", 6).alias("week_end"),
                    F.coalesce("total_starters", F.lit(0).cast("long")).alias("total_starters")))


def recent_dates_filter(col: str | Column, as_of: _dt.date, days: int = 3) -> Column:
    """``as_of`` and the ``days-1`` days before it (D14); dates without data simply have no rows."""
    return C.in_range(col, F.lit(as_of - _dt.timedelta(days=days - 1)), F.lit(as_of + _dt.timedelta(days=1)))


def active_dates(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Distinct dates with production activity (G1)."""
    return prod(wl, cfg).filter(F.col(C.END).isNotNull()).select(C.to_day(C.END).alias("test_date")).distinct()


# ------------------------------------------------------------------ weekly
def weekly_station_yield(sd: DataFrame) -> DataFrame:
    """Per week: station yield per tracked model (level 0) and over models (level 1, model NULL)."""
    return (sd.withColumn("week_start", C.week_start("date_id"))
            .groupingSets([[F.col("week_start"), F.col("model"), F.col("workstation_name")],
                           [F.col("week_start"), F.col("workstation_name")]],
                          "week_start", "model", "workstation_name")
            .agg(F.sum("total_parts").cast("long").alias("total_parts"),
                 F.sum("passed_parts").cast("long").alias("passed_parts"),
                 F.sum("failed_parts").cast("long").alias("failed_parts"),
                 (F.grouping_id() / 2).cast("long").alias("level"))
            .withColumn("throughput_yield", C.pct2("passed_parts", "total_parts"))
            .withColumn("week_id", C.iso_week_label("week_start")))


def _fixed_order(cfg: YieldConfig) -> Column:
    pairs = []
    for model, stations in cfg.fixed_tpy_stations.items():
        for i, st in enumerate(stations):
            pairs += [F.lit(f"{model}|{st}"), F.lit(i)]
    return F.element_at(F.create_map(*pairs), F.concat_ws("|", "model", "workstation_name"))


def _stations_json(entries: Column) -> Column:
    """``{"station": yield}`` with yields printed to 2 decimals, entries in array order."""
    return F.to_json(F.map_from_arrays(F.transform(entries, lambda x: x["workstation_name"]),
                                       F.transform(entries, lambda x: x["throughput_yield"].cast("decimal(7,2)"))))


def tpy_per_model(wsy: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Fixed-list and dynamic TPY per (week, tracked model) from ONE aggregate.

    Each week collects its station yields once (one entry per model and
    station, a list bounded by the station catalogue) and is spread over the
    tracked models, so a model without rows needs no join; the fixed formula
    takes the configured stations in formula order, the dynamic one takes
    all stations in the source report's order (visits descending, then
    name). A model without rows gets 100.00 over 0 stations (dynamic) and
    NULL (fixed); the fixed TPY is NULL unless every formula station is there.
    """
    per_model = wsy.filter(F.col("level") == 0).withColumn("ord", _fixed_order(cfg))
    entry = F.struct((-F.col("total_parts")).alias("k"), "workstation_name", "throughput_yield", "ord", "model")
    weeks = per_model.groupBy("week_start").agg(F.collect_list(entry).alias("all")).select(
        "week_start", "all", F.explode(F.array(*[F.lit(m) for m in cfg.tracked_models])).alias("model"))
    found = weeks.withColumn("e", F.filter("all", lambda x: x["model"] == F.col("model")))
    need = F.create_map(*[x for m, st in cfg.fixed_tpy_stations.items() for x in (F.lit(m), F.lit(len(st)))])
    e = F.col("e")
    dyn = F.array_sort(e)
    fixed = F.array_sort(F.transform(F.filter(e, lambda x: x["ord"].isNotNull()),
                                     lambda x: F.struct(x["ord"].alias("ord"), x["workstation_name"].alias(
                                         "workstation_name"), x["throughput_yield"].alias("throughput_yield"))))
    yields = lambda a: F.transform(a, lambda x: x["throughput_yield"])
    return (found
            .select(C.iso_week_label("week_start").alias("week_id"), "week_start", "model",
                    F.size(fixed).cast("long").alias("stations_found"),
                    F.when(F.size(fixed) == F.element_at(need, F.col("model")),
                           C.ordered_product_pct(yields(fixed))).alias("fixed_tpy"),
                    _stations_json(fixed).alias("fixed_stations_json"),
                    F.size(dyn).cast("long").alias("station_count"),
                    C.ordered_product_pct(yields(dyn)).alias("dynamic_tpy"),
                    _stations_json(dyn).alias("dynamic_stations_json")))


def tpy_fixed(wsy: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Fixed four-station TPY per (week, model)."""
    return tpy_per_model(wsy, cfg).select("week_id", "week_start", "model", "stations_found",
                                          F.col("fixed_tpy").alias("tpy"),
                                          F.col("fixed_stations_json").alias("stations_json"))


def tpy_dynamic(wsy: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """All-station TPY per (week, model)."""
    return tpy_per_model(wsy, cfg).select("week_id", "week_start", "model", "station_count",
                                          F.col("dynamic_tpy").alias("tpy"),
                                          F.col("dynamic_stations_json").alias("stations_json"))


def weekly_overall_yield(daily_kpi: DataFrame) -> DataFrame:
    """Per week, from the daily KPI table: passed visits / all visits (D20, C6 as an equi key, Q14)."""
    return (daily_kpi.groupBy(C.week_start("date_id").alias("week_start"))
            .agg(F.sum("total_parts").cast("long").alias("total_parts"),
                 F.sum("passed_parts").cast("long").alias("completed_parts"))
            .withColumn("overall_yield", C.pct2("completed_parts", "total_parts"))
            .withColumn("week_id", C.iso_week_label("week_start")))


def weekly_station_summary(wsy: DataFrame) -> DataFrame:
    """Per week over the all-model station yields: unweighted mean, count, best and worst.

    Ties keep the station seen first in the source report order: lowest model
    name, then most visits in that model, then station name. The window is
    per week over that week's stations only, a group bounded by the station list.
    """
    per_model = wsy.filter(F.col("level") == 0)
    first_seen = (per_model.groupBy("week_start", "workstation_name")
                  .agg(F.min(F.struct("model", (-F.col("total_parts")).alias("neg_total"))).alias("fs")))
    overall = wsy.filter(F.col("level") == 1).join(first_seen, ["week_start", "workstation_name"])
    w = Window.partitionBy("week_start").orderBy(F.col("fs"), F.col("workstation_name"))
    overall = overall.withColumn("ord", F.row_number().over(w))
    y100 = F.round(F.col("throughput_yield") * 100).cast("long")
    return (overall.groupBy("week_start")
            .agg(F.count(F.lit(1)).alias("total_stations"),
                 F.sum(y100).alias("y_sum"),
                 F.max_by("workstation_name", F.struct("throughput_yield", (-F.col("ord")).alias("o")))
                 .alias("best_station_name"),
                 F.max("throughput_yield").alias("best_station_yield"),
                 F.min_by("workstation_name", F.struct("throughput_yield", "ord")).alias("worst_station_name"),
                 F.min("throughput_yield").alias("worst_station_yield"))
            .withColumn("average_yield", half_even_div(F.col("y_sum"), F.col("total_stations")).cast("double") / 100)
            .drop("y_sum")
            .withColumn("week_id", C.iso_week_label("week_start")))


def _short(cfg: YieldConfig, model: str) -> str:
    return cfg.model_short_names.get(model, model).lower()


def _week_stations(sd: DataFrame) -> DataFrame:
    """One row per week: ``stations``, each with its counts over all models and by model.

    A week's list has one entry per station, each with one per tracked model: a size bounded by the station list. All
    station figures of the weekly record are array expressions over it, so the week is shuffled once, not per figure.
    """
    counts = [F.sum(c).cast("long").alias(c) for c in ("total_parts", "passed_parts", "failed_parts")]
    by_model = (sd.withColumn("week_start", C.week_start("date_id"))
                .groupBy("week_start", "workstation_name", "model").agg(*counts))
    cols = ["model", "total_parts", "passed_parts", "failed_parts"]
    station = by_model.groupBy("week_start", "workstation_name").agg(*counts, F.collect_list(F.struct(*cols)).alias("models"))
    return station.groupBy("week_start").agg(
        F.sum("total_parts").cast("long").alias("total_parts"), F.sum("passed_parts").cast("long").alias("completed_parts"),
        F.collect_list(F.struct("workstation_name", *cols[1:], "models")).alias("stations"))


def _entry(name: Column, c: Column) -> Column:
    """A station's metrics as a map entry."""
    return F.struct(name.alias("workstation_name"), F.struct(
        c["total_parts"].alias("totalParts"), c["passed_parts"].alias("passedParts"), c["failed_parts"].alias("failedParts"),
        C.pct2(c["passed_parts"], c["total_parts"]).cast("decimal(7,2)").alias("throughputYield")).alias("m"))


def _map_json(entries: Column) -> Column:
    """JSON of map entries by station, ``{}`` for none."""
    return F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(F.array_sort(entries)))).otherwise("{}")


def _quoted(k: str) -> Column:
    return F.to_json(F.array(F.lit(k))).substr(F.lit(2), F.length(F.to_json(F.array(F.lit(k)))) - 2)


def weekly_stations(sd: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per week all station figures of the weekly record, from one list per week.

    The same figures as ``weekly_overall_yield``, ``weekly_station_summary``, ``tpy_per_model`` and ``station_metrics_json``.
    """
    st = F.col("stations")

    def of_model(m: str) -> Column:
        """Stations of one model: k orders them by visits, then name."""
        return F.array_sort(F.flatten(F.transform(st, lambda s: F.transform(
            F.filter(s["models"], lambda x: x["model"] == m), lambda x: F.struct(
                (-x["total_parts"]).alias("k"), s["workstation_name"].alias("workstation_name"),
                C.pct2(x["passed_parts"], x["total_parts"]).alias("throughput_yield"), x.alias("c"))))))

    def fixed_of(m: str) -> Column:
        """The formula's stations that the week has, in formula order."""
        order = F.array(*[F.lit(x) for x in cfg.fixed_tpy_stations.get(m, ())])
        return F.array_sort(F.filter(F.transform(F.col(f"_{_short(cfg, m)}"), lambda x: F.struct(
            F.array_position(order, x["workstation_name"]).alias("ord"), x["workstation_name"].alias("workstation_name"),
            x["throughput_yield"].alias("throughput_yield"))), lambda x: x["ord"] > 0))

    # Ties keep the station seen first in the source report's order: lowest model, most visits in it, name.
    ranked = F.transform(st, lambda s: F.struct(
        C.pct2(s["passed_parts"], s["total_parts"]).alias("y"),
        F.array_min(F.transform(s["models"], lambda x: F.struct(x["model"].alias("model"), (-x["total_parts"]).alias("n")))).alias("fs"),
        s["workstation_name"].alias("name")))
    worst, best = F.col("_worst"), F.col("_best")
    yields = lambda a: F.transform(a, lambda x: x["throughput_yield"])
    out = (_week_stations(sd)
           .withColumns({f"_{_short(cfg, m)}": of_model(m) for m in cfg.tracked_models} | {"_ranked": ranked})
           .withColumns({f"_fixed_{_short(cfg, m)}": fixed_of(m) for m in cfg.tracked_models} | {
               "_worst": F.array_min("_ranked"),
               "_best": F.array_min(F.transform("_ranked", lambda x: F.struct((-x["y"]).alias("y"), x["fs"].alias("fs"),
                                                                              x["name"].alias("name")))),
               "_all": F.transform(st, lambda s: _entry(s["workstation_name"], s)),
               "total_stations": F.size(st).cast("long"),
               "_sum": F.aggregate("_ranked", F.lit(0).cast("long"), lambda acc, x: acc + F.round(x["y"] * 100).cast("long"))}))
    cols = []
    for m in cfg.tracked_models:
        k = _short(cfg, m)
        dyn, fixed = F.col(f"_{k}"), F.col(f"_fixed_{k}")
        cols += [_stations_json(fixed).alias(f"weekly_tpy_hardcoded_{k}_stations"),
                 F.when(F.size(fixed) == len(cfg.fixed_tpy_stations.get(m, ())), C.ordered_product_pct(yields(fixed))).alias(
                     f"weekly_tpy_hardcoded_{k}_tpy"),
                 _stations_json(dyn).alias(f"weekly_tpy_dynamic_{k}_stations"),
                 C.ordered_product_pct(yields(dyn)).alias(f"weekly_tpy_dynamic_{k}_tpy"),
                 F.size(dyn).cast("long").alias(f"weekly_tpy_dynamic_{k}_station_count")]
    named = [(m, F.transform(F.col(f"_{_short(cfg, m)}"), lambda x: _entry(x["workstation_name"], x["c"])))
             for m in cfg.tracked_models] + [("overall", F.col("_all"))]
    model_json = F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(_quoted(k), F.lit(":"), _map_json(e)) for k, e in named]), F.lit("}"))
    return out.select(
        "week_start", "total_parts", "completed_parts", C.pct2("completed_parts", "total_parts").alias("overall_yield"),
        _map_json(F.col("_all")).alias("station_metrics"), model_json.alias("model_specific"),
        (half_even_div(F.col("_sum"), F.col("total_stations")).cast("double") / 100).alias("average_yield"), *cols, "total_stations",
        best["name"].alias("best_station_name"), (-best["y"]).alias("best_station_yield"),
        worst["name"].alias("worst_station_name"), worst["y"].alias("worst_station_yield"))


def tpy_weekly(ud: DataFrame, sd: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """The full weekly KPI record, one row per week with station rows, i.e. with daily KPI rows.

    Two aggregates, of the units and of the stations, each down to one row per week, and one join of the two.
    """
    fpy = weekly_fpy(ud).drop("week_id")
    out = weekly_stations(sd, cfg).join(fpy, "week_start", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        C.iso_week_label("week_start").alias("week_id"), "week_start",
        F.date_add("week_start", 6).alias("week_end"), F.lit(7).alias("days_in_week"),
        F.coalesce("parts_started", zero).alias("weekly_first_pass_yield_traditional_parts_started"),
        F.coalesce("first_pass_success", zero).alias("weekly_first_pass_yield_traditional_first_pass_success"),
        F.coalesce("traditional_fpy", F.lit(0.0)).alias("weekly_first_pass_yield_traditional_first_pass_yield"),
        F.coalesce("active_parts", zero).alias("weekly_first_pass_yield_completed_only_active_parts"),
        F.coalesce("first_pass_success", zero).alias("weekly_first_pass_yield_completed_only_first_pass_success"),
        F.coalesce("completed_only_fpy", F.lit(0.0)).alias("weekly_first_pass_yield_completed_only_first_pass_yield"),
        F.coalesce("parts_completed", zero).alias("weekly_first_pass_yield_breakdown_parts_completed"),
        F.coalesce("parts_failed", zero).alias("weekly_first_pass_yield_breakdown_parts_failed"),
        F.coalesce("parts_stuck_in_limbo", zero).alias("weekly_first_pass_yield_breakdown_parts_stuck_in_limbo"),
        F.coalesce("parts_started", zero).alias("weekly_first_pass_yield_breakdown_total_parts"),
        F.col("total_parts").alias("weekly_overall_yield_total_parts"),
        F.col("completed_parts").alias("weekly_overall_yield_completed_parts"),
        F.col("overall_yield").alias("weekly_overall_yield_overall_yield"),
        F.col("station_metrics").alias("weekly_throughput_yield_station_metrics"),
        F.col("average_yield").alias("weekly_throughput_yield_average_yield"),
        F.col("model_specific").alias("weekly_throughput_yield_model_specific"),
        *[c for m in cfg.tracked_models for c in (
            f"weekly_tpy_hardcoded_{_short(cfg, m)}_stations", f"weekly_tpy_hardcoded_{_short(cfg, m)}_tpy",
            f"weekly_tpy_dynamic_{_short(cfg, m)}_stations", f"weekly_tpy_dynamic_{_short(cfg, m)}_tpy",
            f"weekly_tpy_dynamic_{_short(cfg, m)}_station_count")],
        "total_stations", "best_station_name", "best_station_yield", "worst_station_name", "worst_station_yield",
    )


def _metrics() -> Column:
    return F.struct(F.col("total_parts").alias("totalParts"), F.col("passed_parts").alias("passedParts"),
                    F.col("failed_parts").alias("failedParts"),
                    F.col("throughput_yield").cast("decimal(7,2)").alias("throughputYield"))


def _station_maps(wsy: DataFrame) -> DataFrame:
    """week_start, model (NULL: all models), e: the stations' metrics as sorted map entries.

    Entries are sorted by station so the text is deterministic; one map per
    week holds one entry per station, a size bounded by the station list.
    """
    return (wsy.select("week_start", "model", "workstation_name", _metrics().alias("m"))
            .groupBy("week_start", "model")
            .agg(F.array_sort(F.collect_list(F.struct("workstation_name", "m"))).alias("e")))


def station_metrics_json(wsy: DataFrame) -> DataFrame:
    """Per week, the JSON text of the station metric maps (A16): all-model and per model."""
    return _station_maps(wsy).select(
        C.iso_week_label("week_start").alias("week_id"), F.coalesce("model", F.lit("overall")).alias("scope"),
        F.size("e").cast("long").alias("n_stations"), F.to_json(F.map_from_entries("e")).alias("station_metrics_json"))


def station_yield_from_record(record: DataFrame) -> DataFrame:
    """The station yields per week (``weekly_station_yield``) read back from the weekly record's JSON maps.

    The text is parsed once into a VARIANT, whose maps become rows; a map holds one entry per station.
    """
    metrics = "struct<totalParts:bigint,passedParts:bigint,failedParts:bigint,throughputYield:decimal(7,2)>"
    maps = F.variant_get(F.parse_json("weekly_throughput_yield_model_specific"), "$", f"map<string,map<string,{metrics}>>")
    rows = (record.select("week_id", "week_start", F.explode(maps).alias("scope", "stations"))
            .select("week_id", "week_start", "scope", F.explode("stations").alias("workstation_name", "m")))
    overall = F.col("scope") == "overall"
    return rows.select(
        "week_start", F.when(~overall, F.col("scope")).alias("model"), "workstation_name",
        F.col("m.totalParts").alias("total_parts"), F.col("m.passedParts").alias("passed_parts"),
        F.col("m.failedParts").alias("failed_parts"), overall.cast("long").alias("level"),
        F.col("m.throughputYield").cast("double").alias("throughput_yield"), "week_id")


def week_of(as_of: _dt.date) -> _dt.date:
    return as_of - _dt.timedelta(days=as_of.weekday())


def week_rows(wl: DataFrame, week: _dt.date) -> DataFrame:
    """Log rows of the ISO week starting ``week`` (half-open on the end time).

    The weekly record has no full-history term (starters are a daily-table
    attribute), so the current-week mode reads one week of the log: the
    bounds reach the Parquet scan and prune day partitions.
    """
    lo = _dt.datetime.combine(week_of(week), _dt.time())
    return wl.filter(C.in_range(C.END, C.ts_lit(lo), C.ts_lit(lo + _dt.timedelta(days=7))))
