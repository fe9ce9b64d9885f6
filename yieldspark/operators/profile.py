"""Profiles, health and diagnostic reports.

The source scripts ask these questions one date at a time; here each report
groups by the date instead, so one job answers it for every date. Top-k
reports rank aggregated rows (a few per date or per field), never raw rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C


def required_fields(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required field present?, its type, and how many rows carry a value."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [c for c in required if c in types]
    counts = df.agg(*[F.count(c).alias(c) for c in present]) if present else None
    rows = []
    for c in required:
        n = F.col(c) if c in types else F.lit(None).cast("long")
        rows.append(F.struct(F.lit(c).alias("field"), F.lit(c in types).alias("present"),
                             F.lit(types.get(c)).cast("string").alias("data_type"), n.alias("non_null_rows")))
    base = counts if counts is not None else df.limit(1).select()
    return base.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def record_counts(logs: dict[str, DataFrame], approx_rsd: float | None = None,
                  kpis: dict[str, DataFrame] | None = None) -> DataFrame:
    """Per table: rows and distinct serial numbers, and the logs' combined rows.

    KPI tables have no serial numbers (NULL there). Exact by default;
    ``approx_rsd`` switches to HyperLogLog++ (``approx_count_distinct``) for a
    health check that must stay one cheap pass.
    """
    distinct = (F.countDistinct("sn") if approx_rsd is None
                else F.approx_count_distinct("sn", rsd=approx_rsd))
    parts = [df.agg(F.count(F.lit(1)).alias("total_records"), distinct.alias("unique_sn"))
             .select(F.lit(name).alias("table_name"), "total_records", "unique_sn")
             for name, df in logs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    none = F.lit(None).cast("long").alias("unique_sn")
    total = out.agg(F.sum("total_records").alias("total_records")).select(F.lit("total").alias("table_name"), "total_records", none)
    out = out.unionByName(total)
    for name, df in (kpis or {}).items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("total_records"))
                              .select(F.lit(name).alias("table_name"), "total_records", none))
    return out


def recent_activity(logs: dict[str, DataFrame], as_of: _dt.datetime, hours: int = 24) -> DataFrame:
    """Rows created in the ``hours`` before ``as_of`` per table (B7); ``as_of`` replaces NOW()."""
    lo = as_of - _dt.timedelta(hours=hours)
    parts = [df.filter(F.col("created_at") >= C.ts_lit(lo)).agg(F.count(F.lit(1)).alias("recent_records"))
             .select(F.lit(name).alias("table_name"), "recent_records") for name, df in logs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def freshness_report(logs: dict[str, DataFrame], daily_kpi: DataFrame, as_of: _dt.date,
                     weekly_kpi: DataFrame | None = None) -> DataFrame:
    """Data range per log, the daily KPI rows of ``as_of``, and the weekly rows created on it or later."""
    parts = [df.filter(F.col(C.END).isNotNull())
             .agg(F.min(C.END).alias("earliest"), F.max(C.END).alias("latest"),
                  C.count_if(C.to_day(C.END) == F.lit(as_of)).alias("rows_on_as_of"))
             .select(F.lit(name).alias("table_name"), "earliest", "latest", "rows_on_as_of")
             for name, df in logs.items()]
    kpi = (daily_kpi.agg(F.min("date_id").cast("timestamp_ntz").alias("earliest"),
                         F.max("date_id").cast("timestamp_ntz").alias("latest"),
                         C.count_if(F.col("date_id") == F.lit(as_of)).alias("rows_on_as_of"))
           .select(F.lit("daily_tpy_metrics").alias("table_name"), "earliest", "latest", "rows_on_as_of"))
    if weekly_kpi is not None:
        day = C.ts_lit(_dt.datetime.combine(as_of, _dt.time()))
        parts.append(weekly_kpi.agg(F.min("week_start").cast("timestamp_ntz").alias("earliest"),
                                    F.max("week_start").cast("timestamp_ntz").alias("latest"),
                                    C.count_if(F.col("created_at") >= day).alias("rows_on_as_of"))
                     .select(F.lit("weekly_tpy_metrics").alias("table_name"), "earliest", "latest", "rows_on_as_of"))
    out = kpi
    for p in parts:
        out = out.unionByName(p)
    return out


def date_profile(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per date: production rows, PACKING rows, distinct units, distinct stations.

    Two distinct counts in one aggregate would multiply the raw rows before
    their shuffle; here one aggregate per (date, station) gives rows and
    stations, one per (date, sn) the units, and they meet by date.
    """
    p = wl.filter(C.is_production(cfg=cfg)).withColumn("test_date", C.to_day(C.END))
    by_station = (p.groupBy("test_date", C.STATION).agg(F.count(F.lit(1)).alias("n"))
                  .groupBy("test_date").agg(
                      F.sum("n").alias("production_records"),
                      F.sum(F.when(F.col(C.STATION) == cfg.packing_station, F.col("n")).otherwise(0)).alias("packing_records"),
                      F.count(C.STATION).alias("unique_stations")))
    units = p.select("test_date", "sn").distinct().groupBy("test_date").agg(F.count("sn").alias("unique_parts"))
    return (by_station.join(units, C.null_safe_key(by_station, units, ["test_date"]), "left")
            .select(by_station["test_date"], "production_records", "packing_records",
                    F.coalesce("unique_parts", F.lit(0).cast("long")).alias("unique_parts"), "unique_stations"))


def _top_per(df: DataFrame, part: str, k: int, order) -> DataFrame:
    w = Window.partitionBy(part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def date_top_stations(wl: DataFrame, k: int = 10, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per date, the k busiest production stations (D29); ranked over (date, station) aggregates."""
    agg = (wl.filter(C.is_production(cfg=cfg))
           .groupBy(C.to_day(C.END).alias("test_date"), C.STATION).agg(F.count(F.lit(1)).alias("n")))
    return _top_per(agg, "test_date", k, [F.desc("n"), F.col(C.STATION)])


def date_model_counts(wl: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per date: production rows by model."""
    return (wl.filter(C.is_production(cfg=cfg))
            .groupBy(C.to_day(C.END).alias("test_date"), "model").agg(F.count(F.lit(1)).alias("record_count")))


def busy_dates(wl: DataFrame, min_rows: int = 100, k: int = 10, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Dates with at least ``min_rows`` production rows, busiest k."""
    agg = (wl.filter(F.col(C.END).isNotNull() & C.is_production(cfg=cfg))
           .groupBy(C.to_day(C.END).alias("test_date"))
           .agg(F.count(F.lit(1)).alias("record_count"), F.countDistinct("sn").alias("unique_parts"),
                C.count_if(F.col(C.STATION) == cfg.packing_station).alias("packing_records"))
           .filter(F.col("record_count") >= min_rows))
    return agg.orderBy(F.desc("record_count"), F.col("test_date")).limit(k)


def flow_station_profile(wl: DataFrame) -> DataFrame:
    """Visits per (service flow, station), flow not NULL."""
    return (wl.filter(F.col(C.FLOW).isNotNull())
            .groupBy(C.FLOW, C.STATION).agg(F.count(F.lit(1)).alias("record_count")))


def day_flow_profile(wl: DataFrame) -> DataFrame:
    """Visits per (date, service flow), flow not NULL."""
    return (wl.filter(F.col(C.FLOW).isNotNull())
            .groupBy(C.to_day(C.END).alias("test_date"), C.FLOW).agg(F.count(F.lit(1)).alias("record_count")))


def top_station_yield(wl: DataFrame, k: int = 20, min_rows: int = 5, per_date: bool = True,
                      cfg: YieldConfig = DEFAULT, tracked_only: bool = False) -> DataFrame:
    """Station x model pass/fail with at least ``min_rows`` visits, top k by volume.

    ``tracked_only`` keeps the tracked models (the sample report over all dates).
    """
    keys = ([C.to_day(C.END).alias("test_date")] if per_date else []) + [F.col(C.STATION), F.col("model")]
    src = wl.filter(F.col("model").isin(*cfg.tracked_models)) if tracked_only else wl
    agg = (src.filter(C.is_production(cfg=cfg))
           .groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("total_parts"), C.count_if(C.passed(cfg=cfg)).alias("passed_parts"),
                C.count_if(C.not_pass(cfg=cfg)).alias("failed_parts"))
           .filter(F.col("total_parts") >= min_rows)
           .withColumn("throughput_yield", C.pct2("passed_parts", "total_parts")))
    order = [F.desc("total_parts"), F.col(C.STATION), F.col("model")]
    if per_date:
        return _top_per(agg, "test_date", k, order)
    return agg.orderBy(*order).limit(k)


def quality_profile(wl: DataFrame, top_flows: int = 10, top_stations: int = 15,
                    cfg: YieldConfig = DEFAULT) -> DataFrame:
    """One frequency table over model, production flow, station and status.

    One scan: each row is unpivoted into (field, value) pairs for the fields
    whose filter it passes, then a single aggregate counts them (map-side
    combined). The rank window runs over the distinct values of one field.
    """
    flow = F.col(C.FLOW)
    not_excluded = ~flow.isin(*cfg.non_production_flows)  # NULL flow drops out here as well (B1b)
    specs = [
        ("model", F.col("model"), F.col("model").isNotNull(), None),
        ("service_flow", flow, flow.isNotNull() & not_excluded, top_flows),
        ("workstation_name", F.col(C.STATION), F.col(C.STATION).isNotNull() & not_excluded, top_stations),
        ("history_station_passing_status", F.col(C.STATUS), F.col(C.STATUS).isNotNull() & not_excluded, None),
    ]
    pairs = F.array(*[F.when(cond, F.struct(F.lit(name).alias("field"), value.cast("string").alias("value")))
                      for name, value, cond, _ in specs])
    counts = (wl.select(F.explode(F.filter(pairs, lambda x: x.isNotNull())).alias("p"))
              .groupBy("p.field", "p.value").agg(F.count(F.lit(1)).alias("record_count")))
    w = Window.partitionBy("field").orderBy(F.desc("record_count"), F.col("value"))
    beyond = F.lit(False)  # only the fields that have a limit are cut at it
    for name, _, _, k in specs:
        if k:
            beyond = beyond | ((F.col("field") == name) & (F.col("rank") > k))
    return (counts.withColumn("rank", F.row_number().over(w).cast("long")).filter(~beyond)
            .select("field", "value", "record_count", "rank"))


def receive_by_hour(wl: DataFrame, hours: tuple[int, int] = (20, 24), day: _dt.date | None = None,
                    cfg: YieldConfig = DEFAULT) -> DataFrame:
    """RECEIVE visits in the [from, to) hour band of each date (B8); ``day`` narrows to one date."""
    src = wl.filter((F.col(C.STATION) == cfg.receive_station) & F.hour(C.END).between(hours[0], hours[1] - 1))
    if day is not None:
        src = src.filter(C.on_date(C.END, day))
    return src.select("sn", C.END, F.hour(C.END).cast("int").alias("hour")).orderBy(C.END, "sn")


def unit_lookup(log: DataFrame, lookup: DataFrame, keys: Sequence[str] = ("sn",)) -> DataFrame:
    """Batch form of the key lookup (B9): log rows whose key is in the lookup list (semi join)."""
    return log.join(lookup.select(*keys).distinct(), list(keys), "left_semi")


def match_diagnostics(incoming: DataFrame, log: DataFrame, full_key: Sequence[str],
                      id_col: str = "id") -> DataFrame:
    """Per incoming row: log rows matching on the full key, on sn, and on (sn, pn, model, station).

    The log is counted per full key, its rows and the incoming ones are united, and sums over the rows of a key give the
    matches at every width: grouping treats NULL keys as equal, and no join pairs incoming rows with log rows. All widths
    begin with the unit, so one exchange by unit serves them.
    """
    widths = {"exact_matches": list(full_key), "sn_matches": ["sn"],
              "four_col_matches": ["sn", "pn", "model", C.STATION]}
    full = log.groupBy(*full_key).agg(F.count(F.lit(1)).alias("n")).withColumn("in", F.lit(False))
    asked = incoming.select(id_col, *full_key).withColumns({"n": F.lit(0).cast("long"), "in": F.lit(True)})
    both = asked.unionByName(full, allowMissingColumns=True).repartition("sn")
    return both.withColumns({name: F.sum("n").over(Window.partitionBy(*keys)) for name, keys in widths.items()}).where(
        "in").select(id_col, *widths)
