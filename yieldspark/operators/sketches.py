"""Distinct units over many ranges from one sketch per day.

An exact distinct count of units over weeks, months or any range reads the log
again for each, since the counts of days do not add up. A theta sketch of a
day's units does: the sketches of days are merged upwards into any range, and
intersected to tell the units that two ranges share. Only the days' table (a
row per day) is read for that.

Error. A sketch keeps up to ``2 ** lg_k`` hashes. A range with fewer units is
counted exactly; beyond, the relative standard error is ``2 ** (-lg_k / 2)``,
0.4 % at the default. ``profile.date_profile`` is the exact form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C

LG_K = 16
#: Ranges that days are merged into.
RANGES = ("week", "month")


def unit_sketches(wl: DataFrame, lg_k: int = LG_K, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per date: production rows, PACKING rows and the sketch of its units; store it and add days as they come."""
    p = wl.filter(C.is_production(cfg=cfg) & F.col(C.END).isNotNull())
    return p.groupBy(C.to_day(C.END).alias("test_date")).agg(
        F.count(F.lit(1)).alias("production_records"), C.count_if(F.col(C.STATION) == cfg.packing_station).alias("packing_records"),
        F.theta_sketch_agg("sn", lg_k).alias("units"))


def range_sketches(days: DataFrame, ranges: tuple[str, ...] = RANGES, lg_k: int = LG_K) -> DataFrame:
    """Per kind of range and start: rows and the merged sketch of its days."""
    starts = F.explode(F.array(*[F.struct(F.lit(r).alias("kind"), F.trunc("test_date", r).alias("start")) for r in ranges]))
    return (days.withColumn("r", starts).groupBy(F.col("r.kind").alias("range_kind"), F.col("r.start").alias("range_start"))
            .agg(F.sum("production_records").cast("long").alias("production_records"),
                 F.sum("packing_records").cast("long").alias("packing_records"),
                 F.theta_union_agg("units", lg_k).alias("units")))


def unit_ranges(days: DataFrame, ranges: tuple[str, ...] = RANGES, lg_k: int = LG_K) -> DataFrame:
    """Per range: rows, distinct units, and those of them that the range before had, too."""
    r = range_sketches(days, ranges, lg_k)
    step = F.when(F.col("range_kind") == "week", F.date_add("range_start", 7)).otherwise(F.add_months("range_start", 1).cast("date"))
    before = r.select("range_kind", step.alias("range_start"), F.col("units").alias("units_before"))
    both = F.when(F.col("units_before").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("units", "units_before")))
    return r.join(before, ["range_kind", "range_start"], "left").select(
        "range_kind", "range_start", "production_records", "packing_records",
        F.theta_sketch_estimate("units").cast("long").alias("unique_parts"),
        F.coalesce(both.cast("long"), F.lit(0).cast("long")).alias("returning_parts"))
