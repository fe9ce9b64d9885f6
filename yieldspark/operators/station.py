"""Station / fixture pass-fail rates and hourly counts.

All three are one hash aggregate each: partial aggregation on the mappers,
one shuffle on the group key, no window and no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C


def testboard_station_daily(tb: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per day, model, process and station: total, pass, strict fail, failure rate."""
    agg = (tb.filter(F.col(C.END).isNotNull())
           .groupBy(C.to_day(C.END).alias("end_date"), "model", "work_station_process", "workstation_name")
           .agg(F.count(F.lit(1)).alias("total"),
                C.count_if(C.passed(cfg=cfg)).alias("pass"),
                C.count_if(C.fail_strict(cfg=cfg)).alias("fail")))
    return agg.withColumn("failurerate", C.frac3("fail", "total"))


def fixture_daily(tb: DataFrame, cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Per day, fixture, model, pn and station: total, pass, strict fail."""
    return (tb.filter(F.col(C.END).isNotNull())
            .groupBy(C.to_day(C.END).alias("day"), "fixture_no", "model", "pn", "workstation_name")
            .agg(F.count(F.lit(1)).alias("total"),
                 C.count_if(C.passed(cfg=cfg)).alias("pass"),
                 C.count_if(C.fail_strict(cfg=cfg)).alias("fail")))


def station_hourly(wl: DataFrame) -> DataFrame:
    """Visits per date, hour of day and station."""
    return (wl.filter(F.col(C.END).isNotNull())
            .groupBy(C.to_day(C.END).alias("date"), F.hour(C.END).cast("int").alias("hour"), "workstation_name")
            .agg(F.count(F.lit(1)).alias("part_count")))
