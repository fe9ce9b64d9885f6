"""Completions against starters as a join of two streams.

Left side: the log. Right side: first activities of units. A visit counts if
its serial number has a first activity in the visit's week, of whatever
model, so the two are at most a week apart: the join holds rows of both sides
only until the watermark has passed them by a week, however long the stream
runs. Visits that found a starter are counted by unit and day, and these by
day and model, in windows that close with the watermark.

Every row that comes in no later than ``delay`` behind the newest one of its
side counts, in any order and however the rows fall into batches: the result
is that of ``tpy.daily_completions``. A later row may be left out (the watermark
takes hold one batch after it moves); ``stream.start_kpi_refresh`` counts its
week again from the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C
from ..operators import tpy
from . import stream

STARTERS = "sn string, model string, first_activity_time timestamp_ntz"


def visits_of_starters(log: DataFrame, starters: DataFrame, delay: str = "2 days", cfg: YieldConfig = DEFAULT) -> DataFrame:
    """Production visits of units that started in the week of the visit: sn, model, reached, failed, event_time.

    ``starters``: sn, first_activity_time. Both sides are streams; NULL serial numbers meet, as in the batch form.
    """
    visits = tpy.prod(log, cfg).select(
        "sn", "model", (F.col(C.STATION) == cfg.packing_station).alias("reached"), C.not_pass(cfg=cfg).alias("failed"),
        C.week_start(C.END).alias("week"), F.col(C.END).cast("timestamp").alias("event_time")).withWatermark("event_time", delay)
    first = starters.where("first_activity_time is not null").select(
        F.col("sn").alias("starter"), C.week_start("first_activity_time").alias("first_week"),
        F.col("first_activity_time").cast("timestamp").alias("first_time")).withWatermark("first_time", delay)
    week = F.expr("interval 7 days")
    near = (F.col("event_time") > F.col("first_time") - week) & (F.col("event_time") < F.col("first_time") + week)
    same = F.col("sn").eqNullSafe(F.col("starter")) & (F.col("week") == F.col("first_week"))
    return visits.join(first, same & near, "left_semi").drop("week")


def completions(log: DataFrame, starters: DataFrame, delay: str = "2 days", cfg: YieldConfig = DEFAULT) -> DataFrame:
    """The rows of ``tpy.daily_completions``, each once its day is behind the watermark (append mode)."""
    unit_day = (visits_of_starters(log, starters, delay, cfg)
                .groupBy(F.window("event_time", "1 day").alias("w"), "sn", "model")
                .agg(C.count_if(F.col("reached")).alias("reached"), C.count_if(F.col("failed")).alias("failures")))
    day = (unit_day.where("reached > 0")
           .groupBy(F.window("w", "1 day").alias("d"), "model")
           .agg(F.count(F.lit(1)).alias("completed_today"), C.count_if(F.col("failures") == 0).alias("first_pass_today")))
    return day.select(F.to_date("d.start").alias("date_id"), "model", "completed_today", "first_pass_today",
                      C.pct2("first_pass_today", "completed_today").alias("model_fpy"))


def start_daily_completions(spark: SparkSession, log_path: str, starters_path: str, out_root: str, checkpoint: str,
                            available_now: bool = True, delay: str = "2 days", cfg: YieldConfig = DEFAULT,
                            name: str = "daily_completions", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Completions from a growing log and a growing folder of first activities into their KPI table.

    A batch that runs again replaces the rows that it wrote before.
    """
    spark.conf.set("spark.sql.streaming.statefulOperator.allowMultiple", "true")
    first = spark.readStream.schema(STARTERS)
    if max_files_per_trigger:
        first = first.option("maxFilesPerTrigger", str(max_files_per_trigger))
    log = stream._log_stream(spark, log_path, max_files_per_trigger)

    def fn(days: DataFrame, batch_id: int) -> None:
        stream.kpi_table(spark, out_root, name).upsert(days)

    writer = completions(log, first.parquet(starters_path), delay, cfg).writeStream.outputMode("append").foreachBatch(fn)
    return stream._start(writer, checkpoint, available_now)
