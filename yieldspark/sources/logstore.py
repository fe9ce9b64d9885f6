"""Append-only master log on Parquet, partitioned by end date.

Appends go through Spark's file commit protocol (a failed or retried job
leaves no partial files), and every append is preceded by a NULL-safe anti
join against the log, so replaying a batch after an executor loss or a
restart adds nothing twice. The anti join reads only the log partitions of
the dates present in the batch (static partition pruning on ``end_date``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import columns as C
from .sinks import in_values

PARTITION_COL = "end_date"


class LogStore:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def read(self, schema: T.StructType | None = None) -> DataFrame | None:
        """The log; with ``schema`` in exactly these columns, whatever layout its files were written in.

        Parquet columns are bound by name, so files with columns that the schema has dropped and files without columns that
        it has gained are read together, and none is rewritten.
        """
        reader = self.spark.read
        if schema is not None:
            fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name != PARTITION_COL]
            reader = reader.schema(T.StructType([*fields, T.StructField(PARTITION_COL, T.DateType())]))
        try:
            df = reader.parquet(self.path)
            return df if schema is None else df.select(*[f.name for f in fields], PARTITION_COL)
        except AnalysisException:
            return None

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Batch rows (first per key) whose key is not yet in the log."""
        from ..operators import dedup
        order = [c for c in ("row_ordinal", "id") if c in batch.columns]
        batch = dedup.keep_first(batch, self.keys, order=order) if order else batch.dropDuplicates(self.keys)
        log = self.read()
        if log is None:
            return batch
        # Dates in one batch are bounded by the calendar, so this list is small.
        days = [r[0] for r in batch.select(C.to_day(C.END)).distinct().collect()]
        lk = log.filter(in_values(PARTITION_COL, days)).select(*self.keys).distinct()
        return batch.join(lk, C.null_safe_key(batch, lk, self.keys), "left_anti")

    def append(self, batch: DataFrame) -> int:
        """Append the batch's new rows; returns how many, counted by the write itself."""
        seen = Observation()
        new = self.new_rows(batch).drop("row_ordinal").withColumn(PARTITION_COL, C.to_day(C.END))
        (new.observe(seen, F.count(F.lit(1)).alias("n"))
         .write.mode("append").partitionBy(PARTITION_COL).parquet(self.path))
        return seen.get["n"]

    def dedup(self) -> dict[str, int]:
        """Keep the first row of every key (E1, E2); only the day partitions that hold copies are rewritten.

        The kept rows go through a written table first: Spark cannot replace files that it is reading.
        """
        from .. import session
        from ..operators import dedup
        log = self.read()
        if log is None:
            return {"removed": 0, "days": 0}
        copies = (log.groupBy(PARTITION_COL, *self.keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                  .groupBy(PARTITION_COL).agg(F.sum(F.col("n") - 1).alias("removed")).collect())  # a row per day at most
        days = [r[PARTITION_COL] for r in copies]
        if not days:
            return {"removed": 0, "days": 0}
        part = log.filter(in_values(PARTITION_COL, days))
        order = [c for c in ("id", "created_at") if c in log.columns][:1]
        kept = dedup.keep_first(part, self.keys, order=order) if order else part.dropDuplicates(self.keys)
        with session.Cuts(self.spark) as cuts:
            kept = cuts.cut(kept, "dedup")
            kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COL).parquet(self.path)
        return {"removed": sum(r["removed"] for r in copies), "days": len(days)}
