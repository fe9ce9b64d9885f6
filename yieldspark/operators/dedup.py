"""Keep-first de-duplication and duplicate reports.

Keep-first is planned as a hash aggregate, not a window: ``min(struct(order,
rest...))`` per key combines map-side, so a group of copies that holds a
third of the table is reduced on every mapper before it is shuffled, instead
of landing whole in one window task. Grouping treats NULL keys as equal,
which is the NULL-safe semantics chosen for every key comparison (Q3).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                T.DateType, T.TimestampType, T.TimestampNTZType)


def _fixed_width(dt: T.DataType) -> bool:
    return isinstance(dt, _FIXED_WIDTH) or (isinstance(dt, T.DecimalType) and dt.precision <= 18)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("id",)) -> DataFrame:
    """One row per distinct key: the row with the smallest ``order`` value (unique per row).

    With one fixed-width order column and fixed-width payload columns the
    plan is a HashAggregate (``min`` + ``min_by``); otherwise a ``min`` over a
    struct, which Spark runs as a sort-based aggregate. Both combine map-side.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in order if c in rest]
    others = [c for c in rest if c not in order]
    if len(order) == 1 and all(_fixed_width(df.schema[c].dataType) for c in rest):
        o = order[0]
        out = df.groupBy(*keys).agg(F.min(o).alias(o), *[F.min_by(c, o).alias(c) for c in others])
        return out.select(*df.columns)
    packed = F.min(F.struct(*[F.col(c) for c in order + others])).alias("_first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + others]).select(*df.columns)


def duplicate_counts(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """before / removed / after for one table (E3): two aggregates, no row leaves the executors."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (groups.agg(F.sum("n").cast("long").alias("before_count"), F.count(F.lit(1)).alias("after_count"))
            .select(F.lit(table).alias("table_name"), "before_count",
                    (F.col("before_count") - F.col("after_count")).alias("removed"), "after_count"))


def dedup_report(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-table rows plus a ``total`` row summed over them (one row per table, so tiny)."""
    per_table = parts[0]
    for p in parts[1:]:
        per_table = per_table.unionByName(p)
    return (per_table.rollup("table_name")  # one pass: the tables' rows are not computed again for their sum
            .agg(*[F.sum(c).cast("long").alias(c) for c in ("before_count", "removed", "after_count")])
            .withColumn("table_name", F.coalesce("table_name", F.lit("total"))))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity (A11 UNIQUE check)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_violations(df: DataFrame, not_null: Sequence[str]) -> DataFrame:
    """Per NOT NULL column, how many rows break it (A11); one aggregate pass."""
    nulls = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null])
    stacked = nulls.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("n"))
                                               for c in not_null])).alias("s"))
    return stacked.select("s.column_name", "s.n")
