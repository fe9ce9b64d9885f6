"""KPI tables in Parquet, one folder per period: append, replace, upsert, insert-ignore.

The period is a key column (the day or the ISO week of a row), so a write
reads and replaces the folders of its own periods only; the files of all other
periods are left alone. Replacing is Spark's dynamic partition overwrite.
Every write is computed into a table under the shared checkpoint folder first
(Spark cannot replace files that it is reading), so a job that fails while
computing leaves the table as it was. A driver that is lost while Spark moves
finished folders into place leaves some periods new and some old; writing the
same rows again mends that, as an upsert and an insert-ignore are idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import session
from ..functions import columns as C


class NullKeyError(ValueError):
    pass


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE``: updates win, other target rows stay.

    The anti join is NULL-safe; a plain equi anti join would never match NULL
    keys and would add such rows again at every upsert.
    """
    keys = list(keys)
    updates = updates.select(*target.columns)
    uk = updates.select(*keys).distinct()
    kept = target.join(uk, C.null_safe_key(target, uk, keys), "left_anti")
    return updates.unionByName(kept)


def check_null_keys(df: DataFrame, keys: Sequence[str], policy: str = "fail") -> DataFrame:
    """Apply the sink's NULL-key policy: ``fail`` (report offending keys), ``drop`` or ``keep`` (Q15)."""
    any_null = None
    for k in keys:
        term = F.col(k).isNull()
        any_null = term if any_null is None else any_null | term
    if policy == "keep":
        return df
    if policy == "drop":
        return df.filter(~any_null)
    bad = df.filter(any_null).select(*keys).limit(5).collect()  # at most 5 rows, for the message
    if bad:
        raise NullKeyError(f"NULL in primary key {list(keys)}: {[r.asDict() for r in bad]}")
    return df


def in_values(col: str, values: Sequence) -> Column:
    """NULL-safe ``col IN values``, a filter that prunes partitions."""
    named = [v for v in values if v is not None]
    cond = F.col(col).isin(named) if named else F.lit(False)
    return cond | F.col(col).isNull() if None in values else cond


class PeriodTable:
    """A Parquet table in folders by ``period`` (a column; ``None``: one folder, for tables of a few rows).

    ``null_keys`` is the table's NULL-key policy, unless a call names another. Writes return the number of rows written,
    as the write itself counted them.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (), period: str | None = None,
                 period_type: str = "date", null_keys: str = "fail"):
        self.spark, self.root, self.keys, self.null_keys = spark, root.rstrip("/"), list(keys), null_keys
        self.period, self.period_type = period, period_type

    def read_or_none(self) -> DataFrame | None:
        try:
            df = self.spark.read.parquet(self.root)
        except AnalysisException:  # no folder, or none with a file
            return None
        # Spark guesses the type of a folder name; a table whose only period is NULL has none to guess from.
        return df.withColumn(self.period, F.col(self.period).cast(self.period_type)) if self.period else df

    def exists(self) -> bool:
        return self.read_or_none() is not None

    def read(self) -> DataFrame:
        df = self.read_or_none()
        if df is None:
            raise FileNotFoundError(f"no table at {self.root}")
        return df

    def _write(self, df: DataFrame, mode: str, overwrite: str = "static") -> int:
        seen = Observation()
        # The rows of a period, a few per station and model, go to one file.
        df = df.repartition(self.period) if self.period else df.coalesce(1)
        # Counted on top of the plan: below an exchange that turns out empty, AQE would drop the count with its input.
        w = df.observe(seen, F.count(F.lit(1)).alias("n")).write
        if self.period:
            w = w.option("partitionOverwriteMode", overwrite).partitionBy(self.period)
        w.mode(mode).parquet(self.root)
        return seen.get["n"]

    def periods(self, df: DataFrame) -> list:
        """Distinct periods of ``df``: bounded by the calendar."""
        return [r[0] for r in df.select(self.period).distinct().collect()]

    def _touched(self, rows: DataFrame) -> DataFrame | None:
        """The table's rows of the periods of ``rows``; other folders are not read."""
        cur = self.read_or_none()
        return cur.filter(in_values(self.period, self.periods(rows))) if self.period and cur is not None else cur

    def _checked(self, df: DataFrame, null_keys: str | None) -> DataFrame:
        return check_null_keys(df, self.keys, null_keys or self.null_keys) if self.keys else df

    def replace(self, df: DataFrame, null_keys: str | None = None) -> int:
        """TRUNCATE + INSERT (A8): keys and periods no longer produced disappear (Q19)."""
        with session.Cuts(self.spark) as cuts:
            return self._write(self._checked(cuts.cut(df, "replace"), null_keys), "overwrite")

    def append(self, df: DataFrame) -> int:
        """Plain append (A7): files are added, none is read or replaced."""
        cur = self.read_or_none()
        return self._write(df if cur is None else df.select(*cur.columns), "append")

    def upsert(self, updates: DataFrame, null_keys: str | None = None) -> int:
        """Upsert by key (A9): the folders of the periods of ``updates`` are replaced, rows of other keys stay (Q19)."""
        with session.Cuts(self.spark) as cuts:
            updates = self._checked(cuts.cut(updates, "updates"), null_keys)
            cur = self._touched(updates)
            if cur is not None:
                updates = cuts.cut(merge_upsert(cur, updates, self.keys), "merged")
            return self._write(updates, "overwrite", "dynamic")

    def insert_ignore(self, incoming: DataFrame) -> int:
        """``ON CONFLICT DO NOTHING`` (A6): only keys absent from the table are added, as new files."""
        with session.Cuts(self.spark) as cuts:
            new = cuts.cut(incoming, "incoming")
            new = new.dropDuplicates(self.keys) if self.keys else new
            cur = self._touched(new)
            if cur is not None:
                lk = cur.select(*self.keys).distinct()
                new = new.select(*cur.columns).join(lk, C.null_safe_key(new, lk, self.keys), "left_anti")
            return self._write(new, "append")


class FirstActivity:
    """First activity per unit (sn, model), kept as signed rows in folders by ISO week.

    A unit enters a week with +1; when an earlier activity turns up, -1 takes
    it out of the week where it stood and +1 puts it where it belongs. So the
    starters of a week are read from that week's folder alone, and a batch
    adds its moves without a rewrite. A batch has folders of its own, so
    writing a batch again replaces what it wrote.
    """

    COLUMNS = "sn string, model string, first_activity_time timestamp_ntz, sign int"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _rows(self, weeks: Sequence | None = None, but: str | None = None) -> DataFrame:
        schema = f"{self.COLUMNS}, week_start date, batch string"
        try:
            df = self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException:
            return self.spark.createDataFrame([], self.COLUMNS)
        if weeks is not None:
            df = df.filter(F.col("week_start").isin(list(weeks)) if weeks else F.lit(False))
        if but is not None:
            df = df.filter(F.col("batch") != but)
        return df.select("sn", "model", "first_activity_time", "sign")

    def read(self, weeks: Sequence | None = None, moves: DataFrame | None = None, batch: str | None = None) -> DataFrame:
        """sn, model, first_activity_time of the units that start in ``weeks`` (all weeks: ``None``).

        ``moves``: rows of ``batch`` that count as if they were written already.
        """
        rows = self._rows(weeks, batch)
        if moves is not None:
            more = moves if weeks is None else moves.filter(
                C.week_start("first_activity_time").isin(list(weeks)) if weeks else F.lit(False))
            rows = rows.unionByName(more.select(*rows.columns))
        return (rows.groupBy("sn", "model", "first_activity_time").agg(F.sum("sign").alias("n")).where("n > 0").drop("n"))

    def moves(self, first: DataFrame) -> DataFrame:
        """Signed rows that bring the units of ``first`` (sn, model, first_activity_time) to their earliest time.

        Also takes out times that a write cut short has left behind.
        """
        now = self.read()
        held = now.join(first.select("sn", "model"), C.null_safe_key(now, first, ["sn", "model"]), "left_semi")
        both = (held.withColumn("held", F.lit(True)).unionByName(first.select(*held.columns).withColumn("held", F.lit(False))))
        t = F.col("first_activity_time")
        unit = both.groupBy("sn", "model").agg(  # a unit holds one time, two after a write that was cut short
            F.min(t).alias("t"), F.collect_set(F.when(F.col("held"), t)).alias("times"))
        out = F.transform(F.filter("times", lambda x: x > F.col("t")), lambda x: F.struct(x.alias("t"), F.lit(-1).alias("sign")))
        into = F.when(F.array_contains("times", F.col("t")), F.array().cast("array<struct<t:timestamp_ntz,sign:int>>")).otherwise(
            F.array(F.struct(F.col("t").alias("t"), F.lit(1).alias("sign"))))
        return unit.select("sn", "model", F.explode(F.concat(out, into)).alias("m")).select(
            "sn", "model", F.col("m.t").alias("first_activity_time"), F.col("m.sign").alias("sign"))

    def add(self, moves: DataFrame, batch: str) -> None:
        """Write the moves of ``batch``; a second write of the same batch replaces the first."""
        (moves.select("sn", "model", "first_activity_time", "sign", C.week_start("first_activity_time").alias("week_start"),
                      F.lit(batch).alias("batch"))
         .repartition("week_start").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("week_start", "batch").parquet(self.root))
