"""Report ingest: conform, clean, de-duplicate, match against the log.

The client-side loop of one existence probe per incoming row becomes one
hash anti join; the per-file try/rollback becomes a quarantine split. All
key comparisons are NULL-safe (Q3), so loading the same report twice adds
nothing the second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, YieldConfig
from ..functions import columns as C
from ..sources.reports import BAD_COL, FILE_COL, ROW_COL, normalize_headers
from . import dedup


def conform(df: DataFrame, schema: T.StructType, data_source: str | None = None,
            cfg: YieldConfig = DEFAULT, keep: Sequence[str] = (FILE_COL, ROW_COL, BAD_COL),
            start_falls_back_to_end: bool = False) -> DataFrame:
    """Map any report layout onto ``schema``.

    Headers are normalised first; a column the report lacks becomes a typed
    NULL, extra columns are dropped. Text is trimmed and blank / null tokens
    become NULL (one cleaner for every path, Q2); timestamps are parsed from
    text, NULL when unparsable. ``id`` and ``created_at`` are the sink's.
    """
    df = normalize_headers(df)
    present = set(df.columns)  # the first of two columns with one name counts
    out = []
    for f in schema.fields:
        if f.name in ("id", "created_at"):
            continue
        if f.name == "data_source" and data_source is not None:
            out.append(F.lit(data_source).alias(f.name))
            continue
        if f.name not in present:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(C.strip_to_null(c, cfg.null_tokens).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            src = df.schema[f.name].dataType
            v = C.parse_ts(c) if isinstance(src, T.StringType) else c.cast("timestamp_ntz")
            out.append(v.alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    res = df.select(*out, *[k for k in keep if k in present])
    if start_falls_back_to_end:
        res = res.withColumn(C.START, F.coalesce(C.START, C.END))
    return res


def infile_dedup(df: DataFrame, keys: Sequence[str], file_col: str = FILE_COL,
                 order_col: str = ROW_COL) -> DataFrame:
    """First row wins per (file, key) (E4, Q18); hash-aggregate form, safe for hot copies."""
    return dedup.keep_first(df, [file_col, *keys], order=(order_col,))


def log_days_of(incoming: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The log rows that can match ``incoming`` at all.

    The key holds the end timestamp, so only log rows of a day present in
    the incoming rows can match (a missing end time matches a missing one).
    The set of days is bounded by the calendar, so Spark broadcasts it by its
    own size check and filters on the mappers of the log scan; a log with a
    day column (``end_date``) is matched on that, which prunes partitions.
    """
    if C.END not in keys:
        return log
    days = incoming.select(C.to_day(C.END).alias("_day")).distinct()
    day = log["end_date"] if "end_date" in log.columns else C.to_day(log[C.END])
    return log.join(days, day.eqNullSafe(days["_day"]), "left_semi")


def new_rows(incoming: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not in the log, NULL-safe on every column.

    The log is cut to the incoming days, then reduced to its distinct keys,
    so copies of one row in the log (however many) cost one partial-aggregated
    row each before the join, and the join never multiplies incoming rows.
    """
    lk = log_days_of(incoming, log, keys).select(*keys).distinct()
    return incoming.join(lk, C.null_safe_key(incoming, lk, keys), "left_anti")


def insert_ignore(incoming: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows an ``INSERT ... ON CONFLICT DO NOTHING`` would add (A6, C3): the first row of each key that the log lacks.

    Incoming rows and the log's keys meet in one aggregate by key, so both sides are shuffled once, copies are combined
    before that on either side, and no join follows (grouping takes NULLs as equal).
    """
    keys = list(keys)
    rest = [c for c in incoming.columns if c not in keys]
    order = [c for c in (ROW_COL, "id") if c in rest]
    # The constant keeps a row of NULLs apart from a key that has no incoming row.
    row = F.struct(F.lit(0).alias("_in"), *[F.col(c) for c in order + [c for c in rest if c not in order]])
    new = incoming.select(*keys, row.alias("_row"), F.lit(False).alias("_known"))
    old = log_days_of(incoming, log, keys).select(*keys, F.lit(None).cast(new.schema["_row"].dataType).alias("_row"),
                                                  F.lit(True).alias("_known"))
    both = new.union(old).groupBy(*keys).agg(F.min("_row").alias("_first"), F.max("_known").alias("_known"))
    return both.where("not _known").select(*[F.col(c if c in keys else f"_first.{c}").alias(c) for c in incoming.columns])


def load_report(incoming: DataFrame, log: DataFrame, keys: Sequence[str], file_col: str = FILE_COL) -> DataFrame:
    """Per incoming file: rows read, rows already in the log, new rows."""
    lk = log_days_of(incoming, log, keys).select(*keys).distinct().withColumn("_hit", F.lit(1))
    matched = incoming.join(lk, C.null_safe_key(incoming, lk, keys), "left")
    return (matched.groupBy(file_col)
            .agg(F.count(F.lit(1)).alias("rows_read"),
                 F.count("_hit").alias("existing_rows"),
                 C.count_if(F.col("_hit").isNull()).alias("new_rows")))


def mark_rejected(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``df`` plus ``reason``: that the row could not be read, or its first required column that is NULL; NULL for good
    rows (A14, Q21)."""
    reason = F.lit(None).cast("string")
    for c in reversed(list(required)):
        reason = F.when(F.col(c).isNull(), F.lit(f"null {c}")).otherwise(reason)
    if BAD_COL in df.columns:
        reason = F.coalesce(F.col(BAD_COL), reason)
    return df.withColumn("reason", reason).drop(BAD_COL)


def split_marked(marked: DataFrame, file_col: str = FILE_COL, file_atomic: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) of marked rows.

    With ``file_atomic`` a single bad row sends its whole file to quarantine:
    the bad files are found with an aggregate (one row per file) and applied
    with semi / anti joins, so a huge file is never gathered into one task.
    """
    if not file_atomic:
        return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())
    bad_files = marked.filter(F.col("reason").isNotNull()).select(file_col).distinct()
    good = marked.join(bad_files, file_col, "left_anti").drop("reason")
    bad = (marked.join(bad_files, file_col, "left_semi")
           .withColumn("reason", F.coalesce("reason", F.lit("file rejected"))))
    return good, bad


def quarantine_split(df: DataFrame, required: Sequence[str], file_col: str = FILE_COL,
                     file_atomic: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) by the NOT NULL rules (A14); write ``mark_rejected`` first to parse the source once."""
    return split_marked(mark_rejected(df, required), file_col, file_atomic)


def renormalize(log: DataFrame, schema: T.StructType) -> DataFrame:
    """A log in exactly the schema's columns, in order (A13): columns the schema no longer has (e.g. ``day``, a usage
    counter) are dropped, missing ones come back as typed NULLs. For rows at hand; a stored log is read that way, old and
    new layouts together and without a rewrite, by ``LogStore.read(schema)``."""
    present = set(log.columns)
    return log.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in present
                        else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
