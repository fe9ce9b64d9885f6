"""Reusable Column expressions (all JVM-side, codegen friendly).

Every helper returns a ``Column``; none of them touches data on the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, YieldConfig

END = "history_station_end_time"
START = "history_station_start_time"
STATUS = "history_station_passing_status"
FLOW = "service_flow"
STATION = "workstation_name"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- predicates
def is_production(flow: str | Column = FLOW, cfg: YieldConfig = DEFAULT) -> Column:
    """Production flow: not one of the excluded flows and not NULL (B1)."""
    c = col(flow)
    return c.isNotNull() & ~c.isin(*cfg.non_production_flows)


def ts_lit(t) -> Column:
    """A zone-less TIMESTAMP_NTZ literal from a ``datetime`` (no session / process zone involved)."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def in_range(c: str | Column, lo, hi) -> Column:
    """Half-open range ``lo <= c < hi`` (B2); bounds may be literals or Columns."""
    c = col(c)
    return (c >= lo) & (c < hi)


def on_date(c: str | Column, d) -> Column:
    """``DATE(c) = d`` rewritten as a half-open range so it prunes."""
    lo = F.lit(d).cast("date").cast("timestamp_ntz")
    return in_range(c, lo, lo + F.expr("INTERVAL 1 DAY"))


# -------------------------------------------------------------- conditionals
def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END): NULL conditions are not counted."""
    return F.count(F.when(cond, F.lit(1)))


def passed(status: str | Column = STATUS, cfg: YieldConfig = DEFAULT) -> Column:
    return col(status) == F.lit(cfg.pass_status)


def not_pass(status: str | Column = STATUS, cfg: YieldConfig = DEFAULT) -> Column:
    """Failure as the yield jobs count it: ``<> 'Pass'``; NULL is neither (Q6)."""
    return col(status) != F.lit(cfg.pass_status)


def fail_strict(status: str | Column = STATUS, cfg: YieldConfig = DEFAULT) -> Column:
    """Failure as the test-board jobs count it: ``= 'Fail'`` (Q6)."""
    return col(status) == F.lit(cfg.fail_status)


# --------------------------------------------------------------------- dates
def to_day(c: str | Column = END) -> Column:
    """``DATE(ts)``."""
    return F.to_date(col(c))


def weekend_fold(c: str | Column = END) -> Column:
    """Saturday -> Friday, Sunday -> Friday, other days unchanged.

    ``weekday`` is Monday=0 .. Sunday=6, so days past Friday (4) step back.
    """
    d = F.to_date(col(c))
    return F.date_sub(d, F.greatest(F.weekday(d) - 4, F.lit(0)))


def week_start(c: str | Column) -> Column:
    """Monday of the ISO week of a date/timestamp."""
    d = F.to_date(col(c))
    return F.date_sub(d, F.weekday(d))


def week_end(c: str | Column) -> Column:
    """Sunday of the ISO week of a date/timestamp."""
    return F.date_add(week_start(c), 6)


def iso_week_label(c: str | Column) -> Column:
    """``YYYY-Www`` with the ISO week-numbering year."""
    d = F.to_date(col(c))
    year = F.extract(F.lit("YEAROFWEEK"), d)
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def week_from_label(label: str | Column) -> tuple[Column, Column]:
    """Monday and Sunday of a ``YYYY-Www`` label via the January-4 rule."""
    lab = col(label)
    year = F.split(lab, "-W").getItem(0).cast("int")
    week = F.split(lab, "-W").getItem(1).cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(F.date_sub(jan4, F.weekday(jan4)), (week - 1) * 7)
    return monday, F.date_add(monday, 6)


def mdy(c: str | Column) -> Column:
    """Un-padded ``M/D/YYYY``."""
    return F.date_format(col(c), "M/d/yyyy")


# ------------------------------------------------------------------- numbers
def pct2(p: str | Column, t: str | Column) -> Column:
    """``round(p / t * 100, 2)`` with round-half-even on the exact ratio; 0 when t = 0.

    Integer arithmetic only, so Spark and any SQL oracle agree bit for bit.
    """
    p, t = col(p).cast("long"), col(t).cast("long")
    num = p * 10000
    r = num % t
    q = ((num - r) / t).cast("long")
    up = (r * 2 > t) | ((r * 2 == t) & (q % 2 == 1))
    rounded = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.when(t == 0, F.lit(0.0)).otherwise(rounded.cast("double") / 100)


def frac3(fail: str | Column, total: str | Column) -> Column:
    """``round(fail::numeric / NULLIF(total, 0), 3)`` half-up, as DECIMAL(5,3)."""
    f, t = col(fail).cast("long"), col(total).cast("long")
    q = ((f * 2000 + t) - ((f * 2000 + t) % (t * 2))) / (t * 2)
    return F.when(t == 0, F.lit(None)).otherwise((q.cast("double") / 1000).cast("decimal(5,3)"))


def ordered_product_pct(yields: Column) -> Column:
    """Product of percentages (as fractions) in array order, times 100, half-even 2 dp."""
    prod = F.aggregate(yields, F.lit(1.0).cast("double"), lambda acc, y: acc * (y / 100.0))
    return F.bround(prod * 100, 2)


# ------------------------------------------------------------------- strings
def blank_to_null(c: str | Column) -> Column:
    """Blank (after trimming) becomes NULL; other values keep their spaces."""
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def strip_to_null(c: str | Column, null_tokens: Iterable[str] = ()) -> Column:
    """Trim; blank or a null token (e.g. ``nan``) becomes NULL."""
    t = F.trim(col(c))
    tokens = [x for x in null_tokens if x != ""]
    cond = t == ""
    if tokens:
        cond = cond | t.isin(*tokens)
    return F.when(cond, F.lit(None)).otherwise(t)


# Accepted text layouts of spreadsheet timestamps besides ISO-8601.
SLASH_YMD_FORMATS = ("yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm", "yyyy/MM/dd")
SLASH_MDY_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy")
SLASH_MDY_AMPM_FORMATS = ("M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a")


def parse_ts(c: str | Column) -> Column:
    """NULL-safe timestamp parse to TIMESTAMP_NTZ; blank or unparsable text -> NULL.

    The text shape picks the parser first (ISO, year-first with slashes,
    month-first with or without AM/PM), so each value costs one or two parse
    attempts instead of a cascade of failing ones.
    """
    s = F.trim(col(c).cast("string"))

    def attempt(fmts):
        return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in fmts])

    return (F.when((s == "") | s.isNull(), F.lit(None).cast("timestamp_ntz"))
            .when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), s.try_cast("timestamp_ntz"))
            .when(s.rlike(r"^\d{4}/"), attempt(SLASH_YMD_FORMATS))
            .when(s.rlike(r"(?i)[ap]m$"), attempt(SLASH_MDY_AMPM_FORMATS))
            .when(s.rlike(r"^\d{1,2}/"), attempt(SLASH_MDY_FORMATS))
            .otherwise(s.try_cast("timestamp_ntz")))


def safe_int(c: str | Column) -> Column:
    """Integer from text or number, NULL when not numeric; ``"3.0"`` -> 3."""
    return F.trim(col(c).cast("string")).try_cast("double").cast("int")


def null_safe_key(left, right, keys: Iterable[str]) -> Column:
    """Conjunction of ``left.k <=> right.k`` over keys (Q3)."""
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond
