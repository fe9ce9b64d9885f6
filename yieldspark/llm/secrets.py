"""Secret scans with DataFrame functions only.

Two kinds of findings, as code-point spans (end exclusive) of the whole text:

* patterns: assigned values (``password = ...``), access keys (``AKIA...``)
  and long hex runs, leftmost and non-overlapping per kind;
* entropy: per character class, every maximal run of the class is a candidate;
  a window slides over it and its Shannon entropy is kept up to date by adding
  the count of the character that enters and taking off the one that leaves.
  The span reaches from the first window at or over the class's threshold to
  the end of the last one. A window that overlaps a match of the allow-list is
  suppressed: the stretches of a run between such matches are walked, each with
  a span of its own. The allow-list never touches pattern findings.

Entropy is held in integers (a table of ``c * log2(c)`` scaled by 2**20), so a
window's value does not depend on the windows before it. The counts of a window
are packed, ``PER`` symbols of 5 bits to a long, so that a step changes two of a
few numbers whatever the size of the alphabet.

Defined cases: a NULL or empty text has no spans and stays as it is; every row
is scanned by itself, so ties, repeated rows and ids need no rule; an empty
table gives an empty result; other columns are ignored by ``scan`` and passed
through by ``redact``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, let, running_sums, text_or_empty

# The three base patterns and their least lengths.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6)
#: A maximal run is found whole or not at all, so the least length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

SCALE = 1 << 20
PER, BITS = 12, 5


@dataclass(frozen=True)
class CharClass:
    name: str
    chars: str       # regular expression of one character
    alphabet: str    # the same characters, listed
    window: int
    bits: float      # least entropy of a window
    mixed: str       # what a candidate must look like besides (regular expression, anchored: one look at a run, not one per place)
    skip: str = ""   # whole runs left to another class


_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    CharClass("entropy_hex", "[0-9a-f]", _DIGIT + "abcdef", 20, 3.0, r"^(?=.*[0-9])(?=.*[a-f])"),
    CharClass("entropy_base64", "[A-Za-z0-9+/_=-]", _UPPER + _LOWER + _DIGIT + "+/_=-", 20, 3.75,
              r"^(?=.*[0-9])(?=.*[A-Za-z])", r"^[0-9a-f]+$"),
    # Upper-case and mixed-case keys; 16 symbols of either case never reach the bits of the class above reliably.
    CharClass("entropy_hex_any", "[0-9A-Fa-f]", _DIGIT + "abcdefABCDEF", 20, 3.0, r"^(?=.*[0-9])(?=.*[A-Fa-f])", r"^[0-9a-f]+$"),
    # At 3.2 bits, 1.5 in 1,000 windows of random base32 are missed (50,000 drawn).
    CharClass("entropy_base32", "[A-Z2-7]", _UPPER + "234567", 20, 3.2, r"^(?=.*[2-7])(?=.*[A-Z])"),
)

#: What looks random in a run and is no secret: published example keys, UUIDs, digests of the empty input, counting runs,
#: hashes named as such. A pattern that is to suppress a whole run must match all of it.
ALLOW = (
    r"(?i)example|sample|placeholder|dummy|changeme|x{4,}",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)^(d41d8cd98f00b204e9800998ecf8427e|da39a3ee5e6b4b0d3255bfef95601890afd80709"
    r"|e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855)$",
    r"(?i)0123456789abcdef|abcdefghijklmnop|^sha(256|384|512)-.*$",
)

KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))
SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches as array<struct<start, end, value>>: leftmost, non-overlapping; ``value`` is the group's text."""
    p = F.lit(pattern)

    def build(found: Column) -> Column:
        gaps = F.split(text, pattern)
        steps = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
        value = found if group == 0 else F.regexp_extract_all(text, p, F.lit(group))
        return let(running_sums(steps), lambda ends: F.zip_with(
            F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"))), value,
            lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value"))))

    return let(F.regexp_extract_all(text, p, F.lit(0)), build)


def _spans(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 m["end"].alias("end"), F.lit(kind).alias("kind"))).cast(SPAN)


def _none() -> Column:
    return F.array().cast(SPAN)


def pattern_spans(text: Column) -> list[Column]:
    """Spans per base kind; a text that a pattern does not find costs one search."""
    assign, least = ASSIGN
    return [
        F.when(text.rlike(assign), _spans(F.filter(find_all(text, assign, 2), lambda m: F.length(m["value"]) >= least),
                                          "assign")).otherwise(_none()),
        F.when(text.contains("AKIA"), _spans(find_all(text, ACCESS), "access")).otherwise(_none()),
        F.when(text.rlike(HEX), _spans(find_all(text, HEX), "hex")).otherwise(_none()),
    ]


def weighted(c: int) -> int:
    return round(c * math.log2(c) * SCALE) if c else 0


def limit(cls: CharClass) -> int:
    """Largest sum of weighted counts at which a window still has ``cls.bits`` bits."""
    return math.floor(cls.window * (math.log2(cls.window) - cls.bits) * SCALE)


def hot_range(run: Column, cls: CharClass) -> Column:
    """struct<lo, hi>: start of the first and end of the last window at or over the threshold; lo is -1 for none."""
    w, most, n = cls.window, limit(cls), len(cls.alphabet)
    if w >= 1 << BITS:
        raise ValueError(f"a window of {w} characters does not fit {BITS} bits")
    table = F.array(*[F.lit(weighted(c)).cast("long") for c in range(w + 2)])
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(cls.alphabet), c) - 1)
    # Of each symbol: the long that holds its count, the count's place there and one at that place.
    word, place = ([f(i) for i in range(n)] for f in (lambda i: i // PER, lambda i: i % PER * BITS))
    words, places = (F.array(*[F.lit(x) for x in xs]) for xs in (word, place))
    ones = F.array(*[F.lit(1 << p).cast("long") for p in place])
    zero_long = F.lit(0).cast("long")

    def walk(a: Column, g: Column) -> Column:
        zero = F.struct(F.array_repeat(zero_long, word[-1] + 1).alias("cnt"), zero_long.alias("sum"),
                        F.lit(-1).alias("lo"), F.lit(0).alias("hi"))

        def count(cnt: Column, symbol: Column) -> Column:
            return F.call_function("shiftright", F.get(cnt, F.get(words, symbol)), F.get(places, symbol)).bitwiseAND((1 << BITS) - 1).cast("int")

        def step(acc: Column, i: Column) -> Column:
            return let(F.struct(F.get(a, i).alias("enter"), F.coalesce(F.get(a, i - w), F.lit(-1)).alias("leave")),
                       lambda x: slide(acc, i, x["enter"], x["leave"]))

        def slide(acc: Column, i: Column, enter: Column, leave: Column) -> Column:
            cnt, same, full = acc["cnt"], enter == leave, leave >= 0
            total = F.when(same, acc["sum"]).otherwise(
                acc["sum"] + let(count(cnt, enter), lambda c: F.get(g, c + 1) - F.get(g, c))
                + F.when(full, let(count(cnt, leave), lambda c: F.get(g, c - 1) - F.get(g, c))).otherwise(zero_long))
            change = F.struct(F.get(words, enter).alias("k"), F.get(ones, enter).alias("one"),
                              F.when(full, F.get(words, leave)).otherwise(-1).alias("l"),
                              F.when(full, F.get(ones, leave)).otherwise(zero_long).alias("off"))
            counts = F.when(same, cnt).otherwise(let(change, lambda d: F.transform(cnt, lambda c, k: (
                c + F.when(k == d["k"], d["one"]).otherwise(zero_long) - F.when(k == d["l"], d["off"]).otherwise(zero_long)))))
            return let(total, lambda s: let((i >= w - 1) & (s <= F.lit(most).cast("long")), lambda hot: F.struct(
                counts.alias("cnt"), s.alias("sum"),
                F.when(hot & (acc["lo"] < 0), i - (w - 1)).otherwise(acc["lo"]).alias("lo"),
                F.when(hot, i + 1).otherwise(acc["hi"]).alias("hi"))))

        return F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), zero, step,
                           lambda acc: F.struct(acc["lo"].alias("lo"), acc["hi"].alias("hi")))

    return let(codes, lambda a: let(table, lambda g: walk(a, g)))


def entropy_spans(text: Column, cls: CharClass, allow: tuple[str, ...] = ALLOW) -> Column:
    run = rf"{cls.chars}{{{cls.window},}}"

    allowed = "|".join(p if not p.startswith("(?i)") else f"(?i:{p[4:]})" for p in allow)

    def wanted(m: Column) -> Column:
        ok = m["value"].rlike(cls.mixed)
        return ok & ~m["value"].rlike(cls.skip) if cls.skip else ok

    def stretches(m: Column) -> Column:
        """The parts of a run between matches of the allow-list that have room for a window."""
        whole = F.array(F.struct(m["start"].alias("start"), m["value"].alias("value")))

        def between(hits: Column) -> Column:
            starts = F.concat(F.array(F.lit(0)), F.transform(hits, lambda h: h["end"]))
            ends = F.concat(F.transform(hits, lambda h: h["start"]), F.array(F.length(m["value"])))
            return F.zip_with(starts, ends, lambda a, e: F.struct(
                (m["start"] + a).alias("start"), F.substr(m["value"], a + 1, e - a).alias("value")))

        return F.when(m["value"].rlike(allowed), F.filter(let(find_all(m["value"], allowed), between), lambda x: (
            F.length(x["value"]) >= cls.window))).otherwise(whole)

    def build(found: Column) -> Column:
        runs = F.filter(found, wanted)
        if allow:
            runs = F.flatten(F.transform(runs, stretches))
        hot = F.transform(runs, lambda m: let(hot_range(m["value"], cls), lambda h: F.struct(
            (m["start"] + h["lo"]).alias("start"), (m["start"] + h["hi"]).alias("end"), h["lo"].alias("lo"))))
        return _spans(F.filter(hot, lambda m: m["lo"] >= 0), cls.name)

    return F.when(text.rlike(run), let(find_all(text, run), build)).otherwise(_none())


def spans(text: Column, allow: tuple[str, ...] = ALLOW) -> Column:
    """All spans by start, then kind in the order of ``KINDS``."""
    parts = pattern_spans(text) + [entropy_spans(text, c, allow) for c in CLASSES]
    return F.sort_array(F.concat(*parts))


def label(found: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """doc_id and ``found``: array<struct<start, rank, end, kind>> of every document."""
    return (docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("t"))
            .select("doc_id", spans(F.col("t"), allow).alias("found")))


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every (merged) span replaced by ``[KIND]`` of its first finding."""
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"))
    done = F.aggregate(found, zero, lambda acc, s: F.when(s["start"] >= acc["pos"], F.struct(
        F.concat(acc["out"], F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"]),
                 F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"), s["end"].alias("pos"))).otherwise(F.struct(
            acc["out"].alias("out"), F.greatest(acc["pos"], s["end"]).alias("pos"))))
    return let(done, lambda d: F.concat(d["out"], F.substr(text, d["pos"] + 1)))


def redact(docs: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` with secrets replaced in the text; rows without a finding are unchanged.

    A column ``n_chars`` follows the text where the text changed.
    """
    [clean] = fresh(docs, "clean")
    d = docs.withColumn(clean, let(spans(text_or_empty(text), allow), lambda found: F.when(
        F.size(found) > 0, redacted(F.col(text), found)).otherwise(F.col(text))))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.when(F.col(clean) == F.col(text), F.col("n_chars")).when(
            F.col(clean).isNull(), F.col("n_chars")).otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType))
    return d.withColumn(text, F.col(clean)).select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query, from ``scan``."""
    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["rank"] < 3)
    return scan(docs).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(label(base), 256).alias("base_sha256"),
        label(F.col("found")).alias("spans"), *[count(c.name).alias(f"n_{c.name}") for c in CLASSES])
