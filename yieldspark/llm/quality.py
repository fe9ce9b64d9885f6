"""Quality rules as a short-circuit cascade, DataFrame functions only.

Each rule says when a text is rejected. Before the run every rule is timed on
a sample of the documents and its rejection rate is counted there; the rules
then run ordered by rejection per cost, so that cheap rules that reject much
come first and a rejected text never reaches the dear ones. A rule is repeated
on each sampled text until its time stands above that of the job around it,
and costs are compared as powers of two of the dearest, so the order does not
hang on the noise of a run. The order decides how much is computed, never what is kept: a
document is kept if no rule rejects it, under every order.

Words are the runs of characters other than the space and U+0009..U+000D.

Defined cases: a NULL text is an empty one (no word, so it is rejected by
``few_words``); ties, repeated rows and repeated ids are judged row by row; an
empty table gives an empty result and the rules in their written order;
columns other than the id and the text are passed through by ``keep`` and
ignored by ``measure``.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, let, text_or_empty

SPACES = " \t\n\x0b\f\r"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Documents in the sample on which cost and selectivity are estimated (expected number).
SAMPLE_DOCS = 400
#: A rule is repeated until it takes this many times the job without a rule, and so many seconds; at most so often.
FLOORS, LEAST_SECONDS, MOST_REPEATS = 1, 0.15, 256


def _replace_each(c: Column, chars: str, to: str) -> Column:
    """Literal replacement per character: a byte search each, several times cheaper than a regular expression."""
    return reduce(lambda acc, ch: F.replace(acc, F.lit(ch), F.lit(to)), chars, c)


def one_space(text: Column) -> Column:
    return _replace_each(text, SPACES[1:], " ")


def words(text: Column) -> Column:
    return F.array_remove(F.split(one_space(text), " "), "")


def word_chars(text: Column) -> Column:
    return F.length(F.replace(one_space(text), F.lit(" "), F.lit(""))).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(_replace_each(text, SYMBOLS, ""))).cast("long")


def lines_with_word(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))


def n_dup_lines(text: Column) -> Column:
    return let(lines_with_word(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(w: Column, k: int = WINDOW) -> Column:
    """Words inside a ``k``-word window that occurs at least twice in the same text.

    Windows are compared by a 64-bit hash. Equal hashes are brought together
    by one sort of the text's own windows, and only for texts in which some
    window repeats; the covered words are then summed over sorted positions,
    so a text of n words costs n log n.
    """
    def hashes(a: Column) -> Column:
        return F.when(F.size(a) >= k, F.transform(
            F.sequence(F.lit(0), F.size(a) - k),
            lambda i: F.xxhash64(*[F.get(a, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda s: F.filter(s, lambda x, i: (
            F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))))
        at = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        return F.aggregate(at, zero, lambda acc, p: F.struct(
            (acc["n"] + p + k - F.greatest(p, acc["end"])).alias("n"), (p + k).alias("end")), lambda acc: acc["n"])

    return let(hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
               .otherwise(covered(h))).cast("long")


@dataclass(frozen=True)
class Features:
    """What rules may ask of a text: an expression over it, or a column where it is already computed."""
    text: Column
    words: Column
    known: dict[str, Column] = field(default_factory=dict)

    def __getattr__(self, name: str) -> Column:
        if name in self.known:
            return self.known[name]
        make = {"n_words": lambda: F.size(self.words), "word_chars": lambda: word_chars(self.text),
                "n_symbols": lambda: n_symbols(self.text), "n_repeat_words": lambda: n_repeat_words(self.words)}
        if name not in make:
            raise AttributeError(name)
        return make[name]()


@dataclass(frozen=True)
class Rule:
    """``rejects(features)`` is true for texts to drop; it must not be NULL."""
    name: str
    rejects: Callable[[Features], Column]


#: Documents of fewer words, or with a larger share (per cent) of words in repeated windows, fail the base rules.
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
BASE_RULES = ("few_words", "repeated_windows")
#: Method's own rules: mean word length, symbols per 100 characters of words, characters in repeated lines
#: per 100 characters of lines (one repeated line, such as a motto at both ends of a short text, is no fault).
MEAN_WORD, MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT = (2, 25), 5, 30


def _dup_lines(f: Features) -> Column:
    def chars(x: Column) -> Column:
        return F.length(F.array_join(x, ""))

    return let(lines_with_word(f.text), lambda x: let(F.array_distinct(x), lambda u: (
        (F.size(x) - F.size(u) > 1) & (100 * (chars(x) - chars(u)) > MAX_DUP_LINE_PCT * chars(x)))))


RULES = (
    Rule("few_words", lambda f: f.n_words < MIN_WORDS),
    Rule("repeated_windows", lambda f: 100 * f.n_repeat_words > MAX_REPEAT_PCT * f.n_words),
    Rule("word_length", lambda f: ~f.word_chars.between(MEAN_WORD[0] * f.n_words, MEAN_WORD[1] * f.n_words)),
    Rule("symbols", lambda f: 100 * f.n_symbols > MAX_SYMBOL_PCT * f.word_chars),
    Rule("repeated_lines", _dup_lines),
    Rule("no_letter", lambda f: ~f.text.rlike(r"\p{L}")),
)


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float   # over the sample
    rejected: float  # share of the sample


def estimate(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
             sample_docs: int = SAMPLE_DOCS, seed: int = 7) -> list[Estimate]:
    """Time and rejection rate of each rule on about ``sample_docs`` documents, in the order of ``rules``.

    The time of a rule is that of a pass over the sample in which each text is judged several times, less the time of a
    pass without a rule, divided by the number of times (the word split is shared, so it counts for neither).
    """
    n = docs.count()
    if n == 0:
        return [Estimate(r.name, 0.0, 0.0) for r in rules]
    sample = cut(docs.select(F.col(text).alias("t")).sample(fraction=min(1.0, sample_docs / n), seed=seed)
                 .repartition(1), "quality-sample")  # the few sampled rows move, the scan stays spread
    base = sample.select(text_or_empty("t").alias("t")).withColumn("w", words(F.col("t")))

    def timed(test: Column | None, times: int = 1) -> tuple[float, float]:
        hit = F.lit(0).cast("long")
        if test is not None:
            hit = F.aggregate(F.sequence(F.lit(1), F.lit(times)), hit, lambda acc, _: acc + test.cast("long"))
        df = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("w") + F.length("t")), F.sum(hit).alias("hit"))
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            row = df.first()
            best = min(best or 1e9, time.perf_counter() - t0)
        return best, (row["hit"] / row["n"] / times if row["n"] else 0.0)

    floor, _ = timed(None)
    out = []
    for r in rules:
        test, times = r.rejects(Features(F.col("t"), F.col("w"))), 1
        while True:
            s, rate = timed(test, times)
            if s - floor >= max(FLOORS * floor, LEAST_SECONDS) or times >= MOST_REPEATS:
                break
            # As often as the time so far asks for, between twice and sixteen times as often.
            want = 1.5 * max(FLOORS * floor, LEAST_SECONDS) / max(s - floor, 1e-3)
            times = min(MOST_REPEATS, times * min(16, max(2, math.ceil(want))))
        out.append(Estimate(r.name, max(s - floor, 1e-6) / times, rate))
    return out


def ordered(rules: tuple[Rule, ...], estimates: list[Estimate]) -> tuple[Rule, ...]:
    """Rules by falling rejection per cost; rules that reject nothing in the sample go last, the cheapest first."""
    by, place = {e.name: e for e in estimates}, {r.name: i for i, r in enumerate(rules)}
    dearest = max((e.seconds for e in estimates), default=0) or 1.0
    cost = {k: 2.0 ** round(math.log2(max(e.seconds / dearest, 1e-6))) for k, e in by.items()}
    return tuple(sorted(rules, key=lambda r: (-by[r.name].rejected / cost[r.name], cost[r.name], place[r.name])))


def first_rejection(f: Features, rules: tuple[Rule, ...]) -> Column:
    """Name of the first rule that rejects, NULL for none; later branches are not evaluated after a hit."""
    out = F.lit(None).cast("string")
    for r in reversed(rules):
        out = F.when(r.rejects(f), F.lit(r.name)).otherwise(out)
    return out


def judge(docs: DataFrame, out: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` plus ``out``: the rejecting rule that came first in the cascade, NULL where kept."""
    plan = ordered(rules, estimate(docs, text, rules))
    t = text_or_empty(text)
    # The words are bound, not a column: a filter on ``out`` would be pushed below such a column and split the text anew
    # at every use.
    return docs.withColumn(out, let(words(t), lambda w: first_rejection(Features(t, w), plan)))


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with the columns of ``docs``."""
    [why] = fresh(docs, "rejected_by")
    return judge(docs, why, text, rules).where(F.col(why).isNull()).select(*docs.columns)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
            rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of every document and the cascade's verdict.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept. All counts are asked for every
    document, so rules that need no more read them; the others (repeated
    lines, a letter) are reached by the texts that no earlier rule rejects.
    """
    plan = ordered(rules, estimate(docs, text, rules))
    base = tuple(r for r in RULES if r.name in BASE_RULES)
    t = F.col("t")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judged(w: Column, c: Column) -> Column:
        f = Features(t, w, {n: c[n] for n in counts})
        return F.struct(*[c[n].alias(n) for n in counts], first_rejection(f, base).isNotNull().alias("base_failed"),
                        first_rejection(f, plan).isNull().alias("kept"))

    def counted(w: Column) -> Column:
        return let(F.struct(F.size(w).cast("long").alias("n_words"), word_chars(t).alias("word_chars"),
                            n_symbols(t).alias("n_symbols"), n_dup_lines(t).alias("n_dup_lines"),
                            n_repeat_words(w).alias("n_repeat_words")), lambda c: judged(w, c))

    d = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("t"))
    return d.select("doc_id", let(words(t), counted).alias("m")).select("doc_id", "m.*")
