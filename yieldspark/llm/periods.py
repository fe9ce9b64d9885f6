"""Periodic run detection: online dyadic square catching over the words of a text.

Method. Words are appended to a stream one after the other. At level k the
stream is cut into blocks of ``2 ** k`` words, and when a block is complete a
catcher is set up for it, which watches for periods from ``2 ** k`` to
``2 ** (k + 1) - 1``. An appended word completes one suffix of ``2 ** k`` words
per level, and the place of that suffix names the one catcher that it can
matter to: with the suffix at s, that of block ``(s >> k) - 1``. If the suffix
equals the block, the catcher reports the distance p. Suffixes and blocks are
compared by fingerprints that double from level to level, so a word costs one
comparison per level. Two neighbouring catchers that report one p have caught
a square: words and those p further on agree over at least p places. Such
squares merge into one run; its ends are found, and all of it is compared
again, by words, so fingerprints decide nothing alone.

An answer needs only words that came before, so a batch of words is appended
at once, level by level, as array operations; the result is that of appending
them one by one.

Why it is whole. In a run of period p and length >= 4p, words agree with those
p further on over >= 3p places, so for ``2 ** k <= p < 2 ** (k + 1)`` two whole
neighbouring blocks lie in it. Levels go up, and reports inside a run of a
lower level are dropped: a block is at least as long as that run's period, so
the report is one of its multiples. What is left is no repeat of a shorter
period. Per text O(n log n) comparisons; texts are independent, and each is
held in one task as Spark holds it in one row.

Defined cases: a NULL or empty text has no word and no run; rows are
independent, so repeated rows and NULL ids give a result each; an empty table
gives an empty result; columns named like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, text_or_empty, without
from .decontam import slices

EXPONENT, LENGTH = 4, 6
SLICE_BYTES = 4 << 20  # of text in one stream, unless one text is longer
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
SPACE = r"[\x20\x09-\x0D]+"


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, number of words of each)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    some = pc.not_equal(flat, "")
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    some_np = some.to_numpy(zero_copy_only=False)
    return flat.filter(some), np.bincount(row[some_np], minlength=len(lists))


def _double(h: np.ndarray, width: int, factor: int) -> np.ndarray:
    """Fingerprints of twice the width."""
    out = h[:-width] * np.uint64(factor) + h[width:]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


class Known:
    """Runs found so far; ``reach(i)``: the furthest end of a run that starts at i or before."""

    def __init__(self):
        self.start = self.end = self.period = self._reach = np.zeros(0, dtype=np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        self.start, self.end, self.period = (np.concatenate(x) for x in (
            (self.start, start), (self.end, end), (self.period, period)))
        order = np.argsort(self.start, kind="stable")
        self.start, self.end, self.period = self.start[order], self.end[order], self.period[order]
        self._reach = np.maximum.accumulate(self.end)

    def reach(self, at: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(len(at), dtype=np.int64)
        i = np.searchsorted(self.start, at, side="right") - 1
        return np.where(i >= 0, self._reach[np.maximum(i, 0)], 0)


def _reports(h: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, suffix) places of all that the catchers of level ``k`` report while the first ``n`` words are appended."""
    width = 1 << k
    last = n - width + 1  # suffix places, exclusive
    full = last >> k      # suffixes from the second block on, whole rows of a block's catcher first
    if last <= width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows = h[width:full << k].reshape(full - 1, width) == h[: (full - 1) << k: width, None]
    b, off = np.nonzero(rows)
    rest = np.nonzero(h[full << k:last] == h[(full - 1) << k])[0]
    return (np.concatenate([b << k, np.full(len(rest), (full - 1) << k)]),
            np.concatenate([((b + 1) << k) + off, (full << k) + rest]))


def _squares(w: np.ndarray, n: int, k: int, block: np.ndarray, suffix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the squares that neighbouring catchers report, grown to their ends."""
    none = np.zeros(0, dtype=np.int64)
    if len(block) < 2:
        return none, none, none
    period = suffix - block
    key = period * ((n >> k) + 2) + (block >> k)
    order = np.argsort(key)
    key, block, period = key[order], block[order], period[order]
    joined = np.diff(key) == 1
    first = np.nonzero(np.concatenate([[True], ~joined]))[0]
    last = np.append(first[1:], len(key)) - 1
    pair = last > first
    first, last = first[pair], last[pair]
    if not len(first):
        return none, none, none
    # Compare by words, from a block before to a block behind: a run that went further would hold that block as well.
    width = 1 << k
    p = period[first]
    lo, hi = np.maximum(block[first] - width, 0), np.minimum(block[last] + 2 * width, n - p)
    size = hi - lo
    edge = np.cumsum(size + 1)           # one place between groups, never equal
    base = edge - size - 1
    at = np.arange(int(edge[-1])) - np.repeat(base - lo, size + 1)
    step = np.repeat(p, size + 1)
    same = w[at] == w[np.minimum(at + step, n - 1)]
    same[edge - 1] = False
    d = np.diff(same.astype(np.int8), prepend=0)
    on, off = np.nonzero(d == 1)[0], np.nonzero(d == -1)[0]
    g = np.searchsorted(edge, on, side="right")
    long = off - on >= p[g]
    on, off, g = on[long], off[long], g[long]
    start = on - base[g] + lo[g]
    return start, start + (off - on) + p[g], p[g]


def find_runs(words: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT, length: int = LENGTH
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs of all texts, by text, start and period.

    ``words``: word numbers >= 0 of the texts one after the other; ``sizes``: words of each. A run is at least
    ``length`` words and ``exponent`` (4 or more) periods long.
    """
    if exponent < 4:
        raise ValueError("a run of fewer than four periods need not hold two whole blocks")
    # Longest texts first, so that a level's texts stand at the front; a word of its own kind ends each text.
    by_size = np.argsort(-sizes, kind="stable")
    from_ = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    size = sizes[by_size]
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    w = np.empty(int(begin[-1]), dtype=np.int64)
    w[begin[1:] - 1] = -1 - np.arange(len(size))
    inner = np.ones(len(w), dtype=bool)
    inner[begin[1:] - 1] = False
    w[inner] = words[np.arange(int(size.sum())) + np.repeat(from_[by_size] - (np.cumsum(size) - size), size)]
    known, h, factor, k = Known(), w.view(np.uint64), 0xD6E8FEB86659FD93, 0
    while True:
        texts = int(np.searchsorted(-size, -(exponent << k), side="right"))  # long enough for the level's least period
        n = int(begin[texts])
        if not texts:
            break
        block, suffix = _reports(h[:n - (1 << k) + 1], n, k)
        free = suffix + (1 << k) > known.reach(block)
        known.add(*_squares(w[:n], n, k, block[free], suffix[free]))
        h = _double(h[:n - (1 << k) + 1], 1 << k, factor)
        factor = (factor * 0xA0761D6478BD642F + 2) % (1 << 64) | 1
        k += 1
    keep = known.end - known.start >= np.maximum(length, exponent * known.period)
    start, end, period = known.start[keep], known.end[keep], known.period[keep]
    text = np.searchsorted(begin, start, side="right") - 1
    start, end, text = start - begin[text], end - begin[text], by_size[text]
    order = np.lexsort((period, start, text))
    return text[order], start[order], (end - start)[order], period[order]


def collapsed(sizes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """For each word whether it stays: a run keeps its first period only."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    change = np.zeros(int(at[-1]) + 1, dtype=np.int64)
    np.add.at(change, at[text] + start + period, 1)
    np.add.at(change, at[text] + start + length, -1)
    return np.cumsum(change[:-1]) == 0


def _joined(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, words), " ")


def detect(docs: DataFrame, text: str = "text", out: tuple[str, str, str] = ("n_words", "runs", "collapsed"),
           exponent: int = EXPONENT, length: int = LENGTH, keep_text: bool = True) -> DataFrame:
    """``docs`` plus the number of words, the runs (by start, then period) and the text with each run's first period only.

    The collapsed text is its words joined by one space; ``keep_text``: whether ``text`` itself stays.
    """
    docs = without(docs, *out)
    kept = [f for f in docs.schema.fields if keep_text or f.name != text]
    schema = T.StructType([*kept, T.StructField(out[0], T.LongType()), T.StructField(
        out[1], T._parse_datatype_string(RUNS)), T.StructField(out[2], T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for b in slices(batch, batch.column(at), SLICE_BYTES):
                words, sizes = words_of(b.column(at))
                number = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                which, *found = find_runs(number, sizes, exponent, length)
                stay = collapsed(sizes, which, *found)
                row = np.repeat(np.arange(len(sizes)), sizes)
                new = _joined(words.filter(pa.array(stay)), np.bincount(row[stay], minlength=len(sizes)))
                offsets = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(sizes)))]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(x) for x in found], fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(b.schema.get_field_index(f.name)) for f in kept] + [
                        pa.array(sizes.astype(np.int64)), runs, new.cast(pa.string())], names=schema.names)

    return docs.mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text whose runs the registered query looks for: in a tenth of the documents a tail repeats, others stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")).otherwise(text)

    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return F.when(h % 10 == 0, let(words, periodic)).otherwise(text)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query, from ``detect`` over whole texts."""
    d = docs.select("doc_id", planted(F.col("doc_id"), text_or_empty("text")).alias("t"))
    found = detect(d, "t", keep_text=False)
    line = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    # The greatest length, then the smallest start, then the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
