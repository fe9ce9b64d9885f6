"""Benchmark decontamination with an FM-index per training shard.

Words are the runs of 0-9, a-z (A-Z lower-cased) and every non-ASCII
character. A test item gives one phrase per window of ``window`` consecutive
words, or one phrase for the whole item if it is shorter. The texts of one
shard (a slice of an Arrow batch, at most ``SHARD_BYTES`` of text unless one
text is longer) become one sequence of word numbers, over which an FM-index is
built once: suffix array by prefix doubling, Burrows-Wheeler transform in a
wavelet matrix, every 32nd text position sampled. The phrases of one block of
the test set after the other are searched backwards, all of a block at once, by
wavelet ranks; the rows of a found phrase walk back to a sampled position, and
the found word ranges of a text are merged into removal spans.

The sequence keeps what can match: a word that no phrase has breaks the
sequence like a text's end, and a stretch between breaks that is shorter than
the shortest phrase is left out. Neither can hide an occurrence. Words of
phrases are known by their CRC-32 (a word that only shares one is kept, too);
numbers are given to the words of a shard, and a phrase with a word that the
shard has not is not searched there.

The test set is read in blocks of at most ``BLOCK_BYTES`` of text, whatever
its size; each block is collected and broadcast in a compact form (about three
times its text), and ``PASS_BLOCKS`` of them, 128 MB of text, are searched in
one pass over the texts (a narrow operation, nothing is shuffled). A larger
test set takes further passes, whose findings are merged into those of the
passes before. A window of words belongs to one item, so no phrase spans blocks.

Defined cases: a NULL or empty text has no words, no hits and is not
contaminated; a NULL or empty item gives no phrase; items with equal ids count
as one, a NULL id as the empty string; repeated rows are judged row by row; an
empty table gives an empty result and an empty test set no hits; other columns
are passed through,
but for those whose names the output takes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, without

WINDOW, BLOCK_BYTES, PASS_BLOCKS, SHARD_BYTES, SAMPLE = 13, 4 << 20, 32, 12 << 20, 32
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


class Windows(NamedTuple):
    """Phrases as rows of word numbers, 0 beyond a phrase's ``size``."""

    words: np.ndarray
    size: np.ndarray


class Phrases:
    """Distinct windows of a block of items.

    ``vocabulary``: the block's words, numbered from 2; ``flat``: the words of all items in a row. Window k is the ``size[k]``
    words from ``start[k]`` on and belongs to the item ``names[item[k]]``; ``more`` has the further (window, item).
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        ids: dict[bytes, int] = {}
        names: dict[str, int] = {}
        seen: dict[tuple, int] = {}
        flat: list[int] = []
        start, size, item, more = [], [], [], set()
        for name, text in items:
            w = [ids.setdefault(x, len(ids) + 2) for x in words(text)]
            who = names.setdefault(name, len(names))
            for i in range(max(len(w) - window, 0) + 1 if w else 0):
                row = tuple(w[i:i + window])
                k = seen.setdefault(row, len(seen))
                if k == len(start):
                    start.append(len(flat) + i)
                    size.append(len(row))
                    item.append(who)
                elif item[k] != who:
                    more.add((k, who))
            flat += w
        self.window, self.vocabulary, self.names = window, list(ids), list(names)
        self.flat, self.start = np.array(flat, dtype=np.int32), np.array(start, dtype=np.int32)
        self.size, self.item = np.array(size, dtype=np.int32), np.array(item, dtype=np.int32)
        self.more = np.array(sorted(more), dtype=np.int32).reshape(-1, 2)
        self.shortest = int(self.size.min()) if len(start) else 0

    @property
    def words(self) -> np.ndarray:
        return self._rows(self.flat, np.arange(len(self.start)))

    def _rows(self, flat: np.ndarray, some: np.ndarray) -> np.ndarray:
        step = np.arange(self.window)
        at = np.minimum(self.start[some, None] + step, max(len(flat) - 1, 0))
        return np.where(step < self.size[some, None], flat[at], 0)

    def possible(self, ids: dict[bytes, int]) -> tuple[np.ndarray, Windows]:
        """The windows all of whose words are in ``ids``, and these in the numbers of ``ids``."""
        number = np.zeros(len(self.vocabulary) + 2, dtype=np.int32)
        number[2:] = np.fromiter(map(ids.get, self.vocabulary, repeat(0)), dtype=np.int32, count=len(self.vocabulary))
        flat = number[self.flat]
        absent = np.concatenate([[0], np.cumsum(flat == 0)])
        some = np.nonzero(absent[self.start + self.size] == absent[self.start])[0]
        return some, Windows(self._rows(flat, some), self.size[some])

    def items_of(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``windows``, item) of every item that has one of the windows."""
        lo, hi = (np.searchsorted(self.more[:, 0], windows, side=x) for x in ("left", "right"))
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        place = np.arange(len(windows))
        return np.concatenate([place, np.repeat(place, n)]), np.concatenate([self.item[windows], self.more[at, 1]])


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix array of ``seq``, whose last symbol is its smallest and unique."""
    n = len(seq)
    bits = max(int(seq.max()).bit_length(), 1)
    k = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for j in range(k):
        key <<= bits
        key[:max(n - j, 0)] |= seq[j:]
    sa = np.argsort(key)
    key = key[sa]
    head = np.ones(n + 1, dtype=bool)
    np.not_equal(key[1:], key[:-1], out=head[1:n])
    slot = np.arange(n)
    group = np.maximum.accumulate(np.where(head[:n], slot, 0))
    rank = np.zeros(2 * n + k, dtype=np.int64)  # one more than the first slot of a suffix's group; 0 beyond the end
    rank[sa] = group + 1
    # Slots of groups with more than one suffix; all others are at their final place.
    rest = ~(head[:n] & head[1:])
    slot, group = slot[rest], group[rest]
    width = (n + 1).bit_length()
    ranks = max(2, 63 // width)  # ranks of following suffixes that fit into one key: each round sees so many times further
    while len(slot):
        at = sa[slot]
        key = group
        for j in range(1, ranks):
            key = key << width | rank[np.minimum(at + j * k, 2 * n)]
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[slot] = at
        head = np.ones(len(slot) + 1, dtype=bool)
        np.not_equal(key[1:], key[:-1], out=head[1:-1])
        group = slot[np.maximum.accumulate(np.where(head[:-1], np.arange(len(slot)), 0))]
        rank[at] = group + 1
        rest = ~(head[:-1] & head[1:])
        slot, group = slot[rest], group[rest]
        k *= ranks
    return sa


class Bits:
    """Bit vector with ranks: 64-bit words and the ones before each word."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, dtype=bool)
        padded[:self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


class Wavelet:
    """Wavelet matrix: level by level the values are parted by one bit, zeros first."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels = []
        for shift in range(max(top.bit_length(), 1) - 1, -1, -1):
            bit = (values >> shift) & 1 != 0
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])
        self.start = self.walk(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))

    def walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(i)
            i = np.where((c >> shift) & 1 != 0, zeros + ones, i - ones)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often value c occurs before position i."""
        return self.walk(c, i) - self.start[c]

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros(len(i), dtype=np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(i), bits.rank(i)
            i = np.where(one, zeros + ones, i - ones)
            c |= one.astype(np.int64) << shift
        return c


class FMIndex:
    """Index of a sequence of symbols >= 1; symbol 0 ends it."""

    def __init__(self, seq: np.ndarray, top: int):
        seq = np.append(seq, 0)
        sa = suffix_array(seq)
        self.wavelet = Wavelet(seq[sa - 1].astype(np.int64), top)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
        sampled = sa % SAMPLE == 0
        self.marked, self.at = Bits(sampled), sa[sampled]
        self.n = len(seq)

    def search(self, p: Phrases | Windows) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, sequence position) of every occurrence."""
        words, alive = p.words, np.arange(len(p.size))
        lo, hi = np.zeros(len(alive), dtype=np.int64), np.full(len(alive), self.n, dtype=np.int64)
        for step in range(words.shape[1]):
            j = p.size[alive] - 1 - step
            busy = j >= 0
            c = words[alive[busy], j[busy]].astype(np.int64)
            lo[busy] = self.less[c] + self.wavelet.rank(c, lo[busy])
            hi[busy] = self.less[c] + self.wavelet.rank(c, hi[busy])
            found = lo < hi
            alive, lo, hi = alive[found], lo[found], hi[found]
        count = hi - lo
        rows = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        return np.repeat(alive, count), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Sequence positions of suffix rows: step back until a sampled position."""
        out, steps = np.empty(len(rows), dtype=np.int64), 0
        todo = np.arange(len(rows))
        while len(todo):
            hit = self.marked.get(rows)
            out[todo[hit]] = self.at[self.marked.rank(rows[hit])] + steps
            todo, rows = todo[~hit], rows[~hit]
            c = self.wavelet.access(rows)
            rows = self.less[c] + self.wavelet.rank(c, rows)
            steps += 1
        return out


def crc(found: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, found), dtype=np.uint32, count=len(found))


class Known(NamedTuple):
    """What the shards of a pass have to know of all its blocks: CRCs of the phrases' words, ascending, and the least size."""

    words: np.ndarray
    shortest: int


class Shard:
    """The words of some texts, and an FM-index of those that phrases may match."""

    def __init__(self, texts: list[bytes | None], known: Known):
        all_: set[bytes] = set()
        for t in texts:
            all_.update(words(t))
        found = list(all_)
        have = np.isin(crc(found), known.words)
        self.ids = {found[i]: n + 2 for n, i in enumerate(np.nonzero(have)[0].tolist())}
        get, sizes, parts = self.ids.get, [], []
        for t in texts:
            w = words(t)
            sizes.append(len(w))
            parts.append(np.fromiter(map(get, w, repeat(1)), dtype=np.int32, count=len(w)))
            parts.append(np.ones(1, dtype=np.int32))  # a break after every text
        self.n_words = np.array(sizes, dtype=np.int64)
        stream = np.concatenate([np.ones(1, dtype=np.int32), *parts])
        self.begin = np.concatenate([[0], np.cumsum(self.n_words + 1)]) + 1  # of each text in the stream
        # Stretches between breaks that hold the shortest phrase, each kept with the break after it.
        breaks = np.nonzero(stream == 1)[0]
        long_ = np.diff(breaks) - 1 >= max(known.shortest, 1)
        self.index = None
        if known.shortest and long_.any():
            mark = np.zeros(len(stream) + 1, dtype=np.int8)
            mark[breaks[:-1][long_] + 1] += 1
            mark[breaks[1:][long_] + 1] -= 1
            self.kept = np.nonzero(np.cumsum(mark[:-1], dtype=np.int8))[0]
            self.index = FMIndex(stream[self.kept], len(self.ids) + 1)

    def search(self, p: Phrases) -> dict[int, tuple[list, set]]:
        """For texts with a hit the merged word spans and the items."""
        found: dict[int, tuple[list, set]] = {}
        if self.index is None:
            return found
        some, windows = p.possible(self.ids)
        phrase, at = self.index.search(windows)
        if not len(at):
            return found
        start = self.kept[at]
        end = start + windows.size[phrase]
        doc = np.searchsorted(self.begin, start, side="right") - 1
        order = np.lexsort((end, start))
        for d, s, e in zip(doc[order].tolist(), (start - self.begin[doc])[order].tolist(), (end - self.begin[doc])[order].tolist()):
            spans = found.setdefault(d, ([], set()))[0]
            if spans and s <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], e)
            else:
                spans.append([s, e])
        pairs = np.unique(np.stack([doc, some[phrase]]), axis=1)
        place, item = p.items_of(pairs[1])
        for d, k in set(zip(pairs[0][place].tolist(), item.tolist())):
            found[d][1].add(p.names[k])
        return found


def merge(a: list, b: list) -> list:
    out: list = []
    for s, e in sorted(map(tuple, [*a, *b])):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def slices(b: pa.RecordBatch, col: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``b`` with at most ``most`` bytes in ``col`` each (one row at least)."""
    size = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // most
    cuts = np.nonzero(np.diff(group))[0] + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
        if hi > lo:
            yield b.slice(lo, hi - lo)


def _scan_pass(df: DataFrame, blocks: list, known, text: str, out: tuple[str, str, str], first: bool) -> DataFrame:
    n, spans, items = out
    schema = df.schema if not first else T.StructType([*df.schema.fields, T.StructField(n, T.LongType()), T.StructField(
        spans, SPANS), T.StructField(items, T.ArrayType(T.StringType()))])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for b in slices(batch, batch.column(at), SHARD_BYTES):
                shard = Shard(b.column(at).cast(pa.binary()).to_pylist(), known.value)
                s_col, i_col = [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
                if not first:
                    s_col = [[[x["start"], x["end"]] for x in v] for v in b.column(names.index(spans)).to_pylist()]
                    i_col = b.column(names.index(items)).to_pylist()
                for block in blocks:
                    for d, (more, who) in shard.search(block.value).items():
                        s_col[d], i_col[d] = merge(s_col[d], more), sorted({*i_col[d], *who})
                cols = [b.column(i) for i in range(b.num_columns - (0 if first else 3))]
                yield pa.RecordBatch.from_arrays([
                    *cols, pa.array(shard.n_words), pa.array([[{"start": s, "end": e} for s, e in v] for v in s_col], _SPANS),
                    pa.array(i_col, pa.list_(pa.string()))], names=names)

    return df.mapInArrow(run, schema)


def scan(docs: DataFrame, benchmark: DataFrame, out: tuple[str, str, str], text: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, pass_blocks: int = PASS_BLOCKS
         ) -> DataFrame:
    """``docs`` plus ``out``: words (long), merged word spans of hits, items with occurring windows (sorted strings)."""
    docs, sc = without(docs, *out), docs.sparkSession.sparkContext
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"),
                             F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("t"))
    size = items.agg(F.sum(F.length("t") + F.length("name"))).first()[0] or 0
    n_blocks = max(1, -(-int(size) // block_bytes))
    for lo in range(0, n_blocks, pass_blocks):
        blocks, have, shortest = [], np.zeros(0, dtype=np.uint32), []
        for k in range(lo, min(lo + pass_blocks, n_blocks)):
            part = items.where(F.pmod(F.xxhash64("name", "t"), F.lit(n_blocks)) == k).distinct().collect()
            p = Phrases([(r["name"], bytes(r["t"])) for r in part], window)
            have = np.union1d(have, crc(p.vocabulary))
            if p.shortest:
                shortest.append(p.shortest)
                blocks.append(sc.broadcast(p))
        docs = _scan_pass(docs, blocks, sc.broadcast(Known(have, min(shortest, default=0))), text, out, first=lo == 0)
    return docs


def is_contaminated(n_words, n_hit):
    """Some hit, and at least one word in twenty hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def n_hit(spans):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])


def removal_spans(text: bytes, spans: list) -> list[tuple[int, int]]:
    """Word spans as code-point spans of the text, from the first word's start to the last word's end."""
    at = [m.span() for m in _WORD.finditer(text)]
    lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
    return [(int(lead[at[s][0]]), int(lead[at[e - 1][1]])) for s, e in spans]


def with_removal(df: DataFrame, spans: str, out: str, text: str = "text") -> DataFrame:
    """``df`` plus ``out``: the spans to remove, in code points of the text."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(b.schema.get_field_index(text)).cast(pa.binary())
            rows = b.column(b.schema.get_field_index(spans)).to_pylist()
            cut = [[{"start": s, "end": e} for s, e in removal_spans(col[i].as_py(), [(x["start"], x["end"]) for x in r])]
                   if r else [] for i, r in enumerate(rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cut, _SPANS)], names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Documents that are not contaminated, unchanged, with the columns of ``docs``."""
    out = tuple(fresh(docs, "n_words", "spans", "items"))
    d = scan(docs, benchmark, out, text)
    return d.where(~is_contaminated(F.col(out[0]), n_hit(F.col(out[1])))).select(*docs.columns)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of the registered query, from ``scan``."""
    d = scan(docs.select("doc_id", "text"), benchmark, ("n_words", "spans", "items"))
    d = d.select("doc_id", "n_words", n_hit(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                 F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    return d.withColumn("contaminated", is_contaminated(F.col("n_words"), F.col("n_hit")))
