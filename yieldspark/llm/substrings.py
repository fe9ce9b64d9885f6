"""Exact substring deduplication: every byte inside a repeated ``length``-byte string is removed.

A byte string of ``length`` bytes that starts at two places of the corpus (of
one text or of two, never across texts) is repeated; all its occurrences go,
judged on the input.

Meeting. A window is a ``length``-byte string at one place. Its anchor is the
``GRAM``-byte string inside it with the smallest hash (the first one on ties),
which depends on the window's bytes only, so equal windows have equal anchors.
Consecutive windows with one anchor form a context: their bytes, first to last
window. An anchor that occurs once holds no repeat and is dropped; equal
contexts of the rest are counted (combined before the shuffle, so a text with
a million copies is one context of weight a million), and one occurrence each
is read from its text.

Dealing. Contexts are dealt out by what they are known to share: first the
anchor. Contexts of one anchor that are more than ``SHARD_BYTES`` together (a
passage in very many surroundings) are dealt out again by more of it: a window
has bytes left and right of what is shared, and half of them stand on one side,
so each context is cut into the windows that have that half on the left and
those that have it on the right, and the half joins what is shared. Equal
windows are cut alike and still meet; equal pieces are counted into one. What
is left open halves each time, so after eight rounds nothing is, and every
group is within the bound at every size of the input.

Deciding. Groups are taken in shards of about ``SHARD_BYTES``. Over a shard's
contexts or pieces a Burrows-Wheeler transform is built
in a wavelet matrix; intervals of suffixes are extended backwards, breadth
first, by all symbols that occur in them. The intervals found in round ``l``
are where neighbouring suffixes have exactly ``l`` bytes in common, so common
prefixes are found by increasing value; after ``length`` rounds the search
stops, and suffixes not parted by then share their first ``length`` bytes.
Such a class is a repeat if its windows weigh two or more.

Defined cases: a NULL or empty text has no bytes; a text shorter than
``length`` loses nothing; rows are told apart by id and text, rows equal in
both are repeats of each other like any other rows; an empty table gives an
empty result; other columns are passed through by ``remove``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh
from .decontam import Wavelet, slices, suffix_array

LENGTH, GRAM = 200, 32
SLICE_BYTES, PIECE, SHARD_BYTES = 1 << 20, 1 << 20, 1 << 20
_RUNS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
RUNS = "array<struct<lo:int,hi:int>>"


def gram_hashes(b: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``gram`` (a power of two) bytes from each position; shorter at the end by ``gram`` - 1."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    width, factor = 1, 0xD6E8FEB86659FD93
    while width < gram:
        h = h[:-width] * np.uint64(factor) + h[width:]
        h ^= h >> np.uint64(29)
        factor = (factor * 0xA0761D6478BD642F + 2) % (1 << 64) | 1
        width *= 2
    h = h * np.uint64(0xE7037ED1A0B428DB)
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    m = x
    while done < width:
        step = min(done, width - done)
        m = np.minimum(m[:-step], m[step:])
        done += step
    return m


def contexts(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(segment, first window, windows, anchor's place in the context, anchor hash) of each context of the segments.

    Positions are of ``data``; it must be shorter than 2**24 bytes.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none
    b = np.frombuffer(data, dtype=np.uint8)
    h = gram_hashes(b, gram)
    key = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(key, length - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    n = len(anchor)
    seg = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(data))))[:n]
    inside = np.arange(n) + length <= ends[seg]
    first = np.ones(n, dtype=bool)
    first[1:] = (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1])
    at = np.nonzero(first)[0]
    size = np.add.reduceat(inside.astype(np.int64), at)
    at, size = at[size > 0], size[size > 0]
    return seg[at], at, size, anchor[at] - at, h[anchor[at]].view(np.int64)


def _pieces(texts: list[bytes | None], length: int) -> Iterator[tuple[bytes, list[int], list[int], np.ndarray, np.ndarray]]:
    """Texts joined into buffers of about ``PIECE`` windows: (buffer, rows, offsets in the text, starts, ends).

    A longer text is cut into pieces that overlap by ``length`` - 1 bytes: each window is in one of them.
    """
    parts, rows, bases, size = [], [], [], 0

    def done():
        ends = np.cumsum([len(p) for p in parts])
        return b"".join(parts), rows, bases, ends - [len(p) for p in parts], ends

    for i, t in enumerate(texts):
        t = t or b""
        for at in range(0, max(len(t) - length + 1, 0), PIECE):
            p = t[at:at + PIECE + length - 1]
            parts.append(p)
            rows.append(i)
            bases.append(at)
            size += len(p)
            if size >= PIECE:
                yield done()
                parts, rows, bases, size = [], [], [], 0
    if parts:
        yield done()


def anchors(docs: DataFrame, text: str, keys: list[str], length: int = LENGTH) -> DataFrame:
    """keys, start, shape, anchor, context: a row per context of every text (context: hash of its bytes).

    shape: the number of windows times ``length`` plus the anchor's place in the context.
    """
    out = T.StructType([docs.schema[k] for k in keys] + [T.StructField("start", T.LongType()), T.StructField(
        "shape", T.IntegerType()), T.StructField("anchor", T.LongType()), T.StructField("context", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for b in slices(batch, batch.column(at), SLICE_BYTES):
                texts = b.column(at).cast(pa.binary()).to_pylist()
                for data, rows, bases, starts, ends in _pieces(texts, length):
                    seg, first, n, place, anchor = contexts(data, starts, ends, length)
                    if not len(seg):
                        continue
                    row, base = np.array(rows)[seg], np.array(bases)[seg]
                    view = memoryview(data)
                    ctx = np.array([xxhash.xxh3_64_intdigest(view[f:f + m + length - 1]) for f, m in zip(
                        first.tolist(), n.tolist())], dtype=np.uint64).view(np.int64)
                    take = pa.array(row)
                    yield pa.RecordBatch.from_arrays([
                        *(b.column(b.schema.get_field_index(k)).take(take) for k in keys),
                        pa.array(first - starts[seg] + base), pa.array((n * length + place).astype(np.int32)),
                        pa.array(anchor), pa.array(ctx)],
                        names=out.names)

    return docs.select(*keys, text).mapInArrow(run, out)


def common_prefix_classes(seq: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``seq`` and the class of each of its slots: equal classes share ``length`` symbols.

    ``seq`` ends with its smallest, unique symbol. Breadth-first backward extension: an interval of suffixes that start
    with a string w is extended to those of cw for every symbol c before it. An end of such an interval that no shorter
    string has parted is where the common prefix is as long as w.
    """
    sa = suffix_array(seq)
    n, top = len(seq), int(seq.max())
    before = seq[sa - 1]
    wavelet = Wavelet(before.astype(np.int64), top)
    less = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=top + 1))])
    # Where a string occurs once, its only extension is one step back in the text.
    back = np.empty(n, dtype=np.int64)
    back[np.argsort(before.astype(np.uint16) if top < 1 << 16 else before, kind="stable")] = np.arange(n)
    parted = np.zeros(n + 1, dtype=bool)
    parted[0] = True
    lo, hi, single = np.array([0]), np.array([n]), np.zeros(0, dtype=np.int64)
    for _ in range(length):
        if not len(lo) and not len(single):
            break
        single = back[single]
        c = np.zeros(len(lo), dtype=np.int64)
        for shift, bits, zeros in wavelet.levels:
            a, b = bits.rank(lo), bits.rank(hi)
            some0, some1 = lo - a < hi - b, a < b
            c = np.concatenate([c[some0], c[some1] | (1 << shift)])
            lo, hi = (np.concatenate([(lo - a)[some0], zeros + a[some1]]),
                      np.concatenate([(hi - b)[some0], zeros + b[some1]]))
        to = less[c] - wavelet.start[c]
        lo, hi = lo + to, hi + to
        # An end that is parted already belongs to a shorter string; strings of one round have different ends.
        new, new_single = ~parted[hi], single[~parted[single + 1]]
        lo, hi = lo[new], hi[new]
        parted[hi] = parted[new_single + 1] = True
        one = hi - lo == 1
        single = np.concatenate([new_single, lo[one]])
        lo, hi = lo[~one], hi[~one]
    return sa, np.cumsum(parted[:n]) - 1


def repeated_runs(texts: list[bytes], n: list[int], weight: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """For each context the runs (first, last window) whose strings weigh two or more among all the contexts."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    used = np.bincount(data, minlength=256) > 0
    seq = (np.cumsum(used) + 1).astype(np.int32)[data]
    seq[start + sizes] = 1                      # after each context
    seq = np.append(seq, 0)
    sa, group = common_prefix_classes(seq, length)
    w = np.zeros(len(seq), dtype=np.int64)
    size = np.array(n, dtype=np.int64)
    own = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    w[own] = np.repeat(np.array(weight, dtype=np.int64), size)
    total = np.bincount(group, weights=w[sa])
    flag = np.zeros(len(seq) + 1, dtype=np.int8)
    flag[sa] = (total[group] >= 2) & (w[sa] > 0)
    edge = np.diff(flag, prepend=0)
    lo, hi = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0] - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    which = np.searchsorted(start, lo, side="right") - 1
    for i, a, b in zip(which.tolist(), (lo - start[which]).tolist(), (hi - start[which]).tolist()):
        out[i].append((a, b))
    return out


def with_partner(rows: list[tuple], length: int = LENGTH) -> list[tuple]:
    """The pieces of one group (group, piece, n, weight, bytes, left, right) that can hold a repeat.

    A window has ``length`` bytes less the shared ones besides these, so half of them stand on one side: a repeat with
    another piece needs equal flanks of that size on the left or on the right.
    """
    if len(rows) == 1:
        return rows if rows[0][3] > 1 else []
    side = (length - rows[0][6] + rows[0][5] + 1) // 2
    lefts = [r[4][r[5] - side:r[5]] if r[5] >= side else None for r in rows]
    rights = [r[4][r[6]:r[6] + side] if r[6] + side <= len(r[4]) else None for r in rows]
    n_left, n_right = Counter(lefts), Counter(rights)
    return [r for r, a, b in zip(rows, lefts, rights) if r[3] > 1 or (
        a is not None and n_left[a] > 1) or (b is not None and n_right[b] > 1)]


def halves(group: int, data: bytes, n: int, left: int, right: int, length: int = LENGTH
           ) -> Iterator[tuple[int, int, int, int, bytes, int, int]]:
    """(group, piece, first window, windows, bytes, left, right) of the one or two pieces of a piece.

    ``data[left:right]`` is in all ``n`` windows. Left of it a window has some of the open bytes, right of it the rest.
    """
    half = (length - right + left + 1) // 2
    cut_at = left - half + 1  # windows before it have half of the open bytes on the left
    for side, lo, hi, a, b in ((b"<", 0, min(n, cut_at), left - half, right), (b">", max(0, cut_at), n, left, right + half)):
        if hi > lo:
            part = data[lo:hi + length - 1]
            a, b = a - lo, b - lo
            yield (xxhash.xxh3_64_intdigest(side + part[a:b], group & ((1 << 64) - 1)),
                   xxhash.xxh3_64_intdigest(part, a), lo, hi - lo, part, a, b)


_PIECE_ROW = "gid long, pid long, n int, weight long, bytes binary, lo int, hi int"


def _halved(pieces: DataFrame, length: int) -> DataFrame:
    """up_gid, up_pid, at and a piece (``_PIECE_ROW``) for each half of ``pieces``."""
    names = ["up_gid", "up_pid", "at", "gid", "pid", "n", "weight", "bytes", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(),
                 pa.int32(), pa.int32()]
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for b in batches:
            rows = []
            for gid, pid, n, weight, data, left, right in zip(*(b.column(i).to_pylist() for i in range(7))):
                for g, p, at, m, part, lo, hi in halves(gid, data, n, left, right, length):
                    rows.append((gid, pid, at, signed(g), signed(p), m, weight, part, lo, hi))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return pieces.select("gid", "pid", "n", "weight", "bytes", "lo", "hi").mapInArrow(
        run, "up_gid long, up_pid long, at int, " + _PIECE_ROW)


def refine(pieces: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES
           ) -> tuple[DataFrame, list[DataFrame]]:
    """(pieces in groups of at most ``shard_bytes``, for each round the pieces with those that they were cut from)."""
    small, rounds, left_open = [], [], length - gram
    while True:
        size = F.sum(F.octet_length("bytes").cast("long"))
        big = pieces.groupBy("gid").agg(size.alias("size"), F.count(F.lit(1)).alias("c"))
        big = cut(big.where((F.col("size") > shard_bytes) & (F.col("c") > 1)).select("gid"), "crowded-groups")
        if not left_open or not big.take(1):  # a piece with nothing left open is one window, the only one of its group
            small.append(pieces)
            break
        small.append(pieces.join(big, "gid", "left_anti"))
        halved = cut(_halved(pieces.join(big, "gid", "left_semi"), length), "halves")
        rounds.append(halved.select("up_gid", "up_pid", "at", "gid", "pid"))
        one = [F.first(c).alias(c) for c in ("n", "bytes", "lo", "hi")]
        merged = halved.groupBy("gid", "pid").agg(F.sum("weight").alias("weight"), *one)
        pieces = cut(merged.select("gid", "pid", "n", "weight", "bytes", "lo", "hi"), "pieces")
        left_open //= 2
    out = small[0]
    for x in small[1:]:
        out = out.unionByName(x)
    return out, rounds


def decide(pieces: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """gid, pid, runs of ``pieces`` (each piece once, groups within the bound)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []   # of the shard
        same: list[tuple] = []   # of the group that is being read
        size = 0

        def done() -> pa.RecordBatch:
            runs = repeated_runs([r[4] for r in rows], [r[2] for r in rows], [r[3] for r in rows], length)
            keep = [i for i, x in enumerate(runs) if x]
            return pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in keep], pa.int64()), pa.array([rows[i][1] for i in keep], pa.int64()),
                pa.array([[{"lo": a, "hi": b} for a, b in runs[i]] for i in keep], _RUNS)],
                names=["gid", "pid", "runs"])

        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(7))):
                if same and r[0] != same[0][0]:  # the pieces of a group stay together
                    keep = with_partner(same, length)
                    rows += keep
                    size += sum(len(x[4]) for x in keep)
                    same = []
                    if size >= shard_bytes:
                        yield done()
                        rows, size = [], 0
                same.append(r)
        rows += with_partner(same, length) if same else []
        if rows:
            yield done()

    return (pieces.select("gid", "pid", "n", "weight", "bytes", "lo", "hi").repartition("gid").sortWithinPartitions("gid")
            .mapInArrow(run, f"gid long, pid long, runs {RUNS}"))


def decided(ctx: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """anchor, context, runs of ``ctx`` (anchor, context, n, weight, bytes, place; each context once)."""
    whole = ctx.select(F.col("anchor").alias("gid"), F.col("context").alias("pid"), "n", "weight", "bytes",
                       F.col("place").alias("lo"), (F.col("place") + GRAM).alias("hi"))
    pieces, rounds = refine(whole, length, shard_bytes=shard_bytes)
    runs = cut(decide(pieces, length, shard_bytes), "runs")
    found, up = runs, None
    for r in reversed(rounds):  # from pieces back to what they were cut from
        moved = F.transform("runs", lambda x: F.struct((x["lo"] + F.col("at")).alias("lo"), (x["hi"] + F.col("at")).alias("hi")))
        up = cut(found.join(r, ["gid", "pid"]).select(
            F.col("up_gid").alias("gid"), F.col("up_pid").alias("pid"), moved.alias("runs")), "runs-of-pieces")
        found = runs.unionByName(up)
    if up is not None:  # a context has at most ``length`` windows, so at most as many runs
        up = up.groupBy("gid", "pid").agg(F.flatten(F.collect_list("runs")).alias("runs"))
        found = runs.unionByName(up)
    return found.select(F.col("gid").alias("anchor"), F.col("pid").alias("context"), "runs")


def _read_contexts(rich: DataFrame, length: int) -> DataFrame:
    """anchor, context, n, weight, bytes, place from texts with the list of contexts to read (``want``)."""
    names = ["anchor", "context", "weight", "start", "shape"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, batch.column(0), 4 * SLICE_BYTES):
                texts, lists = b.column(0).cast(pa.binary()).to_pylist(), b.column(1)
                row = np.repeat(np.arange(len(texts)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                want = lists.flatten()
                anchor, context, weight, start, shape = (want.field(i) for i in range(len(names)))
                n, place = np.divmod(shape.to_numpy(zero_copy_only=False), length)
                data = [texts[i][s:s + m + length - 1] for i, s, m in zip(
                    row.tolist(), start.to_numpy(zero_copy_only=False).tolist(), n.tolist())]
                if data:
                    yield pa.RecordBatch.from_arrays(
                        [anchor, context, pa.array(n.astype(np.int32)), weight, pa.array(data, pa.binary()),
                         pa.array(place.astype(np.int32))],
                        names=["anchor", "context", "n", "weight", "bytes", "place"])

    want = F.transform("want", lambda x: F.struct(*[x[c].alias(c) for c in names]))
    return rich.select("text", want.alias("want")).mapInArrow(
        run, "anchor long, context long, n int, weight long, bytes binary, place int")


def keyed(docs: DataFrame, k1: str, k2: str, doc_id: str, text: str) -> DataFrame:
    """``docs`` plus a key of id and text in two columns (96 bits)."""
    return docs.withColumn(k1, F.xxhash64(doc_id, text)).withColumn(k2, F.hash(text, doc_id))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """k1, k2, text, spans of every different (id, text) that loses bytes.

    spans: array<struct<start, end>>, the maximal runs to remove, in bytes, in order.
    """
    d = keyed(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), "k1", "k2", "id", "text")
    a = cut(anchors(d, "text", ["k1", "k2"], length), "anchors")
    # Written first: Spark splits the skewed side of a join (a hot anchor) only if both sides come straight from a shuffle.
    often = cut(a.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c >= 2").select("anchor"), "repeated-anchors")
    a = cut(a.join(often.hint("shuffle_hash"), "anchor"), "candidates")
    # Equal contexts are one row with a weight; any of their places will do to read the bytes.
    c = a.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("weight"), *[F.first(x).alias(x) for x in (
        "k1", "k2", "start", "shape")])
    c = cut(c, "contexts")
    want = c.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "context", "weight", "start", "shape")).alias("want"))
    # Texts that hold a candidate, once each, with what to read from them (none for most).
    holds = a.select("k1", "k2").distinct().join(want, ["k1", "k2"], "left")
    texts = d.where(F.octet_length("text") >= length).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    rich = cut(texts.join(holds, ["k1", "k2"]), "texts")
    ctx = cut(_read_contexts(rich.where("want is not null"), length), "context-bytes")
    runs = decided(ctx, length, shard_bytes)
    hits = a.select("anchor", "context", "k1", "k2", "start").join(runs, ["anchor", "context"])
    # Rows equal in id and text have the same places.
    hits = hits.groupBy("k1", "k2", "start").agg(F.first("runs").alias("runs"))
    lists = hits.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "runs")).alias("hits"))
    zero = F.array().cast("array<struct<start:bigint,end:bigint>>")
    flat = F.sort_array(F.flatten(F.transform("hits", lambda x: F.transform(x["runs"], lambda r: F.struct(
        (x["start"] + r["lo"]).alias("start"), (x["start"] + r["hi"] + length).alias("end"))))))
    return rich.select("k1", "k2", "text").join(lists, ["k1", "k2"]).select(
        "k1", "k2", "text", _merged(flat, zero).alias("spans"))


def _merged(spans, zero):
    """Sorted spans with overlapping and touching ones joined.

    One pass that holds the open span and closes it when a gap follows.
    """
    state = F.struct(zero.alias("done"), F.lit(-1).cast("long").alias("s"), F.lit(-1).cast("long").alias("e"))

    def close(acc):
        return F.when(acc["e"] < 0, acc["done"]).otherwise(
            F.concat(acc["done"], F.array(F.struct(acc["s"].alias("start"), acc["e"].alias("end")))))

    return F.aggregate(spans, state, lambda acc, x: F.when((acc["e"] >= 0) & (x["start"] <= acc["e"]), F.struct(
        acc["done"].alias("done"), acc["s"].alias("s"), F.greatest(acc["e"], x["end"]).alias("e"))).otherwise(F.struct(
            close(acc).alias("done"), x["start"].alias("s"), x["end"].alias("e"))), close)


def kept_bytes(found: DataFrame) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept (binary) of ``found`` (from ``find``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, batch.column(2), 4 * SLICE_BYTES):
                rows = []
                for t, spans in zip(b.column(2).cast(pa.binary()).to_pylist(), b.column(3).to_pylist()):
                    at, keep = 0, []
                    for x in spans:
                        keep.append(t[at:x["start"]])
                        at = x["end"]
                    keep.append(t[at:])
                    out = b"".join(keep)
                    rows.append((len(t) - len(out), len(spans), out))
                cols = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.binary())], names=["k1", "k2", "n_removed", "n_spans", "kept"])

    return found.select("k1", "k2", "text", "spans").mapInArrow(
        run, "k1 long, k2 int, n_removed long, n_spans long, kept binary")


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` plus ``kept`` (binary): the text's bytes without repeats (NULL where the text is NULL)."""
    k1, k2, out = fresh(docs, "k1", "k2", "kept")
    done = kept_bytes(find(docs, doc_id, text, length)).select(
        F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("kept").alias(out))
    return (keyed(docs, k1, k2, doc_id, text).join(done, [k1, k2], "left")
            .withColumn(out, F.coalesce(F.col(out), F.col(text).cast("binary"))).select(*docs.columns, out))


def digest(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The columns of the registered query; only digests of the texts are joined back."""
    done = cut(kept_bytes(find(docs, length=length, shard_bytes=shard_bytes)).select(
        "k1", "k2", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")), "kept")
    base = keyed(docs.select("doc_id", "text"), "k1", "k2", "doc_id", "text")
    t = F.coalesce(F.col("text"), F.lit(""))
    base = base.select("doc_id", "k1", "k2", F.octet_length(t).cast("long").alias("n_bytes"), F.sha2(t, 256).alias("whole"))
    zero = F.lit(0).cast("long")
    return base.join(done, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"))
