"""SimHash near-duplicates: fingerprints linked within a Hamming radius by vantage-point trees.

A text (A-Z lower-cased) is split at the space and U+0009..U+000D; its
``shingle``-word shingles, repeats included, are hashed by XXH64 (UTF-8, seed
42) and a fingerprint bit is 1 if more than half of the hashes have it. A text
of fewer words is one shingle; a text without a word has fingerprint 0.

Search. Equal fingerprints are one point. The 64 bits are cut into
``bits`` + 1 blocks (``MAX_BLOCKS`` at most), so of two linked fingerprints
one block differs by ``bits`` // blocks bits at most: by none for radius 2.
For each block a vantage-point tree, built on the driver from a bounded sample
of the points, deals all points out: at a node with vantage point v and radius
mu a point goes near if d(point, v) <= mu and far otherwise, so each leaf is
one shard. A point is looked up in every shard that its ball of radius r can
touch: by the triangle inequality the near side if d - r <= mu, the far side
if d + r > mu. A node measures d over the bits of its block, with r as above;
where all sampled points agree in the block (a value that very many
fingerprints share), the nodes below measure whole fingerprints, with r =
``bits``. Inside a shard another tree of both kinds of nodes is built over all
of the shard's points and every arriving query walks it under the same bounds;
what is left is compared exactly. The sample only shapes the shards: no pair
is lost, whatever the sample.

A shard returns a spanning forest of its links (at most one edge per point),
never all pairs; forests are joined by star contraction. A ball of radius 2
holds 2,081 distinct fingerprints at most, so no shard can be one dense ball.

Cost. Whole random fingerprints lie about 32 bits from any vantage point, and a
boundary of width 2 * bits + 1 crosses two fifths of them; over a block the
ball has radius 0 and no boundary crosses it. A point is so sent once per
block and descends to one side, and the search costs about n log n tests until
the values of a block (2 ** 21) hold more than ``BUCKET`` points each; from
there on the nodes over whole fingerprints prune inside one value only.

Defined cases: a NULL text has no word (fingerprint 0, linked like any
other); a NULL id never names a component unless no member has an id; of
repeated rows and ids one row stays in ``keep_one``, that with the smallest
id, then the first one written; an empty table gives an empty result; other
columns are ignored by ``link`` and passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh
from .components import stars

SHINGLE, BITS, SEED = 3, 2, 42
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 15  # shingles hashed at a time

#: Blocks at most; all bits of a fingerprint.
MAX_BLOCKS, ALL = 4, (1 << 64) - 1
#: Dealing trees: points per shard aimed at, least and greatest depth, sample points per shard and in all.
SHARD_POINTS, MIN_DEPTH, MAX_DEPTH, SAMPLE_PER_SHARD, MAX_SAMPLE = 200_000, 6, 40, 64, 1 << 18
#: Points below which a shard's tree compares directly; pairs compared at a time.
BUCKET, PAIRS = 128, 1 << 21


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        words, n = [b" ".join(words)], 1
        runs = iter(words)
    else:
        n = len(words) - shingle + 1
        runs = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        m = min(_BLOCK, n - at)
        h = np.fromiter((xxhash.xxh64_intdigest(next(runs), SEED) for _ in range(m)), dtype="<u8", count=m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, out: str, text: str = "text", shingle: int = SHINGLE,
                     keep_text: bool = True) -> DataFrame:
    """``docs`` plus ``out`` (long); without ``text`` unless ``keep_text``."""
    schema = T.StructType([f for f in docs.schema.fields if keep_text or f.name != text] + [T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            col = b.column(at).cast(pa.binary())
            fps = pa.array([fingerprint(x.as_py(), shingle) for x in col], pa.int64())
            cols = [b.column(i) for i in range(b.num_columns) if keep_text or i != at]
            yield pa.RecordBatch.from_arrays([*cols, fps], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def block_masks(bits: int) -> list[int]:
    n = min(bits + 1, MAX_BLOCKS)
    edges = [64 * i // n for i in range(n + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:])]


def reach(mask: int, bits: int) -> int:
    """Radius of a search over the bits of ``mask``: all, or the block in which a linked pair differs least."""
    return bits if mask == ALL else bits // min(bits + 1, MAX_BLOCKS)


def distance(a: np.ndarray, b, mask: int = ALL) -> np.ndarray:
    x = np.bitwise_xor(a, b)
    return np.bitwise_count(x if mask == ALL else x & np.uint64(mask)).astype(np.int16)


def split(points: np.ndarray, mask: int = ALL) -> tuple[np.uint64, int] | None:
    """Vantage point and radius that halve ``points`` best among a few; None if none of them splits."""
    best = None
    for v in points[:: max(1, len(points) // 5)][:5]:
        d = distance(points, v, mask)
        mu = int(np.median(d))
        for m in (mu, mu - 1):
            near = int((d <= m).sum())
            if 0 < near < len(points):
                off = abs(2 * near - len(points))
                if best is None or off < best[0]:
                    best = (off, v, m)
    return best and (best[1], best[2])


def plan_shards(sample: np.ndarray, block: int, bits: int, most: float, min_depth: int) -> list:
    """Nested [mask, vantage, mu, near, far]; a leaf is its number, which modulo the blocks is ``block``.

    A node is split while more than ``most`` sample points can arrive there, and to ``min_depth`` at least.
    """
    masks, n = block_masks(bits), [0]

    def grow(home: np.ndarray, arriving: np.ndarray, depth: int, mask: int):
        at = None
        if len(home) > 1 and depth < MAX_DEPTH and (depth < min_depth or len(arriving) > most):
            at = split(home, mask)
            if at is None:
                mask = ALL
                at = split(home)
        if at is None:
            n[0] += 1
            return (n[0] - 1) * len(masks) + block
        v, mu = at
        r, dh, da = reach(mask, bits), distance(home, v, mask), distance(arriving, v, mask)
        return [mask, int(v), mu, grow(home[dh <= mu], arriving[da - r <= mu], depth + 1, mask),
                grow(home[dh > mu], arriving[da + r > mu], depth + 1, mask)]

    return grow(sample, sample, 0, masks[block])


def deal(points: np.ndarray, tree, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, indexes, at home) for every shard that a point's ball can touch."""
    todo = [(tree, np.arange(len(points)), np.ones(len(points), dtype=bool))]
    while todo:
        node, idx, home = todo.pop()
        if not len(idx):
            continue
        if not isinstance(node, list):
            yield node, idx, home
            continue
        mask, v, mu, left, right = node
        d, r = distance(points[idx], np.uint64(v), mask), reach(mask, bits)
        near, far = d - r <= mu, d + r > mu
        todo.append((left, idx[near], (home & (d <= mu))[near]))
        todo.append((right, idx[far], (home & (d > mu))[far]))


class Forest:
    """Union of links over ``n`` points by repeated minimum labels."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                nxt = self.label[self.label]
                if (nxt == self.label).all():
                    break
                self.label = nxt


def link_shard(points: np.ndarray, queries: np.ndarray, bits: int = BITS,
               mask: int = ALL) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (value, root) among the values of both that the pairs near each other in ``mask`` connect."""
    values = np.union1d(points, queries)
    forest = Forest(len(values))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0

    def join_found() -> None:
        if found:
            x, y = (np.searchsorted(values, np.concatenate(side)) for side in zip(*found))
            forest.link(x, y)
            found.clear()

    todo = [(points, queries, mask)]
    while todo:
        p, q, over = todo.pop()
        if not len(p) or not len(q):
            continue
        at = split(p, over) if len(p) > BUCKET else None
        if at is None and len(p) > BUCKET and over != ALL:
            over = ALL
            at = split(p)
        if at is None:
            step = max(1, PAIRS // len(p))
            for k in range(0, len(q), step):
                i, j = np.nonzero(distance(q[k:k + step, None], p[None, :]) <= bits)
                x, y = q[k:k + step][i], p[j]
                other = x != y
                if other.any():
                    found.append((x[other], y[other]))
                    waiting += len(found[-1][0])
                if waiting > PAIRS:  # a link costs a pass over all labels, so links are made many at a time
                    join_found()
                    waiting = 0
            continue
        v, mu = at
        r, dp, dq = reach(over, bits), distance(p, v, over), distance(q, v, over)
        todo.append((p[dp <= mu], q[dq - r <= mu], over))
        todo.append((p[dp > mu], q[dq + r > mu], over))
    join_found()
    moved = forest.label != np.arange(len(values))
    return values[moved], values[forest.label[moved]]


def links(points: DataFrame, bits: int = BITS, shard_points: int = SHARD_POINTS, min_depth: int = MIN_DEPTH) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``points`` (column fp, distinct) within ``bits``."""
    n = points.count()
    size = min(SAMPLE_PER_SHARD * max(1 << min_depth, -(-n // shard_points)), MAX_SAMPLE)
    some = points.orderBy(F.xxhash64("fp"), "fp").limit(size).collect()
    sample = np.array([r["fp"] for r in some], dtype=np.int64).view(np.uint64)
    masks = block_masks(bits)
    trees = [plan_shards(sample, b, bits, shard_points * len(sample) / max(n, 1), min_depth) for b in range(len(masks))]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for tree in trees:
                for shard, idx, home in deal(fp.view(np.uint64), tree, bits):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(idx), shard, dtype=np.int32)), pa.array(fp[idx]), pa.array(home)],
                        names=["shard", "fp", "home"])

    def shard_links(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        a, b = link_shard(fp[pdf["home"].to_numpy(dtype=bool)], fp, bits, masks[int(key[0]) % len(masks)])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (points.select("fp").mapInArrow(route, "shard int, fp long, home boolean")
            .groupBy("shard").applyInPandas(shard_links, "a long, b long"))


def classes(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, root): the component of every distinct fingerprint of ``fps`` (column fp)."""
    points = cut(fps.select("fp").distinct(), "points")
    root = stars(links(points, bits)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return points.join(root, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
         bits: int = BITS) -> DataFrame:
    """doc_id, fp (long), component_id (smallest id that links reach) for every row."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    d = cut(with_fingerprint(d, "fp", "t", shingle, keep_text=False), "fingerprints")
    first = d.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = classes(d, bits).join(first, "fp")
    name = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # Written first: Spark splits the skewed side of a join (a hot fingerprint) only if both sides come straight from a shuffle.
    by_fp = cut(named.join(name, "root").select("fp", "component_id"), "components")
    return d.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             bits: int = BITS) -> DataFrame:
    """One row of every component, that with the smallest id, with the columns of ``docs``."""
    fp, rid = fresh(docs, "fp", "rid")
    d = cut(with_fingerprint(docs, fp, text, shingle).withColumn(rid, F.monotonically_increasing_id()), "fingerprinted")
    keys = d.select(F.col(doc_id).alias("id"), F.col(fp).alias("fp"), F.col(rid).alias("rid"))
    # Per fingerprint first (copies collapse before the shuffle), then per component.
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("best")
    first = keys.groupBy("fp").agg(best)
    stay = classes(keys, bits).join(first, "fp").groupBy("root").agg(F.min("best").alias("best"))
    return d.join(stay.select(F.col("best.rid").alias(rid)), rid, "left_semi").select(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query, from ``link``."""
    return link(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
