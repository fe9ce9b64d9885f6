"""Filter interaction audit: what each filter of a chain removes, in every order of the filters.

Method. A document's failures are a bit mask, so all documents of a part with
one mask behave alike: they are counted, with the weights of the labels, in
one aggregation (combined before the shuffle). Two matrices decide the rest.
The mask matrix holds 0 where a mask fails a filter and infinity elsewhere;
the position matrix holds, for each order, the inverse permutation: the step
at which each filter is applied. Their min-plus product (addition in place of
the product, minimum in place of the sum) is the removal step of each mask in
each order, infinity for masks that pass. The steps drive scatter counts over
(order, step), weighted by documents, good ones and toxic ones; what fails a
filter and is not removed by it was removed earlier, i.e. is redundant there.

Bounds. ``k`` filters have ``2 ** k`` masks and at most ``k!`` orders; both
are parameters of the call, whatever the number of documents. A part is one
row of at most ``2 ** k`` counts before the product.

Copies. ``is_copy`` marks rows whose text equals that of a smaller id anywhere
in the table. Texts meet by their SHA-256; only texts that occur twice are
joined back, from a written table, so that Spark can split the rows of a hot
text over tasks.

Defined cases: a NULL text is empty and equal to an empty one; a NULL id is
no copy and makes none; rows with one id and one text are no copies of each
other, each counts; a NULL part is the empty string; labels repeated for one
id count as their greatest value, labels of a NULL id are not used; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, text_or_empty

SPACE = r"[\x20\x09-\x0D]+"
MAX_FILTERS = 8
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_filters(t: Column) -> dict[str, Column]:
    """Failure conditions that one text decides: few words, few different words, capitals, symbols."""
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    flags = let(words, lambda w: F.struct(
        (F.size(w) < 200).alias("A"), (2 * F.size(F.array_distinct(w)).cast("long") < F.size(w)).alias("B")))
    return {"A": flags["A"], "B": flags["B"],
            "C": 50 * F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long") > F.length(t), "D": t.rlike("[#$%&*|]")}


def mark_copies(rows: DataFrame, doc_id: str, key: str, out: str = "is_copy") -> DataFrame:
    """``rows`` plus ``out``: whether a smaller id has the same ``key``. ``rows`` should be a written table."""
    first = rows.groupBy(key).agg(F.min(doc_id).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    first = cut(first.select(key, "_first"), "copied-texts")
    return (rows.join(first, key, "left")
            .withColumn(out, F.coalesce(F.col(doc_id) > F.col("_first"), F.lit(False))).drop("_first"))


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
          copies: str = "E") -> tuple[DataFrame, str]:
    """(part, mask, good, toxic) of every row of ``docs``, and the filters' letters (bit i of a mask is letter i)."""
    t = text_or_empty("t")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), F.coalesce(F.col(part), F.lit("")).alias("part"))
    fails = text_filters(t)
    letters = "".join(fails) + copies
    mask = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(fails.values())), F.lit(0))
    judged = cut(d.select("doc_id", "part", mask.cast("int").alias("mask"), F.unhex(F.sha2(t, 256)).alias("key")), "judged")
    judged = mark_copies(judged, "doc_id", "key")
    mask = F.col("mask") + F.when(F.col("is_copy"), F.lit(1 << len(fails))).otherwise(F.lit(0))

    def best(c: str) -> Column:
        return F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)

    graded = labels.select(F.col("doc_id"), "quality", "toxic").where("doc_id is not null")
    graded = cut(graded.groupBy("doc_id").agg(best("quality"), best("toxic")).where("quality + toxic > 0"), "graded")
    return judged.join(graded, "doc_id", "left").select(
        "part", mask.alias("mask"), F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")), letters


def removal_steps(masks: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Step (1..k) at which each order removes each mask, k + 1 for a mask that no filter fails.

    ``orders``: filter numbers, a row per order. Min-plus product of the mask and the position matrix.
    """
    k = orders.shape[1]
    never = k + 1
    fails = (masks[:, None] >> np.arange(k)) & 1
    cost = np.where(fails == 1, 0, never)
    position = np.argsort(orders, axis=1).T + 1  # inverse permutations: a filter's step in each order
    steps = np.full((len(masks), len(orders)), never, dtype=np.int64)
    for f in range(k):
        np.minimum(steps, cost[:, f, None] + position[None, f, :], out=steps)
    return steps


def scatter(steps: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Sum of ``weights`` (one per mask) by (order, step 1..k)."""
    n_orders = steps.shape[1]
    out = np.zeros((n_orders, k + 2), dtype=np.int64)
    np.add.at(out, (np.broadcast_to(np.arange(n_orders), steps.shape), steps), weights[:, None])
    return out[:, 1:k + 1]


def account(n: np.ndarray, good: np.ndarray, toxic: np.ndarray, orders: np.ndarray, steps: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of one part by (order, step) from its documents, good and toxic ones by mask (0 .. 2^k - 1)."""
    k = orders.shape[1]
    removed = scatter(steps, n, k)
    has = (np.arange(len(n))[:, None] >> np.arange(k)) & 1
    fails, only = n @ has, n[1 << np.arange(k)]
    total = np.zeros(k, dtype=np.int64)
    np.add.at(total, orders, removed)
    return {"kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": fails[orders] - removed,
            "unique_fails": only[orders], "good_lost": scatter(steps, good, k), "toxic_lost": scatter(steps, toxic, k),
            "shapley": total[orders]}


def audit(judged: DataFrame, letters: str, orders: Sequence[str] | None = None) -> DataFrame:
    """A row per part, order and step of ``judged`` (part, mask, good, toxic); all orders unless some are given."""
    k = len(letters)
    if k > MAX_FILTERS or len(set(letters)) != k:
        raise ValueError(f"up to {MAX_FILTERS} different letters")
    names = ["".join(o) for o in permutations(letters)] if orders is None else list(orders)
    if any(sorted(o) != sorted(letters) for o in names):
        raise ValueError("an order names each filter once")
    counts = judged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))
    # 2 ** k structs at most
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.array([[letters.index(c) for c in o] for o in names], dtype=np.int64).reshape(-1, k)
        steps = removal_steps(np.arange(1 << k), order)
        step = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(names)))
        label = pa.array(np.repeat(np.array(names, dtype=object), k), pa.string())
        for b in batches:
            for part, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = np.zeros((3, 1 << k), dtype=np.int64)
                for r in rows:
                    w[:, r["mask"]] = r["n"], r["good"], r["toxic"]
                got = account(*w, order, steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(label), pa.string()), label, step, *(pa.array(got[c].ravel()) for c in COUNTS)],
                    names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(run, SCHEMA)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: all orders of the five filters over every document."""
    return audit(*judge(docs, labels))
