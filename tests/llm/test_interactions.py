import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from samples import PROSE

from yieldspark.llm import interactions as q

LABELS = "doc_id long, quality int, toxic int, source string"
WHITE = " \t\n\x0b\x0c\r"


def words(t):
    for c in WHITE:
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w]


def brute(rows, labels):
    """The contract step by step: each order is applied to every document in turn."""
    judged = []
    for doc_id, text, part in rows:
        t = text or ""
        w = words(t)
        copy = doc_id is not None and any((u or "") == t and i is not None and i < doc_id for i, u, _ in rows)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 any(c in "#$%&*|" for c in t), copy]
        of = [x for x in labels if x[0] == doc_id and doc_id is not None]
        judged.append((part or "", dict(zip("ABCDE", fails)), any(x[1] == 1 for x in of), any(x[2] == 1 for x in of)))
    out = {}
    for part in {j[0] for j in judged}:
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = [j for j in judged if j[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [j for j in left if j[1][f]]
                left = [j for j in left if not j[1][f]]
                total[f] += len(here)
                out[part, order, step] = [len(left), len(here), sum(j[1][f] for j in gone),
                                          sum(j[0] == part and j[1][f] and sum(j[1].values()) == 1 for j in judged),
                                          sum(j[2] for j in here), sum(j[3] for j in here)]
                gone += here
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(total[f])
    return out


def table(df):
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): [r[c] for c in q.COUNTS] for r in rows}
    assert len(out) == len(rows)
    return out


def docs_of(make_docs, rows):
    from pyspark.sql import functions as F
    d = make_docs([(i, t) for i, t, _ in rows])
    parts = {(i, t): p for i, t, p in rows}  # the fixture's source column is set by id and text
    cases = F.lit(None).cast("string")
    for (i, t), p in parts.items():
        cases = F.when(F.col("doc_id").eqNullSafe(F.lit(i)) & F.col("text").eqNullSafe(F.lit(t)), F.lit(p)).otherwise(cases)
    return d.withColumn("source", cases)


def test_equals_brute_force(spark, make_docs):
    rnd = random.Random(2)
    pool = ["plain", "words", "Of", "UPPER", "with # sign", "", "ünï", "10 % off", "a\x85b", "\t tab \x0b\n"]
    texts = [" ".join(rnd.choice(pool) for _ in range(rnd.choice([3, 80, 260]))) for _ in range(14)]
    texts += [" ".join(f"w{i}{j}" for i in range(230)) for j in range(4)] + [None, "", PROSE]
    rows = [(i, rnd.choice(texts), rnd.choice(["web", "books", "", None])) for i in range(60)]
    rows += [rows[0], rows[0], (None, texts[0], "web"), (None, None, None)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 60, 2)]
    labels += [(2, 1, 1), (2, 0, 0), (None, 1, 1), (999, 1, 1)]
    lab = spark.createDataFrame([(*x, "x") for x in labels], LABELS)
    assert table(q.digest(docs_of(make_docs, rows), lab)) == brute(rows, labels)


def test_edges(spark, make_docs, edge_docs, no_docs):
    none = spark.createDataFrame([], LABELS)
    assert q.digest(no_docs, none).count() == 0
    got = table(q.digest(edge_docs, none))
    assert {k[0] for k in got} == {"s"} and len(got) == 600
    rows = [(r.doc_id, r.text, r.source) for r in edge_docs.collect()]
    assert got == brute(rows, [])


def test_steps_are_min_plus_products():
    orders = np.array(list(permutations(range(3))))
    steps = q.removal_steps(np.arange(8), orders)
    for m in range(8):
        for j, o in enumerate(orders):
            assert steps[m, j] == min((s for s, f in enumerate(o, 1) if m >> f & 1), default=4)


def test_some_orders_and_wrong_ones(spark):
    judged = spark.createDataFrame([("p", 1, 0, 0), ("p", 3, 1, 0), ("p", 2, 0, 1), ("p", 0, 1, 1)], "part string, mask int, good int, toxic int")
    got = table(q.audit(judged, "XY", ["YX"]))
    assert got == {("p", "YX", 1): [2, 2, 0, 1, 1, 1, 2], ("p", "YX", 2): [1, 1, 1, 1, 0, 0, 1]}
    for bad in (["XX"], ["XYZ"]):
        with pytest.raises(ValueError):
            q.audit(judged, "XY", bad)
