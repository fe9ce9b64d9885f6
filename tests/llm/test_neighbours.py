import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from yieldspark.llm import neighbours as q

SCHEMA = "vec_id long, embedding array<float>, label int, ids string, v string, h1 string, shard string"


def table(spark, rows, n=4):
    return spark.createDataFrame([(i, v, 1, "x", "x", "x", "x") for i, v in rows], SCHEMA).repartition(n)


def cloud(n, dim=6, seed=1, groups=5):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(groups, dim))
    x = (centres[rnd.integers(groups, size=n)] + 0.4 * rnd.normal(size=(n, dim))).astype(np.float32)
    return [(i, v.tolist()) for i, v in enumerate(x)]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows, k=10, ask=lambda i: i % 100 == 0):
    seen = {}
    for i, v in rows:
        if i is not None and usable(v):
            v = tuple(float(np.float32(c)) + 0.0 for c in v)
            seen[i, v] = np.array(v, dtype=np.float64)
    out = {}
    for (i, v), x in seen.items():
        if ask(i):
            near = sorted((float(np.sqrt(((x - y) ** 2).sum())), j) for (j, w), y in seen.items()
                          if (j, w) != (i, v) and len(w) == len(v))[:k]
            out.setdefault(i, []).append([(n, j, d) for n, (d, j) in enumerate(near, 1)])
    return out


def answer(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {i: sorted(x) for i, x in got.items()}


def same(got, want):
    assert set(got) == {i for i, x in want.items() if x[0]}
    for i, rows in got.items():
        assert [r[:2] for r in rows] == [r[:2] for r in want[i][0]], i
        assert np.allclose([r[2] for r in rows], [r[2] for r in want[i][0]], rtol=1e-13, atol=0)


def asked(t, step=10):
    return t.where(F.col("vec_id") % step == 0)


def test_factor_one_is_exact_over_many_cells_and_shards(spark):
    rows = cloud(1500)
    rnd = random.Random(3)
    rows += [(2000 + i, rows[rnd.randrange(30) * 10][1]) for i in range(300)]   # copies: ties go to the smaller id
    t = table(spark, rows)
    want = brute(rows, ask=lambda i: i % 10 == 0)
    same(answer(q.search(t, asked(t), factor=1, shard_points=60, leaf=8)), want)
    same(answer(q.search(t, asked(t), factor=1, shard_points=60, max_cells=3, leaf=8)), want)
    same(answer(q.search(t, asked(t), factor=1, sample=40, shard_points=100, leaf=200)), want)


def test_one_vector_of_a_third_of_the_rows(spark):
    rows = cloud(400) + [(1000 + i, [1.0] * 6) for i in range(300)]
    t = table(spark, rows)
    same(answer(q.search(t, asked(t), factor=1, shard_points=50, leaf=8)), brute(rows, ask=lambda i: i % 10 == 0))


def test_query_recall_on_vectors_without_structure(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(3000, 64))
    x /= np.sqrt((x ** 2).sum(axis=1))[:, None]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    t = table(spark, rows)
    want = brute(rows, ask=lambda i: i % 50 == 0)
    got = answer(q.search(t, asked(t, 50), shard_points=400, leaf=64))
    hits = sum(len({r[1] for r in got[i]} & {r[1] for r in want[i][0]}) for i in want)
    assert hits >= 0.9 * 10 * len(want)
    for i, rs in got.items():  # what is found is ranked and measured exactly
        d = [float(np.sqrt(((np.float32(x[i]).astype(float) - np.float32(x[r[1]]).astype(float)) ** 2).sum())) for r in rs]
        assert [r[0] for r in rs] == list(range(1, 11)) and np.allclose([r[2] for r in rs], d, rtol=1e-13) and d == sorted(d)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-0.0, 1.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 2.0]), (10, [1.0, 2.0, 3.0]), (11, [2.0, 2.0, 3.0]),
            (20, [5.0]), (30, None), (40, [0.0, 0.0]), (50, [1e30, 1e30])]
    t = table(spark, rows)
    same(answer(q.search(t, asked(t), factor=1)), brute(rows, ask=lambda i: i % 10 == 0))
    same(answer(q.digest(t)), brute(rows))
    assert q.digest(table(spark, [])).collect() == [] and q.digest(table(spark, [(0, [1.0])])).collect() == []
    assert q.digest(t).dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    # Queries that are not rows of the table; fewer neighbours than asked for.
    got = answer(q.search(t, table(spark, [(77, [1.0, 2.0])]), k=2, factor=1))
    assert got == {77: [(1, 0, 0.0), (2, 1, 0.0)]}
    for bad in ({"factor": 0.5}, {"k": 0}):
        with pytest.raises(ValueError):
            q.search(t, t, **bad)
