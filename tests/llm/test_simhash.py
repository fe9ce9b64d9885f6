import random
import re

import numpy as np
import pytest
import xxhash

from yieldspark.llm import components, simhash as q

from samples import PROSE


def fp(t):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, bits=2):
    v = np.array(values, dtype=np.uint64)
    lab = list(range(len(v)))

    def find(x):
        while lab[x] != x:
            x = lab[x]
        return x
    for i, j in zip(*np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None]) <= bits, 1))):
        a, b = find(i), find(j)
        lab[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def test_fingerprints_and_components_match_brute_force(make_docs, edge_rows):
    rnd = random.Random(5)
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows) if i != 7]
    base = [rnd.choice(PROSE.lower().split()) for _ in range(400)]
    for i in range(100, 160):
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = rnd.choice("abcdef")
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in q.digest(make_docs(rows)).collect()}
    ids = [i for i, _ in rows]
    values = [fp(t) for _, t in rows]
    assert {i: f for i, (f, _) in got.items()} == {i: f"{v:016x}" for i, v in zip(ids, values)}
    assert {i: c for i, (_, c) in got.items()} == {i: ids[r] for i, r in zip(ids, roots(values))}


def test_shards_lose_no_pair(spark):
    rnd = np.random.default_rng(2)
    centres = rnd.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [c ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for c in centres for a, b in rnd.integers(0, 63, (30, 2))]
    v = np.unique(np.array([*centres, *near, *rnd.integers(0, 1 << 63, 3000, dtype=np.uint64)], dtype=np.uint64))
    points = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    edges = [(r.a, r.b) for r in q.links(points, shard_points=300).collect()]
    lab = {int(x): int(x) for x in v.view(np.int64)}

    def find(x):
        while lab[x] != x:
            x = lab[x]
        return x
    for a, b in edges:
        lab[find(a)] = find(b)
    got, want = {}, {}
    for x, r in zip(v.view(np.int64).tolist(), roots(v)):
        got.setdefault(find(x), set()).add(x)
        want.setdefault(r, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert len(edges) <= 20 * len(v)


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_values_that_share_a_block_are_dealt_by_whole_fingerprints(spark, bits):
    rnd = np.random.default_rng(bits)
    far = rnd.integers(0, 1 << 63, 1000, dtype=np.uint64) << np.uint64(1)
    shared = (rnd.integers(0, 1 << 63, 1500, dtype=np.uint64) << np.uint64(22)) | np.uint64(0x155555)
    v = np.concatenate([far, shared])
    for _ in range(bits):
        v = np.concatenate([v[:2500], v[-500:] ^ (np.uint64(1) << rnd.integers(0, 64, 500).astype(np.uint64))])
    v = np.unique(v)
    points = spark.createDataFrame([(int(x),) for x in v.view(np.int64)], "fp long")
    got = {r.a: r.b for r in components.stars(q.links(points, bits, shard_points=200, min_depth=2)).collect()}
    want = {}
    for x, r in zip(v.view(np.int64).tolist(), roots(v, bits)):
        want.setdefault(r, set()).add(x)
    assert got == {x: min(c) for c in want.values() for x in c if x != min(c)}


def test_search_tests_grow_little_faster_than_the_points(monkeypatch):
    tests, inner = [0], q.distance

    def counted(*a):
        d = inner(*a)
        tests[0] += d.size
        return d
    monkeypatch.setattr(q, "distance", counted)

    def cost(n):
        v = np.unique(np.random.default_rng(3).integers(0, 1 << 63, n, dtype=np.uint64))
        tests[0] = 0
        for m in q.block_masks(2):
            q.link_shard(v, v, 2, m)
        return tests[0]
    assert cost(80_000) < 4.6 * cost(20_000)


def test_dense_ball_gives_a_forest():
    ball = np.array([0, *[1 << i for i in range(64)], *[(1 << i) | (1 << j) for i in range(64) for j in range(i)]], dtype=np.uint64)
    a, b = q.link_shard(ball, ball)
    assert len(a) == len(ball) - 1 and set(b.tolist()) == {0}


def test_stars_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.a: r.b for r in components.stars(spark.createDataFrame([*path, *hub, (5, 5)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_keep_one_keeps_the_smallest_id(make_docs, edge_docs):
    d = make_docs([(5, PROSE), (3, PROSE), (3, PROSE), (None, PROSE), (9, PROSE.upper()), (7, None), (8, ""), (4, "other text here")])
    assert sorted(r.doc_id for r in q.keep_one(d).collect()) == [3, 4, 7]
    out = q.keep_one(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 5, 7, 8, 9, 10]


def test_empty_table(no_docs):
    assert q.digest(no_docs).count() == 0 and q.keep_one(no_docs).count() == 0
