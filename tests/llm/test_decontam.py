import hashlib
import random
import re

import numpy as np
import pytest

from yieldspark.llm import decontam as q

from samples import PROSE

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=13):
    win = {}
    for name, t in items:
        w = words(t)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            win.setdefault(tuple(w[i:i + window]), set()).add("" if name is None else str(name))
    out = {}
    for i, t in docs:
        w, hit, who = words(t), set(), set()
        for z in {len(k) for k in win}:
            for s in range(len(w) - z + 1):
                k = tuple(w[s:s + z])
                if k in win:
                    hit.update(range(s, s + z))
                    who |= win[k]
        out[i] = (len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(),
                  bool(hit) and 20 * len(hit) >= len(w))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


@pytest.fixture(scope="module")
def case(make_docs, spark, edge_rows):
    rnd = random.Random(9)
    v = ["ab", "cd", "é", "42", "xyz", "Foo", "日本"]
    items = [(i, " ".join(rnd.choice(v) for _ in range(rnd.randint(1, 30)))) for i in range(12)]
    items += [(None, "one two three"), (3, "same id other text"), (50, None), (51, "!!!"), (52, PROSE), (52, PROSE)]
    docs = [(i, t) for i, (_, t) in enumerate(edge_rows)]
    for i in range(100, 160):
        parts = [" ".join(rnd.choice(v) for _ in range(rnd.randint(0, 40)))]
        parts += [rnd.choice(items)[1] or "" for _ in range(rnd.randint(0, 3))]
        rnd.shuffle(parts)
        docs.append((i, rnd.choice([" ", ", ", "-\n"]).join(parts)))
    return docs, items, make_docs(docs), spark.createDataFrame(items, "item_id long, text string")


def test_hits_match_brute_force(case):
    docs, items, d, b = case
    assert result(q.digest(d, b)) == brute(docs, items)


def test_blocks_of_the_test_set_give_the_same(case):
    docs, items, d, b = case
    names = ("n", "s", "i")
    one = {r.doc_id: (r.n, r.s, r.i) for r in q.scan(d, b, names).collect()}
    many = {r.doc_id: (r.n, r.s, r.i) for r in q.scan(d, b, names, block_bytes=200).collect()}
    assert one == many


def test_passes_and_blocks_within_a_pass_give_the_same(case):
    docs, items, d, b = case
    names = ("n", "s", "i")
    one = {r.doc_id: (r.n, r.s, r.i) for r in q.scan(d, b, names).collect()}
    assert one == {r.doc_id: (r.n, r.s, r.i) for r in q.scan(d, b, names, block_bytes=200, pass_blocks=3).collect()}


def test_index_is_built_once_per_shard(monkeypatch):
    built = []
    index = q.FMIndex
    monkeypatch.setattr(q, "FMIndex", lambda *a: built.append(1) or index(*a))
    blocks = [q.Phrases([(str(i), f"w{i} w{i + 1} w{i + 2} w{i + 3}".encode())], 3) for i in range(40)]
    known = q.Known(np.unique(np.concatenate([q.crc(p.vocabulary) for p in blocks])), 3)
    shard = q.Shard([b"x w0 w1 w2 y", b"w5 w6 w7 w8 w9", None, b"w9 w8"], known)
    found = {i: f for i, p in enumerate(blocks) if (f := shard.search(p))}
    assert len(built) == 1 and shard.n_words.tolist() == [5, 5, 0, 2]
    assert found == {0: {0: ([[1, 4]], {"0"})}, 4: {1: ([[0, 3]], {"4"})}, 5: {1: ([[0, 4]], {"5"})}, 6: {1: ([[1, 5]], {"6"})}, 7: {1: ([[2, 5]], {"7"})}}


def test_items_that_share_windows():
    p = q.Phrases([("x", b"a b c d"), ("y", b"z b c d"), ("w", b"b c d"), ("y", b"b c d")], 3)
    k = next(i for i in range(len(p.size)) if [p.vocabulary[n - 2] for n in p.words[i]] == [b"b", b"c", b"d"])
    place, item = p.items_of(np.array([k, k]))
    for j in (0, 1):
        assert {p.names[i] for i in item[place == j]} == {"x", "y", "w"}


def test_index_finds_every_occurrence():
    rnd = np.random.default_rng(4)
    seq = rnd.integers(1, 5, 3000).astype(np.int32)
    p = q.Phrases([("x", b"a b c a"), ("y", b"b b"), ("z", b"c")], 4)
    top = 4
    at = {}
    for k, pos in zip(*q.FMIndex(seq, top).search(p)):
        at.setdefault(int(k), set()).add(int(pos))
    for k, n in enumerate(p.size):
        want = {i for i in range(len(seq) - n + 1) if (seq[i:i + n] == p.words[k, :n]).all()}
        assert at.get(k, set()) == want


def test_suffix_array_of_repetitive_text():
    seq = np.append(np.tile([2, 1, 2, 3], 200), 0).astype(np.int32)
    assert q.suffix_array(seq).tolist() == sorted(range(len(seq)), key=lambda i: seq[i:].tolist())


def test_removal_spans_are_code_points(make_docs, spark):
    d = make_docs([(1, "é! One, TWO three — 日本")])
    b = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    r = q.with_removal(q.scan(d, b, ("n_", "s_", "i_")), "s_", "cut").first()
    assert [r.text[x.start:x.end] for x in r.cut] == ["TWO three"]


def test_keep_clean(case):
    docs, items, d, b = case
    want = sorted(i for i, x in brute(docs, items).items() if not x[-1])
    out = q.keep_clean(d, b)
    assert sorted(r.doc_id for r in out.collect()) == want and out.columns == d.columns


def test_empty_tables(no_docs, edge_docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert q.digest(no_docs, none).count() == 0
    assert all(r.n_hit == 0 and not r.contaminated for r in q.digest(edge_docs, none).collect())
