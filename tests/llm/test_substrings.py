import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from yieldspark.llm import substrings as q


def brute(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((str(i), len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def rows():
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7)))
    passage = [" ".join(word() for _ in range(70)) for _ in range(4)]
    out = [(1, None), (2, ""), (None, "short"), (3, "a" * 1000), (4, "ab" * 300), (None, passage[0]), (None, passage[0]),
           (5, passage[1]), (5, passage[1]), (6, passage[1] + passage[1]), (7, passage[2][:199]), (8, passage[2][:200]),
           (9, "é" * 99 + "x" + passage[2])]
    for i in range(100, 130):
        t = [" ".join(word() for _ in range(rnd.randint(0, 60))) for _ in range(3)]
        t.insert(rnd.randint(0, 3), rnd.choice(passage))
        if rnd.random() < 0.5:
            t.insert(0, rnd.choice(passage)[rnd.randint(0, 100):])
        out.append((i, " ".join(t)))
    base = " ".join(word() for _ in range(300)).split()
    for i in range(200, 215):
        w = list(base)
        for _ in range(3):
            w[rnd.randrange(len(w))] = word()
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("shard_bytes", [q.SHARD_BYTES, 2000, 0])
def test_removal_matches_brute_force(make_docs, shard_bytes):
    """Also where groups have to be dealt out again, some of them or all of them down to single windows."""
    r = rows()
    assert result(q.digest(make_docs(r), shard_bytes=shard_bytes)) == brute(r, 200)


def test_ten_thousand_contexts_of_one_anchor(make_docs):
    """A passage in very many surroundings: the groups stay within the bound, the result is that of brute force."""
    rnd = random.Random(4)
    passage = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 6) for _ in range(50))[:170]
    r = [(i, f"{i * 7919 % 100003:06d} {passage} {i * 104729 % 1000003:07d} " + "z" * (i % 3) + str(i)) for i in range(10_000)]
    r += [(20_000 + i, "left " * 8 + passage + " right" * 8) for i in range(3)]
    assert result(q.digest(make_docs(r))) == brute(r, 200)


def test_halves_keep_every_window_once_and_equal_ones_together():
    rnd = random.Random(9)
    core = bytes(rnd.choice(b"ab") for _ in range(32))
    todo = [(1, core.join((bytes(rnd.choice(b"ab") for _ in range(168)), bytes(rnd.choice(b"ab") for _ in range(168)))), 169, 168, 200, 0)
            for _ in range(3)]
    want = sorted(d[i:i + 200] for _, d, n, *_ in todo for i in range(n))
    rounds = 0
    while todo[0][4] - todo[0][3] < 200:
        rounds += 1
        todo = [(g, d, m, a, b, 0) for g0, d0, n, lo, hi, _ in todo for g, _, at, m, d, a, b in q.halves(g0, d0, n, lo, hi)]
        assert all(i <= a and b <= i + 200 for _, _, n, a, b, _ in todo for i in range(n))  # what is shared is in every window
        assert sorted(d[i:i + 200] for _, d, n, *_ in todo for i in range(n)) == want
    assert rounds == 8 and all(n == 1 and len(d) == 200 for _, d, n, *_ in todo)
    by_group = {}
    for g, d, *_ in todo:
        by_group.setdefault(g, set()).add(d)
    assert all(len(x) == 1 for x in by_group.values()) and len(by_group) == len(set(want))


def test_small_shards_and_pieces_change_nothing(make_docs, monkeypatch):
    r = rows()
    monkeypatch.setattr(q, "PIECE", 300)
    batch = [(t or "").encode() for _, t in r]
    whole = []
    for data, _, _, starts, ends in q._pieces(batch, 200):
        seg, first, n, _, _ = q.contexts(data, starts, ends)
        whole += [data[f + k:f + k + 200] for f, m in zip(first.tolist(), n.tolist()) for k in range(m)]
    want = Counter(b[i:i + 200] for b in batch for i in range(len(b) - 199))
    assert Counter(whole) == want


def test_equal_windows_have_equal_anchors():
    rnd = random.Random(1)
    core = bytes(rnd.choice(b"abcd") for _ in range(260))
    a = bytes(rnd.choice(b"abcd") for _ in range(500)) + core + b"tail" * 60
    b = core + bytes(rnd.choice(b"abcd") for _ in range(300))
    at = []
    for data, offset in ((a, 500), (b, 0)):
        _, first, n, _, anchor = q.contexts(data, np.array([0]), np.array([len(data)]))
        by = {f + k: h for f, m, h in zip(first.tolist(), n.tolist(), anchor.tolist()) for k in range(m)}
        at.append([by[offset + k] for k in range(61)])
    assert at[0] == at[1]


def test_classes_are_common_prefixes():
    rnd = np.random.default_rng(3)
    for seq in (rnd.integers(1, 3, 400), np.tile([1, 2, 2], 100), rnd.integers(1, 200, 300)):
        seq = np.append(seq, 0).astype(np.int32)
        for length in (1, 3, 8):
            sa, group = q.common_prefix_classes(seq, length)
            assert sa.tolist() == sorted(range(len(seq)), key=lambda i: seq[i:].tolist())
            for i in range(1, len(seq)):
                a, b = seq[sa[i - 1]:sa[i - 1] + length].tolist(), seq[sa[i]:sa[i] + length].tolist()
                assert (group[i] == group[i - 1]) == (a == b and len(a) == length)


def test_remove_keeps_columns(make_docs, edge_docs, no_docs):
    out = q.remove(edge_docs)
    assert out.columns == [*edge_docs.columns, "_kept"] and out.count() == edge_docs.count()
    assert all((r.text is None) == (r._kept is None) for r in out.select("text", "_kept").collect())
    assert q.digest(no_docs).count() == 0 and q.remove(no_docs).count() == 0
