import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from samples import PROSE

from yieldspark.llm import periods as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, exponent=4, length=6):
    """Every maximal stretch of each period, those of a smaller period inside left out."""
    n, out = len(w), []
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(length, exponent * p) and not any(
                    s <= i and j + p <= s + m for s, m, r in out if r < p):
                out.append((i, j - i + p, p))
            i = j + 1
    return sorted((s, m, p) for s, m, p in out)


def brute(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, m, p in runs for i in range(s + p, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def random_text(rnd):
    kind = rnd.randrange(5)
    if kind == 0:
        return [rnd.randrange(2) for _ in range(rnd.randrange(60))]
    if kind == 1:
        return [rnd.randrange(50) for _ in range(rnd.randrange(200))]
    if kind == 2:  # one word over and over, broken here and there
        return [0 if rnd.random() < 0.97 else 1 for _ in range(rnd.randrange(150))]
    out = []
    for _ in range(rnd.randrange(1, 5)):  # periodic stretches of repetitive words
        unit = [rnd.randrange(3) for _ in range(rnd.randrange(1, 14))]
        if kind == 4:
            unit = unit * rnd.randrange(1, 4) + [rnd.randrange(3)]
        m = rnd.randrange(1, 7 * len(unit))
        out += (unit * 8)[:m] + [rnd.randrange(3) for _ in range(rnd.randrange(4))]
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = [random_text(rnd) for _ in range(400)]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    got = [[] for _ in texts]
    for t, *run in zip(*(x.tolist() for x in q.find_runs(np.array(sum(texts, []), dtype=np.int64), sizes))):
        got[t].append(tuple(run))
    for t, runs in zip(texts, got):
        assert runs == brute_runs(t), t


def test_long_runs_and_exponents():
    unit = list(range(500))
    w = np.array([7, 8, *unit * 5, *unit[:250], 9], dtype=np.int64)
    run = tuple(int(x[0]) for x in q.find_runs(w, np.array([len(w)])))
    assert run == (0, 2, 2750, 500)
    ones = np.zeros(300_000, dtype=np.int64)
    assert [x.tolist() for x in q.find_runs(ones, np.array([len(ones)]))] == [[0], [0], [300_000], [1]]
    # Five periods and a half are a run at least exponent 4 and 5, not at 6.
    assert len(q.find_runs(w, np.array([len(w)]), exponent=5)[0]) == 1
    assert len(q.find_runs(w, np.array([len(w)]), exponent=6)[0]) == 0
    with pytest.raises(ValueError):
        q.find_runs(w, np.array([len(w)]), exponent=3)


def test_texts_do_not_meet():
    none = q.find_runs(np.array([1, 1, 1, 1, 1, 1], dtype=np.int64), np.array([3, 0, 3]))
    assert len(none[0]) == 0


def as_tuple(r):
    return (r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def test_query_equals_brute_force(make_docs, edge_rows):
    rnd = random.Random(5)
    vocab = ["a", "b", "ä b", "c\td", "e\n\x0bf", "\x1cg\x85", "日本　語", "word", ""]
    rows = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(90)))) for i in range(300)]
    rows += [(1000 + i, f"x{i} " + "ha " * i + "end") for i in range(12)]
    rows += [r for r in edge_rows if r[0] != 5] + [(2000, "\n".join(["the same line again"] * 400))]
    got = [as_tuple(r) for r in q.digest(make_docs(rows)).collect()]
    assert sorted(got, key=repr) == sorted((brute(*r) for r in rows), key=repr)
    assert any(r[1] for r in got) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i)


def test_edges(make_docs, edge_docs, no_docs):
    assert q.digest(no_docs).count() == 0 and q.detect(no_docs).columns[-3:] == ["n_words", "runs", "collapsed"]
    got = {(r.doc_id, r.text): r for r in q.detect(edge_docs).collect()}
    long_ = next(r for (i, _), r in got.items() if i == 5)  # 5,000 pairs of words twelve times over
    assert long_.n_words == 120_000 and [tuple(x) for x in long_.runs] == [(0, 120_000, 10_000)]
    assert long_.collapsed == " ".join(long_.text.split()[:10_000])
    assert got[(2, None)].n_words == 0 and got[(2, None)].runs == [] and got[(2, None)].collapsed == ""
    assert got[(1, PROSE)].collapsed == PROSE
    # A column with a new one's name is replaced, and the text can be left out.
    d = make_docs([(1, "ha " * 9)]).withColumnRenamed("t", "Runs")
    row = q.detect(d, keep_text=False).first()
    assert "text" not in row.asDict() and [tuple(x) for x in row.runs] == [(0, 9, 1)] and row.collapsed == "ha"
