import hashlib
import random

import numpy as np
import pytest
import sentencepiece as sp
from sentencepiece import sentencepiece_model_pb2 as pb

from yieldspark.llm import pieces as q
from yieldspark.llm.queries import tokenizer_path

PATH = tokenizer_path()


def blobs():
    """The installed model, and the same with a compiled character map and with extra spaces removed."""
    m = pb.ModelProto()
    with open(PATH, "rb") as f:
        m.ParseFromString(f.read())
    yield m.SerializeToString()
    rules = pb.ModelProto()
    rules.ParseFromString(sp.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    m.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
    yield m.SerializeToString()
    m.normalizer_spec.remove_extra_whitespaces = True
    yield m.SerializeToString()


def texts():
    rnd = random.Random(1)
    alphabet = list("abcdefg  \n\t ▁é日本語😀\x00ﬁ①Ａ　́​</s>0") + ["the ", "ing", "<0x0A>"]
    out = ["", " ", "  ", " a", "a ", "  a  b  ", "\n", "▁", "▁▁a", "x" * 500, "the " * 300, "abcd" * 200 + " é" * 50, "日本語" * 50]
    return out + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(250)]


@pytest.mark.parametrize("which", [0, 1, 2])
def test_ids_ends_and_decoding_match_the_library(which):
    blob = list(blobs())[which]
    lib, e = sp.SentencePieceProcessor(model_proto=blob), q.Encoder(q.Model(blob))
    for t in texts():
        norm, back = e.normalizer.normalise(t.encode())
        ids, _ = e.encode([norm])
        want = lib.encode(t)
        assert ids.tolist() == want, t
        assert q.decode(e.model, want).decode() == lib.decode(want), t
        assert e.ends(ids, back).tolist() == [p.end for p in lib.encode(t, return_type="proto").pieces], t


def test_decoding_of_any_ids_matches_the_library():
    lib, m = sp.SentencePieceProcessor(model_file=PATH), q.Model(open(PATH, "rb").read())
    rnd = random.Random(4)
    for _ in range(200):
        ids = [rnd.choice([rnd.randrange(3, 259), rnd.randrange(259, 32000)]) for _ in range(12)]
        assert q.decode(m, ids).decode() == lib.decode(ids)


def test_heap_and_list_merges_agree():
    e = q.Encoder(q.Model(open(PATH, "rb").read()))
    rnd = random.Random(2)
    for _ in range(300):
        s = "▁" + "".join(rnd.choice("theinga日") for _ in range(rnd.randint(1, 40)))
        assert e.merge(s) == e._merge_long(list(s))


def test_many_segments_at_once_agree_with_one_by_one():
    e = q.Encoder(q.Model(open(PATH, "rb").read()))
    rnd = random.Random(7)
    segs = ["▁" + "".join(rnd.choice("theingaé日\n😀ouxsr") for _ in range(rnd.randint(0, 30))) for _ in range(2000)]
    sym, n = e.pairs.merge(segs)
    edge = np.concatenate([[0], np.cumsum(n)])
    for s, lo, hi in zip(segs, edge, edge[1:]):
        want = [e.pairs.symbol.get(p, -1 - ord(p) if len(p) == 1 else None) for p in e.merge(s)]
        assert sym[lo:hi].tolist() == want, s


def test_query_matches_the_library(make_docs, edge_rows):
    lib = sp.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows)]
    got = {r.doc_id: r for r in q.digest(make_docs(rows), PATH).collect()}
    for i, t in rows:
        ids = lib.encode(t or "")
        assert got[i].n_tokens == len(ids) and got[i].n_bytes == len((t or "").encode())
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_cache_overflow_changes_nothing(monkeypatch):
    e = q.Encoder(q.Model(open(PATH, "rb").read()))
    norms = [e.normalizer.normalise(t.encode())[0] for t in texts()]
    want = e.encode(norms)[0]
    monkeypatch.setattr(q, "CACHE_SEGMENTS", 3)
    assert np.concatenate([e.encode([n])[0] for n in norms]).tolist() == want.tolist()


def test_with_ids_keeps_columns(edge_docs, no_docs):
    out = q.with_ids(edge_docs, PATH)
    assert out.columns[:len(edge_docs.columns)] == edge_docs.columns and out.count() == edge_docs.count()
    assert q.digest(no_docs, PATH).count() == 0


def test_with_ids_gives_offsets_and_decoded_texts(make_docs, edge_rows):
    lib = sp.SentencePieceProcessor(model_file=PATH)
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows)]
    docs = make_docs(rows)
    out = q.with_ids(docs, PATH)
    assert out.columns[len(docs.columns):] == ["_ids", "ends", "decoded", "n_tokens"]  # these documents have ids of their own
    got = {r.doc_id: r for r in out.collect()}
    for i, t in rows:
        pieces = lib.encode(t or "", return_type="proto").pieces
        want = [p.id for p in pieces]
        assert got[i].text == t and got[i].ids == "x" and got[i]._ids == want and got[i].n_tokens == len(want)
        assert got[i].decoded == lib.decode(want)
        assert got[i].ends == [p.end for p in pieces], i


def test_with_ids_leaves_columns_of_its_names_alone(make_docs):
    docs = make_docs([(1, "one two")]).withColumnRenamed("t", "Ends").withColumnRenamed("w", "decoded")
    [r] = q.with_ids(docs, PATH).collect()
    assert (r["Ends"], r["decoded"], r["_ends"][-1], r["_decoded"]) == ("x", "x", 7, "one two")
