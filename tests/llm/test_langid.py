import random
import zlib

import pytest
from pyspark.sql import functions as F
from samples import PROSE

from yieldspark.llm import langid as q

VOCAB = {"en": "the of and to in is that it was for on are with as his they at be this have from or one had by",
         "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden",
         "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya"}


def corpus(n=240):
    rnd = random.Random(8)
    out = []
    for i in range(n):
        lang = rnd.choice(sorted(VOCAB))
        out.append((i, " ".join(rnd.choice(VOCAB[lang].split()) for _ in range(rnd.randint(15, 120))), lang))
    return out


def test_held_out_rows_are_named_and_not_learned_from(make_docs):
    rows = corpus()
    got = {r.doc_id: r for r in q.digest(make_docs(rows)).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    test = [(i, lang) for i, _, lang in rows if got[i].held_out]
    assert sum(got[i].lang_pred == lang for i, lang in test) >= 0.97 * len(test)
    # Labels of held-out rows change nothing.
    wrong = [(i, t, "xx" if got[i].held_out else lang) for i, t, lang in rows]
    assert {r.doc_id: r for r in q.digest(make_docs(wrong)).collect()} == got


def test_prediction_uses_the_text_only(make_docs):
    content = q.learn(make_docs(corpus(60)))
    a = q.identify(make_docs([(1, "der die und das nicht", "en")]), content).first()
    b = q.identify(make_docs([(99, "der die und das nicht", None)]), content).first()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score) and a.lang_pred == "de" and 0 <= a.score <= 1


def test_edges(make_docs, edge_docs, no_docs):
    rows = corpus(60)
    content = q.learn(make_docs(rows + [(None, "x y z", "zz"), (500, None, "zz"), (501, "a b", None)]))
    assert sorted(content) == ["de", "en", "es"]
    got = [(r.text, r.lang_pred, r.score, r.accepted) for r in q.identify(edge_docs, content).collect()]
    for t, lang, score, ok in got:
        if t is None or not any(c.isalpha() for c in t):
            assert (lang, score, ok) == ("und", 0.0, False)
        else:
            assert lang in content and 0 <= score <= 1
    assert q.digest(no_docs).count() == 0
    assert {r.lang_pred for r in q.identify(edge_docs, {}).collect()} == {"und"}


def test_ties_go_to_the_first_name_and_are_rejected():
    c = q.Classifier({"b": PROSE.encode(), "a": PROSE.encode()})
    assert c.predict("lazy dog") == ("a", 0.0)


def test_query_matches_plain_compression(spark):
    """Every document of the smallest table, each block compressed by a new compressor per language."""
    import zstandard
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    content = q.learn(docs.where(~q.held_out(F.col("doc_id"))))

    def size(data, lang):
        d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        how = zstandard.ZstdCompressionParameters.from_level(
            q.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=how).compress(data[i:i + q.BLOCK]))
                   for i in range(0, len(data), q.BLOCK))

    got = {r.doc_id: (r.lang_pred, r.score) for r in q.digest(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and len(content) > 1
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        sizes = sorted((size(r.text.lower().encode(), k), k) for k in content)
        assert got[r.doc_id] == (sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0])


def test_many_languages_share_the_excerpts(make_docs):
    rows = corpus()
    content = q.learn(make_docs(rows), most=60)
    assert sorted(content) == ["de", "en", "es"] and all(1 <= c.count(b"\n") + 1 <= 20 for c in content.values())
    many = q.learn(make_docs([(i, f"text of label {i}", f"l{i:04}") for i in range(1500)]))
    assert len(many) == 1500 and many["l0007"] == b"text of label 7"
    with pytest.raises(ValueError, match="3 labels"):
        q.learn(make_docs(rows), most=2)
