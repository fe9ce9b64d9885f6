import duckdb
import pytest
from samples import PROSE
from test_decontam import brute as hits
from test_quality import brute as counts
from test_secrets import base, entropy
from test_simhash import fp, roots

import __spark_entry__ as entry
import corpus_pipeline as cp
from tools.check_oracle import canon
from yieldspark.llm import oracles, queries
from yieldspark.sources.tables import TABLES, path

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(oracles.SQL) <= set(queries.queries())


@pytest.mark.parametrize("key", sorted(oracles.SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path(SF, t)}')")
    df = entry.queries()[key](spark, SF)
    res = con.execute(oracles.SQL[key])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in res.description], res.fetchall())


def test_pipeline_matches_brute_force(spark):
    """Every stage over the documents of the smallest scale, against plain Python."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for i, t in docs.items():
        n, chars, symbols, _, _, failed = counts(t)
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\f\r")]
        size, once = sum(map(len, lines)), sum(map(len, dict.fromkeys(lines)))
        if not failed and 2 * n <= chars <= 25 * n and 100 * symbols <= 5 * chars and (
                len(lines) - len(set(lines)) < 2 or 100 * (size - once) <= 30 * size) and any(
                c.isalpha() for c in t):
            kept[i] = t
    ids = sorted(kept)
    one = [ids[r] for r in roots([fp(kept[i]) for i in ids])]
    kept = {i: kept[i] for i, r in zip(ids, one) if i == r}
    dirty = {i for i, x in hits(kept.items(), items).items() if x[-1]}
    want = {}
    for i in set(kept) - dirty:
        t, pos, out = kept[i], 0, ""
        for s, _, e, k in sorted(base(t) + entropy(t)):
            if s >= pos:
                out += t[pos:s] + f"[{k.upper()}]"
            pos = max(pos, e)
        want[i] = out + t[pos:]
    got = cp.run(spark, SF).collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) and r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_columns_on_edges_and_empty_input(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.count() <= docs.count(), name
        last = cp.STAGES[-1][1](spark, docs, SF)
        assert last.count() == docs.count()


def test_clean_documents_stay(spark, make_docs):
    rows = [(i, f"{PROSE} Document number {i} adds {' '.join(f'fact{i}x{k}' for k in range(60))}.") for i in range(30)]
    d = make_docs(rows)
    for _, stage in cp.STAGES:
        d = stage(spark, d, SF)
    assert {r.doc_id: r.text for r in d.collect()} == dict(rows)


def test_last_stage_encodes_aligns_and_decodes(spark, make_docs):
    rows = dict([(1, PROSE), (2, "  ünïcödé 日本語\n😀 "), (3, "")])
    for r in cp.STAGES[-1][1](spark, make_docs(rows.items()), SF).collect():
        size = len(rows[r.doc_id].encode())
        assert r.decoded == rows[r.doc_id] and r.n_tokens == len(r.ends)
        assert r.ends == sorted(r.ends) and (r.ends or [0])[-1] == size
