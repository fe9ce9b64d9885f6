import re

from yieldspark.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    cover = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(cover) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover), failed)


def row(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_counts_match_brute_force(make_docs, edge_rows):
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows)]
    rows += [(100, "a b c d e f a b c d e g"), (101, "a a a a a a a a a a a a"), (102, "one two\none two\n\n \none two\nthree"),
             (103, "# * $ % & | < > word " * 3), (104, "a b c d\x0be\x0cf")]
    got = {r.doc_id: r for r in q.measure(make_docs(rows)).collect()}
    assert {i: row(got[i]) for i, _ in rows} == {i: brute(t) for i, t in rows}
    assert all(not r.kept for r in got.values() if r.base_failed)
    assert got[0].kept


def test_one_repeated_line_is_no_fault(make_docs):
    motto, other = "the motto of this small house stands here", "one line of text lies between the two of them today"
    docs = make_docs([(1, f"{motto}\n{other}\n{motto}"), (2, "\n".join([motto] * 4 + [other]))])
    assert {r.doc_id: r.why for r in q.judge(docs, "why", rules=q.RULES[2:]).collect()} == {1: None, 2: "repeated_lines"}


def test_keep_agrees_with_measure_and_any_rule_order(make_docs, edge_docs):
    kept = sorted((str(r.doc_id), r.text) for r in q.keep(edge_docs).collect())
    again = sorted((str(r.doc_id), r.text) for r in q.keep(edge_docs, rules=q.RULES[::-1]).collect())
    assert kept == again and q.keep(edge_docs).columns == edge_docs.columns
    ids = sorted(str(r.doc_id) for r in q.measure(edge_docs).where("kept").collect())
    assert ids == [i for i, _ in kept]


def test_filter_on_the_verdict_is_cheap(edge_docs):
    assert q.judge(edge_docs, "why").where("why is not null").count() + q.keep(edge_docs).count() == edge_docs.count()


def test_order_is_by_rejection_per_cost():
    rules = q.RULES[:3]
    est = [q.Estimate(rules[0].name, 1.0, 0.1), q.Estimate(rules[1].name, 0.1, 0.1), q.Estimate(rules[2].name, 0.5, 0.0)]
    assert [r.name for r in q.ordered(rules, est)] == [rules[1].name, rules[0].name, rules[2].name]


def test_order_does_not_hang_on_the_noise_of_a_run(make_docs):
    """Costs that differ by what a busy machine adds give one order; rules of clearly different cost are told apart."""
    rules = q.RULES[:3]
    for busy in (0.8, 1.0, 1.7):
        est = [q.Estimate(r.name, s * busy * noise, 0.1) for r, s, noise in zip(rules, (0.01, 0.16, 0.08), (1.2, 0.9, 1.1))]
        assert [r.name for r in q.ordered(rules, est)] == [rules[0].name, rules[2].name, rules[1].name]
    docs = make_docs([(i, f"{'word of a text ' * (20 + i % 9)} {i} {'same line again' if i % 3 else 'other'}\n") for i in range(120)])
    got = {e.name: e for e in q.estimate(docs)}
    assert got["repeated_windows"].seconds > 5 * got["few_words"].seconds and got["repeated_windows"].rejected == 1.0


def test_empty_table(no_docs):
    assert q.measure(no_docs).count() == 0 and q.keep(no_docs).count() == 0
