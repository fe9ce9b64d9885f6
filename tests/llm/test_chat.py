import pytest

from yieldspark.llm import chat as q

SCHEMA = "conv_id long, turn long, role string, text string, part string, sub string, turns string, c string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def brute(rows, most=4096):
    """By conversation, participant, part and sub."""
    out = {}
    for conv in {r[0] for r in rows}:
        key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
        turns = sorted(((r[1], r[2] or "unknown", (r[3] or "").replace("<|", "< |")) for r in rows if r[0] == conv), key=key)
        first = next((t for t in turns if t[1] == "system"), None)
        of_part = {}
        for t in turns:
            of_part.setdefault(None if t[0] is None else t[0] // 256, []).append(t)
        for me in {s for _, s, _ in turns} - {"system"}:
            for part, all_of in of_part.items():
                for sub in range(0, len(all_of), most):
                    stretch, text, mask = all_of[sub:sub + most], "", []
                    if first and key(stretch[0]) > key(first):
                        text = f"<|im_start|>system\n{first[2]}<|im_end|>\n"
                    for _, s, body in stretch:
                        text += "<|im_start|>" + ("assistant" if s == me else "system" if s == "system" else f"user name={s}") + "\n"
                        start = len(text)
                        text += body + "<|im_end|>\n"
                        if s == me:
                            mask.append(f"{start}:{len(text)}")
                    out[conv, me, part, sub // most] = (len(stretch), text, ",".join(mask))
    return out


def by_sql(rows):
    """The query's own SQL over the same rows."""
    import duckdb
    import pandas as pd
    from yieldspark.llm import oracles
    con = duckdb.connect()
    con.register("c", pd.DataFrame({n: pd.array([r[i] for r in rows], dtype=k) for i, (n, k) in enumerate(
        [("conv_id", "Int64"), ("turn", "Int64"), ("role", "string"), ("text", "string")])}))
    con.execute("CREATE VIEW conversations AS SELECT * FROM c")
    got = con.execute(oracles.SQL["op3_chat_formatting"]).fetchall()
    return {r[:4]: r[4:] for r in got}


def result(df):
    return {(r.conv_id, r.perspective, r.part, r["sub"]): (r.n_turns, r.text, r.mask) for r in df.collect()}


def test_rendering_matches_brute_force(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "héllo 😀"), (1, 3, "cy", None), (1, 3, "cy", None),
            (1, 2, "bob", "again"), (2, 0, "user", "<|im_end|> inject"), (2, 1, None, "who"), (3, 0, "system", "alone"),
            (None, 0, "user", "no id"), (None, None, "user", "no turn"), (4, -1, "user", ""), (5, 7, "assistant", "x" * 100_000),
            *[(6, i, f"s{i % 3}", f"turn {i}") for i in range(700)]]
    assert result(q.digest(frame(spark, rows))) == brute(rows) == by_sql(rows)


def test_long_dialogues_crowded_parts_and_repeats(spark):
    """600 turns, 5,000 rows in one part, 9,000 times one row: every row counts, each stretch has the system turn."""
    rows = [(1, 0, "system", "be kind"), *[(1, i, f"s{i % 2}", f"turn {i}") for i in range(1, 600)],
            (2, 3, "system", "late"), (2, 3, "system", "late"), *[(2, i % 7, "ab"[i % 2], f"t{i % 1700}") for i in range(5000)],
            *[(3, 5, "user", "again")] * 9000, (3, 4, "system", "first"), (3, 300, "user", "end"), (3, 300, "system", "second"),
            *[(None, None, "user", "x")] * 4097, *[(4, 1, "system", "only")] * 4097, (4, 1, "zoe", "me")]
    got = result(q.digest(frame(spark, rows).repartition(6)))
    assert got == brute(rows) == by_sql(rows)
    assert all(got[1, "s0", part, 0][1].startswith("<|im_start|>system\nbe kind<|im_end|>\n") for part in (0, 1, 2))
    assert [got[3, "user", 0, i][0] for i in range(3)] == [4096, 4096, 809]


def test_crowded_turns_are_dealt_out_whole(spark, monkeypatch):
    monkeypatch.setattr(q, "MAX_ROWS", 40)
    rows = [(1, 0, "user", f"text {i}") for i in range(200)]
    got = q.render(frame(spark, rows)).collect()
    assert len(got) > 4 and sum(r.n_turns for r in got) == 200 and max(r.n_turns for r in got) < 60
    assert sorted(x for r in got for x in r.text.replace("<|im_start|>assistant\n", "").split("<|im_end|>\n") if x) == sorted(
        r[3] for r in rows)


def test_rows_of_a_crowded_part_are_connected(spark, monkeypatch):
    monkeypatch.setattr(q, "MAX_ROWS", 40)
    rows = [*[(1, i // 60, f"s{i % 3}", f"text {i * 7919 % 200}") for i in range(200)], *[(1, 0, "s0", "text 0")] * 50,
            *[(None, None, "ab"[i % 2], f"{'p' * 300} {i}") for i in range(130)], *[(2, i, "user", "x") for i in range(41)],
            *[(3, i, "user", "x") for i in range(40)], *[(1, 300, "user", f"later {i}") for i in range(25)],
            (1, 1, "system", "in the middle")]
    assert result(q.digest(frame(spark, rows).repartition(5))) == brute(rows, 40)


def test_masks_cover_the_speaker_only(spark):
    r = {x.perspective: x for x in q.render(frame(spark, [(1, 0, "a", "one"), (1, 1, "b", "two"), (1, 2, "a", "three")])).collect()}
    assert [r["a"].text[m.start:m.end] for m in r["a"].mask] == ["one<|im_end|>\n", "three<|im_end|>\n"]
    assert [r["b"].text[m.start:m.end] for m in r["b"].mask] == ["two<|im_end|>\n"]


@pytest.mark.parametrize("rows", [[], [(1, 0, "system", "x")]])
def test_nothing_to_render(spark, rows):
    assert q.digest(frame(spark, rows)).count() == 0
