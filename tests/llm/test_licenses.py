import random

import pytest
from samples import PROSE

from yieldspark.llm import licenses as q


@pytest.fixture(scope="module")
def classifier():
    rnd = random.Random(3)
    v = PROSE.split() + "the of and to in is free use under this work public version all rights".split()
    return q.Classifier([q.words(" ".join(rnd.choice(v) for _ in range(rnd.randint(3, 40))).encode()) for _ in range(400)])


def test_held_out_accuracy(classifier):
    assert classifier.accuracy > 0.95 and 0.5 <= classifier.least <= 0.95


def test_notices_that_were_not_learned():
    """Whole notices left out, each once: families are often wrong; a template confirms one only where the telling word was dropped."""
    got = q.unseen_notices([q.words(PROSE.encode())] * 20, variants=6)
    assert got["variants"] == 6 * sum(map(len, q.TEMPLATES.values()))
    assert got["wrong_confirmed"] <= 0.01 * got["variants"] and 0 < got["recall"] <= got["right"] < 1


def test_background_lines_come_from_any_place(make_docs):
    text = "\n".join(f"line{i} " + " ".join(f"w{i}x{k}" for k in range(300)) for i in range(400))
    got = q.background(make_docs([(1, text), (2, None), (3, ""), (4, " \n "), (5, "one line"), (None, "no id")]))
    place = [tuple(map(int, w[1][1:].split(b"x"))) for w in got if w[1].startswith(b"w")]
    assert len(place) == q.LINES_PER_DOC and max(i for i, _ in place) > 100 and max(k for _, k in place) > 100
    assert sum(w == [b"one", b"line"] for w in got) == 1 and all(len(w) <= q.UNIT for w in got)
    assert got == q.background(make_docs([(5, "one line"), (1, text), (None, "no id")]))


def test_families_of_documents_with_known_lines(spark):
    """Every document of the small table against a plain search for the notices, line by line."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = sorted(((q.words(t.encode()), k) for k, v in q.TEMPLATES.items() for t in v), key=lambda x: -len(x[0]))

    def known(text):
        out = set()
        for line in (text or "").encode().split(b"\n"):
            w = b" ".join([b"", *q.words(line), b""])
            out.update(next(([k] for t, k in notices if b" ".join([b"", *t, b""]) in w), []))
        return ",".join(sorted(out))

    got = {r.doc_id: r.families for r in q.digest(docs).collect()}
    want = {r.doc_id: known(r.text) for r in docs.collect()}
    assert got == want and sum(map(bool, want.values())) > 20


def test_unseen_wordings_and_other_uses(classifier):
    said = {"This software is released under the MIT License, see the file.": "MIT",
            "The data are licensed under the Apache License, Version 2.0": "Apache",
            "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3!": "GPL",
            "Text licensed under CC BY-NC 4.0 by the authors.": "CC-BY-NC"}
    for text, family in said.items():
        assert [f for _, f, _ in classifier.predict([q.words(text.encode())])] == [family], text
    for text in (*q.OTHER_USES, PROSE, "He lost his driving license in version city.", "", "42"):
        w = q.words(text.encode())
        assert all(classifier.likeness(w, f) < q.CONFIRM for _, f, _ in classifier.predict([w] if w else [])), text


def test_spans_in_documents(make_docs, edge_rows, classifier):
    rows = [(i, t) for i, (_, t) in enumerate(edge_rows)]
    long_ = " ".join(PROSE.split() * 40)
    rows += [(100, f"é {PROSE}\nReleased under the MIT License.\n{PROSE}"), (101, "All rights reserved.\n\nAll rights reserved."),
             (102, f"{long_} Licensed under the Apache License, Version 2.0. {long_}")]
    got = {r.doc_id: r for r in q.scan(make_docs(rows), classifier).collect()}
    found = {i: [(f.family, r.text[f.start:f.end]) for f in r.found if f.confirmed] for i, r in got.items()}
    assert found[100] == [("MIT", "Released under the MIT License")]
    assert found[101] == [("proprietary", "All rights reserved")] * 2
    assert {f for f, _ in found[102]} == {"Apache"} and all("Apache License" in t for _, t in found[102])
    assert all(not found[i] for i in range(len(edge_rows)))


WRAPPED = {
    "GPL": """/* This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License as
 * published by the Free Software Foundation; either version 2 of
 * the License, or (at your option) any later version.
 */""",
    "LGPL": """# This library is free software: you can redistribute it and/or modify
# it under the terms of the GNU Lesser General Public License as published
# by the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "AGPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU Affero General Public License as published
# by the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "MIT": """// Permission is hereby granted, free of charge, to any person obtaining a
// copy of this software and associated documentation files (the "Software"),
// to deal in the Software without restriction, including without limitation""",
    "BSD": """Redistribution and use in source and binary forms, with or
without modification, are permitted provided that the following
conditions are met:""",
}


def test_wrapped_notices(make_docs, classifier):
    keys = sorted(WRAPPED)
    rows = [(n * 100 + i, " ".join(PROSE.split()[:n]) + "\n" * (n > 0) + WRAPPED[k] + "\n\n" + PROSE)
            for n in (0, 3, 7, 11, 20) for i, k in enumerate(keys)]
    rows.append((9999, f"{PROSE}\nReleased under the MIT License.\r\n{PROSE}\n{PROSE}"))
    got = {r.doc_id: r for r in q.scan(make_docs(rows), classifier).collect()}
    for i, _ in rows[:-1]:
        sure = [f for f in got[i].found if f.confirmed]
        assert {f.family for f in sure} == {keys[i % 100]}, got[i]
        assert all("\n" in got[i].text[f.start:f.end] for f in sure)
    assert [got[9999].text[f.start:f.end] for f in got[9999].found if f.confirmed] == ["Released under the MIT License"]


def test_units_cover_every_word():
    text = (" ".join(f"w{i}" for i in range(200)) + "\n\n\none two\n").encode()
    w = q.words(text)
    seen = set()
    for at, u in q.units(text):
        assert w[at:at + len(u)] == u and len(u) <= q.UNIT
        seen.update(range(at, at + len(u)))
    assert seen == set(range(len(w)))


def test_query_on_edges(edge_docs, no_docs):
    assert q.digest(edge_docs).count() == edge_docs.count()
    assert q.digest(no_docs).count() == 0
