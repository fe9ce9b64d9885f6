"""Licence scans by a trained paragraph classifier.

A paragraph is a line; a longer one than ``UNIT`` words is taken in windows of
``UNIT`` words that overlap by half. Hard-wrapped notices are seen by the same
windows over the words of each block of lines (up to a line without words;
comment marks are no words), as far as they hold a line end; such a window is
left out where it repeats what one of its lines has found. The features of a
paragraph are the counts of known word
1- to 3-grams over the root of its length. A softmax regression over licence
families and the class ``unknown`` is trained on the driver from a bounded
set: variants of public licence notices (words dropped, put inside other
words) against lines of at most ``SAMPLE_SLOTS`` documents, one per hash slot
(``LINES_PER_DOC`` lines of each, from any place of the text, ``UNIT`` words from
any place of a line), and sentences that use the same words otherwise.

A quarter of the variants and lines is held out: there the softmax temperature is
fitted and the least probability is chosen at which predictions are right; below
it a paragraph is ``unknown``. ``accuracy`` is that on this quarter, i.e. on other
variants of notices that were learned. What the classifier makes of notices that
it has not learned, ``unseen_notices`` measures: whole notices are left out, with
all their variants. It is no good there (about 0.3 get their family, and of the
families named 0.4 are right); template comparison confirms a wrong one only where
a variant lost the word that tells two families apart. A wording becomes known by
adding it to ``TEMPLATES``.

A predicted family is confirmed if enough of the word pairs of one of its
templates occur in the paragraph, and no other family's template has them all
(the GPL, LGPL and AGPL notices differ in one word).

Defined cases: a NULL or empty text has no paragraph and no finding; repeated
rows are scanned row by row; an empty table gives an empty result (the
classifier then has no background lines); other columns are passed through,
but for those whose names the output takes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import let, without
from .decontam import removal_spans, slices, words

UNKNOWN = "unknown"
UNIT, SAMPLE_SLOTS, LINES_PER_DOC, LINE_CHARS = 24, 512, 8, 400
CONFIRM, RIGHT, FOLDS = 0.6, 0.98, 4
SLICE_BYTES = 2 << 20

# Customary notices of public licences by family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright the company. All rights reserved.",
    ),
}
# The same words in other uses.
OTHER_USES = (
    "A driver needs a license before the first trip on public roads.",
    "The general public reserved all seats for version two of the play.",
    "The rights of the public were discussed under the new law.",
    "He released the record under his own name in May.",
    "The work is free and all software was written by students.",
    "The museum keeps a license plate and an apache blanket.",
    "They studied at MIT and worked on version 2 of the engine.",
    "Creative people share common ground and give attribution.",
    "The source of the river is open to the public without conditions.",
    "The permission of the owner is required to use this road.",
    "Terms and conditions of the trip are under discussion.",
    "The foundation published a report on free trade.",
)


def units(text: bytes | None) -> list[tuple[int, list[bytes]]]:
    """(number of the first word in the text, words) of each paragraph or window of one."""
    out, at = [], 0
    for line in (text or b"").split(b"\n"):
        w = words(line)
        if len(w) <= UNIT:
            if w:
                out.append((at, w))
        else:
            for i in range(0, len(w) - UNIT // 2, UNIT // 2):
                out.append((at + i, w[i:i + UNIT]))
        at += len(w)
    return out


def crossing(text: bytes | None) -> list[tuple[int, list[bytes]]]:
    """(number of the first word in the text, words) of the windows over blocks of lines that hold a line end."""
    out, at = [], 0
    block: list[bytes] = []
    line: list[int] = []  # line of each word of the block
    for i, x in enumerate([*(text or b"").split(b"\n"), b""]):
        w = words(x)
        if w:
            block += w
            line += [i] * len(w)
        elif block:
            for k in range(0, max(len(block) - UNIT // 2, 1), UNIT // 2):
                if line[k] != line[min(k + UNIT, len(block)) - 1]:
                    out.append((at + k, block[k:k + UNIT]))
            at += len(block)
            block, line = [], []
    return out


class Vocabulary:
    """Numbers of known words, pairs and triples; 0 is none."""

    def __init__(self, samples: list[list[bytes]], least: int = 3, most: int = 1 << 12):
        seen: Counter = Counter()
        for w in samples:
            for n in (1, 2, 3):
                seen.update(set(zip(*[w[i:] for i in range(n)])))
        grams = sorted((g for g, c in seen.items() if c >= least), key=lambda g: (-seen[g], g))[:most]
        self.words = {g: i + 1 for i, g in enumerate(sorted({x for g in grams for x in g}))}
        self.base = len(self.words) + 1
        code = sorted(self.code([self.words[x] for x in g]) for g in grams)
        self.codes = np.array(code, dtype=np.int64)

    def code(self, ids: list[int]) -> int:
        out = 0
        for i in reversed(ids):
            out = out * self.base + i
        return out

    def features(self, batch: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(sample, feature) of every known n-gram occurrence."""
        size = np.array([len(w) for w in batch], dtype=np.int64)
        get = self.words.get
        flat = np.fromiter((get(x, 0) for w in batch for x in w), dtype=np.int64, count=int(size.sum()))
        row = np.repeat(np.arange(len(batch)), size)
        rows, feats = [], []
        code, ok = flat.copy(), flat > 0
        for n in (1, 2, 3):
            if n > 1:
                m = len(flat) - n + 1
                if m <= 0:
                    break
                ok = ok[:m] & (flat[n - 1:] > 0) & (row[:m] == row[n - 1:])
                code = code[:m] + flat[n - 1:] * self.base ** (n - 1)
            at = np.nonzero(ok)[0]
            f = np.searchsorted(self.codes, code[at])
            known = (f < len(self.codes)) & (self.codes[np.minimum(f, len(self.codes) - 1)] == code[at])
            rows.append(row[at[known]])
            feats.append(f[known])
        return np.concatenate(rows), np.concatenate(feats)


class Classifier:
    """Softmax regression over sparse n-gram counts with a fitted temperature and least probability."""

    def __init__(self, background: list[list[bytes]], seed: int = 7, variants: int = 24, steps: int = 150,
                 decay: float = 1e-4, without: set[tuple[str, int]] = frozenset()):
        """``without``: (family, place) of templates whose variants are not learned; ``left_out`` has these."""
        rng = np.random.default_rng(seed)
        self.classes = [UNKNOWN, *TEMPLATES]
        self.pairs = {k: [self.grams(words(t.encode())) for t in v] for k, v in TEMPLATES.items()}
        other = [words(t.encode()) for t in OTHER_USES]
        background = [w for w in background if w and max(self.likeness(w, k) for k in TEMPLATES) < CONFIRM]
        filler = [w for w in background if len(w) >= 4] or other
        x: list[list[bytes]] = []
        y: list[int] = []
        self.left_out: list[tuple[list[bytes], int]] = []
        for k, texts in TEMPLATES.items():
            for j, t in enumerate(texts):
                w = words(t.encode())
                for v in range(variants):
                    u = w if v % 2 == 0 else [a for a in w if rng.random() > 0.05] or w
                    if v % 3 == 2:  # inside running text
                        f = [a for _ in range(6) for a in filler[rng.integers(len(filler))]]
                        room = max(UNIT - len(u), 4)
                        f = f[:rng.integers(4, room + 1)]
                        at = rng.integers(len(f) + 1)
                        u = [*f[:at], *u, *f[at:]]
                    if (k, j) in without:
                        self.left_out.append((u, self.classes.index(k)))
                        continue
                    x.append(u)
                    y.append(self.classes.index(k))
        for w in [*background, *(o for o in other for _ in range(variants))]:
            x.append(w)
            y.append(0)
        label = np.array(y)
        test = rng.random(len(x)) < 0.25
        self.vocabulary = Vocabulary([w for w, t in zip(x, test) if not t])
        self.weights = np.zeros((len(self.vocabulary.codes), len(self.classes)))
        self.bias = np.zeros(len(self.classes))
        self._fit([w for w, t in zip(x, test) if not t], label[~test], steps, decay)
        self._calibrate([w for w, t in zip(x, test) if t], label[test])

    def _matrix(self, batch: list[list[bytes]]) -> np.ndarray:
        m = np.zeros((len(batch), len(self.vocabulary.codes)), dtype=np.float32)
        row, f = self.vocabulary.features(batch)
        np.add.at(m, (row, f), 1)
        return m / np.sqrt([[max(len(w), 1)] for w in batch]).astype(np.float32)

    def _fit(self, batch: list[list[bytes]], label: np.ndarray, steps: int, decay: float) -> None:
        m = self._matrix(batch)
        want = np.eye(len(self.classes), dtype=np.float32)[label]
        # Every family weighs as much as the unknown class.
        weight = (1.0 / np.bincount(label, minlength=len(self.classes)).clip(1))[label]
        weight = (weight / weight.sum()).astype(np.float32)[:, None]
        w, b = self.weights.astype(np.float32), self.bias.astype(np.float32)
        mean, square = np.zeros_like(w), np.zeros_like(w)
        for i in range(1, steps + 1):
            z = m @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = weight * (p - want)
            grad = m.T @ g + decay * w
            mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
            w = w - 0.1 * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.999 ** i)) + 1e-8)
            b = b - 0.5 * g.sum(0)
        self.weights, self.bias = w.astype(np.float64), b.astype(np.float64)

    def _calibrate(self, batch: list[list[bytes]], label: np.ndarray) -> None:
        self.temperature, self.least = 1.0, 0.5
        z = self.logits(batch)

        def loss(t: float) -> float:
            p = softmax(z / t)
            return -np.log(p[np.arange(len(label)), label].clip(1e-12)).mean()

        self.temperature = min(np.geomspace(0.25, 4, 17), key=loss)
        p = softmax(z / self.temperature)
        top = p.argmax(1)
        for least in np.arange(0.5, 0.96, 0.05):
            said = (top > 0) & (p.max(1) >= least)
            self.least = float(least)
            if said.any() and (top[said] == label[said]).mean() >= RIGHT:
                break
        said = np.where(p.max(1) >= self.least, top, 0)
        self.accuracy = float((said == label).mean())

    def logits(self, batch: list[list[bytes]]) -> np.ndarray:
        row, f = self.vocabulary.features(batch)
        z = np.zeros((len(batch), len(self.classes)))
        if len(row):
            order = np.argsort(row, kind="stable")
            row, f = row[order], f[order]
            first = np.nonzero(np.diff(row, prepend=-1))[0]
            z[row[first]] = np.add.reduceat(self.weights[f], first, axis=0)
        return z / np.sqrt([[max(len(w), 1)] for w in batch]) + self.bias

    def predict(self, batch: list[list[bytes]]) -> list[tuple[int, str, float]]:
        """(sample, family, probability) of the samples that are not unknown."""
        if not batch:
            return []
        p = softmax(self.logits(batch) / self.temperature)
        top, best = p.argmax(1), p.max(1)
        return [(int(i), self.classes[top[i]], float(best[i])) for i in np.nonzero((top > 0) & (best >= self.least))[0]]

    @staticmethod
    def grams(w: list[bytes]) -> set:
        return set(zip(w, w[1:])) or {tuple(w)}

    def likeness(self, w: list[bytes], family: str) -> float:
        """Largest share of a template's word pairs that occur in ``w``."""
        have = self.grams(w)
        return max(len(t & have) / len(t) for t in self.pairs[family])

    def confirming(self, w: list[bytes], family: str) -> list[set]:
        """The word pairs in ``w`` of each template that confirms it, unless another family's template has them all."""
        have = self.grams(w)
        found = [t & have for t in self.pairs[family] if len(t & have) >= CONFIRM * len(t)]
        return [x for x in found if not any(x <= t for k, v in self.pairs.items() if k != family for t in v)]

    def adds(self, w: list[bytes], family: str, lines: list[list[bytes]]) -> bool:
        """Whether a template confirms ``w`` by word pairs that none of ``lines`` has."""
        seen = set().union(*map(self.grams, lines))
        return any(not x <= seen for x in self.confirming(w, family))


def unseen_notices(background: list[list[bytes]], folds: int = FOLDS, **how) -> dict[str, float]:
    """Share of right families among those named, share of variants given their family, and number of wrong families that
    a template confirms, over notices not learned.

    Each notice is left out once; no fold has all notices of a family.
    """
    named = right = n = confirmed = 0
    for f in range(folds):
        out = {(k, j) for i, (k, v) in enumerate(TEMPLATES.items()) for j in range(len(v)) if (i + j) % folds == f}
        c = Classifier(background, without=out, **how)
        said = {i: c.classes.index(k) for i, k, _ in c.predict([w for w, _ in c.left_out])}
        n, named = n + len(c.left_out), named + len(said)
        wrong = {i: k for i, k in said.items() if c.left_out[i][1] != k}
        right += len(said) - len(wrong)
        confirmed += sum(bool(c.confirming(c.left_out[i][0], c.classes[k])) for i, k in wrong.items())
    return {"right": right / max(named, 1), "recall": right / max(n, 1), "wrong_confirmed": confirmed, "variants": n}


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def background(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SAMPLE_SLOTS) -> list[list[bytes]]:
    """Words of some lines of the documents with the smallest id hash per slot (at most ``slots`` ids).

    Of each, ``LINES_PER_DOC`` lines that hold more than spaces (with repeats, if there are fewer), and of a line
    ``LINE_CHARS`` characters; places are hashes of the id.
    """
    d = docs.select(F.xxhash64(F.col(doc_id)).alias("h"), F.col(text).alias("t")).where("t is not null")
    chosen = [r["h"] for r in d.groupBy(F.pmod("h", F.lit(slots)).alias("s")).agg(F.min("h").alias("h")).collect()]
    lines = F.filter(F.split("t", "\n"), lambda x: F.trim(x) != "")
    some = d.where(F.col("h").isin(chosen)).select("h", lines.alias("lines")).where(F.size("lines") > 0)

    def place(n, *salt) -> Column:
        return F.pmod(F.xxhash64("h", *salt), F.greatest(n, F.lit(1)).cast("long")).cast("int")

    def excerpt(i: Column) -> Column:
        return let(F.get("lines", place(F.size("lines"), i)), lambda x: F.substr(
            x, place(F.length(x) - LINE_CHARS + 1, i, F.lit("at")) + 1, F.lit(LINE_CHARS)))

    picked = F.transform(F.sequence(F.lit(0), F.lit(LINES_PER_DOC - 1)), excerpt)
    some = some.groupBy("h").agg(F.min(F.array_join(F.array_distinct(picked), "\n")).alias("x")).collect()
    out = []
    for r in sorted(some, key=lambda r: r["h"]):
        for j, x in enumerate(r["x"].encode().split(b"\n")):
            if w := words(x):
                at = zlib.crc32(f"{r['h']} {j}".encode()) % max(len(w) - UNIT + 1, 1)
                out.append(w[at:at + UNIT])
    return out


FOUND = T.ArrayType(T.StructType([
    T.StructField("family", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("score", T.DoubleType()), T.StructField("likeness", T.DoubleType()),
    T.StructField("confirmed", T.BooleanType())]))
_FOUND = pa.list_(pa.struct([("family", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
                             ("likeness", pa.float64()), ("confirmed", pa.bool_())]))


def scan(docs: DataFrame, classifier: Classifier, out: str = "found", text: str = "text") -> DataFrame:
    """``docs`` plus ``out``: paragraphs that are not unknown, as code-point spans of the text."""
    docs = without(docs, out)
    bc = docs.sparkSession.sparkContext.broadcast(classifier)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = bc.value
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for b in slices(batch, batch.column(at), SLICE_BYTES):
                texts = b.column(at).cast(pa.binary()).to_pylist()
                place, flat = [], []
                for i, t in enumerate(texts):
                    for across, of in enumerate((units, crossing)):
                        for first, w in of(t):
                            place.append((i, first, across))
                            flat.append(w)
                said: list[list] = [[] for _ in texts]
                for k, family, p in c.predict(flat):
                    i, first, across = place[k]
                    like = c.likeness(flat[k], family)
                    # The lines of a text come before the windows across them.
                    lines = [x for x in said[i] if not x[-1] and x[2] == family and x[0] < first + len(flat[k])
                             and first < x[0] + len(x[1])] if across else []
                    if not lines or c.adds(flat[k], family, [x[1] for x in lines if x[5]]):
                        said[i].append((first, flat[k], family, p, like, bool(c.confirming(flat[k], family)), across))
                rows: list[list] = [[] for _ in texts]
                for i, found in enumerate(said):
                    for first, w, family, p, like, sure, _ in sorted(found, key=lambda x: (x[0], len(x[1]))):
                        [(s, e)] = removal_spans(texts[i], [(first, first + len(w))])
                        rows[i].append({"family": family, "start": s, "end": e, "score": round(p, 6),
                                        "likeness": round(like, 6), "confirmed": sure})
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, _FOUND)], names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The registered query: families of confirmed paragraphs per document, from ``scan``."""
    c = Classifier(background(docs))
    sure = F.filter("found", lambda x: x["confirmed"])
    return scan(docs.select("doc_id", "text"), c).select(
        "doc_id", F.size("found").cast("long").alias("n_predicted"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.transform(sure, lambda x: F.concat_ws(":", x["family"], x["start"], x["end"])), ",").alias("spans"))
