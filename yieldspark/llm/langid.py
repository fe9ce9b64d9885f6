"""Language identification by compression.

For every language a raw-content zstandard dictionary is put together from
excerpts of labelled documents. A text is compressed block by block with each
dictionary; the language whose dictionary gives the fewest bytes in total is
its language. The margin (share of the second best's bytes that the best
saves) tells how sure that is; a margin under ``min_margin`` is rejected.

Learning reads id and label of every labelled row and keeps, per language, the
rows with the smallest id hash of ``SLOTS`` hash slots (a bounded sample,
combined before the shuffle), then one excerpt of at most ``EXCERPT``
characters of each: at most 128 K characters per language, on the driver. Where
that would be more than ``MAX_EXCERPTS`` excerpts in all (over 1,000
languages), every language gets an equal share of them as its slots.
Prediction reads nothing but the text.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0
and not accepted; equal sizes go to the first language by name; without any
labelled row every text is ``und``; rows without id or label are not learned
from; repeated rows are judged row by row; an empty table gives an empty
result; other columns are passed through,
but for those whose names the output takes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without

SLOTS, EXCERPT, MAX_EXCERPTS = 512, 256, 512_000
LEVEL, BLOCK, MIN_MARGIN = 6, 4096, 0.01
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          slots: int = SLOTS, most: int = MAX_EXCERPTS) -> dict[str, bytes]:
    """Dictionary content per language from rows with an id, a text and a label; ``most`` excerpts in all."""
    d = labelled.select(F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("t"))
    d = d.where("id is not null and lang is not null and t is not null").withColumn("h", F.xxhash64("id"))
    chosen = d.groupBy("lang", F.pmod("h", F.lit(slots)).alias("slot")).agg(F.min("h").alias("h"))
    keys = [(r["lang"], r["h"]) for r in chosen.limit(most + 1).collect()]
    if len(keys) > most:
        n = d.select("lang").distinct().count()
        if n > most:
            raise ValueError(f"{n} labels, more than the {most} excerpts that are learned from")
        return learn(labelled, doc_id, text, lang, most // n, most)
    # One excerpt per chosen id (ids may repeat), from a place that depends on the id only.
    some = d.where(F.col("h").isin([h for _, h in keys]) if keys else F.lit(False))
    at = F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.length("t") - EXCERPT, F.lit(0)) + 1).cast("int") + 1
    some = some.groupBy("lang", "h").agg(F.min(F.substr("t", at, F.lit(EXCERPT))).alias("x"))
    parts: dict[str, list[str]] = {}
    for r in sorted(some.collect(), key=lambda r: (r["lang"], r["h"])):
        parts.setdefault(r["lang"], []).append(r["x"].lower())
    return {k: "\n".join(v).encode() for k, v in parts.items()}


class Classifier:
    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        self.langs = sorted(content)
        self.compress = []
        for k in self.langs:
            d = zstandard.ZstdCompressionDict(content[k], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            params = zstandard.ZstdCompressionParameters.from_level(
                level, write_checksum=False, write_content_size=False, write_dict_id=False)
            d.precompute_compress(compression_params=params)
            self.compress.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        return [sum(len(c(b)) for b in blocks) for c in self.compress]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and margin."""
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        size = self.sizes(text)
        best = min(range(len(size)), key=lambda i: (size[i], self.langs[i]))
        others = [s for i, s in enumerate(size) if i != best]
        second = min(others) if others else 0
        return self.langs[best], (second - size[best]) / second if second else 1.0


def identify(docs: DataFrame, content: dict[str, bytes], out: tuple[str, str, str] = ("lang_pred", "score", "accepted"),
             text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` plus the language of fewest bytes, its margin (0 to 1) and whether the margin is wide enough."""
    docs = without(docs, *out)
    bc = docs.sparkSession.sparkContext.broadcast(content)
    schema = T.StructType([*docs.schema.fields, T.StructField(out[0], T.StringType()),
                           T.StructField(out[1], T.DoubleType()), T.StructField(out[2], T.BooleanType())])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Classifier(bc.value)
        for b in batches:
            col = b.column(b.schema.get_field_index(text))
            found = [c.predict(x.as_py()) for x in col]
            yield pa.RecordBatch.from_arrays([
                *b.columns, pa.array([k for k, _ in found], pa.string()), pa.array([m for _, m in found], pa.float64()),
                pa.array([k != UNKNOWN and m >= min_margin for k, m in found], pa.bool_())], names=names)

    return docs.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of the registered query: learned from the rows that are not held out, applied to all."""
    content = learn(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), content).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
