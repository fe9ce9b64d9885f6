"""WARC archives with revisit records for repeated payloads.

A page becomes one record: ``response`` with an HTTP message whose payload is
the page, or ``revisit`` (identical payload digest) with the HTTP header only.
Of pages with equal payloads of at least ``min_bytes`` bytes the one with the
largest id is the response and the others revisit it; shorter ones are all
responses.

Resolution shuffles headers only (id, URL, digest, length): the response of a
digest is an aggregate, and revisits join it by digest, where Spark may split
a hot digest. Payloads are then joined to the chosen responses by the record
id (a hash of id, URL and digest), so that a digest which a third of the pages
share is spread over its pages; identical rows, which share one, are reduced to
one row by each task before the shuffle. Records are text: Spark's text writer
writes them with the record end ``CR LF CR LF`` as line separator,
gzip-compressed, under the shared folder.

Files are bounded by bytes. Payloads of up to ``SMALL`` bytes go to files of at
most ``FILE_BYTES / SMALL`` records; longer ones to files of their own, with as
many records as the longest payload lets into ``FILE_BYTES``, one at least. A
reader holds one compressed file and one record at a time.

Reading back takes files as binary rows and walks their records by
Content-Length; the digest of a response is computed again from its payload.

Defined cases: a NULL payload is empty; a NULL id counts as smaller than any
id and has no id header; a NULL URL is written as ``urn:unknown``, line breaks
in one are percent-encoded; of identical rows one is the response and the
others revisit it; an empty table gives no record; other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime as dt
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from .common import cut

FILE_BYTES, SMALL = 512 << 20, 256 << 10
# Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_END = "\r\n\r\n"


def sha1_base32(payload: Column) -> Column:
    """Base32 of the SHA-1: each 5 hex digits of it are 4 base-32 digits."""
    x = F.sha1(payload.cast("binary"))
    digits = F.concat(*[F.lpad(F.conv(F.substring(x, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def headers(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """id, url, payload, digest, n_bytes of every page."""
    p = F.coalesce(F.col(html), F.lit(""))
    return pages.select(F.col(page_id).alias("id"), F.coalesce(F.col(url), F.lit("urn:unknown")).alias("url"),
                        p.alias("payload"), sha1_base32(p).alias("digest"),
                        F.octet_length(p).cast("long").alias("n_bytes"))


def record_id(*cols) -> Column:
    x = F.md5(F.to_json(F.struct(*cols)))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(x, a, n) for a, n in (
        (1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def resolve(head: DataFrame, min_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """(responses, revisits) by header.

    responses: id, url, digest, n_bytes, copies (identical rows) and one, true
    if only one of the copies is the response. revisits: id, url, digest,
    n_bytes, nr, to_id, to_url.
    """
    groups = head.groupBy("digest", "id", "url", "n_bytes").agg(F.count(F.lit(1)).alias("copies"))
    short = F.col("n_bytes") < min_bytes
    top = F.max(F.struct(F.col("id").isNotNull().alias("has"), "id", "url")).alias("top")
    first = (head.where(~short).groupBy("digest").agg(top)
             .select("digest", F.col("top.id").alias("to_id"), F.col("top.url").alias("to_url")))
    j = groups.where(~short).join(first, "digest")
    is_top = F.col("id").eqNullSafe(F.col("to_id")) & (F.col("url") == F.col("to_url"))
    responses = (j.where(is_top).select("id", "url", "digest", "n_bytes", "copies", F.lit(True).alias("one"))
                 .unionByName(groups.where(short).withColumn("one", F.lit(False))
                              .select("id", "url", "digest", "n_bytes", "copies", "one")))
    # Copies of the response but one revisit it, too.
    n = F.col("copies") - F.when(is_top, 1).otherwise(0)
    revisits = (j.withColumn("n", n.cast("int")).where("n > 0")
                .withColumn("nr", F.explode(F.sequence(F.lit(1), F.col("n"))))
                .select("id", "url", "digest", "n_bytes", "nr", "to_id", "to_url"))
    return responses, revisits


def _lines(*pairs: tuple[str, Column | str | None]) -> Column:
    """Header lines; a NULL value leaves its line out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{k}: "), v if isinstance(v, Column) else F.lit(v)) for k, v in pairs])


def _url(c: str) -> Column:
    return F.replace(F.replace(F.col(c), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _http() -> Column:
    return F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _lines(
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("n_bytes").cast("string"))), F.lit(_END))


def _record(kind: str, date: str, rid: Column, block: Column, *more: tuple[str, Column | str]) -> Column:
    head = _lines(("WARC-Type", kind), ("WARC-Record-ID", F.concat(F.lit("<"), rid, F.lit(">"))), ("WARC-Date", date),
                  ("WARC-Target-URI", _url("url")), ("X-Page-ID", F.col("id").cast("string")),
                  ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), *more,
                  ("Content-Type", "application/http; msgtype=response"),
                  ("Content-Length", F.octet_length(block).cast("string")))
    return F.concat(F.lit("WARC/1.1\r\n"), head, F.lit(_END), block).alias("value")


def _resolved(pages: DataFrame, page_id: str, url: str, html: str, min_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers with payload, responses, revisits); headers are a small table that is written once, as several steps read
    it and each would read and hash all payloads."""
    h = headers(pages, page_id, url, html)
    return (h, *resolve(cut(h.drop("payload"), "warc-headers"), min_bytes))


def _kept(h: DataFrame, responses: DataFrame, date: str, min_bytes: int) -> DataFrame:
    """Response records of ``h``: all short pages, and the chosen one of each other payload."""
    rid = record_id("id", "url", "digest").alias("rid")  # never NULL
    # The step that leaves one of identical rows combines before its shuffle, and the join reads the same shuffle.
    full = h.where(F.col("n_bytes") >= min_bytes).select("*", rid).dropDuplicates(["rid"])
    full = full.join(responses.where("one").select(rid), "rid", "left_semi")
    if min_bytes > 0:
        full = full.unionByName(h.where(F.col("n_bytes") < min_bytes).select("*", rid))
    return full.select(_record("response", date, F.col("rid"), F.concat(_http(), F.col("payload"))))


def _again(revisits: DataFrame, date: str) -> DataFrame:
    return revisits.select(_record(
        "revisit", date, record_id("id", "url", "digest", "nr"), _http(), ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", F.concat(F.lit("<"), record_id(
            F.col("to_id").alias("id"), F.col("to_url").alias("url"), "digest"), F.lit(">"))),
        ("WARC-Refers-To-Target-URI", _url("to_url")), ("WARC-Refers-To-Date", date),
        ("X-Refers-To-Page-ID", F.col("to_id").cast("string"))))


def written_at(at: dt.datetime | None = None) -> str:
    """The date of a record: ``at``, or now."""
    return (at or dt.datetime.now(dt.UTC)).astimezone(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            min_bytes: int = 0, at: dt.datetime | None = None) -> DataFrame:
    """One column ``value``: the record of every page, without the record end."""
    h, responses, revisits = _resolved(pages, page_id, url, html, min_bytes)
    return _kept(h, responses, written_at(at), min_bytes).unionByName(_again(revisits, written_at(at)))


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_bytes: int = 0, file_bytes: int = FILE_BYTES, small: int = SMALL, at: dt.datetime | None = None) -> None:
    """Archives of all pages as gzip files under ``path`` (a folder that does not exist yet)."""
    h, responses, revisits = _resolved(pages, page_id, url, html, min_bytes)
    date, n = written_at(at), F.col("n_bytes")
    longest = responses.agg(F.max("n_bytes")).first()[0] or 0

    def save(df: DataFrame, size: int, mode: str) -> None:
        (df.write.mode(mode).option("lineSep", _END).option("compression", "gzip")
         .option("maxRecordsPerFile", max(1, file_bytes // size)).text(path))

    save(_kept(h.where(n <= small), responses, date, min_bytes).unionByName(_again(revisits, date)), small, "errorifexists")
    if longest > small:
        save(_kept(h.where(n > small), responses, date, min_bytes), longest, "append")


def parse(f) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(record headers, HTTP headers, payload) of an open, decompressed archive."""
    def fields(lines: list[bytes]) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}

    while (line := f.readline()):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("no record where one should start")
        lines = []
        while (line := f.readline()).strip():
            lines.append(line)
        head = fields(lines)
        n = int(head["content-length"])
        block = f.read(n)
        if len(block) < n:
            raise ValueError("record is cut off")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield head, fields(http.split(b"\r\n")[1:]), payload


ROW = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                 ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()),
                 ("intact", pa.bool_()), ("payload", pa.binary())])


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives under ``path``.

    ``intact``: a response's payload has the length and the digest that its headers name; true for revisits.
    """
    schema = ROW if with_payload else ROW.remove(ROW.get_field_index("payload"))

    def row(head: dict, http: dict, payload: bytes) -> dict:
        kind, digest, n = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
        ok = kind == "revisit" or (len(payload) == n and base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest)
        return {"page_id": head.get("x-page-id"), "url": head.get("warc-target-uri"), "record_type": kind,
                "payload_bytes": n, "payload_digest": digest, "refers_to": head.get("x-refers-to-page-id"), "intact": ok,
                "payload": payload if kind == "response" else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())) as f:
                    for one in parse(f):
                        rows.append({k: v for k, v in row(*one).items() if k in schema.names})
                        if len(rows) == 500:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else f.type}" for f in schema).replace(" bool", " boolean")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, kinds)


def digest(pages: DataFrame) -> DataFrame:
    """The columns of the registered query: all pages written, then read from the archives."""
    spark = pages.sparkSession
    path = session.scratch_table_path(spark, f"llm-warc-{uuid.uuid4().hex}")
    write(pages, path)
    kind = pages.schema["page_id"].dataType
    return read(spark, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "intact")
