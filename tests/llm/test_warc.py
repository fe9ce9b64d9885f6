import base64
import datetime as dt
import glob
import gzip
import hashlib
import uuid

import pytest

from yieldspark import session
from yieldspark.llm import warc as q

SCHEMA = "page_id long, url string, html string, id string, digest string, payload string"


def b32(s):
    return base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>é日本</p>\r\n\r\nWARC/1.1\r\n" * 30_000
    rows = [(1, "http://a", "same"), (9, "http://b", "same"), (4, "http://c", "same"), (2, "http://d", None), (3, None, ""),
            (5, "http://e\r\nX: y", "one\r\n\r\ntwo"), (6, "http://f", big), (7, "http://g", big), (None, "http://h", "lone"),
            (None, "http://i", "same"), (8, "http://j", "copy"), (8, "http://j", "copy"), (8, "http://j", "copy"), (8, "http://k", "copy")]
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def test_round_trip(pages):
    got = q.digest(pages).collect()
    rows = pages.collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (str(r.page_id), len((r.html or "").encode()), b32(r.html)) for r in rows)
    for html in {r.html or "" for r in rows}:
        same = [r for r in got if r.payload_digest == b32(html)]
        top = max((r.page_id for r in rows if (r.html or "") == html and r.page_id is not None), default=None)
        first = [r for r in same if r.record_type == "response"]
        assert len(first) == 1 and first[0].page_id == top and first[0].refers_to is None
        assert all(r.refers_to == top for r in same if r.record_type == "revisit")


def test_payloads_and_least_size(spark, pages):
    path = session.scratch_table_path(spark, f"warc-test-{uuid.uuid4().hex}")
    q.write(pages, path, min_bytes=5, file_bytes=300, small=100, at=dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.UTC))
    got = q.read(spark, path, with_payload=True).collect()
    assert {bytes(r.payload).decode() for r in got if r.record_type == "response"} == {r.html or "" for r in pages.collect()}
    short = [r for r in got if r.payload_bytes < 5]
    assert len(short) == 11 and all(r.record_type == "response" for r in short)
    assert [r.record_type for r in got if r.payload_bytes > 1000].count("revisit") == 1
    for f in glob.glob(path.removeprefix("file:") + "/*.gz"):
        with gzip.open(f) as g:
            data = g.read()
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        assert data.count(b"WARC-Date: 2024-05-06T07:08:09Z\r\n") == data.count(b"WARC-Record-ID: ")


def test_files_are_bounded_by_bytes(spark):
    rows = [(i, f"http://{i}", f"{i:04d}" * n, None, None, None) for i, n in enumerate([10] * 300 + [250] * 10 + [10_000] * 3)]
    path = session.scratch_table_path(spark, f"warc-test-{uuid.uuid4().hex}")
    q.write(spark.createDataFrame(rows, SCHEMA).coalesce(1), path, file_bytes=45_000, small=900)
    payload = [sorted(len(p) for _, _, p in q.parse(gzip.open(f))) for f in glob.glob(path.removeprefix("file:") + "/*.gz")]
    assert sorted(x for p in payload for x in p) == [40] * 300 + [1000] * 10 + [40_000] * 3
    assert all(sum(p) <= 45_000 for p in payload) and len(payload) > 5
    assert {len(p) for p in payload if p[-1] > 900} == {1}


def test_identical_rows_are_reduced_before_the_shuffle(spark):
    rows = [(1, "http://a", "same" * 1000, None, None, None)] * 3000 + [(2, "http://b", "other", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plan = q.records(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_first" in plan
    got = q.digest(df).groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in got} == {"response": 2, "revisit": 2999}


def test_damage_is_seen():
    import io
    with pytest.raises(ValueError):
        list(q.parse(io.BytesIO(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort")))
    with pytest.raises(ValueError):
        list(q.parse(io.BytesIO(b"junk\r\n")))


def test_empty_table(spark):
    assert q.digest(spark.createDataFrame([], SCHEMA)).count() == 0
