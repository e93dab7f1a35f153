from __future__ import annotations

import hashlib
import io
import random

import pytest
from llm.helpers import dicts

from tablemend.llm import warc
from tablemend.llm.common import fresh_folder

SCHEMA = "page_id long, url string, html string, most long, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


BIG = "".join(random.Random(1).choices("abcdefé\r\n<>", k=400_000))
ROWS = [
    (1, "http://a/ b", "x" * 1000), (7, "http://a/c", "x" * 1000), (3, None, "x" * 1000), (4, "u", "x" * 999), (5, "u", "x" * 999), (6, "u", None), (8, "u", ""),
    (9, "u", BIG), (10, "u", BIG), (11, "u", "WARC/1.1\r\n\r\n\r\n" * 200), (None, "u", "y" * 2000), (12, "u", "y" * 2000), (None, "u", "z" * 2000), (None, "u", "z" * 2000),
]


def test_pages(spark):
    out = dicts(warc.page_records(warc.archived(table(spark, ROWS))))
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out), key=repr)
    want = []
    for page, _, html in ROWS:
        data = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "").encode() == data and p is not None]
        revisit = len(data) >= 1000 and bool(same) and page != max(same)
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    assert got == sorted(want, key=repr)


def test_chunks(spark):
    folder = fresh_folder(spark, "warc-test")
    index = warc.write_archives(warc.planned(table(spark, ROWS)), folder)
    rows = dicts(warc.read_chunks(index, folder, 10_000))
    record = sorted((r for r in rows if r["record_id"] == "urn:page:10"), key=lambda r: r["chunk_no"])
    whole = b"".join(bytes(r["chunk"]) for r in record)
    assert whole == BIG.encode() and max(len(r["chunk"]) for r in record) <= 10_000 and [r["last"] for r in record].count(True) == 1
    for k, r in enumerate(record):
        assert r["bytes_so_far"] == sum(len(x["chunk"]) for x in record[: k + 1])
    assert record[3]["sha1_so_far"] == hashlib.sha1(whole[:40_000]).hexdigest() and record[-1]["sha1_so_far"] == record[-1]["declared_digest"]


def test_a_revisit_without_its_response_stops_the_job(spark):
    folder = fresh_folder(spark, "warc-test")
    chunks = warc.read_chunks(warc.write_archives(warc.planned(table(spark, ROWS[:4])), folder), folder)
    assert warc.page_records(chunks).count() == 4
    with pytest.raises(Exception, match="no response for urn:page:1"):
        warc.page_records(chunks.where("record_id <> 'urn:page:7'")).where("page_id = 1").collect()


def test_empty(spark):
    assert warc.page_records(warc.archived(table(spark, []))).count() == 0


def test_one_file():
    out = io.BytesIO()
    for k in range(50):
        warc.write_record(out, k, "u", memoryview(b"%d" % k * k), None, hashlib.sha1(b"%d" % k * k).hexdigest())
    for size in (1, 7, 1000):
        rows = list(warc.chunks_of(io.BytesIO(out.getvalue()), "a", size))
        ends = [r for r in rows if r["last"]]
        assert len(ends) == 50 and all(r["sha1_so_far"] == r["declared_digest"] for r in ends)
