"""Archives are read back as written; the index finds every capture of a URL."""

from __future__ import annotations

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from supportlens.llm import warc

SCHEMA = "page_id long, url string, html string, file string, skey string, digest string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "f", "s", "d") for r in rows], SCHEMA)


def brute(rows):
    first = {}
    for k, _, html in rows:
        if k is not None:
            first[html or ""] = min(first.get(html or "", k), k)
    out = []
    for k, _, html in rows:
        data = (html or "").encode()
        least = first.get(html or "") if len(data) >= 100 and sum((h or "") == (html or "") for *_, h in rows) > 1 else None
        revisit = least is not None and least != k
        out.append((k, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    return sorted(out, key=str)


def run(spark, rows):
    return sorted((tuple(r) for r in warc.archived(frame(spark, rows)).collect()), key=str)


@pytest.mark.parametrize("url, key", [
    ("https://www.Example.com:443/a/B?x=1#top", "com,example)/a/B?x=1"), ("http://m.example.co.uk", "uk,co,example,m)/"),
    ("http://u:p@a.b:8080/x", "b,a:8080)/x"), ("no address", "-)no address"), (None, "-)"), ("", "-)"),
    ("http://a.b?q", "b,a)/?q"),
])
def test_url_keys(url, key):
    assert warc.url_key(url) == key


def test_record_is_a_warc_record():
    data = gzip.decompress(warc.record(7, "http://a.b/c d\r\n", b"<p>\r\n\r\n</p>", hashlib.sha256(b"<p>\r\n\r\n</p>").hexdigest(), None, False))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n") and b"http://a.b/c%20d%0D%0A\r\n" in data
    assert warc.parsed(gzip.compress(data))["payload"] == b"<p>\r\n\r\n</p>"


def test_round_trip_with_copies_nulls_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    long, cut = "é" * 50, "x" * 99
    rows = [
        (5, "http://a.com/1", long), (3, "http://a.com/1", long), (4, "http://b.com", long), (4, "http://b.com", long),
        (None, None, long), (6, None, None), (7, "http://c.com", ""), (8, "x", cut), (9, "y", cut), (10, "http://a.com/1", "\r\n\r\nWARC/1.1"),
        (None, "http://n.com", "q" * 200), (None, "http://n.com", "q" * 200), (11, "http://z.com", "z" * 300_000),
    ]
    assert run(spark, rows) == brute(rows)


def test_index_finds_every_capture_of_a_common_url(spark):
    chance = random.Random(4)
    rows = [(i, chance.choice(["http://hot.com/", f"http://s{i % 37}.com/{i % 5}"]), str(i)) for i in range(3000)]
    captures = warc.write_archives(frame(spark, rows))
    index = warc.build_index(captures)
    for url in ("http://hot.com/", "http://s3.com/3", "http://none.com/", "http://s36.com/4"):
        found = warc.lookup(index, spark.createDataFrame([(warc.url_key(url),), (None,)], "skey string"))
        assert sorted(r["page_id"] for r in found.collect()) == [k for k, u, _ in rows if u == url]
    some = warc.fetch(index, warc.lookup(index, spark.createDataFrame([(warc.url_key("http://s3.com/3"),)], "skey string")), payloads=True)
    assert sorted(bytes(r["payload"]).decode() for r in some.collect()) == sorted(str(k) for k, u, _ in rows if u == "http://s3.com/3")


def test_records_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 2000)
    index = warc.build_index(warc.write_archives(frame(spark, [(i, f"http://a.com/{i}", str(i)) for i in range(200)])))
    found = warc.lookup(index, spark.createDataFrame([(warc.url_key(f"http://a.com/{i}"),) for i in range(200)], "skey string"))
    size = found.agg(F.sum("length")).first()[0]
    read = warc.fetch(index, found)
    assert read.count() == 200 and read.rdd.getNumPartitions() == -(-size // 2000) > 8


def test_empty_table(spark):
    assert run(spark, []) == []
    assert warc.archived(frame(spark, [(1, "u", "h")]).filter(F.lit(False))).count() == 0
