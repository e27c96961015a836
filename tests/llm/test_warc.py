"""WARC archives and their index."""

import hashlib
from collections import Counter

import pytest

from allelic.llm import warc
from allelic.llm.common import fresh_folder
from tests.llm.conftest import SF001

PAGES = [(1, "http://Www.Example.com:80/a?b=1#top", "x" * 150), (2, "https://example.com/a", "x" * 150), (3, None, "x" * 150),
         (4, "http://example.com/a", "short"), (5, "http://example.com/a", "short"), (6, "not a url", None), (7, "http://[bad", ""),
         (None, "http://example.com/n", "x" * 150), (8, "http://ex.org/é \n?q=ü", "é" * 60), (9, "http://ex.org/é \n?q=ü", "é" * 60),
         (9, "http://ex.org/é \n?q=ü", "é" * 60), (10, "", "y" * 300_000), (None, "http://z.net", "z" * 200), (None, "http://z.net", "z" * 200)]


def plain(pages):
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        to = first.get(h or "") if len(data) >= 100 and first.get(h or "", i) != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return out


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, "f", 1, "d", 2) for p in PAGES],
                                 "page_id long, url string, html string, file string, offset int, digest string, surt int").repartition(3)


def test_round_trip(pages):
    got = warc.archive_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == Counter(plain(PAGES))


def test_empty_table(pages):
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_small_blocks_and_files(spark, pages, monkeypatch):
    """Many blocks and archive files; the payloads come back whole."""
    monkeypatch.setattr(warc, "BLOCK", 2)
    monkeypatch.setattr(warc, "FILE_BYTES", 500)
    folder = fresh_folder(spark, "warc")
    captures = warc.write_archives(pages, folder)
    index = warc.write_index(captures, folder)
    found = warc.look_up(index, captures)
    assert found.count() == len(PAGES)
    got = warc.read_records(found).collect()
    texts = {(i, h or "") for i, _, h in PAGES}
    assert all((r["page_id"], bytes(r["payload"]).decode()) in texts for r in got if r["record_type"] == "response")
    assert Counter(r["url"] for r in got) == Counter(u for _, u, _ in PAGES)


def test_look_up_finds_only_what_is_there(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    folder = fresh_folder(spark, "warc")
    index = warc.write_index(warc.write_archives(pages, folder), folder)
    wanted = [("com,example)/nowhere", 1), ("", None), ("zzz", 5)]
    one = pages.first()
    wanted.append((warc.surt_key(one["url"]), one["page_id"]))
    got = warc.look_up(index, spark.createDataFrame(wanted, "surt string, page_id long")).collect()
    assert [(r["surt"], r["page_id"]) for r in got] == [wanted[-1]]


@pytest.mark.parametrize(("url", "key"), [
    ("http://www.Example.com/a/b?c=d#e", "com,example,www)/a/b?c=d"), ("https://example.com:443", "com,example)/"),
    ("http://u:p@example.com:8080/x", "com,example:8080)/x"), (None, ""), ("http://[bad", "http://[bad"), ("path only", ")path%20only")])
def test_keys(url, key):
    assert warc.surt_key(url) == key


def test_table(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    got = warc.archive_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(map(tuple, got)) == Counter(plain(rows))
