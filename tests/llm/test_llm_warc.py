"""Archives: round trips, the format, and lookups of keys that many records share."""

from __future__ import annotations

import gzip
import hashlib
import os

from acervo.llm import warc
from acervo.llm.common import local_path

HTML = "<p>é " * 400
PAGES = [
    (1, "http://www.Example.org/a?b#c", HTML), (2, "http://example.org/b", HTML), (9, "http://a.net", HTML),
    (3, None, None), (4, "x", ""), (5, "http://a.net", "short"), (6, "http://a.net", "short"),
    (7, "http://a.net/\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\n" * 100), (None, "http://a.net", HTML), (None, "u", "no id"),
    (8, "http://a.net", "short"), (8, "http://a.net", "short"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    got = warc.round_trip(table(spark, PAGES)).collect()
    expected = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        revisit = html == HTML and page != 9
        expected.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None))
    key = lambda r: tuple((x is None, x) for x in r)
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(found, key=key) == sorted(expected, key=key)
    for r in got:
        assert r["record_type"] == "revisit" or hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    assert warc.round_trip(table(spark, PAGES).limit(0)).collect() == []


def test_archives_are_gzip_members_that_can_be_read_alone(spark):
    folder = warc.new_folder(spark, "t")
    records = warc.write_archives(table(spark, PAGES).repartition(3), folder).collect()
    path = local_path(folder)[1]
    for name in {r["file"] for r in records}:
        data = open(os.path.join(path, name), "rb").read()
        members = sorted((r["offset"], r["length"]) for r in records if r["file"] == name)
        assert b"".join(gzip.decompress(data[o : o + n]) for o, n in members) == gzip.decompress(data)
        assert sum(n for _, n in members) == len(data)
        for o, n in members:
            text = gzip.decompress(data[o : o + n])
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")


def test_many_captures_of_one_address(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, "http://hot.org/", f"page {i}") for i in range(60)] + [(100 + i, f"http://h{i % 7}.org/{i}", "x") for i in range(40)]
    rows += [(200, "http://hot.org/", "again")] * 11
    folder = warc.new_folder(spark, "t")
    records = warc.write_archives(table(spark, rows).repartition(4), folder)
    top = warc.write_index(records, folder)
    got = warc.read_records(records, folder, top).collect()
    assert sorted((r["page"], bytes(r["payload"]).decode()) for r in got) == sorted((i, h) for i, _, h in rows)
    reader = warc.Reader(folder, top)
    assert len(list(reader.find("org,hot)/", 200))) == 11
    assert list(reader.find("org,none)/", 1)) == [] and list(reader.find("zzz", 1)) == []
