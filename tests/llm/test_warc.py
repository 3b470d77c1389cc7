from __future__ import annotations

import gzip
import hashlib
import json

import pytest
from pyarrow import fs

from matchday.llm import warc
from matchday.workspace import new_folder

PAGES = "page_id long, url string, html string, payload string, record_type string, first string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>été\r\n\r\nWARC/1.1\r\n</p>" * 20
    rows = [(5, "u", big), (3, "u\r\nx", big), (9, None, big), (9, None, big), (None, "n", big), (1, "a", None), (2, "b", ""), (4, "c", "short"), (6, "d", "short")]
    rows += [(None, "z", big + "z"), (None, "z", big + "z"), (20, "long", "x" * 3_000_000), (21, "é", "\x00\x01 odd \n" * 30)]
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], PAGES)


def brute(rows):
    first = {}
    for i, h in rows:
        if len(h) >= 100 and i is not None:
            first[h] = min(first.get(h, i), i)
    out = []
    for i, h in rows:
        to = first.get(h) if first.get(h) != i else None
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def test_round_trip(spark, pages):
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    found = warc.round_trip(pages).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=repr) == brute(rows)
    payloads = {h for _, h in rows}
    assert {bytes(r.payload) for r in found if r.record_type == "response"} == payloads
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_members_and_index(spark, pages):
    whole, normal = new_folder(spark, "t"), new_folder(spark, "t")
    warc.write_monolithic(warc.with_record_types(pages).coalesce(1), whole)
    files = warc.normalise(spark, whole, normal).collect()
    assert sum(r.records for r in files) == pages.count()
    store = fs.LocalFileSystem()
    for r in files:
        with store.open_input_file(r.file) as f:
            data = f.read()
        index = [json.loads(x) for x in open(r.file.removesuffix(".warc.gz") + ".idx")]
        assert len(index) == r.records and sum(x["length"] for x in index) == len(data)
        for x in index:
            # each member is a gzip file of its own with one whole record
            record = gzip.decompress(data[x["offset"] : x["offset"] + x["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and x["record_id"].encode() in record


def test_streams_of_one_or_more_members():
    record = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    for data in (gzip.compress(record * 3), gzip.compress(record) * 3, gzip.compress(record[:20]) + gzip.compress(record[20:] + record * 2)):
        assert [b for _, _, b in warc.records_of(data)] == [b"ab\r\nc"] * 3
    with pytest.raises(ValueError):
        list(warc.records_of(gzip.compress(record[:-4])))
    assert list(warc.records_of(gzip.compress(b""))) == []
