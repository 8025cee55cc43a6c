"""Bundles: round trip, random access, plain Zstandard readers, revisits and broken files."""

import hashlib
import random
import re
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from tokenloom.llm import warc
from tokenloom.llm.common import shared_path

SCHEMA = "page_id long, url string, html string, payload string, bundle int"


def pages():
    rng = random.Random(2)
    page = lambda n: "".join(rng.choice("<p>é\r\n\r\nWARC/1.1 ") for _ in range(n))
    same, small, long = page(1500), "x" * 999, page(3_000_000)
    rows = [(1, "http://a.org/x y\r\nz", page(50)), (2, None, None), (3, "", ""), (None, "http://n.org/", page(40)), (4, "http://l.org", long),
            (5, "u", small), (6, "u", small), (7, "u", same), (9, "u", same), (8, "u", same), (None, "u", same), (10, "u", "y" * 1000),
            (10, "u", "y" * 1000), (3, "again", ""), (11, "u", "é" * 500), (12, "u", "é" * 500), (13, "u", "é" * 499)]
    rows += [(20 + i, f"http://h.org/{i}", page(rng.randrange(3000))) for i in range(60)]
    return [(*r, "clash", 0) for r in rows]


def expected(rows):
    keep = {}
    for page, _, html, *_ in rows:
        if html and len(html.encode()) >= 1000:
            keep[html] = max(keep.get(html, -1), -1 if page is None else page)
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        to = keep.get(html)
        to = to if to is not None and to >= 0 and (page is None or page < to) else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(map(repr, out))


def test_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA)
    got = warc.archive_round_trip(spark, df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(repr, map(tuple, got))) == expected(rows)


def test_files_and_random_access(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    folder = shared_path(spark, "warc-test")
    index = warc.write_bundles(spark, df, folder, frame=4096, bundle=20000)
    files = sorted(Path(re.sub("^file:/*", "/", folder)).iterdir())
    assert len(files) > 2 and all(f.name.endswith(".warc.zst") for f in files)
    places = [r for r in index.collect()]
    assert len(places) == len(rows) and len({r["bundle"] for r in places}) == len(files)
    assert max(r["frame"] for r in places) > 2
    # a plain Zstandard reader sees whole WARC files
    n = 0
    for f in files:
        with f.open("rb") as raw:
            plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        n += sum(1 for _ in warc.records_of(plain))
        assert plain.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert n == len(rows)
    # some records by identifier, payloads byte for byte
    some = index.where(F.col("page_id").isin(1, 4, 9, 30))
    got = {r["page_id"]: bytes(r["payload"]) for r in warc.read_records(some).collect()}
    assert got == {r[0]: r[2].encode() for r in rows if r[0] in (1, 4, 9, 30)}
    # the index can be made from the files
    again = warc.rebuild_index(spark, index)
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, places), key=repr)


def test_header(spark):
    fields, payload, end = warc.decode_record(warc.encode_record(5, "http://a b\r\nX: 1", b"p", hashlib.sha1(b"p").hexdigest(), None, False))
    assert fields["WARC-Target-URI"] == "http://a%20b%0D%0AX:%201" and payload == b"p" and fields["Page-Id"] == "5"
    with pytest.raises(ValueError):
        warc.decode_record(warc.encode_record(5, None, b"pp", "00" * 20, None, False)[:-3])


def test_broken_files(spark, tmp_path):
    sha = hashlib.sha1(b"p").hexdigest()
    out = warc.BundleWriter(str(tmp_path))
    out.add("k", warc.encode_record(1, None, b"p", sha, None, False))
    (place,) = out.close()
    assert place[2] == 0 and place[3] > 0
    path = Path(place[1])
    frame = warc.BundleReader(str(path)).frame(0)
    assert warc.decode_record(frame, place[3])[1] == b"p"
    path.write_bytes(path.read_bytes()[:-4])
    with pytest.raises(ValueError):
        warc.BundleReader(str(path))
    fields, _, _ = warc.decode_record(frame, place[3])
    with pytest.raises(ValueError):
        warc._row(fields, b"q", False)


def test_empty_and_missing_target(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(spark, empty).collect() == []
    lone = spark.createDataFrame([("a", 1, "revisit", "gone", "00", None)],
                                 "record_id string, page_id long, record_type string, refers_to_id string, payload_digest string, payload_bytes long")
    with pytest.raises(Exception, match="no stored payload"):
        warc.resolve_revisits(lone).collect()
