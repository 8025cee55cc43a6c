"""Split scans against whole-file readers, with splits cut at every byte."""

import csv
import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from tokenloom.sources import splitscan
from tokenloom.sources.archives import unpack_archives, write_archives
from tokenloom.sources.files import read_tsv_manifest, work_dir
from tokenloom.sources.splitscan import ends, first_record, index_archives, read_members, read_tsv_splits, split_states, splits_of


def _file(tmp_path, name, data):
    p = tmp_path / name
    p.write_bytes(data)
    return str(p)


TORN = ('a/1.flac\tplain\n"b/2.flac"\t"two\nlines ""and"" more\n"\n\n\nc/3.flac\tNA\nd/4.flac\t""\n"e\t5"\t"tab\there"\n'
        'f/6.flac\té "quoted" in the middle\n"g"\t""""\nh\n"i/.flacx"\t"\n\n"\nj\tlast').encode()


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40, 1000])
def test_torn_quotes_at_every_split_edge(spark, tmp_path, size):
    path = _file(tmp_path, "x.tsv", TORN)
    rows = [r for r in csv.reader(io.StringIO(TORN.decode(), newline=""), delimiter="\t") if r]
    na = splitscan.NA_TOKENS
    want = sorted(((r[0].replace(".flac", ""), None if len(r) < 2 or r[1] in na else r[1]) for r in rows), key=repr)
    got = sorted(map(tuple, read_tsv_splits(spark, path, size).collect()), key=repr)
    assert got == want
    assert splits_of(spark, path, size).count() == -(-len(TORN) // size)


def test_equals_the_whole_file_reader(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice('ab "\t\né') for _ in range(rng.randrange(12)))
    quoted = lambda s: '"' + s.replace('"', '""') + '"'
    data = "".join(f"k{i}.flac\t{quoted(word())}\n" + "\n" * (rng.random() < .1) for i in range(500)).encode()
    path = _file(tmp_path, "y.tsv", data)
    other = _file(tmp_path, "z.tsv", b"k.flac\tone more")
    whole = sorted(map(tuple, read_tsv_manifest(spark, [path, other]).collect()), key=repr)
    assert len(whole) == 501
    for size in (13, 500, 1 << 20):
        d = read_tsv_splits(spark, str(tmp_path), size)
        assert sorted(map(tuple, d.collect()), key=repr) == whole
    # several tasks take part
    assert d.rdd.getNumPartitions() >= 2


def test_states_compose(spark, tmp_path, monkeypatch):
    path = _file(tmp_path, "x.tsv", TORN)
    for r in split_states(splits_of(spark, path, 11)).collect():
        assert r["state"] == ends(TORN[:r["start"]], [0])[0]
    assert first_record(b"x\ny", 2) == (2, 0) and first_record(b'x\n"', 3) == (None, 4) and first_record(b"", 1) == (None, 1)


def test_members_by_range(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"a{i % 2}", f"{i:03d}.bin", rng.randbytes(rng.randrange(3000))) for i in range(120)] + [("a0", "none", None), ("a2", "x" * 150, b"long name")]
    df = spark.createDataFrame(rows, "archive string, member string, content binary")
    out = work_dir(spark, "tar-test")
    written = write_archives(df, out, "archive", "member", "content").collect()
    assert {r["archive"]: r["n_members"] for r in written} == {"a0": 61, "a1": 60, "a2": 1}
    paths = spark.createDataFrame([(r["path"],) for r in written], "path string")
    index = index_archives(paths).cache()
    got = read_members(index, portion=20_000)
    key = lambda d: sorted((r["archive"], r["member"], r["size"], bytes(r["content"]), r["error"]) for r in d.collect())
    assert key(got) == key(unpack_archives(spark, paths)) == sorted((a, m, len(c or b""), bytes(c or b""), None) for a, m, c in rows)
    # one archive is read by several tasks
    tasks = read_members(index.where("archive = 'a0'"), portion=20_000).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 1


def test_broken_archives(spark, tmp_path):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tf:
        for n in ("one", "two"):
            info = tarfile.TarInfo(n)
            info.size = 5000
            tf.addfile(info, io.BytesIO(b"z" * 5000))
    cut = _file(tmp_path, "cut.tar", buf.getvalue()[:8000])
    none = _file(tmp_path, "none.tar", b"no archive")
    index = index_archives(spark.createDataFrame([(cut,), (none,), (str(tmp_path / "gone.tar"),)], "path string"))
    rows = {(r["archive"], r["member"]): r["error"] for r in read_members(index).collect()}
    assert rows["cut", "one"] is None and "cut short" in rows["cut", None]
    assert rows["none", None] and rows["gone", None] and len(rows) == 4
