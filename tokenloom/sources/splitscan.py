"""Large files read by many tasks: delimited text with quoted newlines (S1) and archive members.

A quoted newline belongs to its record, so where a record starts is only known from the file's beginning. Every split is therefore
scanned once for quotes, tabs and newlines and summed up as a function from the state at its start to the state at its end; these
functions are composed along each file, and a second scan parses every split from its known state. A record belongs to the
split that it starts in and is read on past the split's end.

An archive is a chain of headers; one task per archive hops from header to header and writes down where each member lies. Members
are then read by byte range, in as many tasks as there are portions of ``PORTION`` bytes.
"""

from __future__ import annotations

import csv
import io
import re
import tarfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sources.archives import BATCH_BYTES
from tokenloom.sources.files import NA_TOKENS, stage
from tokenloom.sources.fsio import resolve

#: Bytes of a split of a delimited file, bytes read at once, and bytes of members that one task reads.
SPLIT = 64 << 20
BLOCK = 4 << 20
PORTION = 256 << 20
MOST_TASKS = 100_000
#: Bytes of small splits that one task scans.
TASK_BYTES = 16 << 20
LEAST_BLOCK = 1 << 16

# states of a scan: at the start of a record, at the start of another field, in a plain field, inside quotes, behind a quote inside quotes
_RECORD, _FIELD, _PLAIN, _QUOTED, _CLOSING = range(5)
_MARKS = re.compile(rb'["\t\r\n]|[^"\t\r\n]+')


def _step(state: int, mark: bytes) -> int:
    """State after one quote, tab, line end or run of other bytes."""
    if state == _QUOTED:
        return _CLOSING if mark == b'"' else _QUOTED
    if mark in (b"\n", b"\r"):
        return _RECORD
    if mark == b"\t":
        return _FIELD
    if mark == b'"':
        return _QUOTED if state in (_RECORD, _FIELD, _CLOSING) else _PLAIN
    return _PLAIN


_TABLE = [[_step(s, m) for s in range(5)] for m in (b'"', b"\t", b"\n", b"x")]
_KIND = {b'"': 0, b"\t": 1, b"\n": 2, b"\r": 2}


def ends(data: bytes, states: list) -> list:
    """End state for each start state; states that have met stay together."""
    for m in _MARKS.finditer(data):
        row = _TABLE[_KIND.get(m[0], 3)]
        states = [row[s] for s in states]
    return states


def first_record(data: bytes, state: int) -> tuple:
    """Offset at which the first record of ``data`` starts (None: none does), and the state at the end if there is none."""
    if state == _RECORD:
        return 0, state
    for m in _MARKS.finditer(data):
        state = _TABLE[_KIND.get(m[0], 3)][state]
        if state == _RECORD:
            return m.end(), state
    return None, state


class _Lines:
    """Text lines of a file from a byte offset on, and the offset behind the last line handed out."""

    def __init__(self, file, at: int, block: int = BLOCK):
        file.seek(at)
        self.file, self.at, self.rest, self.begin, self.block, self.over = file, at, b"", 0, block, False

    def __iter__(self):
        return self

    def __next__(self) -> str:
        block, seen = self.block, self.begin
        while True:
            end = self.rest.find(b"\n", seen)
            if end >= 0 or self.over:
                break
            more = self.file.read(block)
            self.over = not more
            self.rest, self.begin = self.rest[self.begin:] + more, 0
            seen, block = len(self.rest) - len(more), 2 * block  # of a long line no byte is searched twice
        stop = end + 1 if end >= 0 else len(self.rest)
        line, self.begin = self.rest[self.begin:stop], stop
        if not line:
            raise StopIteration
        self.at += len(line)
        return line.decode("utf-8", "replace")


def splits_of(spark: SparkSession, path: str, split_bytes: int = SPLIT) -> DataFrame:
    """``(path, split, start, stop)`` of the files at ``path``, by their sizes alone."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    n = F.ceil(F.col("length") / split_bytes).cast("int")
    return files.select("path", "length", F.explode(F.sequence(F.lit(0), n - 1)).alias("split")).select(
        "path", "split", (F.col("split").cast("long") * split_bytes).alias("start"),
        F.least((F.col("split").cast("long") + 1) * split_bytes, "length").alias("stop"))


def _spread(rows: DataFrame, *by: str) -> DataFrame:
    """About one row per task. Without a number, small rows that stand for much work would be put together."""
    return rows.repartition(max(1, min(rows.count(), MOST_TASKS)), *by)


def _spread_splits(splits: DataFrame) -> DataFrame:
    """Splits by the bytes they stand for: one of ``TASK_BYTES`` or more has a task of its own, smaller ones share tasks."""
    n, size = splits.agg(F.count(F.lit(1)), F.sum(F.col("stop") - F.col("start"))).first()
    least = int(splits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return splits.repartition(max(1, min(n, max(least, -(-(size or 0) // TASK_BYTES)), MOST_TASKS)), "path", "split")


def split_states(splits: DataFrame) -> DataFrame:
    """``splits`` with the scan state at the start of each, from one scan of the bytes."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, p = resolve(r["path"])
                states, left = list(range(5)), r["stop"] - r["start"]
                with fs.open_input_file(p) as file:
                    file.seek(r["start"])
                    # a run of plain bytes may be cut anywhere: it leads to the same state twice
                    while left:
                        data = file.read(min(left, BLOCK))
                        states = ends(data, states)
                        left -= len(data)
                yield pa.RecordBatch.from_pylist([{**r, "ends": states}], pa.schema([
                    ("path", pa.string()), ("split", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("ends", pa.list_(pa.int32()))]))

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, state, out = pdf.sort_values("split"), _RECORD, []
        for end in pdf["ends"]:
            out.append(state)
            state = int(end[state])
        return pdf.drop(columns="ends").assign(state=out)

    kind = "path string, split int, start long, stop long"
    # one row of five numbers per split meets the others of its file
    scanned = _spread_splits(splits).mapInArrow(run, f"{kind}, ends array<int>")
    return scanned.groupBy("path").applyInPandas(compose, f"{kind}, state int")


def read_tsv_splits(spark: SparkSession, path: str, split_bytes: int = SPLIT) -> DataFrame:
    """S1 for files of any size: headerless ``path<TAB>text`` -> ``(key, text)`` as ``read_tsv_manifest`` gives, in many tasks per file.

    Quotes count at the start of a field; ``""`` inside quotes is a quote; a quote elsewhere is a character. Line ends outside quotes
    are ``\\n`` or ``\\r\\n``. Blank lines are skipped, missing-value tokens become null. A task holds one record and ``BLOCK`` bytes.
    """
    def run(batches):
        csv.field_size_limit(1 << 31)
        for b in batches:
            for r in b.to_pylist():
                fs, p = resolve(r["path"])
                with fs.open_input_file(p) as file:
                    at, state = r["start"], r["state"]
                    while at < r["stop"]:
                        file.seek(at)
                        data = file.read(min(BLOCK, r["stop"] - at))
                        first, state = first_record(data, state)
                        if first is not None:
                            at += first
                            break
                        at += len(data)
                    if at >= r["stop"]:  # no record starts here
                        continue
                    lines = _Lines(file, at, min(BLOCK, max(LEAST_BLOCK, r["stop"] - at)))  # not far beyond the split
                    rows, held = [], 0
                    reader = csv.reader(lines, delimiter="\t", quotechar='"', doublequote=True)
                    while lines.at < r["stop"]:
                        row = next(reader, None)
                        if row is None:
                            break
                        if row:
                            rows.append((row[0], row[1] if len(row) > 1 else None))
                            held += sum(map(len, row))
                        if held > BATCH_BYTES:
                            yield _pairs(rows)
                            rows, held = [], 0
                    if rows:
                        yield _pairs(rows)

    raw = _spread_splits(stage(split_states(splits_of(spark, path, split_bytes)), "splits")).mapInArrow(run, "path string, text string")
    text = F.when(F.col("text").isNull() | F.col("text").isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(F.col("text"))
    return raw.select(F.replace(F.col("path"), F.lit(".flac"), F.lit("")).alias("key"), text.alias("text"))


def _pairs(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["path", "text"])


# ---------------------------------------------------------------- archives

_MEMBERS = "path string, archive string, member string, offset long, size long, error string"


def index_archives(paths: DataFrame, path: str = "path") -> DataFrame:
    """``(path, archive, member, offset, size, error)`` of every regular member; only headers are read.

    An archive that breaks off gives the members before that and a row with its ``error``.
    """
    kind = pa.schema([("path", pa.string()), ("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()),
                      ("size", pa.int64()), ("error", pa.string())])

    def run(batches):
        for b in batches:
            for where in b.column(0).to_pylist():
                base = where.rstrip("/").rsplit("/", 1)[-1]
                name, out = base.removesuffix(".tar"), []
                try:
                    fs, p = resolve(where)
                    with fs.open_input_file(p) as file, tarfile.open(fileobj=file, mode="r:") as tf:
                        size = file.size()
                        while (m := tf.next()) is not None:
                            tf.members = []  # nothing of a member is kept but its row
                            if not m.isfile():
                                continue
                            if m.offset_data + m.size > size:
                                raise tarfile.ReadError(f"{m.name} is cut short")
                            out.append((where, name, m.name, m.offset_data, m.size, None))
                            if len(out) >= 10_000:
                                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)
                                out = []
                except (OSError, EOFError, tarfile.TarError) as ex:
                    out.append((where, name, None, None, None, f"{type(ex).__name__}: {ex}"))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    listed = paths.select(F.col(path).alias("path"))
    return _spread(listed, "path").mapInArrow(run, _MEMBERS)


def read_members(index: DataFrame, portion: int = PORTION) -> DataFrame:
    """``(archive, member, size, content, error)`` of the members that ``index`` names, read by byte range.

    Members of an archive whose offsets are in one portion are read by one task, in order; rows with an error pass through.
    """
    kind = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("error", pa.string())])

    def run(batches):
        file, where, out, held = None, None, [], 0
        for b in batches:
            for r in b.to_pylist():
                data, error = None, r["error"]
                if error is None:
                    if r["path"] != where:
                        if file:
                            file.close()
                        fs, p = resolve(r["path"])
                        file, where = fs.open_input_file(p), r["path"]
                    file.seek(r["offset"])
                    data = file.read(r["size"])
                    if len(data) != r["size"]:
                        data, error = None, "member is cut short"
                out.append({"archive": r["archive"], "member": r["member"], "size": r["size"], "content": data, "error": error})
                held += len(data or b"")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, kind)
                    out, held = [], 0
        if file:
            file.close()
        if out:
            yield pa.RecordBatch.from_pylist(out, kind)

    part = F.floor(F.coalesce("offset", F.lit(0)) / portion)
    n = index.agg(F.sum("size")).first()[0] or 0
    return index.repartition(max(1, min(-(-n // portion), MOST_TASKS)), "path", part).sortWithinPartitions("path", "offset").mapInArrow(
        run, "archive string, member string, size long, content binary, error string")
