"""WARC records in seekable Zstandard bundles.

Records are grouped into frames of about ``FRAME`` bytes; every frame is a Zstandard frame of its own, so any one can be
read without the others. A bundle ends in a seek table: a skippable frame with the compressed and plain size of every frame, as in the public
seekable format, which plain Zstandard readers skip. The index maps a record to (bundle, frame, offset in the plain frame, length); a
reader takes the frame's place in the file from the bundle's own seek table.

Of equal payloads one is stored, the others are revisit records that refer to it. Equality is by SHA-256 and
found in a join on digests; a digest in a third of all rows is one row of its narrow side, and adaptive execution splits the other. A
bundle gets a new name in every attempt of a task and is moved into place when complete; the index, written by Spark's committer, names
those of the attempts that counted.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm.common import shared_path, stage
from tokenloom.sources.fsio import resolve

#: Plain bytes of a frame and compressed bytes of a bundle at which the next one begins; a longer record has a frame of its own.
FRAME = 1 << 20
BUNDLE = 1 << 28
LEVEL = 3
#: Frames that a task reads.
RUN = 16
#: Payloads below this many bytes are always stored.
REVISIT_FROM = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# fixed values of the seekable format: magic numbers of the skippable frame and of the footer
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<II")


def record_id(page_id: int | None, sha1: str) -> str:
    """Name of a record: from its page and payload, so reruns agree."""
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}:{sha1}'.encode()).digest(), version=3)}"


def _head(fields: list) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n").encode()


def encode_record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record: a response with its payload, or a revisit of page ``refers_to`` with HTTP headers only.

    Control characters and spaces of the url are percent-encoded.
    """
    url = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    return _head([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{record_id(page_id, sha1)}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", url), ("Page-Id", page_id), ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", f"<{record_id(refers_to, sha1)}>" if revisit else None),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]) + block + b"\r\n\r\n"


def decode_record(data: bytes, at: int = 0) -> tuple:
    """``(fields, payload, end)`` of the record at ``at``; the payload of a revisit is None. Raises ValueError if it is broken."""
    end = data.find(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if end < 0 or lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    start = end + 4
    stop = start + int(fields["Content-Length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError(f"record at {at} is cut short")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = data[data.index(b"\r\n\r\n", start) + 4:stop]
    return fields, payload, stop + 4


class BundleWriter:
    """Appends records to bundles in ``folder``; ``add`` and ``close`` return the places of the records whose frame was written."""

    def __init__(self, folder: str, frame: int = FRAME, bundle: int = BUNDLE):
        self.folder, self.frame, self.bundle = folder, frame, bundle
        self.zip = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.out = None
        self.held, self.size, self.waiting = [], 0, []

    def _open(self) -> None:
        self.fs, path = resolve(self.folder)
        self.fs.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.path = f"{path}/{self.name}"
        self.out, self.table, self.written = self.fs.open_output_stream(self.path + ".part", compression=None), [], 0
        info = b"software: tokenloom\r\nformat: WARC File Format 1.1\r\n"
        self.held = [_head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                            ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"),
                            ("Content-Length", len(info))]) + info + b"\r\n\r\n"]
        self.size = len(self.held[0])

    def _flush(self) -> list:
        if not self.held:
            return []
        plain = b"".join(self.held)
        data = self.zip.compress(plain)
        self.out.write(data)
        done = [(key, f"{self.folder}/{self.name}", len(self.table), offset, length) for key, offset, length in self.waiting]
        self.table.append((len(data), len(plain)))
        self.written += len(data)
        self.held, self.size, self.waiting = [], 0, []
        return done

    def _finish(self) -> None:
        body = b"".join(_ENTRY.pack(*x) for x in self.table) + _FOOTER.pack(len(self.table), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)
        self.out = None

    def add(self, key, record: bytes) -> list:
        done = []
        if self.out is None:
            self._open()
        elif self.size and self.size + len(record) > self.frame:
            done = self._flush()
            if self.written >= self.bundle:
                self._finish()
                self._open()
        self.waiting.append((key, self.size, len(record)))
        self.held.append(record)
        self.size += len(record)
        return done

    def close(self) -> list:
        if self.out is None:
            return []
        done = self._flush()
        self._finish()
        return done


class BundleReader:
    """Frames of one bundle, found by its seek table."""

    def __init__(self, path: str):
        fs, p = resolve(path)
        self.file = fs.open_input_file(p)
        size = self.file.size()
        self.file.seek(size - _FOOTER.size)
        n, flags, magic = _FOOTER.unpack(self.file.read(_FOOTER.size))
        if magic != _SEEKABLE or flags:
            raise ValueError(f"{path} has no seek table")
        start = size - _FOOTER.size - n * _ENTRY.size
        self.file.seek(start)
        self.starts, at = [], 0
        self.sizes = list(_ENTRY.iter_unpack(self.file.read(n * _ENTRY.size)))
        for packed, _ in self.sizes:
            self.starts.append(at)
            at += packed
        if at != start - 8:
            raise ValueError(f"the seek table of {path} doesn't fit the file")

    def frame(self, i: int) -> bytes:
        self.file.seek(self.starts[i])
        return zstandard.ZstdDecompressor().decompress(self.file.read(self.sizes[i][0]), max_output_size=self.sizes[i][1])

    def close(self) -> None:
        self.file.close()


def records_of(frame: bytes) -> Iterator:
    """``(offset, length, fields, payload)`` of every record of a frame but warcinfo ones."""
    at = 0
    while at < len(frame):
        fields, payload, end = decode_record(frame, at)
        if fields["WARC-Type"] != "warcinfo":
            yield at, end - at, fields, payload
        at = end


def classify(pages: DataFrame, smallest: int = REVISIT_FROM) -> DataFrame:
    """``(page_id, url, payload, sha1, revisit, refers_to)`` from ``(page_id, url, html)``.

    Of equal payloads of ``smallest`` bytes or more the rows with the largest page_id are stored, the others refer to it; a null id is below
    all others, and where all ids are null all rows are stored. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    d = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    name = F.sha2("payload", 256)
    copies = (d.where(F.octet_length("payload") >= smallest).groupBy(name.alias("name"))
              .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    d = d.withColumn("name", name).join(copies, "name", "left")
    revisit = F.coalesce(F.col("refers_to").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))), F.lit(False))
    return d.select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), revisit.alias("revisit"),
                    F.when(revisit, F.col("refers_to")).alias("refers_to"))


_INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, offset long, length long"


def write_bundles(spark: SparkSession, pages: DataFrame, folder: str, frame: int = FRAME, bundle: int = BUNDLE) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` to bundles in ``folder``; returns the index, staged.

    Index columns ``record_id, page_id, record_type, bundle, frame, offset, length``. Rows that agree in page and payload have one
    record id and a record each. No rows give no bundles.
    """
    def run(batches):
        out = BundleWriter(folder, frame, bundle)
        kind = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("bundle", pa.string()),
                          ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])

        def rows(done):
            if done:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(kind.names, (*key, *place))) for key, *place in done], kind)

        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "payload", "sha1", "revisit", "refers_to")]
            for i in range(b.num_rows):
                page, url, payload, sha1, revisit, refers = (c[i].as_py() for c in cols)
                record = encode_record(page, url, payload, sha1, refers, revisit)
                yield from rows(out.add((record_id(page, sha1), page, "revisit" if revisit else "response"), record))
        yield from rows(out.close())

    return stage(spark, classify(pages).mapInArrow(run, _INDEX), "index")


_RECORD = ("record_id string, page_id long, record_type string, refers_to_id string, payload_digest string, payload_bytes long, "
           "payload binary")
_RECORD_ARROW = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to_id", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _row(fields: dict, payload: bytes | None, keep: bool) -> dict:
    """A record as it is in the archive; the digest of a stored payload is taken anew and has to agree."""
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if payload is not None and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest")
    page = fields.get("Page-Id")
    return {"record_id": fields["WARC-Record-ID"].strip("<>"), "page_id": None if page is None else int(page),
            "record_type": fields["WARC-Type"], "refers_to_id": fields["WARC-Refers-To"].strip("<>") if payload is None else None,
            "payload_digest": digest, "payload_bytes": None if payload is None else len(payload),
            "payload": payload if keep else None}


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that ``index`` names, read from their frames; a frame is read once.

    Columns ``record_id, page_id, record_type, refers_to_id, payload_digest, payload_bytes, payload``; a revisit has no payload and no size, see
    ``resolve_revisits``. Without ``payloads`` that column is null.
    """
    def run(batches):
        reader, path, held, size = None, None, [], 0
        for b in batches:
            for r in b.to_pylist():
                if r["bundle"] != path:
                    if reader:
                        reader.close()
                    reader, path = BundleReader(r["bundle"]), r["bundle"]
                plain = reader.frame(r["frame"])
                for x in r["places"]:
                    fields, payload, end = decode_record(plain, x["offset"])
                    if end - x["offset"] != x["length"]:
                        raise ValueError(f"{path}: record of another length at {x['offset']} of frame {r['frame']}")
                    held.append(_row(fields, payload, payloads))
                    size += len(payload or b"") * payloads + 200
                if size > FRAME:
                    yield pa.RecordBatch.from_pylist(held, _RECORD_ARROW)
                    held, size = [], 0
        if reader:
            reader.close()
        if held:
            yield pa.RecordBatch.from_pylist(held, _RECORD_ARROW)

    frames = index.groupBy("bundle", "frame").agg(F.collect_list(F.struct("offset", "length")).alias("places"))
    # a task reads about RUN frames; without a number, the small index rows would be put together
    n = -(-index.select("bundle", "frame").distinct().count() // RUN)
    return (frames.repartition(max(1, n), "bundle", F.floor(F.col("frame") / RUN)).sortWithinPartitions("bundle", "frame")
            .mapInArrow(run, _RECORD))


def rebuild_index(spark: SparkSession, bundles: DataFrame) -> DataFrame:
    """The index of ``bundles(bundle)`` from the files alone: frames are dealt out by the seek tables and read record by record."""
    def frames(batches):
        for b in batches:
            out = []
            for path in b.column("bundle").to_pylist():
                reader = BundleReader(path)
                out += [(path, i) for i in range(len(reader.sizes))]
                reader.close()
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int32())],
                                             names=["bundle", "frame"])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                reader = BundleReader(r["bundle"])
                out = [{**_row(f, p, False), "bundle": r["bundle"], "frame": r["frame"], "offset": at, "length": n}
                       for at, n, f, p in records_of(reader.frame(r["frame"]))]
                reader.close()
                names = [x.split()[0] for x in _INDEX.split(", ")]
                kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], k) for n, k in zip(names, kinds)], names=names)

    listed = bundles.select("bundle").distinct().mapInArrow(frames, "bundle string, frame int")
    listed = stage(spark, listed, "frames")
    return listed.repartition(max(1, -(-listed.count() // RUN)), "bundle", "frame").mapInArrow(run, _INDEX)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Size of the payload and page of the record that a revisit refers to; fails if that is missing or has another digest."""
    stored = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("size"), F.first("payload_digest").alias("digest"))
    again = records.where("record_type = 'revisit'").join(stored, "refers_to_id", "left")
    known = F.when(F.col("digest") == F.col("payload_digest"), F.col("size")).otherwise(
        F.raise_error(F.concat(F.lit("no stored payload for "), "record_id")).cast("long"))
    cols = ["record_id", "page_id", "record_type", "payload_digest"]
    return records.where("record_type = 'response'").select(*cols, "payload_bytes", F.lit(None).cast("long").alias("refers_to")).unionByName(
        again.select(*cols, known.alias("payload_bytes"), "refers_to"))


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` to bundles in the shared folder and read every record back: what the archives hold of each page."""
    index = write_bundles(spark, pages, shared_path(spark, "warc"))
    return resolve_revisits(stage(spark, read_records(index, payloads=False).drop("payload"), "records"))
