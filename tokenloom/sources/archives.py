"""Archives: write tar files and unpack members in parallel (S4); see ``splitscan`` for one archive in many tasks."""

from __future__ import annotations

import io
import tarfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tokenloom.sources.fsio import open_input, resolve

# Bytes of members that a worker gathers before it hands a batch on.
BATCH_BYTES = 16_000_000

MEMBER_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("error", T.StringType()),
])


def unpack_archives(spark: SparkSession, paths: DataFrame, path: str = "path", done: DataFrame | None = None,
                    ) -> DataFrame:
    """One row per regular member of each ``.tar`` listed in ``paths``.

    Archives are opened in streaming mode inside Python workers (no 2 GB single-row
    binary). ``done`` (column ``archive``) lists archives already unpacked; they are
    skipped with an anti join, as an existing directory is skipped.
    """
    todo = paths.select(path)
    if done is not None:
        from pyspark.sql import functions as F

        todo = todo.withColumn("archive", F.regexp_extract(path, r"([^/]+)\.tar$", 1)) \
            .join(done.select("archive"), "archive", "left_anti").select(path)

    names = [f.name for f in MEMBER_SCHEMA.fields]

    def run(batches):
        for pdf in batches:
            for p in pdf[path]:
                base = p.rstrip("/").rsplit("/", 1)[-1]
                name = base[:-4] if base.endswith(".tar") else base
                rows, held = [], 0
                try:
                    with open_input(p) as stream, tarfile.open(fileobj=stream, mode="r|*") as tf:
                        for m in tf:
                            if not m.isfile():
                                continue
                            data = tf.extractfile(m).read()
                            rows.append((name, m.name, len(data), data, None))
                            held += len(data)
                            if held >= BATCH_BYTES:
                                yield pd.DataFrame(rows, columns=names)
                                rows, held = [], 0
                except (OSError, EOFError, tarfile.TarError) as ex:  # unreadable from here on: a row says why
                    rows.append((name, None, None, None, f"{type(ex).__name__}: {ex}"))
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return todo.mapInPandas(run, MEMBER_SCHEMA)


def write_archives(df: DataFrame, out_dir: str, archive: str, member: str, content: str) -> DataFrame:
    """Write one ``<archive>.tar`` per value of ``archive``, members in name order; rows ``(archive, path, n_members)``.

    An archive is written by one task as its rows stream by, under a temporary name until it is complete; the task
    holds one batch of members, not the archive.
    """
    schema = "archive string, path string, n_members long"

    def write(batches):
        tar, name, n = None, None, 0

        def close() -> list:
            if tar is None:
                return []
            tar.close()
            out.close()
            fs.move(part, target)
            p = f"{out_dir.rstrip('/')}/{name}.tar"
            return [(name, p if "://" in p else "file:" + p, n)]

        for pdf in batches:
            done = []
            for a, m, c in zip(pdf[archive], pdf[member], pdf[content]):
                if tar is None or str(a) != name:
                    done += close()
                    name, n = str(a), 0
                    fs, target = resolve(f"{out_dir.rstrip('/')}/{name}.tar")
                    fs.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    part = f"{target}.{uuid.uuid4().hex}.part"
                    out = fs.open_output_stream(part)
                    tar = tarfile.open(fileobj=out, mode="w|")
                data = bytes(c) if c is not None else b""
                info = tarfile.TarInfo(name=str(m))
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1
            if done:
                yield pd.DataFrame(done, columns=["archive", "path", "n_members"])
        done = close()
        if done:
            yield pd.DataFrame(done, columns=["archive", "path", "n_members"])

    rows = df.select(archive, member, content).repartition(archive).sortWithinPartitions(archive, member)
    return rows.mapInPandas(write, schema)
