"""File access from Python workers through ``pyarrow.fs``: the same code writes to a
local/NFS folder or to an ``hdfs://`` / ``s3://`` shared folder named by the session."""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    """(filesystem, path inside it) for a local path, a ``file:`` URI or a remote URI."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def write_atomic(path: str, data: bytes) -> None:
    """Write ``data`` under a unique temporary name, then move it into place, so a retried
    or speculative task never exposes a partial file."""
    fs, p = resolve(path)
    parent = p.rsplit("/", 1)[0]
    if parent:
        fs.create_dir(parent, recursive=True)
    tmp = f"{p}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, p)


def open_input(path: str):
    fs, p = resolve(path)
    return fs.open_input_stream(p)
