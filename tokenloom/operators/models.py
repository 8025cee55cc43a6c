"""Python-worker operators: trained BPE tokenisers and user models.

Both take Arrow batches in and out, the tokeniser or model built once per Python worker (cached by
a fingerprint), never per row.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tokenloom.functions.util import cuts, list_array, offsets_of
from tokenloom.layout import STAGE1

# Public GPT-2 pre-tokenisation pattern (tiktoken's r50k pattern).
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
EOT_STRING = "<|endoftext|>"
#: Bytes of text or ids that leave a worker at once, however many rows Spark puts into a batch.
AT_ONCE = 1 << 20
PART_BYTES = 16 << 20
SPECIAL_TOKEN_ERROR = "text contains a special token"

_CACHE: dict[str, object] = {}


def byte_level_ranks() -> dict[bytes, int]:
    """A vocabulary of the 256 single bytes (no merges)."""
    return {bytes([i]): i for i in range(256)}


def _encoding(spec: bytes):
    fp = hashlib.sha1(spec).hexdigest()
    enc = _CACHE.get(fp)
    if enc is None:
        import tiktoken

        name, pat, ranks, special = pickle.loads(spec)
        enc = tiktoken.Encoding(name=name, pat_str=pat, mergeable_ranks=ranks, special_tokens=special)
        _CACHE[fp] = enc
    return enc


def bpe_encode(df: DataFrame, text: str = "text", ranks: dict[bytes, int] | None = None,
               pat_str: str = GPT2_PATTERN, special_tokens: dict[str, int] | None = None,
               offset: int | None = STAGE1.text_offset, out: str = "tokens", name: str = "bpe") -> DataFrame:
    """BPE ids + end-of-text (+ offset) per row; text holding a special token string
    is an error row (null tokens, message in ``error``), as the encoder refuses it."""
    ranks = ranks or byte_level_ranks()
    special = special_tokens or {EOT_STRING: len(ranks)}
    spec = pickle.dumps((name, pat_str, ranks, special))
    bspec = df.sparkSession.sparkContext.broadcast(spec)
    eot = special[EOT_STRING]
    off = offset or 0
    at = df.columns.index(text)
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.IntegerType())),
                                              T.StructField("error", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(bspec.value)
        for b in batches:
            for i, j in cuts(offsets_of(b.column(at)), AT_ONCE):
                part, toks, errs = b.slice(i, j - i), [], []
                for s in part.column(at):
                    s = s.as_py()
                    if s is None:
                        toks.append(None)
                        errs.append("null text")
                        continue
                    try:
                        ids = np.asarray(enc.encode(s), dtype=np.int64)
                        toks.append(np.append(ids, eot).astype(np.int32) + off)
                        errs.append(None)
                    except ValueError:
                        toks.append(None)
                        errs.append(SPECIAL_TOKEN_ERROR)
                yield pa.RecordBatch.from_arrays([*part.columns, list_array(toks, pa.int32()), pa.array(errs, pa.string())],
                                                 names=schema.names)

    return df.mapInArrow(run, schema)


def bpe_decode(df: DataFrame, tokens: str = "tokens", ranks: dict[bytes, int] | None = None,
               pat_str: str = GPT2_PATTERN, special_tokens: dict[str, int] | None = None,
               offset: int | None = STAGE1.text_offset, out: str = "decoded", name: str = "bpe") -> DataFrame:
    """U1 inverse: subtract the offset and decode (special tokens decode to their string)."""
    ranks = ranks or byte_level_ranks()
    special = special_tokens or {EOT_STRING: len(ranks)}
    bspec = df.sparkSession.sparkContext.broadcast(pickle.dumps((name, pat_str, ranks, special)))
    off = offset or 0
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.StringType())])

    at = df.columns.index(tokens)

    def run(batches):
        enc = _encoding(bspec.value)
        for b in batches:
            for i, j in cuts(offsets_of(b.column(at)), AT_ONCE):
                part = b.slice(i, j - i)
                dec = [enc.decode((t.values.to_numpy(zero_copy_only=False).astype(np.int64) - off).tolist()) if t.is_valid else None
                       for t in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(dec, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def cached_model(key: str, spec: bytes):
    """The model of a pickled loader. A function of the module, so every task of a worker shares its cache."""
    if key not in _CACHE:
        _CACHE[key] = pickle.loads(spec)()
    return _CACHE[key]


def map_model(df: DataFrame, loader: Callable[[], object], fn: Callable[[object, pd.DataFrame], pd.Series],
              out: str, out_type: T.DataType, batch_rows: int | None = None, name: str = "model",
              keep: list[str] | None = None) -> DataFrame:
    """Run a user model over Arrow batches.

    ``loader()`` runs once per Python worker and model (cached under ``name`` and a hash of the
    pickled loader); ``fn(model, batch)``
    returns one value per row, called on at most ``batch_rows`` rows at a time. A failing
    batch is retried row by row so one bad row gives a null result with its reason in
    ``<out>_error`` instead of failing the job. ``keep`` names the columns that pass through, if not all do.
    """
    spec = cloudpickle.dumps(loader)
    key = f"{name}-{hashlib.sha1(spec).hexdigest()}"
    keep = df.columns if keep is None else keep
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, out_type), T.StructField(f"{out}_error", T.StringType())])
    at = [df.columns.index(c) for c in keep]

    def results(model, pdf):
        try:
            return list(fn(model, pdf)), [None] * len(pdf)
        except Exception:  # noqa: BLE001
            vals, errs = [], []
            for i in range(len(pdf)):
                try:
                    vals.append(list(fn(model, pdf.iloc[i:i + 1]))[0])
                    errs.append(None)
                except Exception as ex:  # noqa: BLE001
                    vals.append(None)
                    errs.append(f"{type(ex).__name__}: {ex}")
            return vals, errs

    def in_pandas(batches):
        model = cached_model(key, spec)
        for pdf in batches:
            step = batch_rows or max(len(pdf), 1)
            for i in range(0, len(pdf), step):
                part = pdf.iloc[i:i + step]
                vals, errs = results(model, part)
                yield part[keep].assign(**{out: vals, f"{out}_error": errs})

    def in_arrow(batches):
        # columns that pass through stay in Arrow; a model sees at most PART_BYTES of them at once
        model = cached_model(key, spec)
        for b in batches:
            step = min(batch_rows or b.num_rows, max(1, b.num_rows * PART_BYTES // max(b.nbytes, 1))) or 1
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                vals, errs = results(model, part.to_pandas())
                held = pd.Series(vals, dtype=object)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in at), pa.Array.from_pandas(held, mask=held.isnull(), type=kind),
                                                  pa.array(errs, pa.string())], names=schema.names)

    if _plain(df.schema) and _plain(schema):
        kind = to_arrow_type(out_type)
        return df.mapInArrow(in_arrow, schema)
    return df.mapInPandas(in_pandas, schema)


def _plain(kind: T.DataType, top: bool = True) -> bool:
    """Whether pandas gets the same values from Arrow as from Spark: numbers, text, and arrays of them."""
    if isinstance(kind, T.StructType):
        return top and all(_plain(f.dataType, False) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _plain(kind.elementType, False)
    return isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType, T.StringType, T.BooleanType))
