"""Token-sequence array functions (T1-T4, T6-T14, T17-T21, L2-L4, O13, byte U1).

All of them are columns over ``array<int>`` / ``array<array<int>>``, with no shuffle. Bytes become ids and ids bytes in
Arrow functions, a batch at a time; the rest are Spark's own functions, one row at a time.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from tokenloom.functions.text import text_lists
from tokenloom.functions.util import col_of, cuts, offsets_of, once
from tokenloom.layout import BYTE_EOT, STAGE1, STAGE2, TokenLayout


#: Bytes or ids that one Arrow array of a result stands for, whatever the batch it comes from.
IDS_AT_ONCE = 1 << 20


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def repeat(value, count) -> Column:
    """``array_repeat`` that treats negative counts as zero."""
    return F.array_repeat(_lit(value), F.greatest(_lit(count), F.lit(0)).cast("int"))


def pad_right(arr, width, value) -> Column:
    """T4: right-pad ``arr`` with ``value`` up to ``width`` (never cuts)."""
    a = col_of(arr)
    return F.concat(a, repeat(value, _lit(width) - F.size(a)))


def shift_ids(arr, offset, arrow: bool = False) -> Column:
    """Add ``offset`` to every id; a null/None offset leaves the ids as they are.

    ``arrow``: ids are ``array<int>`` and the offset is a number; an Arrow batch of them is shifted at once.
    """
    a = col_of(arr)
    if offset is None:
        return a
    if arrow:
        return _shifted(offset)(a)
    off = _lit(offset)
    return F.when(off.isNull(), a).otherwise(F.transform(a, lambda x: x + off))


@functools.cache
def _shifted(offset: int):
    @F.arrow_udf(ArrayType(IntegerType()))
    def shifted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            for i, j in cuts(offsets_of(b), IDS_AT_ONCE):
                part = b.slice(i, j - i)
                ends = offsets_of(part)
                ids = pa.compute.add_checked(part.values.slice(ends[0], ends[-1] - ends[0]), pa.scalar(offset, pa.int32()))
                yield pa.ListArray.from_arrays(pa.array(ends - ends[0]), ids, mask=part.is_null())

    return shifted


def utf8_bytes(text) -> Column:
    """UTF-8 byte values (0..255) of a string.

    The bytes of an Arrow batch lie behind each other, so they are widened at once, not one by one.
    """
    return _byte_values(F.encode(col_of(text), "UTF-8"))


@F.arrow_udf(ArrayType(IntegerType()))
def _byte_values(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for b in batches:
        b = b.cast(pa.binary())
        for i, j in cuts(offsets_of(b), IDS_AT_ONCE):
            part = b.slice(i, j - i)
            ends = offsets_of(part)
            raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
            yield pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(raw.astype(np.int32)), mask=part.is_null())


def _utf8(texts: pa.Array) -> pa.Array:
    """Bytes of strings; what isn't UTF-8 becomes U+FFFD, as in Spark's ``encode``."""
    raw = texts.cast(pa.binary())
    try:
        texts.validate(full=True)
        return raw
    except pa.ArrowInvalid:
        return pa.array([None if x is None else x.decode("utf-8", "replace").encode() for x in raw.to_pylist()], pa.binary())


@F.arrow_udf(ArrayType(IntegerType()))
def _bytes_and_end(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """UTF-8 byte values of strings with end-of-text behind each row."""
    for b in batches:
        b = _utf8(b)
        for i, j in cuts(offsets_of(b), IDS_AT_ONCE):
            yield _ended(b.slice(i, j - i))


def _ended(part: pa.Array) -> pa.ListArray:
    ends = offsets_of(part)
    to = ends - ends[0] + np.arange(len(ends), dtype=np.int32)
    is_byte = np.ones(to[-1], bool)
    is_byte[to[1:] - 1] = False
    ids = np.full(to[-1], BYTE_EOT, np.int32)
    ids[is_byte] = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return pa.ListArray.from_arrays(pa.array(to), pa.array(ids), mask=part.is_null())


@functools.cache
def _tokens_of_all(offset: int):
    @F.arrow_udf(ArrayType(ArrayType(IntegerType())))
    def tokens_of_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            for part, at, flat in text_lists(b, IDS_AT_ONCE):
                rows = _ended(_utf8(flat))
                ids = pa.compute.add_checked(rows.values, pa.scalar(offset, pa.int32()))
                rows = pa.ListArray.from_arrays(pa.array(offsets_of(rows)), ids, mask=rows.is_null())
                yield pa.ListArray.from_arrays(pa.array(at), rows, mask=part.is_null())

    return tokens_of_all


@F.arrow_udf(BinaryType())
def _as_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The ids 0..255 of every row as bytes; others are left out."""
    for b in batches:
        for i, j in cuts(offsets_of(b), IDS_AT_ONCE):
            part = b.slice(i, j - i)
            ends = offsets_of(part)
            ids = part.values.slice(ends[0], ends[-1] - ends[0]).fill_null(-1).to_numpy()
            kept = (ids >= 0) & (ids < BYTE_EOT)
            at = np.concatenate(([0], np.cumsum(kept)))[ends - ends[0]].astype(np.int32)
            raw = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(at), pa.py_buffer(ids[kept].astype(np.uint8))])
            yield pa.compute.if_else(part.is_valid(), raw, pa.scalar(None, pa.binary()))


def byte_tokens(text, layout: TokenLayout = STAGE1) -> Column:
    """U1 (byte vocabulary): UTF-8 bytes of ``text`` + end-of-text, shifted by the text offset.

    No Spark function stands between the steps, so one Python worker does them all, with those of ``normalize_text``.
    """
    return shift_ids(_bytes_and_end(col_of(text).cast("string")), layout.text_offset, arrow=True)


def byte_tokens_of_all(texts, layout: TokenLayout = STAGE1) -> Column:
    """:func:`byte_tokens` of every text of an array, in one Python step."""
    return _tokens_of_all(layout.text_offset)(col_of(texts).cast("array<string>"))


def token_count(text) -> Column:
    """Number of :func:`byte_tokens` of a text: its UTF-8 bytes and end-of-text."""
    return (F.octet_length(col_of(text)) + 1).cast("long")


def byte_decode(tokens, layout: TokenLayout = STAGE1) -> Column:
    """Inverse of :func:`byte_tokens`: drop the offset and end-of-text, decode UTF-8."""
    return F.decode(_as_bytes(shift_ids(tokens, -layout.text_offset)), "UTF-8")


def interleave(codes, n_bands: int = 2, codebook_size: int = STAGE1.codebook_size) -> Column:
    """First ``n_bands`` codebooks, band b shifted by b*codebook_size, frame-major."""
    c = col_of(codes)
    if n_bands == 2:
        return F.flatten(F.zip_with(c[0], c[1], lambda x, y: F.array(x, y + codebook_size)))
    frames = F.sequence(F.lit(0), F.size(c[0]) - 1)
    return F.flatten(F.transform(
        frames, lambda f: F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)),
                                      lambda b: F.element_at(c, b + 1)[f] + b * codebook_size)))


def n_frames(codes) -> Column:
    return F.size(col_of(codes)[0])


def stage1_input(text, codes, width, layout: TokenLayout = STAGE1, max_len: int | None = None,
                 interleaved=None) -> Column:
    """``text ++ interleaved`` right-padded with end-of-audio to ``width``.

    With ``max_len`` (L2) only the first ``max_len`` columns are built: every part is cut
    before concatenation, so work per row is bounded by ``max_len`` whatever the text length.
    ``interleaved`` may name a column already holding T1 of ``codes``.
    """
    t = col_of(text)
    inter = col_of(interleaved) if interleaved is not None else interleave(codes, 2, layout.codebook_size)
    pad = _lit(width) - F.size(t) - 2 * n_frames(codes)
    if max_len is None:
        return F.concat(t, inter, repeat(layout.eoa, pad))
    L = F.lit(max_len)
    return F.slice(F.concat(F.slice(t, 1, L), F.slice(inter, 1, L), repeat(layout.eoa, F.least(pad, L))), 1, L)


def stage1_target(text, codes, width, layout: TokenLayout = STAGE1, max_len: int | None = None,
                  interleaved=None) -> Column:
    """Next-token targets ``-1*(len(text)-1) ++ interleaved ++ [eoa] ++ -1...`` to ``width``."""
    t = col_of(text)
    inter = col_of(interleaved) if interleaved is not None else interleave(codes, 2, layout.codebook_size)
    ign = layout.loss_ignore
    lead = F.size(t) - 1
    pad = _lit(width) - F.size(t) - 2 * n_frames(codes)
    if max_len is None:
        return F.concat(repeat(ign, lead), inter, F.array(F.lit(layout.eoa)), repeat(ign, pad))
    L = F.lit(max_len)
    return F.slice(F.concat(repeat(ign, F.least(lead, L)), F.slice(inter, 1, L), F.array(F.lit(layout.eoa)),
                            repeat(ign, F.least(pad, L))), 1, L)


def pad_codes(codes, width, value: int = STAGE1.codebook_size) -> Column:
    """T4: right-pad every codebook row to ``width`` frames."""
    return F.transform(col_of(codes), lambda row: pad_right(row, width, value))


def crop_context(arr, block: int) -> Column:
    """L3: keep the last ``block`` elements."""
    a = col_of(arr)
    return F.when(F.size(a) <= block, a).otherwise(F.slice(a, -block, block))


def take_until(arr, marker: int) -> Column:
    """L4: elements up to and including the first ``marker``; all of them if absent."""
    a = col_of(arr)
    p = F.array_position(a, marker)
    return F.when(p > 0, F.slice(a, F.lit(1), p.cast("int"))).otherwise(a)


def generation_budget(prompt_len, max_new: int, block: int) -> Column:
    """L4: tokens that may still be generated, ``min(T+max_new, block) - T``; <=0 means error."""
    t = col_of(prompt_len)
    return F.least(t + max_new, F.lit(block)) - t


def budget_error(budget) -> Column:
    """L4: a prompt that leaves no room to generate is an error."""
    return F.when(col_of(budget) <= 0, F.lit("no room left to generate"))


def deinterleave(tokens, eoa: int = STAGE2.eoa) -> tuple[Column, Column]:
    """Split a flat sequence by value into (text, [band0, band1]).

    ``< eoa`` -> band 0; ``eoa..2*eoa-1`` -> band 1 (minus eoa); ``2*eoa`` dropped;
    ``> 2*eoa`` -> text. Bands are cut to the shorter one, the last text id is dropped.
    """
    t = col_of(tokens)
    b0 = F.filter(t, lambda v: v < eoa)
    b1 = F.transform(F.filter(t, lambda v: (v >= eoa) & (v < 2 * eoa)), lambda v: v - eoa)
    txt = F.filter(t, lambda v: v > 2 * eoa)
    return drop_last(txt), cut_to_shortest(F.array(b0, b1))


def cut_to_shortest(rows) -> Column:
    """Rows of an array of arrays, cut to the shortest; ``rows`` and the length are worked out once per row."""
    return once(col_of(rows), lambda rs: once(F.array_min(F.transform(rs, lambda r: F.size(r))),
                                              lambda m: F.transform(rs, lambda r: F.slice(r, F.lit(1), m))))


def drop_last(arr) -> Column:
    return once(col_of(arr), lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))))


def untilt(rows, eoa: int = STAGE2.eoa) -> tuple[Column, Column]:
    """(text, codes) from >=2 hierarchy rows; row 0 carries text (> eoa) and codes (< eoa)."""
    r = col_of(rows)
    txt = F.filter(r[0], lambda v: v > eoa)
    codes = F.transform(r, lambda row: F.filter(row, lambda v: v < eoa))
    return drop_last(txt), cut_to_shortest(codes)


def fill_codebooks(codes, n: int = 8) -> Column:
    """Append all-zero codebooks up to ``n`` rows."""
    c = col_of(codes)
    return F.concat(c, F.array_repeat(F.array_repeat(F.lit(0), F.size(c[0])), F.greatest(F.lit(n) - F.size(c), F.lit(0))))


def stage2_input(text, codes, ctx: int, pad: int = STAGE2.eoa) -> Column:
    """Two rows ``text ++ c0 ++ [pad]`` and ``pad*len(text) ++ c1 ++ [pad]``, padded/cut to ``ctx``."""
    t, c = col_of(text), col_of(codes)

    def fit(lead: Column, row: Column) -> Column:
        # parts are cut before they are put together, so work is bounded by ctx whatever the text's length
        rest = repeat(pad, F.least(F.lit(ctx), F.lit(ctx) - F.size(t) - F.size(row)))
        return F.slice(F.concat(lead, F.slice(row, 1, ctx), F.array(F.lit(pad)), rest), 1, ctx)

    return F.array(fit(F.slice(t, 1, ctx), c[0]), fit(repeat(pad, F.least(F.size(t), F.lit(ctx))), c[1]))


def prompt_rows(text, n_hier: int, other: int = STAGE2.eoa) -> Column:
    """T10 (one row): row 0 = text, other rows = ``other`` repeated len(text) times."""
    t = col_of(text)
    return F.concat(F.array(t), F.array_repeat(repeat(other, F.size(t)), n_hier - 1))


def pad_rows(rows, width, value: int = 0) -> Column:
    """T10 (batch): right-pad each row to ``width``."""
    return F.transform(col_of(rows), lambda r: pad_right(r, width, value))


def prefix_mask(length, width) -> Column:
    """``i < length`` for i in 0..width-1; two runs, and nulls for a null length."""
    w, n = col_of(width) if isinstance(width, str) else _lit(width), col_of(length)
    runs = F.concat(repeat(True, F.least(n, w)), repeat(False, w - F.greatest(n, F.lit(0))))
    return F.when(w.isNotNull(), F.when(n.isNotNull(), runs).otherwise(repeat(F.lit(None).cast("boolean"), w)))


def overlay(pred, orig, mask) -> Column:
    """Where the mask is true the original (prompt) wins, else the prediction; shorter rows count as followed by nulls."""
    return _overlaid(col_of(pred), col_of(orig), col_of(mask))


@F.arrow_udf(ArrayType(IntegerType()))
def _overlaid(pred: pa.Array, orig: pa.Array, mask: pa.Array) -> pa.Array:
    rows = [pred, orig, mask]
    lens = [np.diff(offsets_of(a).astype(np.int64)) for a in rows]
    if all((x == lens[0]).all() for x in lens):
        return _overlaid_rows(rows)
    # shorter rows are filled up by index, which takes several times their bytes
    ends = np.r_[0, np.cumsum(np.maximum.reduce(lens))]
    return pa.concat_arrays([_overlaid_rows([a.slice(i, j - i) for a in rows]) for i, j in cuts(ends, IDS_AT_ONCE)] or [pred.slice(0, 0)])


def _overlaid_rows(rows: list[pa.Array]) -> pa.Array:
    null = np.logical_or.reduce([a.is_null().to_numpy(zero_copy_only=False) for a in rows])
    starts = [offsets_of(a).astype(np.int64) for a in rows]
    lens = [np.diff(s) for s in starts]
    n = np.where(null, 0, np.maximum.reduce(lens))
    ends = np.r_[0, np.cumsum(n)]
    if all((x == n).all() for x in lens):
        p, o, m = (a.values.slice(s[0], ends[-1]) for a, s in zip(rows, starts))
    else:
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(ends[-1]) - ends[row]
        p, o, m = (a.values.take(pa.array(s[row] + at, mask=at >= x[row])) for a, s, x in zip(rows, starts, lens))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.compute.if_else(m.fill_null(False), o, p), mask=pa.array(null))


def stack_hierarchies(first, rest) -> Column:
    """Concatenate hierarchy rows (2 input rows ++ predicted rows)."""
    return F.concat(col_of(first), col_of(rest))


def null_pad_tokens(arr, pad: int = -1) -> Column:
    """Pad ids become null."""
    return F.transform(col_of(arr), lambda x: F.nullif(x, F.lit(pad)))


def gather(values, index) -> Column:
    """Per step pick ``values[index[t]]`` (0-based)."""
    v = col_of(values)
    return F.transform(col_of(index), lambda i: F.element_at(v, i + 1))


def mask_after_marker(tokens, marker: int) -> Column:
    """True from the first ``marker`` onwards (marker included).

    Built from two ``array_repeat`` runs, so the marker position is found once per row.
    """
    t = col_of(tokens)
    p = F.array_position(t, marker).cast("int")
    n = F.size(t)
    return F.when(p > 0, F.concat(F.array_repeat(F.lit(False), p - 1), F.array_repeat(F.lit(True), n - p + 1))
                  ).otherwise(F.array_repeat(F.lit(False), n))
