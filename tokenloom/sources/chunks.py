"""Recordings of any length as chunks: S5 and U3-U6 without a row that holds a whole waveform.

A recording is a table ``(key, n, chunk, samples)`` of ``chunk_size`` samples a row. WAV files are read by byte range, in many tasks per
file. Operators that look beyond a chunk's edges get the neighbours' samples by ``with_halo``: every row sends its ends to the chunks
beside it in one shuffle. Results equal those of the whole-row form, sample for sample.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.util import list_array
from tokenloom.operators.segments import PARTIAL_FRAMES, frame_step, padded_length, window_count
from tokenloom.sources.audio import BATCH_SAMPLES, MEL_BANDS, MEL_HOP, MEL_WINDOW, _mels, mel_filterbank, sinc_kernel
from tokenloom.sources.files import list_files, spread_files, stage
from tokenloom.sources.fsio import resolve

#: Samples of a chunk (30 s at 16 kHz): a multiple of the mel hop, the trim hop's and common rates' steps. No row holds more than
#: this, its halo and the padding of the last window.
CHUNK = 480_000
#: Bytes of samples that one task reads.
PORTION = 64 << 20
TRIM_FRAME, TRIM_HOP = 2048, 512
ROWS = 10_000

_CHUNKS = "path string, sample_rate int, n long, chunk long, samples array<float>, error string"


def _wav_layout(file) -> tuple:
    """Rate, channels, bytes a sample, offset and length of the data of a PCM WAV file; only headers are read."""
    head = file.read(12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, shape = 12, None
    while True:
        file.seek(at)
        head = file.read(8)
        if len(head) < 8:
            raise ValueError("no data chunk")
        name, size = struct.unpack("<4sI", head)
        if name == b"fmt ":
            code, channels, rate, _, _, bits = struct.unpack("<HHIIHH", file.read(16))
            if code not in (1, 0xFFFE) or bits not in (8, 16, 32):
                raise ValueError(f"unsupported format {code} with {bits} bits")
            shape = rate, channels, bits // 8
        elif name == b"data":
            if shape is None:
                raise ValueError("data before its format")
            return *shape, at + 8, min(size, file.size() - at - 8)
        at += 8 + size + size % 2


def _samples(raw: bytes, width: int) -> np.ndarray:
    if width == 1:
        return (np.frombuffer(raw, np.uint8).astype(np.float32) - 128.0) / 128.0
    kind, scale = ("<i2", 32768.0) if width == 2 else ("<i4", 2147483648.0)
    return np.frombuffer(raw, kind).astype(np.float32) / scale


def read_chunks(spark: SparkSession, path: str, chunk_size: int = CHUNK, channel_mode: str = "first", glob: str = "*.wav") -> DataFrame:
    """``(path, sample_rate, n, chunk, samples, error)`` of the mono signal (channel 0 or the ``mean``) of PCM WAV files.

    A file without samples is one empty chunk; one that can't be read is a row with its ``error``.
    """
    files = spread_files(list_files(spark, path, glob)).select("path")
    shape = pa.schema([("path", pa.string()), ("rate", pa.int32()), ("channels", pa.int32()), ("width", pa.int32()), ("at", pa.int64()),
                       ("n", pa.int64()), ("error", pa.string())])

    def heads(batches):
        for b in batches:
            out = []
            for p in b.column(0).to_pylist():
                try:
                    fs, inside = resolve(p)
                    with fs.open_input_file(inside) as f:
                        rate, channels, width, at, size = _wav_layout(f)
                    out.append((p, rate, channels, width, at, size // (channels * width), None))
                except Exception as ex:  # noqa: BLE001 -- an unreadable file is a row with its reason
                    out.append((p, None, None, None, None, None, f"{type(ex).__name__}: {ex}"))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), shape)] if out else [
                pa.array([], f.type) for f in shape], schema=shape)

    def read(batches):
        kind = pa.schema([("path", pa.string()), ("sample_rate", pa.int32()), ("n", pa.int64()), ("chunk", pa.int64()),
                          ("samples", pa.list_(pa.float32())), ("error", pa.string())])
        batch = lambda rows: pa.RecordBatch.from_arrays([
            list_array(c, pa.float32()) if f.name == "samples" else pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], schema=kind)
        out, held = [], 0
        for b in batches:
            for r in b.to_pylist():
                x = None
                if r["error"] is None:
                    fs, inside = resolve(r["path"])
                    frame = r["channels"] * r["width"]
                    with fs.open_input_file(inside) as f:
                        f.seek(r["at"] + r["chunk"] * chunk_size * frame)
                        raw = f.read(min(chunk_size, r["n"] - r["chunk"] * chunk_size) * frame)
                    x = _samples(raw, r["width"]).reshape(-1, r["channels"])
                    x = x[:, 0] if channel_mode == "first" else x.mean(axis=1, dtype=np.float32)
                out.append((r["path"], r["rate"], r["n"], r["chunk"] if x is not None else None, x, r["error"]))
                held += 0 if x is None else len(x)
                if held >= BATCH_SAMPLES or len(out) >= ROWS:
                    yield batch(out)
                    out, held = [], 0
        if out:
            yield batch(out)

    known = stage(files.mapInArrow(heads, "path string, rate int, channels int, width int, at long, n long, error string"), "wav-heads")
    last = F.greatest(F.ceil(F.coalesce("n", F.lit(0)) / chunk_size).cast("long") - 1, F.lit(0).cast("long"))
    rows = known.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = known.agg(F.sum(F.col("n") * F.col("channels") * F.col("width"))).first()[0] or 0
    # by number: the rows are small, what they stand for isn't
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PORTION)), "path", "chunk").mapInArrow(read, _CHUNKS)


def with_halo(chunks: DataFrame, left: int, right: int, chunk_size: int, key: str = "key", value: str = "samples", zero=None,
              times: str | None = None, open_end: bool = False) -> DataFrame:
    """``chunks`` with ``left`` values before and ``right`` after each ``value`` array; ``zero`` stands beyond a recording's ends.

    A value is taken from the next chunks only, so a halo must not be longer than a chunk. Equal rows become one; ``times`` names a
    column for their number. ``open_end``: an array ends with what there is, without zeros.
    """
    if max(left, right) > chunk_size:
        raise ValueError(f"a halo of {max(left, right)} is longer than a chunk of {chunk_size}")
    zero = F.lit(0.0).cast("float") if zero is None else zero
    rest = [c for c in chunks.columns if c not in (key, "chunk", value)]
    none = F.lit(None)
    kinds = {c: chunks.schema[c].dataType for c in rest}
    part = lambda side, to, v, own: F.struct(
        F.lit(side).alias("side"), to.alias("to"), v.alias("v"), *[(F.col(c) if own else none.cast(kinds[c])).alias(c) for c in rest])
    v, here = F.col(value), F.col("chunk")
    tail = F.when(F.size(v) > 0, F.slice(v, -F.least(F.lit(left), F.size(v)), left)) if left else F.slice(v, 1, 0)
    sent = F.array(part(0, here, v, True), part(-1, here + 1, tail, False), part(1, here - 1, F.slice(v, 1, right), False))
    of = lambda side, c: F.any_value(F.when(F.col("s.side") == side, F.col(f"s.{c}")), ignoreNulls=True)
    met = chunks.select(key, F.explode(sent).alias("s")).where("s.to >= 0").groupBy(key, F.col("s.to").alias("chunk")).agg(
        of(0, "v").alias("_own"), of(-1, "v").alias("_before"), of(1, "v").alias("_after"), *[of(0, c).alias(c) for c in rest],
        *([F.count_if(F.col("s.side") == 0).alias(times)] if times else []))
    empty = F.slice(F.col("_own"), 1, 0)
    before, after = F.coalesce("_before", empty), F.coalesce("_after", empty)
    whole = F.concat(F.array_repeat(zero, F.greatest(F.lit(left) - F.size(before), F.lit(0))), before, F.col("_own"), after,
                     *([] if open_end else [F.array_repeat(zero, F.greatest(F.lit(right) - F.size(after), F.lit(0)))]))
    return met.where("_own is not null").select(key, "chunk", whole.alias(value), *rest, *([times] if times else []))


def _per_chunk(df: DataFrame, run, out: str, kind: str) -> DataFrame:
    """``run(row) -> list of numpy arrays or values`` for the columns ``out`` of every row."""
    names = out.split()

    def batch(rows):
        cols = []
        for c in zip(*rows):
            kinds = [x.type for x in c if not pa.types.is_null(x.type)]
            cols.append(pa.concat_arrays([x.cast(kinds[0]) if pa.types.is_null(x.type) else x for x in c] if kinds else c))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def go(batches):
        rows, held = [], 0
        for b in batches:
            cols = {c: b.column(i) for i, c in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                row = {c: (x[i].values.to_numpy(zero_copy_only=False) if pa.types.is_list(x.type) and x[i].is_valid else x[i].as_py())
                       for c, x in cols.items()}
                rows.append(run(row))
                held += sum(c.nbytes for c in rows[-1])
                if held >= 4 * BATCH_SAMPLES or len(rows) >= ROWS:
                    yield batch(rows)
                    rows, held = [], 0
        if rows:
            yield batch(rows)

    return df.mapInArrow(go, kind)


def resample_chunks(chunks: DataFrame, source: int, target: int, chunk_size: int = CHUNK, key: str = "key") -> DataFrame:
    """U3 per chunk: ``(key, n, chunk, samples)`` at ``target``; chunks then hold ``chunk_size * target / source`` samples."""
    if source == target:
        return chunks.select(key, "n", "chunk", "samples")
    up, down, base, weights = sinc_kernel(source, target)
    if chunk_size % down:
        raise ValueError(f"a chunk has to be a multiple of {down} samples")
    left, right = max(0, -int(base.min())), int(base.max()) + weights.shape[1]
    kind = f"{key} {chunks.schema[key].dataType.simpleString()}, n long, chunk long, samples array<float>"

    def run(r):
        x, at = np.asarray(r["samples"], np.float64), r["chunk"] * chunk_size
        n_out = -(-r["n"] * target // source)
        first = r["chunk"] * (chunk_size // down) * up
        own = max(0, min(n_out - first, chunk_size // down * up))
        steps = -(-own // up)
        xp = np.zeros(max(len(x), left + right + steps * down + 1))
        xp[:len(x)] = x
        xp[left + max(0, r["n"] - at):] = 0.0
        y = np.zeros((steps, up))
        for p in range(up if steps else 0):
            for k, w in enumerate(weights[p]):
                i = left + int(base[p]) + k
                y[:, p] += w * xp[i:i + (steps - 1) * down + 1:down]
        return (pa.array([r[key]]), pa.array([n_out], pa.int64()), pa.array([r["chunk"]], pa.int64()),
                pa.array([y.ravel()[:own].astype(np.float32)], pa.list_(pa.float32())))

    return _per_chunk(with_halo(chunks.select(key, "n", "chunk", "samples"), left, right, chunk_size, key), run,
                      f"{key} n chunk samples", kind)


def _own_frames(r: dict, chunk_size: int, hop: int) -> int:
    """Centred frames whose middle lies in a chunk; the one behind the last sample belongs to the last chunk."""
    total, first = 1 + r["n"] // hop, r["chunk"] * chunk_size // hop
    last = r["chunk"] >= max(0, -(-r["n"] // chunk_size) - 1)
    return total - first if last else chunk_size // hop


def _frames(r: dict, chunk_size: int, frame: int, hop: int, more: int = 0) -> np.ndarray:
    """Those frames and up to ``more`` behind them, from samples with a halo of half a frame and the hops between the further ones."""
    own = min(_own_frames(r, chunk_size, hop) + more, 1 + r["n"] // hop - r["chunk"] * chunk_size // hop)
    x = np.zeros(max(len(r["samples"]), (own - 1) * hop + frame))
    x[:len(r["samples"])] = r["samples"]
    return np.lib.stride_tricks.sliding_window_view(x, frame)[::hop][:own]


def trim_chunks(chunks: DataFrame, chunk_size: int = CHUNK, top_db: float = 20.0, key: str = "key") -> DataFrame:
    """U4 over chunks: ``(key, n, trim_start, trim_end)``; the peak of a recording is a partial aggregate over its chunks.

    Frame powers are one number per 512 samples; the loud range follows from the peak in a second aggregate.
    """
    if chunk_size % TRIM_HOP:
        raise ValueError(f"a chunk has to be a multiple of {TRIM_HOP} samples")
    kind = f"{key} {chunks.schema[key].dataType.simpleString()}, n long, first long, power array<double>"

    def run(r):
        f = _frames(r, chunk_size, TRIM_FRAME, TRIM_HOP)
        power = np.maximum((f * f).mean(axis=1), 1e-10)
        return (pa.array([r[key]]), pa.array([r["n"]], pa.int64()), pa.array([r["chunk"] * chunk_size // TRIM_HOP], pa.int64()),
                pa.array([power], pa.list_(pa.float64())))

    half = TRIM_FRAME // 2
    power = stage(_per_chunk(with_halo(chunks.select(key, "n", "chunk", "samples"), half, half, chunk_size, key), run,
                             f"{key} n first power", kind), "power")
    peak = power.groupBy(F.col(key).alias("_key")).agg(F.max(F.array_max("power")).alias("peak"))
    frames = power.select(key, "n", "first", F.posexplode("power").alias("i", "p")).join(peak, F.col(key) == F.col("_key"))
    loud = frames.where(10 * F.log10(F.col("p") / F.col("peak")) > -top_db).groupBy(key, "n").agg(
        F.min(F.col("first") + F.col("i")).alias("low"), F.max(F.col("first") + F.col("i")).alias("high"))
    n = F.col("n")
    return loud.select(key, "n", F.when(n == 0, 0).otherwise(F.col("low") * TRIM_HOP).cast("long").alias("trim_start"),
                       F.when(n == 0, 0).otherwise(F.least(n, (F.col("high") + 1) * TRIM_HOP)).cast("long").alias("trim_end"))


def mel_chunks(chunks: DataFrame, chunk_size: int = CHUNK, key: str = "key", rate: int = 16000, more: int = 0, keep: tuple[str, ...] = (),
               times: str | None = None) -> DataFrame:
    """U5 per chunk: ``(key, n, chunk, first, mels)``, the frames from number ``first`` on that a chunk holds.

    ``more``: frames of the next chunk that are made here too; ``keep``: further columns; ``times``: see :func:`with_halo`.
    """
    if chunk_size % MEL_HOP:
        raise ValueError(f"a chunk has to be a multiple of {MEL_HOP} samples")
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(MEL_WINDOW) / MEL_WINDOW)
    bank = mel_filterbank(rate).T
    half = MEL_WINDOW // 2
    near = with_halo(chunks.select(key, "n", "chunk", "samples", *keep), half, half + max(0, more - 1) * MEL_HOP, chunk_size, key,
                     times=times, open_end=True)  # _frames puts zeros there
    rest = [*keep, *([times] if times else [])]
    kind = ", ".join([f"{key} {near.schema[key].dataType.simpleString()}, n long, chunk long, first long, mels array<array<float>>",
                      *(f"{c} {near.schema[c].dataType.simpleString()}" for c in rest)])

    def run(r):
        f = _frames(r, chunk_size, MEL_WINDOW, MEL_HOP, more)
        mels = _mels(f, window, bank)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(mels.ravel()), MEL_BANDS).cast(pa.list_(pa.float32()))
        return (pa.array([r[key]]), pa.array([r["n"]], pa.int64()), pa.array([r["chunk"]], pa.int64()),
                pa.array([r["chunk"] * chunk_size // MEL_HOP], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(mels)], pa.int32()), flat), *(pa.array([r[c]]) for c in rest))

    return _per_chunk(near, run, " ".join([key, "n chunk first mels", *rest]), kind)


def partial_chunks(chunks: DataFrame, chunk_size: int = CHUNK, key: str = "key", rate: float = 1.3, min_coverage: float = 0.75) -> DataFrame:
    """T21 + U5 + U6 per chunk: ``(key, win_idx, n_frames, padded_samples, mels)``, one slice of 160 frames per window.

    The last chunk is padded to the end of the last window; a window belongs to the chunk of its first frame, which also makes the frames
    of the next chunk that its windows reach. So samples move once, frames never.
    """
    step, frames = frame_step(rate), chunk_size // MEL_HOP
    if frames < PARTIAL_FRAMES:
        raise ValueError(f"a chunk has to hold {PARTIAL_FRAMES} frames")
    shaped = chunks.select(key, "chunk", "samples", F.col("n").alias("_n"), window_count(F.col("n"), rate, min_coverage).cast("long").alias("_windows"),
                           padded_length(F.col("n"), rate, min_coverage).cast("long").alias("_padded")).where(F.col(key).isNotNull())
    # zeros behind the last sample are chunks of their own where one is full; only a chunk before such a one is filled up, others end where they do
    last = F.greatest(F.ceil(F.col("_n") / chunk_size).cast("long") - 1, F.lit(0).cast("long"))
    end = F.greatest(F.ceil(F.col("_padded") / chunk_size).cast("long") - 1, last)
    to = F.when(F.col("chunk") == last, end).otherwise(F.col("chunk"))
    spread = shaped.select(key, "_windows", "_padded", "samples", F.col("chunk").alias("_of"), to.alias("_to")).select(
        "*", F.explode(F.sequence("_of", "_to")).alias("chunk"))
    first = F.col("chunk") == F.col("_of")
    own = F.when(first, F.col("samples")).otherwise(F.slice("samples", 1, 0))
    room = F.when(first & (F.col("chunk") < F.col("_to")), F.lit(chunk_size) - F.size("samples")).otherwise(F.lit(0))
    filled = spread.select(key, F.col("_padded").alias("n"), "chunk", "_windows", F.concat(
        own, F.array_repeat(F.lit(0.0).cast("float"), room)).alias("samples"))
    mels = mel_chunks(filled, chunk_size, key, more=PARTIAL_FRAMES - 1, keep=("_windows",), times="_times")
    low = F.ceil(F.col("first") / step).cast("long")
    high = F.least(F.col("_windows"), F.ceil((F.col("first") + frames) / step).cast("long")) - 1
    wins = F.flatten(F.array_repeat(F.sequence(low, high), F.col("_times").cast("int")))
    d = mels.where(low <= high).select(key, "n", "first", "mels", F.explode(wins).alias("win"))
    return d.select(key, F.col("win").cast("int").alias("win_idx"), (1 + F.floor(F.col("n") / MEL_HOP)).cast("int").alias("n_frames"),
                    F.col("n").alias("padded_samples"),
                    F.slice("mels", (F.col("win") * step - F.col("first") + 1).cast("int"), F.lit(PARTIAL_FRAMES)).alias("mels"))
