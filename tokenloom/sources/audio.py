"""Audio files and per-utterance signal work in Python workers (S5, WAV sink, U3-U6).

Decoding and DSP are per-row numpy inside ``mapInArrow``; Spark distributes the files
and rows. Samples stay in Arrow buffers: no sample becomes a Python object. Only PCM WAV is decoded (stdlib ``wave``); other codecs are out of scope.
"""

from __future__ import annotations

import functools
import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.util import cuts, list_array, offsets_of
from tokenloom.operators.segments import PARTIAL_FRAMES, frame_step, padded_length, window_count
from tokenloom.sources.files import list_files, spread_files
from tokenloom.sources.fsio import resolve, write_atomic

# Fixed values of the speaker-encoder front end: 40 mel bands, 25 ms window, 10 ms hop.
MEL_BANDS = 40
MEL_WINDOW = 400
MEL_HOP = 160

# Samples that a worker gathers before it hands a batch on, and frames it transforms at once.
BATCH_SAMPLES = 1_000_000
FRAMES_AT_ONCE = 4096
ROWS = 10_000

AUDIO_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("sample_rate", T.IntegerType()),
    T.StructField("channels", T.IntegerType()),
    T.StructField("n_samples", T.LongType()),
    T.StructField("pcm", T.ArrayType(T.ArrayType(T.FloatType()))),
    T.StructField("error", T.StringType()),
])


def _decode_wav(content: bytes) -> tuple[int, int, np.ndarray]:
    with wave.open(io.BytesIO(content), "rb") as w:
        rate, ch, width, n = w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()
        raw = w.readframes(n)
    if width == 2:
        x = np.frombuffer(raw, dtype="<i2").astype(np.float32) / 32768.0
    elif width == 1:
        x = (np.frombuffer(raw, dtype=np.uint8).astype(np.float32) - 128.0) / 128.0
    elif width == 3:  # 24-bit: place the three bytes above an empty low byte
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw[:len(raw) // 3 * 3], np.uint8).reshape(-1, 3)
        x = wide.view("<i4").ravel().astype(np.float32) / 2147483648.0
    elif width == 4:
        x = np.frombuffer(raw, dtype="<i4").astype(np.float32) / 2147483648.0
    else:
        raise ValueError(f"unsupported sample width {width}")
    frames = len(x) // ch
    return rate, ch, x[: frames * ch].reshape(frames, ch).T


def read_audio(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """WAV files under ``path`` -> ``(path, sample_rate, channels, n_samples, pcm[ch][t], error)``.

    A file that cannot be decoded becomes a row with ``error`` set instead of failing the job.
    Rows leave the worker in batches of about ``BATCH_SAMPLES`` samples.
    """
    def batch(rows: list) -> pa.RecordBatch:
        paths, rates, channels, n, pcm, errors = zip(*rows)
        return pa.RecordBatch.from_arrays([
            pa.array(paths, pa.string()), pa.array(rates, pa.int32()), pa.array(channels, pa.int32()), pa.array(n, pa.int64()),
            _nested(pcm), pa.array(errors, pa.string())], names=AUDIO_SCHEMA.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for b in batches:
            for p in b.column(0).to_pylist():
                try:
                    fs, inside = resolve(p)
                    with fs.open_input_file(inside) as f:
                        rate, ch, x = _decode_wav(f.read())
                    out.append((p, rate, ch, x.shape[1], list(x), None))
                    held += x.size
                except Exception as ex:  # noqa: BLE001 -- an undecodable file is a row with its reason
                    out.append((p, None, None, None, None, f"{type(ex).__name__}: {ex}"))
                if held >= BATCH_SAMPLES or len(out) >= ROWS:
                    yield batch(out)
                    out, held = [], 0
        if out:
            yield batch(out)

    return spread_files(list_files(spark, path, glob)).mapInArrow(run, AUDIO_SCHEMA)


def _nested(rows: list) -> pa.ListArray:
    """``list<list<float>>`` of lists of numpy arrays or of 2-d arrays (None: null)."""
    inner = list_array([x for r in rows if r is not None for x in r], pa.float32())
    ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), inner, mask=pa.array([r is None for r in rows], pa.bool_()))


def _grid(rows: list) -> pa.ListArray:
    """``list<list<float>>`` of 2-d arrays of one width."""
    flat, width = np.concatenate(rows), rows[0].shape[1]
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, width, dtype=np.int32)), pa.array(flat.ravel(), pa.float32()))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)], dtype=np.int32)), inner)


def _floats(a: pa.ListArray) -> list:
    """Rows of a list array as numpy arrays over its buffer (null: None)."""
    ends, flat = offsets_of(a), a.values.to_numpy(zero_copy_only=False).astype(np.float32, copy=False)
    return [flat[ends[i]:ends[i + 1]] if ok else None for i, ok in enumerate(a.is_valid().to_pylist())]


def _by_samples(batches, at: int):
    """Parts of at most ``BATCH_SAMPLES`` values of column ``at`` (or one row), whatever the batches hold."""
    for b in batches:
        for i, j in cuts(offsets_of(b.column(at)), BATCH_SAMPLES):
            yield b.slice(i, j - i)


def write_wavs(df: DataFrame, out_dir: str, key: str = "key", pcm: str = "pcm", rate: str = "sample_rate") -> DataFrame:
    """Sink: one 16-bit mono WAV per row at ``out_dir/<key>.wav``; returns ``(key, path)``.

    Runs as a distributed ``mapInArrow`` (each task writes its own rows) and is forced
    by the caller's action. ``out_dir`` may be a local/NFS path or a remote URI
    (``pyarrow.fs``); files are moved into place only when complete.
    """
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("path", T.StringType())])

    def run(batches):
        for b in _by_samples(batches, 1):
            paths = []
            for k, x, r in zip(b.column(0).to_pylist(), _floats(b.column(1)), b.column(2).to_pylist()):
                p = f"{out_dir.rstrip('/')}/{k}.wav"
                a = np.clip(np.asarray(x if x is not None else [], dtype=np.float64), -1.0, 1.0)
                buf = io.BytesIO()
                with wave.open(buf, "wb") as w:
                    w.setnchannels(1)
                    w.setsampwidth(2)
                    w.setframerate(int(r))
                    w.writeframes((np.round(a * 32767.0)).astype("<i2").tobytes())
                write_atomic(p, buf.getvalue())  # unique temp name, then move into place
                paths.append(p if "://" in p else "file:" + p)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(paths, pa.string())], names=schema.names)

    return df.select(F.col(key).cast("string"), F.col(pcm).cast("array<double>"), rate).mapInArrow(run, schema)


# ---------------------------------------------------------------- signal functions (numpy)

def sinc_kernel(src: int, dst: int, crossings: int = 6) -> tuple[int, int, np.ndarray, np.ndarray]:
    """``(up, down, first input offset, weights)`` of every output phase.

    Output sample ``j * up + p`` lies at input time ``j * down + p * down / up``. Its weights are a sinc low-pass at the lower
    of both Nyquist rates under a Hann window of ``crossings`` zero crossings a side, scaled to sum to one.
    """
    g = int(np.gcd(src, dst))
    up, down = dst // g, src // g
    cutoff = min(1.0, up / down)
    reach = int(np.ceil(crossings / cutoff))
    time = np.arange(up) * down / up
    base = np.floor(time).astype(np.int64) - reach + 1
    t = base[:, None] + np.arange(2 * reach)[None, :] - time[:, None]
    shape = np.where(np.abs(t) < reach, np.cos(np.pi * t / (2 * reach)) ** 2, 0.0)
    weights = np.sinc(cutoff * t) * shape
    return up, down, base, weights / weights.sum(axis=1, keepdims=True)


def resample(x: np.ndarray, src: int, dst: int) -> np.ndarray:
    """Windowed-sinc resampling to ``ceil(n * dst / src)`` samples, zeros beyond the ends; identity if equal."""
    if src == dst or len(x) == 0:
        return x.astype(np.float32)
    up, down, base, weights = sinc_kernel(src, dst)
    n_out = -(-len(x) * dst // src)
    steps = -(-n_out // up)
    lead = -int(base.min())
    xp = np.zeros(lead + (steps - 1) * down + int(base.max()) + weights.shape[1] + 1)
    xp[lead:lead + len(x)] = x[:len(xp) - lead]
    y = np.zeros((steps, up))
    for p in range(up):
        for k, w in enumerate(weights[p]):
            at = lead + int(base[p]) + k
            y[:, p] += w * xp[at:at + (steps - 1) * down + 1:down]
    return y.ravel()[:n_out].astype(np.float32)


def _frame_chunks(x: np.ndarray, frame: int, hop: int) -> Iterator[np.ndarray]:
    """Centred frames of a waveform, zeros beyond its ends, at most ``FRAMES_AT_ONCE`` at a time."""
    xp = np.pad(x.astype(np.float64), (frame // 2, frame // 2))
    view = np.lib.stride_tricks.sliding_window_view(xp, frame)[::hop]
    for i in range(0, len(view), FRAMES_AT_ONCE):
        yield view[i:i + FRAMES_AT_ONCE]


def trim_silence(x: np.ndarray, top_db: float = 20.0, frame: int = 2048, hop: int = 512) -> tuple[int, int]:
    """U4: ``[start, end)`` after dropping leading/trailing frames ``top_db`` below the peak RMS.

    Powers are compared above a floor of 1e-10, so a clip that is silent throughout is all as loud
    as its peak and stays whole.
    """
    if len(x) == 0:
        return 0, 0
    power = np.concatenate([(f * f).mean(axis=1) for f in _frame_chunks(x, frame, hop)])
    power = np.maximum(power, 1e-10)
    loud = np.flatnonzero(10.0 * np.log10(power / power.max()) > -top_db)
    return int(loud[0] * hop), int(min(len(x), (loud[-1] + 1) * hop))


# Fixed values of the mel scale: linear below 1 kHz at 3 mels per 200 Hz, 27 mels per factor 6.4 above.
MEL_PER_HZ = 3 / 200
MEL_BREAK_HZ = 1000.0
MEL_PER_LOG = 27 / np.log(6.4)


def _band_edges(sr: int, n_mels: int) -> np.ndarray:
    """``n_mels + 2`` frequencies, equally spaced in mels from 0 to half the rate."""
    knee = MEL_PER_HZ * MEL_BREAK_HZ
    top = sr / 2 * MEL_PER_HZ if sr / 2 < MEL_BREAK_HZ else knee + MEL_PER_LOG * np.log(sr / 2 / MEL_BREAK_HZ)
    mels = np.linspace(0.0, top, n_mels + 2)
    return np.where(mels < knee, mels / MEL_PER_HZ, MEL_BREAK_HZ * np.exp(np.maximum(mels - knee, 0) / MEL_PER_LOG))


@functools.cache
def mel_filterbank(sr: int = 16000, n_fft: int = MEL_WINDOW, n_mels: int = MEL_BANDS) -> np.ndarray:
    """Triangles over neighbouring band edges with unit area in Hz, ``[n_mels, n_fft//2+1]``.

    Each band rises from its left edge to its centre and falls to its right edge: the piecewise linear
    function through (left, 0), (centre, 2 / width), (right, 0).
    """
    edges = _band_edges(sr, n_mels)
    bins = np.arange(n_fft // 2 + 1) * sr / n_fft
    return np.stack([np.interp(bins, edges[i:i + 3], [0.0, 2.0 / (edges[i + 2] - edges[i]), 0.0], left=0.0, right=0.0)
                     for i in range(n_mels)])


def mel_frames(x: np.ndarray, sr: int = 16000) -> np.ndarray:
    """Mel power spectrogram (not log), frame-major ``[1 + n // hop, n_mels]`` float32."""
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(MEL_WINDOW) / MEL_WINDOW)
    bank = mel_filterbank(sr).T
    return np.concatenate([_mels(f, window, bank) for f in _frame_chunks(x, MEL_WINDOW, MEL_HOP)])


def _mels(frames: np.ndarray, window: np.ndarray, bank: np.ndarray) -> np.ndarray:
    """Band powers of frames; those behind the last sample that isn't zero (padding) have none and aren't transformed."""
    out = np.zeros((len(frames), bank.shape[1]), np.float32)
    sound = np.flatnonzero(frames.any(axis=1))
    n = int(sound[-1]) + 1 if len(sound) else 0
    out[:n] = np.abs(np.fft.rfft(frames[:n] * window, axis=1)) ** 2 @ bank if n else 0
    return out


# ---------------------------------------------------------------- DataFrame operators

def resample_audio(df: DataFrame, target_rate: int, channel_mode: str = "first", pcm: str = "pcm",
                   rate: str = "sample_rate", out: str = "wave", keep: list[str] | None = None) -> DataFrame:
    """One mono waveform per row at ``target_rate``: channel 0 (``first``, codes path) or
    the channel mean (``mean``, embedding path); resampled only when the rate differs.
    The other columns pass through; ``keep`` names those that are wanted, if not all are."""
    keep = df.columns if keep is None else keep
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(out, T.ArrayType(T.FloatType()))])
    at = [df.columns.index(c) for c in keep]
    sound, speed = df.columns.index(pcm), df.columns.index(rate)

    def run(batches):
        for b in batches:
            ends = offsets_of(b.column(sound))
            samples = offsets_of(b.column(sound).values)[ends] if len(b.column(sound).values) else ends
            for i, j in cuts(samples, BATCH_SAMPLES):
                part, res = b.slice(i, j - i), []
                channels = part.column(sound)
                for k, r in enumerate(part.column(speed).to_pylist()):
                    if r is None or not channels[k].is_valid:
                        res.append(None)
                        continue
                    arr = np.stack(_floats(channels[k].values))
                    mono = arr[0] if channel_mode == "first" else arr.mean(axis=0)
                    res.append(resample(mono, int(r), target_rate))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in at), list_array(res, pa.float32())], names=schema.names)

    return df.mapInArrow(run, schema)


def trim_audio(df: DataFrame, wave_col: str = "wave", top_db: float = 20.0) -> DataFrame:
    """U4: trimmed waveform plus the kept ``[trim_start, trim_end)`` sample range."""
    schema = T.StructType([f for f in df.schema.fields if f.name != wave_col] + [
        T.StructField(wave_col, T.ArrayType(T.FloatType())), T.StructField("trim_start", T.LongType()),
        T.StructField("trim_end", T.LongType())])

    at = df.columns.index(wave_col)

    def run(batches):
        for b in _by_samples(batches, at):
            waves, s0, s1 = [], [], []
            for x in _floats(b.column(at)):
                a = x if x is not None else np.zeros(0, np.float32)
                lo, hi = trim_silence(a, top_db)
                waves.append(a[lo:hi])
                s0.append(lo)
                s1.append(hi)
            rest = [c for i, c in enumerate(b.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, list_array(waves, pa.float32()), pa.array(s0, pa.int64()), pa.array(s1, pa.int64())],
                                             names=schema.names)

    return df.mapInArrow(run, schema)


def partial_mels(df: DataFrame, wave_col: str = "wave", key: str = "key", rate: float = 1.3,
                 min_coverage: float = 0.75) -> DataFrame:
    """T21 + U5 + U6: pad the waveform to the last window stop, compute mel frames once,
    emit one ``160 x 40`` slice per O12 window as ``(key, win_idx, n_frames, padded_samples, mels)``.

    The number of windows and the padded length are columns (see ``operators.segments``).
    """
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("win_idx", T.IntegerType()),
                           T.StructField("n_frames", T.IntegerType()), T.StructField("padded_samples", T.LongType()),
                           T.StructField("mels", T.ArrayType(T.ArrayType(T.FloatType())))])
    n = F.greatest(F.size(wave_col), F.lit(0)).cast("long")
    shaped = df.select(F.col(key).cast("string"), wave_col, window_count(n, rate, min_coverage).alias("_tl_windows"),
                       padded_length(n, rate, min_coverage).alias("_tl_padded"))
    step = frame_step(rate)

    def batch(rows: list) -> pa.RecordBatch:
        k, i, n, padded, mels = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(i, pa.int32()), pa.array(n, pa.int32()),
                                           pa.array(padded, pa.int64()), _grid(mels)], names=schema.names)

    def run(batches):
        rows = []
        for b in batches:
            for k, x, windows, padded in zip(b.column(0).to_pylist(), _floats(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                a = x if x is not None else np.zeros(0, np.float32)
                mel = mel_frames(np.pad(a, (0, padded - len(a))))
                for i in range(windows):
                    rows.append((k, i, len(mel), padded, mel[i * step:i * step + PARTIAL_FRAMES]))
                    if len(rows) * PARTIAL_FRAMES * MEL_BANDS >= BATCH_SAMPLES:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    return shaped.mapInArrow(run, schema)


def key_from_path(path_col: str, root: str) -> F.Column:
    """``<root>/<key>.wav`` -> ``key``, whatever scheme the listed path carries."""
    tail = root.split("://", 1)[-1]
    tail = tail.split("/", 1)[1] if "://" in root else tail  # drop the authority of a URI
    tail = tail[5:] if tail.startswith("file:") else tail
    tail = tail.strip("/")
    return F.regexp_extract(F.col(path_col), r"\Q" + tail + r"\E/(.+)\.wav$", 1)


def mel_spectrogram(df: DataFrame, wave_col: str = "wave", key: str = "key") -> DataFrame:
    """U5 on whole waveforms: ``(key, n_frames, n_mels, mels[frame][band])``."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("n_frames", T.IntegerType()),
                           T.StructField("n_mels", T.IntegerType()),
                           T.StructField("mels", T.ArrayType(T.ArrayType(T.FloatType())))])

    def run(batches):
        for b in _by_samples(batches, 1):
            mels = [mel_frames(x if x is not None else np.zeros(0, np.float32)) for x in _floats(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(m) for m in mels], pa.int32()),
                                              pa.array([MEL_BANDS] * len(mels), pa.int32()), _grid(mels)], names=schema.names)

    return df.select(F.col(key).cast("string"), wave_col).mapInArrow(run, schema)
