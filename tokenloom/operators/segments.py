"""Sliding partial-utterance windows for speaker embedding.

Fixed values of the speaker encoder front end: 16 kHz audio, 10 ms mel hop (160
samples), 160-frame partials (1.6 s = 25,600 samples), windows per second ``rate`` = 1.3,
minimum coverage 0.75 of the last window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLING_RATE = 16000
HOP_MS = 10
PARTIAL_FRAMES = 160
SAMPLES_PER_FRAME = SAMPLING_RATE * HOP_MS // 1000


def frame_step(rate: float = 1.3) -> int:
    """Frames between window starts, rounded half-to-even as numpy does."""
    return int(round((SAMPLING_RATE / rate) / SAMPLES_PER_FRAME))


def window_count(n_samples, rate: float = 1.3, min_coverage: float = 0.75) -> F.Column:
    """Windows kept for an utterance of ``n_samples`` samples (see :func:`segment_windows`)."""
    step = frame_step(rate)
    n = F.col(n_samples) if isinstance(n_samples, str) else n_samples
    frames = F.ceil((n + 1) / SAMPLES_PER_FRAME)
    steps = F.greatest(F.lit(1), frames - PARTIAL_FRAMES + step + 1)
    n_win = F.floor((steps - 1) / step) + 1
    last_start = (n_win - 1) * step * SAMPLES_PER_FRAME
    coverage = (n - last_start) / F.lit(PARTIAL_FRAMES * SAMPLES_PER_FRAME)
    return F.when((coverage < min_coverage) & (n_win > 1), n_win - 1).otherwise(n_win).cast("int")


def last_window_stop(n_samples, rate: float = 1.3, min_coverage: float = 0.75) -> F.Column:
    """Sample index where the last kept window ends."""
    k = window_count(n_samples, rate, min_coverage)
    return (((k - 1) * frame_step(rate) + PARTIAL_FRAMES) * SAMPLES_PER_FRAME).cast("long")


def segment_windows(df: DataFrame, n_samples: str = "n_samples", rate: float = 1.3, min_coverage: float = 0.75,
                    out_prefix: str = "win") -> DataFrame:
    """One row per window ``(idx, frame_start, frame_stop, start, stop)``, in samples and frames.

    The last window is dropped when it covers less than ``min_coverage`` and is not the only
    one; the last kept window may run past the end (zero padding, T21).
    """
    step = frame_step(rate)
    kept = window_count(n_samples, rate, min_coverage)
    starts = F.sequence(F.lit(0), (kept - 1) * step, F.lit(step))
    p = out_prefix
    return (df.select("*", F.posexplode(starts).alias(f"{p}_idx", "_tl_f"))
            .withColumn(f"{p}_frame_start", F.col("_tl_f"))
            .withColumn(f"{p}_frame_stop", F.col("_tl_f") + PARTIAL_FRAMES)
            .withColumn(f"{p}_start", (F.col("_tl_f") * SAMPLES_PER_FRAME).cast("long"))
            .withColumn(f"{p}_stop", ((F.col("_tl_f") + PARTIAL_FRAMES) * SAMPLES_PER_FRAME).cast("long"))
            .drop("_tl_f"))


def padded_length(n_samples, rate: float = 1.3, min_coverage: float = 0.75) -> F.Column:
    """Samples after right zero-padding up to the last window stop (never shorter)."""
    n = F.col(n_samples) if isinstance(n_samples, str) else n_samples
    return F.greatest(n.cast("long"), last_window_stop(n, rate, min_coverage))
