"""Synthesis requests: parsing with defaults, UI knob mapping, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.util import col_of

# Request fields and the defaults used when a field is absent.
REQUEST_DEFAULTS = {"guidance": 3.0, "top_p": 0.95, "speaker_ref_path": None, "top_k": None}
REQUEST_FIELDS = ["text", "guidance", "top_p", "speaker_ref_path", "top_k"]

# UI limits.
MAX_CHARS = 220
MAX_UPLOAD_MB = 50
MAX_REFERENCE_SECONDS = 120

# Voice-source choices in the UI, in display order.
VOICE_CHOICES = ["Preset voices", "Upload target voice", "Record your voice"]


def parse_request(payload) -> Column:
    """JSON payload -> struct(text, guidance, top_p, speaker_ref_path, top_k, error).

    Defaults apply only when a field is absent; an explicit JSON null stays null. A missing
    ``text`` or any unknown field is an error (the struct then carries only ``error``).
    The payload is read as ``map<string,string>`` so absent and null can be told apart.
    """
    m = F.from_json(col_of(payload), "map<string,string>")

    def field(name: str, typ: str, default):
        present = F.map_contains_key(m, name)
        dflt = F.lit(default).cast(typ)
        # try_cast: a malformed value becomes an error row, not a failed job (ANSI mode)
        return F.when(present, m[name].try_cast(typ)).otherwise(dflt)

    def invalid(name: str, typ: str):
        return F.map_contains_key(m, name) & m[name].isNotNull() & m[name].try_cast(typ).isNull()

    unknown = F.array_except(F.map_keys(m), F.array(*[F.lit(f) for f in REQUEST_FIELDS]))
    error = (
        F.when(m.isNull(), F.lit("malformed payload"))
        .when(~F.map_contains_key(m, "text"), F.lit("missing field: text"))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown field: "), F.array_join(F.array_sort(unknown), ",")))
    )
    for name, typ in (("guidance", "double"), ("top_p", "double"), ("top_k", "int")):
        error = error.when(invalid(name, typ), F.lit(f"invalid value for field: {name}"))
    ok = error.isNull()
    return F.struct(
        F.when(ok, m["text"]).alias("text"),
        F.when(ok, field("guidance", "double", REQUEST_DEFAULTS["guidance"])).alias("guidance"),
        F.when(ok, field("top_p", "double", REQUEST_DEFAULTS["top_p"])).alias("top_p"),
        F.when(ok, field("speaker_ref_path", "string", None)).alias("speaker_ref_path"),
        F.when(ok, field("top_k", "int", None)).alias("top_k"),
        error.alias("error"),
    )


def slider_value(slider, ends: tuple[float, float], lo: float, hi: float, places: int | None = None) -> Column:
    """P10: linear map of a slider with end marks ``ends`` to ``[lo, hi]``, rounded half-even if asked for."""
    share = (col_of(slider) - F.lit(ends[0])) / F.lit(float(ends[1] - ends[0]))
    value = F.lit(float(lo)) + share * F.lit(hi - lo)
    return value if places is None else F.bround(value, places)


# Slider marks and the range each stands for.
TOP_P_SLIDER = {"ends": (0, 10), "lo": 0.9, "hi": 1.0, "places": 2}
GUIDANCE_SLIDER = {"ends": (1, 5), "lo": 1.0, "hi": 3.0}


def validation_error(text, upload_bytes=None) -> Column:
    """Reason a UI request is rejected, or null: ``empty text``, or ``upload too large`` with the
    size in whole MB (half-even) and the limit."""
    t = col_of(text)
    err = F.when(t.isNull() | (t == ""), F.lit("empty text"))
    if upload_bytes is not None:
        mb = col_of(upload_bytes) / 1024 / 1024
        err = err.when(mb >= MAX_UPLOAD_MB, F.concat(
            F.lit("upload too large: "), F.bround(mb).cast("long").cast("string"), F.lit(f" MB of at most {MAX_UPLOAD_MB}")))
    return err


def cut_text(text, max_chars: int = MAX_CHARS) -> Column:
    """Texts of ``max_chars`` or more characters are cut to ``max_chars``."""
    return F.substring(col_of(text), 1, max_chars)


def is_long_text(text, max_chars: int = MAX_CHARS) -> Column:
    """The model path only warns (no cut) when text is longer than ``max_chars``."""
    return F.length(col_of(text)) > max_chars


def choose_reference(choice, preset_url, upload_path, record_path) -> Column:
    """Voice reference by UI choice: preset URL / uploaded file / recording."""
    c = col_of(choice)
    return (F.when(c == VOICE_CHOICES[0], col_of(preset_url))
            .when(c == VOICE_CHOICES[1], col_of(upload_path))
            .when(c == VOICE_CHOICES[2], col_of(record_path)))


# Synthesised audio shorter than 400 ms at 24 kHz is rejected.
MIN_SYNTH_SAMPLES = 9600


def synthesis_error(n_samples, min_samples: int = MIN_SYNTH_SAMPLES) -> Column:
    """Reason a synthesised waveform is rejected (shorter than 400 ms at 24 kHz), or null."""
    return F.when(col_of(n_samples) < min_samples, F.lit("audio shorter than 400 ms"))


# Fixed value: utterances shorter than this many seconds aren't used for training.
MIN_SECONDS = 2.0


def duration_filter(df: DataFrame, n_samples: str = "n_samples", sample_rate: str = "sample_rate",
                    min_seconds: float = MIN_SECONDS, out: str = "seconds") -> DataFrame:
    """Add the duration and keep rows of at least ``min_seconds``."""
    return df.withColumn(out, F.col(n_samples) / F.col(sample_rate)).where(F.col(out) >= min_seconds)


def cap_waveform(pcm, sample_rate, seconds: int = MAX_REFERENCE_SECONDS) -> Column:
    """The first ``seconds`` of a waveform."""
    return F.slice(col_of(pcm), F.lit(1), (col_of(sample_rate) * seconds).cast("int"))


def cap_samples(n_samples, sample_rate, seconds: int = MAX_REFERENCE_SECONDS) -> Column:
    """Keep at most the first ``seconds`` of an upload (in samples)."""
    return F.least(col_of(n_samples), col_of(sample_rate) * seconds)
