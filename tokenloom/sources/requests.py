"""Request payloads (S8) and result sidecars."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.sources.fsio import write_atomic
from tokenloom.sources.tables import table

# Voice presets: display name -> reference audio URL. The URLs are placeholders for the
# deployment's own storage; pass a real table to ``presets``.
PRESET_NAMES = ["Ava", "Bria", "Alex", "Jacob"]
PRESET_FILES = ["ava.flac", "bria.mp3", "alex.mp3", "jacob.wav"]


def presets(spark: SparkSession, base_url: str = "https://voices.example.org/speakers/") -> DataFrame:
    return spark.createDataFrame(
        [(n, base_url + f) for n, f in zip(PRESET_NAMES, PRESET_FILES)], "name string, url string")


def _json_str(c) -> F.Column:
    """A JSON string literal for a column (quotes and escapes via to_json)."""
    j = F.to_json(F.struct(c.alias("v")))
    return F.substring(j, F.lit(6), F.length(j) - 6)


def request_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON request per conversation turn ``(conv_id, turn, payload)``.

    Shape by ``turn % 4``: 0 all fields; 1 guidance absent; 2 guidance explicitly null;
    3 an unknown extra field. Numeric fields vary with ``conv_id``.
    """
    c = table(spark, sf_dir, "conversations")
    text = _json_str(F.col("text"))
    g = (F.lit(1.0) + F.pmod(F.col("conv_id"), F.lit(5)) * 0.5).cast("string")
    p = (F.lit(0.9) + F.pmod(F.col("conv_id"), F.lit(10)) / 100.0).cast("string")
    ref = F.concat(F.lit('"https://voices.example.org/ref/'), F.col("conv_id").cast("string"), F.lit('.wav"'))
    k = (F.lit(10) + F.pmod(F.col("conv_id"), F.lit(40))).cast("string")
    variant = F.pmod(F.col("turn"), F.lit(4))
    payload = (
        F.when(variant == 0, F.concat(F.lit('{"text": '), text, F.lit(', "guidance": '), g, F.lit(', "top_p": '), p,
                                      F.lit(', "speaker_ref_path": '), ref, F.lit(', "top_k": '), k, F.lit("}")))
        .when(variant == 1, F.concat(F.lit('{"text": '), text, F.lit(', "top_p": '), p, F.lit("}")))
        .when(variant == 2, F.concat(F.lit('{"text": '), text, F.lit(', "guidance": null}')))
        .otherwise(F.concat(F.lit('{"text": '), text, F.lit(', "voice": "x"}')))
    )
    return c.select("conv_id", "turn", payload.alias("payload"))


def json_string(c) -> F.Column:
    """A string as a JSON literal the way Python's ``json.dumps`` writes it by default
    (``ensure_ascii``): quote, backslash and control characters escaped, every character
    outside printable ASCII as ``\\uXXXX`` (surrogate pairs above U+FFFF); null -> ``null``."""
    col = F.col(c) if isinstance(c, str) else c

    def hex4(v):
        return F.lpad(F.lower(F.hex(v)), 4, "0")

    def esc(ch):
        cp = F.ascii(ch)
        off = cp - 0x10000
        return (F.when(ch == '"', F.lit('\\"')).when(ch == "\\", F.lit("\\\\"))
                .when(ch == "\n", F.lit("\\n")).when(ch == "\r", F.lit("\\r")).when(ch == "\t", F.lit("\\t"))
                .when(ch == "\b", F.lit("\\b")).when(ch == "\f", F.lit("\\f"))
                .when((cp >= 0x20) & (cp <= 0x7E), ch)
                .when(cp < 0x10000, F.concat(F.lit("\\u"), hex4(cp)))
                .otherwise(F.concat(F.lit("\\u"), hex4(F.lit(0xD800) + F.shiftright(off, 10)),
                                    F.lit("\\u"), hex4(F.lit(0xDC00) + off.bitwiseAND(F.lit(0x3FF))))))

    body = F.array_join(F.transform(F.split(col, "", -1), esc), "")
    return (F.when(col.isNull(), F.lit("null")).when(F.length(col) == 0, F.lit('""'))
            .otherwise(F.concat(F.lit('"'), body, F.lit('"'))))


def sidecar_json(speaker, text, enabled: bool = True) -> F.Column:
    """``{"speaker": ..., "text": ...}`` written beside each result, formatted as Python's
    ``json.dump`` writes it (``", "`` / ``": "`` separators, ASCII-only escapes, nulls kept).
    ``enabled=False`` (a model checkpoint path is missing) writes no sidecar (null)."""
    if not enabled:
        return F.lit(None).cast("string")
    return F.concat(F.lit('{"speaker": '), json_string(speaker), F.lit(', "text": '), json_string(text), F.lit("}"))


def write_sidecars(df: DataFrame, out_dir: str, name: str = "name", sidecar: str = "sidecar") -> DataFrame:
    """S7 sink: one file ``<name>.json`` per result; returns ``(name, path)``, forced by the caller's action.

    Each task writes its own rows; files are moved into place when complete.
    """
    def run(batches):
        for pdf in batches:
            paths = []
            for n, text in zip(pdf[name], pdf[sidecar]):
                paths.append(f"{out_dir.rstrip('/')}/{n}.json")
                write_atomic(paths[-1], text.encode())
            yield pd.DataFrame({"name": pdf[name], "path": paths})

    return df.select(name, sidecar).mapInPandas(run, "name string, path string")
