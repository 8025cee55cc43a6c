"""Golden values for text, path and request functions."""

import random

from pyspark.sql import functions as F

from tokenloom.functions import requests as R
from tokenloom.functions import text as X


def _py_normalize(s: str) -> str:
    # independent statement of the rule: substitutions, tab/newline/* -> space,
    # strip, then collapse 2+ whitespace characters
    import re
    s = s.translate({cp: r for cp, r in X.CHAR_SUBSTITUTIONS.items()})
    s = s.replace("\t", " ").replace("\n", " ").replace("*", " ").strip()
    return re.sub(r"\s\s+", " ", s)


def test_normalize_golden(spark):
    cases = ["　a\r b　c \rd\x1c", "x…y", "™ࡊ", "a—b “q”", "  **  "]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r.n for r in df.select(X.normalize_text("s").alias("n")).collect()]
    assert got[0] == "a b　c d"
    assert got[1] == "x...y"
    assert got[2] == "™TM"
    assert got == [_py_normalize(c) for c in cases]


def test_normalize_random_whitespace(spark):
    rnd = random.Random(3)
    alphabet = ["a", " ", "\t", "\n", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "*", "…", "„"]
    cases = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s string")
    got = {r.i: r.n for r in df.select("i", X.normalize_text("s").alias("n")).collect()}
    assert all(got[i] == _py_normalize(c) for i, c in enumerate(cases))


def test_every_substitution(spark):
    df = spark.createDataFrame([(chr(cp),) for cp in X.CHAR_SUBSTITUTIONS], "s string")
    got = [r.n for r in df.select(X.normalize_text("s").alias("n")).collect()]
    assert got == [r.strip() for r in X.CHAR_SUBSTITUTIONS.values()]


def test_parent_dirs(spark):
    import os

    def walk(p):  # independent statement: repeated dirname until '/' or ''
        out = []
        while True:
            p = os.path.dirname(p)
            if p == "/" or not p:
                return out
            out.append(p)

    cases = ["data/wav/a.wav", "/x/y/z", "a", "a//b/c", "a/b/", "src3/17"]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = [r.d for r in df.select(X.parent_dirs("p").alias("d")).collect()]
    assert got[:3] == [["data/wav", "data"], ["/x/y", "/x"], []]
    assert got == [walk(c) for c in cases]


def test_extensions(spark):
    df = spark.createDataFrame([("https://h/b.mp3?x=1.2",), ("/a/.x",), ("b.",), ("b",), ("https://h/a.b/",)], "u string")
    got = [r.e for r in df.select(X.file_extension("u").alias("e")).collect()]
    assert got == [".2", "", "", "", ".b"]
    df2 = spark.createDataFrame([("dir/a.b.wav",), ("x/.hidden",), ("b.",)], "p string")
    got2 = [r.o for r in df2.select(X.tagged_output_path("p", "_e").alias("o")).collect()]
    assert got2 == ["./enhanced/a.b_e.wav", "./enhanced/.hidden_e", "./enhanced/b_e."]


def test_result_name_fallback(spark):
    df = spark.createDataFrame([("hello big world of speech synthesis", "7"), (None, "8")], "t string, i string")
    got = [r.n for r in df.select(X.result_name("t", "i").alias("n")).collect()]
    assert got == ["synth_hello_big_world_of_speech_7", "synth_8"]


def test_cache_key_and_suffix(spark):
    import hashlib
    df = spark.createDataFrame([("http://h/v.flac",), ("local/p.wav",), (None,)], "u string")
    got = [r.k for r in df.select(X.cache_key("u").alias("k")).collect()]
    assert got[0] == "audio_" + hashlib.md5(b"http://h/v.flac").hexdigest() + ".flac"
    assert got[1] == "embedding_" + hashlib.md5(b"local/p.wav").hexdigest() + ".pt"
    sfx = [r.s for r in df.select(X.ensure_suffix("u").alias("s")).collect()]
    assert sfx == ["http://h/v.flac.wav", "local/p.wav", None]


def test_parse_request_absent_vs_null(spark):
    payloads = ['{"text": "hi"}', '{"text": "hi", "guidance": null}', '{"text": "hi", "top_k": 5, "top_p": 0.5}',
                '{"guidance": 2}', '{"text": "a", "extra": 1}', "not json", '{"text": "a", "guidance": "loud"}']
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    rows = df.select(R.parse_request("p").alias("r")).select("r.*").collect()
    assert (rows[0].guidance, rows[0].top_p, rows[0].top_k) == (3.0, 0.95, None)
    assert rows[1].guidance is None and rows[1].error is None
    assert (rows[2].top_k, rows[2].top_p) == (5, 0.5)
    assert rows[3].error == "missing field: text"
    assert rows[4].error == "unknown field: extra"
    assert rows[5].error == "malformed payload"
    assert rows[6].error == "invalid value for field: guidance" and rows[6].guidance is None


def test_ui_knobs(spark):
    df = spark.range(11).select(F.col("id").alias("s"))
    got = [r.p for r in df.select(R.slider_value("s", **R.TOP_P_SLIDER).alias("p")).orderBy("p").collect()]
    assert got == [round(0.9 + s / 100, 2) for s in range(11)]
    g = spark.range(1, 6).select(R.slider_value("id", **R.GUIDANCE_SLIDER).alias("g")).collect()
    assert [r.g for r in g] == [1 + ((s - 1) * 2) / 4 for s in range(1, 6)]


def test_sidecar_matches_python_json(spark):
    import json

    from tokenloom.sources.requests import json_string, sidecar_json

    cases = ['a😀é"\\\n\x1f\x7f\b\f\r\t', "", None, "plain", "日本語", "\U0010FFFF"]
    df = spark.createDataFrame([(c, c) for c in cases], "s string, t string")
    got = [r.j for r in df.select(json_string("s").alias("j")).collect()]
    assert got == [json.dumps(c) for c in cases]
    side = [r.j for r in df.select(sidecar_json("s", "t").alias("j")).collect()]
    assert side == [json.dumps({"speaker": c, "text": c}) for c in cases]
    assert df.select(sidecar_json("s", "t", enabled=False).alias("j")).first().j is None
