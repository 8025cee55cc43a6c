"""Chunked recordings against the whole-row functions, at every chunk edge."""

import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.sources import audio as A
from tokenloom.sources import chunks as C

SIZE = 25_600 * 2  # a multiple of every hop and holding more than one window
EDGES = [0, 1, 159, 160, 5000, SIZE - 1, SIZE, SIZE + 1, SIZE + 100, 2 * SIZE, 2 * SIZE + 640, 3 * SIZE + 17, 5 * SIZE]


@pytest.fixture(scope="module")
def sounds():
    rng = np.random.default_rng(3)
    out = {}
    for i, n in enumerate(EDGES):
        x = rng.normal(0, .2, n).astype(np.float32)
        x[:n // 3] *= 0.01 if i % 2 else 1
        out[f"s{i}"] = np.clip(x, -1, 1)
    out["silent"] = np.zeros(SIZE + 9, np.float32)
    return out


@pytest.fixture(scope="module")
def chunks(spark, sounds):
    rows = [(k, len(x), c, x[c * SIZE:(c + 1) * SIZE].tolist(), "own", -1) for k, x in sounds.items()
            for c in range(max(1, -(-len(x) // SIZE)))]
    return spark.createDataFrame(rows, "key string, n long, chunk long, samples array<float>, path string, first long").repartition(5).cache()


def whole(df, value):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["key"], r["chunk"])):
        out.setdefault(r["key"], []).append(np.array(r[value], np.float32))
    return {k: np.concatenate(v) for k, v in out.items()}


@pytest.mark.parametrize("target", [24000, 16000, 8000])
def test_resample(spark, chunks, sounds, target):
    r = C.resample_chunks(chunks, 16000, target, SIZE)
    got = whole(r, "samples")
    assert set(got) == set(sounds)
    for k, x in sounds.items():
        assert np.array_equal(got[k], A.resample(x, 16000, target)), k
    assert r.agg(F.max(F.size("samples"))).first()[0] <= SIZE * target // 16000


def test_mels(spark, chunks, sounds):
    m = C.mel_chunks(chunks, SIZE)
    got = whole(m, "mels")
    for k, x in sounds.items():
        want = A.mel_frames(x)
        assert got[k].shape == want.shape and np.allclose(got[k], want, rtol=1e-5, atol=1e-7), k
    assert {r["first"] * 160 for r in m.select("first").collect()} <= set(range(0, 9 * SIZE, SIZE))


def test_trim(spark, chunks, sounds):
    got = {r["key"]: (r["trim_start"], r["trim_end"]) for r in C.trim_chunks(chunks, SIZE).collect()}
    assert got == {k: A.trim_silence(x) for k, x in sounds.items()}


def test_partials(spark, chunks, sounds):
    df = spark.createDataFrame([(k, x.tolist()) for k, x in sounds.items()], "key string, wave array<float>")
    want = {(r["key"], r["win_idx"]): r for r in A.partial_mels(df).collect()}
    got = {(r["key"], r["win_idx"]): r for r in C.partial_chunks(chunks, SIZE).collect()}
    assert set(got) == set(want) and len(got) > 20
    for k, r in got.items():
        w = want[k]
        assert (r["n_frames"], r["padded_samples"]) == (w["n_frames"], w["padded_samples"])
        assert np.allclose(np.array(r["mels"]), np.array(w["mels"]), rtol=1e-5, atol=1e-7), k


def test_partials_move_samples_once(spark):
    """No recording is joined, nor gathered for a broadcast: the windows of a recording come with its chunks."""
    d = spark.range(4).selectExpr("cast(id AS string) AS key", "25600L AS n", "0L AS chunk", "array_repeat(cast(0.5 AS float), 25600) AS samples")
    plan = C.partial_chunks(d, SIZE)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_partials_of_repeated_and_missing_keys(spark):
    x = np.random.default_rng(5).normal(0, .2, SIZE + 30_000).astype(np.float32)
    rows = [(k, len(x), c, x[c * SIZE:(c + 1) * SIZE].tolist()) for k in ("a", "a", "b", None) for c in (0, 1)]
    got = C.partial_chunks(spark.createDataFrame(rows, "key string, n long, chunk long, samples array<float>"), SIZE).collect()
    want = A.partial_mels(spark.createDataFrame([("a", x.tolist())], "key string, wave array<float>")).collect()
    assert sorted((r["key"], r["win_idx"]) for r in got) == sorted((k, r["win_idx"]) for k in ("a", "a", "b") for r in want)
    by = {r["win_idx"]: np.array(r["mels"]) for r in want}
    assert all(np.allclose(np.array(r["mels"]), by[r["win_idx"]], rtol=1e-5, atol=1e-7) for r in got)


@pytest.mark.parametrize("size, rate, coverage", [(25_600, 1.3, 0.75), (25_760, 0.5, 0.2), (32_000, 4.0, 0.9)])
def test_partials_at_the_least_chunk(spark, size, rate, coverage):
    rng = np.random.default_rng(7)
    waves = {f"w{n}": rng.normal(0, .2, n).astype(np.float32) for n in (size - 1, size, 2 * size + 1, 3 * size - 161, 4 * size + 12_000)}
    rows = [(k, len(x), c, x[c * size:(c + 1) * size].tolist()) for k, x in waves.items() for c in range(-(-len(x) // size))]
    got = C.partial_chunks(spark.createDataFrame(rows, "key string, n long, chunk long, samples array<float>"), size, "key", rate, coverage).collect()
    want = A.partial_mels(spark.createDataFrame([(k, x.tolist()) for k, x in waves.items()], "key string, wave array<float>"), rate=rate, min_coverage=coverage)
    want = {(r["key"], r["win_idx"]): r for r in want.collect()}
    assert {(r["key"], r["win_idx"]) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        w = want[r["key"], r["win_idx"]]
        assert (r["n_frames"], r["padded_samples"]) == (w["n_frames"], w["padded_samples"])
        assert np.allclose(np.array(r["mels"]), np.array(w["mels"]), rtol=1e-5, atol=1e-7)


def test_resampled_chunks_are_not_stored(spark, tmp_path):
    """One and a half times the samples in four bytes each, to read three of them: they go on to the aggregate as they are made."""
    import glob

    from conftest import SF001
    from tokenloom.plans.catalog import QUERIES, load_all
    from tokenloom.session import checkpoint_dir

    load_all()
    root = checkpoint_dir(spark).removeprefix("file://") + "/tokenloom-work/resampled-*"
    before = glob.glob(root)
    d = QUERIES["chunked_resample"](spark, SF001)
    assert glob.glob(root) == before and d.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()


def test_sizes_are_checked(spark, chunks):
    for f in (lambda: C.with_halo(chunks, 9, 0, 8), lambda: C.mel_chunks(chunks, 100), lambda: C.trim_chunks(chunks, 100),
              lambda: C.resample_chunks(chunks, 16000, 24000, 25), lambda: C.partial_chunks(chunks, 1600)):
        with pytest.raises(ValueError):
            f()


def test_wav_files_by_range(spark, tmp_path):
    rng = np.random.default_rng(1)

    def put(name, channels, width, n):
        x = rng.integers(0, 256, n * channels * width, dtype=np.uint8).tobytes()
        with wave.open(str(tmp_path / name), "wb") as w:
            w.setnchannels(channels), w.setsampwidth(width), w.setframerate(16000)
            w.writeframes(x)

    for i, (ch, width, n) in enumerate([(1, 2, 1000), (2, 2, 333), (3, 1, 250), (1, 4, 100), (1, 2, 0), (1, 2, 300)]):
        put(f"{i}.wav", ch, width, n)
    raw = (tmp_path / "0.wav").read_bytes()
    (tmp_path / "extra.wav").write_bytes(b"RIFF" + struct.pack("<I", len(raw) + 4) + raw[8:12] + b"LIST\x03\x00\x00\x00abc\x00" + raw[12:])
    (tmp_path / "bad.wav").write_bytes(b"RIFF....nope")
    for mode in ("first", "mean"):
        rows = C.read_chunks(spark, str(tmp_path), 100, mode).collect()
        assert all(len(r["samples"] or []) <= 100 for r in rows)
        got = {}
        for r in sorted(rows, key=lambda r: r["chunk"] or 0):
            got.setdefault(r["path"].rsplit("/", 1)[1], []).extend(r["samples"] or [])
        for r in A.read_audio(spark, str(tmp_path)).collect():
            name = r["path"].rsplit("/", 1)[1]
            if r["error"]:
                assert name == "bad.wav" and any(x["error"] and x["path"].endswith(name) for x in rows)
                continue
            x = np.array(r["pcm"], np.float32)
            want = x[0] if mode == "first" else x.mean(axis=0)
            assert np.allclose(got[name], want, atol=1e-7), name
        assert got["extra.wav"] == got["0.wav"]
