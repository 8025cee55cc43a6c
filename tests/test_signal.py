"""O12 window arithmetic, mel front end, silence trimming (numpy helpers)."""

import numpy as np
from pyspark.sql import functions as F

from tokenloom.operators import segments as SG
from tokenloom.sources import audio as AU


def test_window_counts_golden(spark):
    cases = {8000: (1, 0), 25600: (1, 0), 31519: (1, 0), 31520: (2, 12320), 48000: (3, 24640),
             160000: (12, 135520)}
    df = spark.createDataFrame([(n,) for n in cases], "n_samples long")
    w = SG.segment_windows(df).groupBy("n_samples").agg(F.count("*").alias("k"), F.max("win_start").alias("last"))
    got = {r.n_samples: (r.k, r.last) for r in w.collect()}
    assert got == cases
    counted = df.select("n_samples", SG.window_count("n_samples").alias("k")).collect()
    assert {r.n_samples: r.k for r in counted} == {n: k for n, (k, _) in cases.items()}


def test_padded_length(spark):
    df = spark.createDataFrame([(8000,), (31520,)], "n long")
    got = [r.p for r in df.select(SG.padded_length("n").alias("p")).collect()]
    assert got == [25600, 12320 + 25600]


def test_mel_shapes_and_energy():
    sr = 16000
    t = np.arange(sr) / sr
    x = np.sin(2 * np.pi * 1000 * t).astype(np.float32)
    m = AU.mel_frames(x)
    assert m.shape == (1 + len(x) // 160, 40)
    band = m[10:-10].mean(axis=0).argmax()
    fb = AU.mel_filterbank()
    freqs = np.linspace(0, sr / 2, 201)
    assert abs(freqs[fb[band].argmax()] - 1000) < 120
    assert (m >= 0).all()


def test_trim_silence_drops_quiet_ends():
    x = np.concatenate([np.zeros(8000), np.ones(16000) * 0.5, np.zeros(8000)]).astype(np.float32)
    lo, hi = AU.trim_silence(x, 20)
    assert 4000 < lo <= 8000 and 24000 <= hi < 28000
    # silence throughout is as loud as its own peak: nothing to trim
    assert AU.trim_silence(np.zeros(5000, dtype=np.float32)) == (0, 5000)
    assert AU.trim_silence(np.zeros(0, dtype=np.float32)) == (0, 0)


def test_resample_length_and_tone():
    x = np.sin(2 * np.pi * 440 * np.arange(16000) / 16000)
    y = AU.resample(x, 16000, 24000)
    assert len(y) == 24000
    spec = np.abs(np.fft.rfft(y))
    assert abs(np.argmax(spec) * 24000 / len(y) - 440) < 2


def test_resample_kernel_and_edges():
    for src, dst in ((16000, 24000), (44100, 16000), (8000, 16000), (24000, 16000)):
        _, _, _, weights = AU.sinc_kernel(src, dst)
        assert np.allclose(weights.sum(axis=1), 1)
        y = AU.resample(np.ones(4000), src, dst)
        assert len(y) == -(-4000 * dst // src)
        assert np.allclose(y[200:-200], 1, atol=1e-5)
        # a pulse at the start doesn't wrap to the end
        pulse = np.zeros(4000)
        pulse[0] = 1
        assert np.abs(AU.resample(pulse, src, dst)[-500:]).max() == 0
    t = np.arange(8000) / 16000
    y = AU.resample(np.sin(2 * np.pi * 1000 * t), 16000, 24000)
    want = np.sin(2 * np.pi * 1000 * np.arange(len(y)) / 24000)
    assert np.abs(y - want)[300:-300].max() < 0.02


def test_mel_frames_match_a_direct_transform(monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=3000).astype(np.float32)
    monkeypatch.setattr(AU, "FRAMES_AT_ONCE", 4)
    got = AU.mel_frames(x)
    n = np.arange(400)
    window = np.sin(np.pi * n / 400) ** 2
    dft = np.exp(-2j * np.pi * np.outer(n, np.arange(201)) / 400)
    xp = np.pad(x.astype(float), 200)
    for f in (0, 7, len(got) - 1):
        power = np.abs((xp[160 * f:160 * f + 400] * window) @ dft) ** 2
        assert np.allclose(got[f], AU.mel_filterbank() @ power, rtol=1e-4)
    # each band has unit area over its width
    edges = AU._band_edges(16000, 40)
    assert edges[0] == 0 and abs(edges[-1] - 8000) < 1e-6 and (np.diff(edges) > 0).all()


def test_wav_24_bit():
    import io
    import wave

    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(3)
        w.setframerate(8000)
        w.writeframes(b"".join(int(v).to_bytes(3, "little", signed=True) for v in (0, -1, 2**22, -2**23)))
    rate, ch, x = AU._decode_wav(buf.getvalue())
    assert (rate, ch) == (8000, 2)
    assert np.allclose(x, [[0, 0.5], [-2.0**-23, -1.0]])
