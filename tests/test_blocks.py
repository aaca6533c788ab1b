"""Blocks of samples against one pass over the whole track."""

import math

import numpy as np
import pytest

from parley.operators import blocks, spectrum


def _track(spark, tracks, size):
    rows = [(k, i, float(x)) for k, xs in tracks.items() for i, x in enumerate(xs)]
    return blocks.blocked(spark.createDataFrame(rows, "track string, i long, x double").repartition(5), ["track"], ["i"], "x", size)


def _noise(n, seed, scale=3000):
    return np.round(np.random.default_rng(seed).normal(0, scale, n))


def test_mel_spectrum_equals_one_pass(spark):
    p = spectrum.MelPolicy(rate=8000, fft=64, hop=24, bins=10, lowest=50, highest=4000)
    tracks = {"a": _noise(1000, 1) / 32768, "exact": _noise(48 * 5, 2) / 32768, "short": _noise(7, 3) / 32768}
    got = spectrum.mel_spectrum(_track(spark, tracks, 96), ["track"], p, 96).collect()
    for name, x in tracks.items():
        frames = sorted((r["frame"], r["bands"]) for r in got if r["track"] == name)
        assert [f for f, _ in frames] == list(range(1 + len(x) // p.hop))
        padded = np.concatenate([np.zeros(32), x, np.zeros(32)])
        window = np.array([0.5 - 0.5 * math.cos(2 * math.pi * k / 64) for k in range(64)])
        whole = []
        for f in range(1 + len(x) // p.hop):
            part = padded[f * p.hop : f * p.hop + 64]
            power = [abs(sum(window[k] * part[k] * complex(math.cos(2 * math.pi * k * b / 64), -math.sin(2 * math.pi * k * b / 64)) for k in range(64))) ** 2 for b in range(33)]
            whole.append(10 * np.log10(np.maximum(p.least_power, spectrum.mel_filters(p) @ power)))
        assert np.allclose([b for _, b in frames], whole, atol=1e-8)


def test_standardised_bands_have_no_mean_and_unit_spread(spark):
    p = spectrum.MelPolicy(rate=8000, fft=64, hop=32, bins=6, lowest=50, highest=4000)
    made = spectrum.floored(spectrum.mel_spectrum(_track(spark, {"a": _noise(900, 4), "still": np.zeros(200)}, 128), ["track"], p, 128), ["track"], 20.0)
    got = spectrum.standardised(made, spectrum.band_moments(made, ["track"]), ["track"]).collect()
    a = np.array([r["bands"] for r in got if r["track"] == "a"])
    assert np.allclose(a.mean(axis=0), 0, atol=1e-9) and np.allclose(a.std(axis=0), 1)
    assert {x for r in got if r["track"] == "still" for x in r["bands"]} == {0.0}
    loud = np.array([r["bands"] for r in made.collect() if r["track"] == "a"])
    assert loud.min() >= loud.max() - 20 - 1e-9
    assert spectrum.standardised(made, spectrum.band_moments(made, []), []).count() == len(got)


@pytest.mark.parametrize(("source", "target"), [(16_000, 22_050), (24_000, 16_000), (8_000, 16_000)])
def test_resampling_equals_direct_convolution(spark, source, target):
    p = spectrum.SincPolicy()
    tracks = {"a": _noise(300, 5), "one": np.array([1000.0])}
    got = spectrum.resampled(_track(spark, tracks, 64), ["track"], source, target, p, 64).collect()
    cut = min(source, target) * p.kept
    for name, x in tracks.items():
        parts = sorted((r["block"], r["start"], r["samples"]) for r in got if r["track"] == name)
        assert all(s == sum(len(q[2]) for q in parts[:k]) for k, (_, s, _) in enumerate(parts))
        made = [v for _, _, s in parts for v in s]
        assert len(made) == -(-len(x) * target // source)
        for n, v in enumerate(made):
            want = 0.0
            for k, xk in enumerate(x):
                t = (k / source - n / target) * cut
                if abs(t) < p.crossings:
                    want += xk * np.sinc(t) * math.cos(math.pi * t / 2 / p.crossings) ** 2 * cut / source
            assert v == pytest.approx(want, abs=1e-6)


def test_a_tone_survives_resampling(spark):
    x = 10_000 * np.sin(2 * np.pi * 440 * np.arange(4000) / 16_000)
    rows = sorted((r["start"], r["samples"]) for r in spectrum.resampled(_track(spark, {"a": x}, 512), ["track"], 16_000, 22_050, size=512).collect())
    made = np.array([v for _, s in rows for v in s])
    want = 10_000 * np.sin(2 * np.pi * 440 * np.arange(len(made)) / 22_050)
    assert np.abs(made[100:-100] - want[100:-100]).max() < 60


def _plain_snr(x):
    from parley.operators.signal import SNR_STATISTIC as g

    peak = np.abs(x).max() if len(x) else 0
    if peak == 0:
        return None
    m = np.maximum(np.abs(x / peak), 1e-10)
    st = np.log(max(1e-10, m.mean())) - np.log(m).mean()
    below = [i for i, v in enumerate(g) if v < st]
    k = below[-1] if below else None
    db = -20 if k is None else 100 if k == 120 else k - 20 + (st - g[k]) / (g[k + 1] - g[k])
    f, energy = 10 ** (db / 10), ((x / peak) ** 2).sum()
    return 10 * np.log10((energy * f / (1 + f)) / (energy / (1 + f) + 1e-10))


def test_snr_of_intervals_equals_that_of_slices(spark):
    r = np.random.default_rng(6)
    x = np.round(r.normal(0, 500, 2_500) * (r.random(2_500) < 0.8) * np.repeat(r.random(25) * 3, 100))
    x[700:900] = 0
    held = _track(spark, {"a": x, "b": x[:40]}, 16)
    asked = [("a", int(a), int(a + n)) for a, n in zip(r.integers(0, 2_400, 150), r.integers(0, 100, 150))]
    asked += [("a", 0, 2_500), ("a", 0, 16), ("a", 16, 2_048), ("a", 5, 6), ("a", 720, 880), ("a", 9, 9), ("a", 1, 2_499), ("a", 512, 1_536), ("b", 0, 40), ("b", 30, 40), ("b", 17, 31)] * 2
    asked = [(k, a, min(b, 2_500)) for k, a, b in asked]
    df = spark.createDataFrame([(*q, n) for n, q in enumerate(asked)], "track string, from_sample long, to_sample long, id long")
    got = {q["id"]: q["snr_db"] for q in blocks.interval_snr(held, df, ["track"], 16).collect()}
    assert len(got) == len(asked)
    for n, (_, a, b) in enumerate(asked):
        want = _plain_snr(x[a:b])
        assert got[n] == (None if want is None else pytest.approx(want, abs=2e-4)), (a, b)
