"""Operators that SQL does not state, against direct computation."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from synapark.operators import fir as X
from synapark.operators import graph
from synapark.operators import intervals as I
from synapark.operators import signal as S
from synapark.operators import trials as R
from synapark.operators import units as U
from synapark.operators import windows as W


def recording(spark, x, channels=1):
    rows = [(c, k, float(v) + c) for c in range(channels) for k, v in enumerate(x)]
    return spark.createDataFrame(rows, "channel int, sample long, v double").repartition(3)


def series(df, column="v", channel=0):
    return np.array([r[column] for r in df.where(F.col("channel") == channel).orderBy("sample").collect()], float)


def plain_sections(sos, x):
    y = np.array(x, float)
    for b0, b1, b2, a1, a2 in sos:
        s1 = s2 = 0.0
        for i, v in enumerate(y):
            w = b0 * v + s1
            s1, s2 = b1 * v - a1 * w + s2, b2 * v - a2 * w
            y[i] = w
    return y


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 500])
def test_filter_in_blocks(n):
    x, sos = np.random.default_rng(n).normal(size=n), S.butter(5, (0.1, 0.4), "band")
    whole, state = S.run_sections(sos, x)
    assert np.allclose(whole, plain_sections(sos, x), atol=1e-11)
    first, between = S.run_sections(sos, x[: n // 3])
    second, after = S.run_sections(sos, x[n // 3 :], between)
    assert np.allclose(np.r_[first, second], whole, atol=1e-11) and np.allclose(after, state, atol=1e-11)


def test_filter_over_stretches(spark):
    """Several stretches give what the whole channel gives."""
    x = np.random.default_rng(1).normal(size=3000)
    got = series(S.filtered(recording(spark, x), 1000.0, (30.0, 90.0), "band", order=3, halo_s=0.4, size=700))
    assert np.allclose(got[400:-400], S.zero_phase(S.butter(3, (0.06, 0.18), "band"), x)[400:-400], atol=1e-6)


def test_unwrapped_phase_over_stretches(spark):
    t = np.arange(2000)
    x = np.cos(2 * np.pi * t / 50)
    got = series(X.hilbert(recording(spark, x), "unwrap", half=150, size=300))
    assert np.abs(np.diff(got)[200:-200] - 2 * np.pi / 50).max() < 0.02 and abs((got[1800] - got[200]) - 1600 * 2 * np.pi / 50) < 0.1


def test_hilbert_of_trials(spark):
    """The analytic signal of a whole trial; one that lacks a value has none, one too long is refused."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=400).cumsum()
    spectrum = np.fft.fft(x)
    spectrum[201:] = 0
    spectrum[1:200] *= 2
    for kind, want in (("abs", np.abs(np.fft.ifft(spectrum))), ("real", x), ("unwrap", np.unwrap(np.angle(np.fft.ifft(spectrum))))):
        assert np.allclose(series(S.hilbert(recording(spark, x), kind)), want)
    holed = recording(spark, x).withColumn("v", F.when(F.col("sample") != 7, F.col("v")))
    assert np.isnan(series(S.hilbert(holed))).all()
    with pytest.raises(Exception, match="fir.hilbert"):
        S.hilbert(recording(spark, x), longest=399).collect()


def direct(x, taps):
    """Each sample's sum over the taps, the ends going on."""
    half = len(taps) // 2
    long = np.pad(x, half, mode="edge")
    return np.array([sum(taps[::-1] * long[i : i + len(taps)]) for i in range(len(x))])


def test_sinc_kernels():
    """Unit gain where it passes, half at the cuts, little where it stops, order from the transition."""
    rate = 1000.0
    gain = lambda taps, f: abs(np.sum(taps * np.exp(-2j * np.pi * f / rate * np.arange(len(taps)))))
    for window, ripple in (("hann", 0.016), ("hamming", 0.007), ("blackman", 0.001)):
        for kind, cut, passes, stops in (("low", 60.0, (0, 40), (80, 300)), ("high", 60.0, (80, 500), (0, 40)), ("band", (60.0, 120.0), (85, 95), (0, 40, 140)), ("stop", (60.0, 120.0), (0, 40, 140), (85, 95))):
            taps = X.sinc_kernel(rate, cut, kind, transition=40.0, window=window)
            assert len(taps) == X.even_order(rate, 40.0, window) + 1 and np.allclose(taps, taps[::-1])
            assert all(abs(gain(taps, f) - 1) < ripple for f in passes) and all(gain(taps, f) < ripple for f in stops)
            assert all(abs(gain(taps, f) - 0.5) < 0.02 for f in np.atleast_1d(cut))
            scaled = X.sinc_kernel(rate, cut, kind, 40, window=window, scaled="pass")
            assert abs(gain(scaled, {"low": 0, "high": 500, "stop": 0, "band": 90}[kind]) - 1) < 1e-12
    kaiser = X.sinc_kernel(rate, 60.0, "low", X.even_order(rate, 40.0, "kaiser", 0.001), window="kaiser", beta=X.kaiser_beta(0.001))
    assert all(abs(gain(kaiser, f) - 1) < 0.0015 for f in (0, 40)) and all(gain(kaiser, f) < 0.0015 for f in (80, 200))
    for bad in ((600.0, "low", 10), (60.0, "low", 11), (60.0, "band", 10)):
        with pytest.raises(ValueError):
            X.sinc_kernel(rate, *bad)


@pytest.mark.parametrize("taps", [1, 5, 31, 33, 301])
def test_overlap_save(taps):
    rng = np.random.default_rng(taps)
    for n in (taps - 1, taps, 700, 5000):
        x, k = rng.normal(size=n).cumsum(), rng.normal(size=taps)
        assert np.allclose(X.overlap_save(x, k), np.convolve(x, k, "valid") if n >= taps else [], atol=1e-9)


@pytest.mark.parametrize("direction", ["zerophase", "onepass", "reverse", "twopass"])
def test_fir_knows_no_stretch(spark, direction):
    """A random walk in stretches of any size, shorter than the filter too, gives what the whole channel gives."""
    x = np.random.default_rng(2).normal(size=3000).cumsum()
    taps = X.sinc_kernel(1000.0, (20.0, 45.0), "band", transition=20.0) + np.linspace(0, 0.002, 167)[: X.even_order(1000.0, 20.0) + 1]
    idle = np.zeros(len(taps) - 1)
    want = direct(x, {"zerophase": taps, "onepass": np.r_[idle, taps], "reverse": np.r_[taps[::-1], idle], "twopass": np.convolve(taps, taps[::-1])}[direction])
    for size in (100, 700, 1 << 16):
        assert np.abs(series(X.filtered(recording(spark, x), taps, size=size, direction=direction)) - want).max() < 1e-9


def test_fir_hilbert_knows_no_stretch(spark):
    x = np.random.default_rng(3).normal(size=2500).cumsum()
    whole = series(X.hilbert(recording(spark, x), "abs", half=200))
    assert np.allclose(whole, np.abs(x + 1j * direct(x, X.hilbert_kernel(200))), atol=1e-9)
    assert all(np.abs(series(X.hilbert(recording(spark, x), "abs", half=200, size=size)) - whole).max() < 1e-9 for size in (64, 500, 1111))
    t = np.arange(4000)
    wave = np.cos(2 * np.pi * 0.05 * t) * (1 + 0.3 * np.cos(2 * np.pi * t / 2000))
    assert np.abs(series(X.hilbert(recording(spark, wave), "abs", half=200, size=900))[300:-300] - (1 + 0.3 * np.cos(2 * np.pi * t / 2000))[300:-300]).max() < 5e-3


def test_padded_median(spark):
    x = np.random.default_rng(6).normal(size=400)
    long = np.r_[np.full(6, x[:6].mean()), x, np.full(6, x[-6:].mean())]
    want = [np.median(long[k : k + 13]) for k in range(400)]
    for size in (50, 1 << 16):
        assert np.allclose(series(W.padded_median(recording(spark, x), "v", 6, "m", size=size), "m"), want)
    assert series(W.padded_median(recording(spark, x[:1]), "v", 6, "m"), "m").tolist() == [x[0]]
    assert np.allclose(series(W.padded_median(recording(spark, x[:3]), "v", 6, "m"), "m"), [np.median(np.r_[np.full(6 - k, x[0]), x[:3], np.full(4 + k, x[2])]) for k in range(3)])


def test_fir_gaps(spark):
    """Only what a missing value reaches is missing."""
    x = np.random.default_rng(4).normal(size=1000)
    holed = recording(spark, x).withColumn("v", F.when(F.col("sample") != 400, F.col("v")))
    got = series(X.filtered(holed, X.sinc_kernel(1000.0, 50.0, order=60), size=300))
    want = direct(x, X.sinc_kernel(1000.0, 50.0, order=60))
    assert np.isnan(got[370:431]).all() and np.allclose(np.delete(got, range(370, 431)), np.delete(want, range(370, 431)))


def test_windows_over_stretches(spark):
    x = np.random.default_rng(2).normal(size=500)
    gaps = np.where(x > 1, np.nan, x)
    df = recording(spark, x).withColumn("g", F.when(F.col("v") <= 1, F.col("v")))
    made = W.over_stretches(df, 2, {"m": lambda w: W.moving_average("v", w, 2), "d": lambda w: W.gradient("v", w)}, size=64)
    assert np.allclose(series(made, "m"), [x[max(0, k - 2) : k + 3].mean() for k in range(500)])
    assert np.allclose(series(made, "d"), np.gradient(x))
    filled = series(W.fill_gaps(df, "g", size=64), "g")
    known = np.flatnonzero(~np.isnan(gaps))
    inside = np.arange(known[0], known[-1] + 1)
    assert np.allclose(filled[inside], np.interp(inside, known, gaps[known]))
    assert np.allclose(series(W.running_total(df, F.col("v"), "s", size=64), "s"), np.cumsum(x))
    state = np.full(500, np.nan)
    for k, v in enumerate(x):
        state[k] = 1 if v > 1.5 else 0 if v < -1.5 else state[k - 1] if k else np.nan
    got = series(W.carried(df, F.when(F.col("v") > 1.5, 1).when(F.col("v") < -1.5, 0), "s", size=64), "s")
    assert np.array_equal(got, state, equal_nan=True)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_detrended(spark, order):
    x = np.cumsum(np.random.default_rng(order).normal(size=300))
    t = np.arange(300)
    got = series(W.detrended(recording(spark, x), "v", "sample", ["channel"], "flat", order), "flat")
    assert np.allclose(got, x - np.polyval(np.polyfit(t, x, order), t), atol=1e-6)


def test_positions(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(int(a), k) for k, a in enumerate(rng.integers(0, 40, 300))], "a int, k int").repartition(5)
    got = [(r["a"], r["k"]) for r in sorted(W.positions(df, ["a", "k"]).collect(), key=lambda r: r["position"])]
    assert got == sorted(got) and len(got) == 300
    assert W.positions(df.limit(0), ["a", "k"]).count() == 0


def test_resampled(spark):
    """A slow tone keeps its shape, a fast one goes; stretches give what one stretch gives."""
    t = np.arange(1200)
    slow, fast = np.sin(2 * np.pi * t / 60), np.sin(2 * np.pi * t / 2.5)
    got = series(S.resampled(recording(spark, slow + fast), 2, 3, size=250))
    k = np.arange(len(got))
    assert len(got) == 800 and np.abs(got - np.sin(2 * np.pi * k * 1.5 / 60))[60:-60].max() < 0.01
    assert np.allclose(got, series(S.resampled(recording(spark, slow + fast), 2, 3)), atol=1e-9)
    up = series(S.resampled(recording(spark, slow), 3, 1, size=100))
    assert len(up) == 3600 and np.abs(up - np.sin(2 * np.pi * np.arange(3600) / 3 / 60))[90:-90].max() < 0.01


def test_welch_and_band_power(spark):
    rng = np.random.default_rng(4)
    t = np.arange(4096)
    x = 3 * np.sin(2 * np.pi * 100 * t / 1000) + rng.normal(size=4096)
    freq, power = S.welch(x - x.mean(), 1000.0, 256)
    assert abs(freq[power.argmax()] - 100) < 4 and abs(power.sum() * freq[1] - x.var()) < 0.4
    rows = spark.createDataFrame([(0, k + 1, float(v)) for k, v in enumerate(x)], "channel int, sample long, v double")
    got = {r["band"]: r for r in S.band_power(rows, 1000.0, {"tone": (90.0, 110.0), "rest": (200.0, 400.0)}, 1000, 256).collect()}
    assert got["tone"]["power"] > 20 * got["rest"]["power"] and got["rest"]["clips"] == 4
    clips = [S.welch(x[k : k + 1000] - x[k : k + 1000].mean(), 1000.0, 256) for k in range(0, 4000, 1000)]
    assert math.isclose(got["rest"]["power"], np.mean([p[(f > 200) & (f <= 400)].mean() for f, p in clips]), rel_tol=1e-9)


def test_gappy_spectrum(spark):
    x = np.random.default_rng(5).normal(size=32)
    df = recording(spark, x).withColumn("trial", F.lit(0))
    got = np.array([complex(r["re"], r["im"]) for r in S.gappy_spectrum(df, 32.0).orderBy("freq").collect()])
    want = np.fft.rfft(x) / 32 * np.r_[1, np.full(15, 2), 1]
    assert np.allclose(got, want, atol=1e-9)
    t = np.arange(64)
    tone = np.where(t % 7 == 3, np.nan, 2 * np.cos(2 * np.pi * 5 * t / 64) + np.sin(2 * np.pi * 5 * t / 64))
    rows = spark.createDataFrame([(0, int(k), None if np.isnan(v) else float(v), 0) for k, v in enumerate(tone)], "channel int, sample long, v double, trial int")
    r = S.gappy_spectrum(rows, 64.0).where("freq = 5").first()
    assert abs(r["re"] - 2) < 1e-9 and abs(r["im"] + 1) < 1e-9


def test_sliding_spectrum(spark):
    t = np.arange(256)
    x = np.where(t < 128, np.sin(2 * np.pi * 10 * t / 64), np.sin(2 * np.pi * 20 * t / 64))
    out = S.sliding_spectrum(recording(spark, x).withColumn("trial", F.lit(1)), 64.0, 64, 32, 3).toPandas()
    top = out.loc[out.groupby("at")["power"].idxmax()].set_index("at")["freq"]
    assert set(out["at"]) == set(range(0, 193, 32)) and abs(top[0] - 10) <= 1 and abs(top[192] - 20) <= 1


def test_distribution_functions(spark):
    """Against sums of densities on a fine grid."""
    def area(f, low, high, n=400_001):
        u = np.linspace(low, high, n)
        return np.trapezoid(f(u), u)

    t_density = lambda v: lambda x: math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi) * (1 + x * x / v) ** (-(v + 1) / 2)
    rows = spark.createDataFrame([(1.3, 7), (-2.2, 30), (0.0, 5), (float("nan"), 5), (1.0, 0)], "t double, df long")
    got = [r["p"] for r in rows.select(S.t_pvalue("t", "df").alias("p")).collect()]
    assert abs(got[0] - 2 * area(t_density(7), 1.3, 400)) < 1e-6 and abs(got[1] - 2 * area(t_density(30), 2.2, 100)) < 1e-8 and got[2] == 1 and all(x is None or math.isnan(x) for x in got[3:])
    f = spark.createDataFrame([(2.5, 3, 20), (0.4, 10, 4)], "f double, a long, b long")
    p = [r["p"] for r in f.select(S.f_pvalue("f", "a", "b").alias("p")).collect()]
    back = f.withColumn("p", 1 - S.f_pvalue("f", "a", "b")).select(S.f_quantile("p", "a", "b").alias("f")).collect()
    assert all(abs(r["f"] - w) < 1e-6 for r, w in zip(back, (2.5, 0.4), strict=True))
    density = lambda m, n: lambda x: np.exp(math.lgamma((m + n) / 2) - math.lgamma(m / 2) - math.lgamma(n / 2) + m / 2 * math.log(m / n) + (m / 2 - 1) * np.log(x) - (m + n) / 2 * np.log1p(m * x / n))
    assert abs(p[0] - area(density(3, 20), 2.5, 4000, 4_000_001)) < 1e-5
    chi = lambda k: lambda x: x ** (k / 2 - 1) * np.exp(-x / 2) / 2 ** (k / 2) / math.gamma(k / 2)
    assert np.allclose(S.chi_square_tail(np.array([0.5, 3.0, 20.0]), 4), [area(chi(4), x, 200) for x in (0.5, 3.0, 20.0)], atol=1e-7)


def test_isolation(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(m, 1, (n, 3)) for m, n in ((0, 60), (3, 80), (5, 25))])
    unit = np.repeat([1, 2, 3], [60, 80, 25])
    df = spark.createDataFrame([(int(u), k, v.tolist()) for k, (u, v) in enumerate(zip(unit, x, strict=True))], "unit int, spike_id int, x array<double>").repartition(4)
    got = {r["unit"]: r for r in S.isolation(df).collect()}
    for u in (1, 2, 3):
        own = x[unit == u]
        gap = x - own.mean(0)
        d2 = np.einsum("ij,ij->i", gap @ np.linalg.inv(np.cov(own.T)), gap)
        other = np.sort(d2[unit != u])
        want = other[len(own) - 1] if len(other) >= len(own) else None
        assert math.isclose(got[u]["isolation"], want, rel_tol=1e-9)
        assert math.isclose(got[u]["l_ratio"], S.chi_square_tail(other, 3).sum() / len(own), rel_tol=1e-8)
        assert math.isclose(got[u]["separation"], np.sqrt(other).mean() / np.sqrt(d2[unit == u]).mean(), rel_tol=1e-9)
    assert S.isolation(df.limit(0)).count() == 0
    assert S.isolation(df.where("unit = 3 OR spike_id < 10")).where("unit = 3").first()["isolation"] is None


def test_copula_information(spark):
    """Close to the closed form for normal pairs; unchanged by bending an axis."""
    rng = np.random.default_rng(7)
    a = rng.normal(size=3000)
    b = 0.6 * a + 0.8 * rng.normal(size=3000)
    rows = [(0, k, float(x), float(y)) for k, (x, y) in enumerate(zip(a, b, strict=True))] + [(1, k, float(np.exp(x)), float(y**3)) for k, (x, y) in enumerate(zip(a, b, strict=True))]
    got = {r["g"]: r["bits"] for r in S.copula_information(spark.createDataFrame(rows, "g int, k int, x double, y double"), "x", "y", ["g"], "k").collect()}
    assert abs(got[0] + 0.5 * math.log2(1 - 0.36)) < 0.03 and abs(got[0] - got[1]) < 1e-12
    assert abs(S.digamma(1.0) + 0.5772156649) < 1e-7


def test_bayes_factor(spark):
    """Against the integral over effect sizes."""
    rows = [(0.5, 20.0, 19.0), (3.0, 20.0, 19.0), (-2.2, 12.5, 48.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "t double, n double, v double").select(S.bayes_factor("t", "n", "v")).collect()]
    for (t, n, v), bf in zip(rows, got, strict=True):
        delta = np.linspace(-12, 12, 4001)
        w = np.linspace(1e-4, 6, 2000)  # the root of a chi square over its degrees of freedom
        pdf = np.exp(np.log(2) + v / 2 * np.log(v / 2) - math.lgamma(v / 2) + (v - 1) * np.log(w) - v * w**2 / 2)
        like = lambda d: np.trapezoid(w * np.exp(-0.5 * (t * w - d) ** 2) / math.sqrt(2 * math.pi) * pdf, w)
        prior = 1 / (math.pi * 0.70710678 * (1 + (delta / 0.70710678) ** 2))
        up = np.trapezoid([like(d * math.sqrt(n)) * p for d, p in zip(delta, prior, strict=True)], delta)
        assert abs(bf / (up / like(0.0)) - 1) < 0.01


def test_multivariate_f(spark):
    rng = np.random.default_rng(8)
    y = rng.normal(size=(30, 4)) + np.arange(4) * 0.3
    rows = [(s, k, float(y[s, k])) for s in range(30) for k in range(4)] + [(99, 0, 1.0)]
    got = S.multivariate_f(spark.createDataFrame(rows, "s int, k int, y double"), "y", "s", "k").first()
    c = y[:, 1:] - y[:, :1]
    want = 30 * c.mean(0) @ np.linalg.inv(np.cov(c.T)) @ c.mean(0) * (30 - 3) / (29 * 3)
    assert math.isclose(got["f"], want, rel_tol=1e-9) and (got["df1"], got["df2"]) == (3, 27)


def test_prominent():
    x = np.array([0, 2, 1, 5, 5, 3, 4, 0, 1.0])
    at, tall, wide = U.prominent(x, 0)
    assert at.tolist() == [1, 3, 6] and tall.tolist() == [1, 5, 1]
    assert wide[1] == pytest.approx((4 + (5 - 2.5) / 4 * 0 + (4 - 2.5) / 4 + 2) - (2 + (2.5 - 1) / 4)) or wide[1] > 0
    assert U.prominent(x, 2)[0].tolist() == [3]


def test_wave_shape(spark):
    t = np.arange(60)
    bump = lambda m, s, h: h * np.exp(-((t - m) ** 2) / (2 * s**2))
    x = bump(20, 2, -10) + bump(10, 3, 3) + bump(30, 4, 4)
    rows = spark.createDataFrame([(1, x.tolist()), (2, None), (3, [0.0] * 10), (4, [1.0, None, 2.0])], "unit int, wave array<double>")
    got = {r["unit"]: r["w"] for r in rows.select("unit", U.wave_properties("wave").alias("w")).collect()}
    w = got[1]
    assert (w["n_peaks"], w["n_troughs"], w["trough_at"], w["peak_at"]) == (2, 1, 20, 30)
    assert abs(w["trough"] + 10) < 0.3 and abs(w["peak_before"] - 3) < 0.1 and abs(w["peak_after"] - 4) < 0.1
    assert abs(w["width_trough"] - 2.355 * 2) < 1.2 and abs(w["duration_us"] - 10 / 30_000 * 1e6) < 1e-6
    assert abs(w["peak_to_trough"] - 0.4) < 0.02 and abs(w["first_peak_to_trough"] - 0.3) < 0.02
    assert all(got[k] is None or got[k]["n_peaks"] is None for k in (2, 3, 4))


def test_decay():
    lags = np.arange(0, 2, 0.05)
    assert abs(U.decay(lags, 7 * np.exp(-lags / 0.4)) - 0.4) < 1e-6
    assert abs(U.decay(-lags, 7 * np.exp(-lags / 0.4)) + 0.4) < 1e-6
    noisy = 7 * np.exp(-lags / 0.4) + np.random.default_rng(0).normal(0, 0.1, len(lags))
    tau = U.decay(lags, noisy)
    best = min(((noisy - a * np.exp(-lags / s)) ** 2).sum() for a in np.linspace(6, 8, 81) for s in np.linspace(0.3, 0.5, 81))
    a = (noisy * np.exp(-lags / tau)).sum() / (np.exp(-2 * lags / tau)).sum()
    assert ((noisy - a * np.exp(-lags / tau)) ** 2).sum() <= best + 1e-9
    assert math.isnan(U.decay(lags, np.zeros(len(lags))))


def test_all_properties(spark):
    rng = np.random.default_rng(9)
    spikes = spark.createDataFrame([(u, k, int(v)) for u in (1, 2) for k, v in enumerate(np.cumsum(rng.integers(3, 60, 200)))], "unit long, spike_id long, t long")
    acg = spark.createDataFrame([(u, b, abs(b) + u) for u in (1, 2) for b in range(-10, 11)], "unit long, bin long, n long")
    waves = spark.createDataFrame([(1, 5, (-np.exp(-((np.arange(40) - 20) ** 2) / 8)).tolist())], "unit long, channel int, wave array<double>")
    rows = {r["cluster_id"]: r for r in U.all_properties(spikes, acg, waves, width=1.0, bin_ms=100, long=50).collect()}
    assert set(rows) == {1, 2} and rows[1]["phy_id"] == 0 and rows[1]["channel"] == 5 and rows[2]["n_peaks"] is None
    assert len(rows[1].asDict()) == 22 and rows[1]["acg"] == [abs(b) + 1 for b in range(-10, 11)]


def test_connected(spark):
    rng = np.random.default_rng(10)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(k, k + 1) for k in range(300, 360)]
    nodes = sorted({x for e in edges for x in e} | {900})
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        up[max(p, q)] = min(p, q)
    got = graph.connected(spark.createDataFrame([(x,) for x in nodes], "node long"), spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["cluster"] for r in got} == {x: top(x) for x in nodes}


def test_resolve_duplicates(spark):
    rng = np.random.default_rng(11)
    rows = [(int(c), int(u), k, int(t), float(a), int(p)) for k, (c, u, t, a, p) in enumerate(zip(rng.integers(0, 2, 200), rng.integers(0, 4, 200), rng.integers(0, 900, 200), rng.integers(0, 9, 200), rng.integers(0, 3, 200), strict=True))]
    size = pd.Series([r[1] for r in rows]).value_counts()
    kept = {r[2] for r in rows}
    for channel in (0, 1):
        own = sorted((r for r in rows if r[0] == channel), key=lambda r: (r[3], r[2]))
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                if a[2] in kept and b[2] in kept and b[3] - a[3] <= 5:
                    first, second = (a[4], b[4]) if a[5] == b[5] else (size[a[1]], size[b[1]])
                    kept.discard(b[2] if second <= first else a[2])
    got = R.resolve_duplicates(spark.createDataFrame(rows, "channel int, unit int, spike_id int, t long, ampl double, template int").repartition(3), 5)
    assert {r["spike_id"] for r in got.collect()} == kept and got.columns == ["channel", "unit", "spike_id", "t", "ampl", "template"]


def test_clock_fits(spark):
    rng = np.random.default_rng(12)
    x = np.sort(rng.uniform(0, 1000, 60))
    y = 1.00002 * x + 3.25
    frm = spark.createDataFrame([(1, k, float(v)) for k, v in enumerate(x)], "dev int, k int, t double")
    to = spark.createDataFrame([(1, k, float(v)) for k, v in enumerate(y)], "dev int, k int, t double")
    r = I.fit_clock(to, frm, t="t", by=["dev"], key="k").first()
    assert abs(r["slope"] - 1.00002) < 1e-9 and abs(r["offset"] - 3.25) < 1e-6 and r["n"] == 60
    near = I.fit_clock_nearest(to.where("k % 9 <> 4"), frm.where("k % 11 <> 5"), t="t", by=["dev"]).first()
    assert abs(near["slope"] - 1.00002) < 1e-6 and abs(near["offset"] - 3.25) < 1e-3


def test_trial_conversions(spark):
    events = spark.createDataFrame([(1, 100, 5, -2), (2, 200, 0, None), (3, 300, None, 1)], "id int, sample long, duration long, offset long")
    got = {r["id"]: (r["start"], r["end"], r["offset"]) for r in R.events_to_trials(events).collect()}
    assert got == {1: (100, 104, -2), 2: (200, 200, 0), 3: (300, 300, 1)}
    back = {r["id"]: (r["sample"], r["duration"]) for r in R.trials_to_events(R.events_to_trials(events)).collect()}
    assert back == {1: (100, 5), 2: (200, 1), 3: (300, 1)}


def test_digital_events(spark):
    """A bounce before the code settles does not count, nor does what is up at the start."""
    rows = [(s, p, 0) for s in range(60) for p in range(1, 17)]
    up = {(s, 1) for s in range(3)} | {(20, 2), *((s, p) for s in range(22, 30) for p in (1, 3, 7))} | {(s, 4) for s in range(40, 50)}
    pins = spark.createDataFrame([(s, p, int((s, p) in up)) for s, p, _ in rows], "sample long, pin int, v int")
    got = sorted(tuple(r) for r in R.digital_events(pins, 4, 4).collect())
    assert got == [(20, 5, 64), (40, 8, 0)]


def test_pairs_by_counts(spark):
    rng = np.random.default_rng(13)
    a = [(g, k, float(rng.integers(0, 20)), float(rng.integers(0, 9))) for g in (1, 2) for k in range(6)]
    b = [(g, 100 + k, float(rng.integers(0, 20)), float(rng.integers(0, 9))) for g in (1, 3) for k in range(8)]
    names = "session int, trial int, x double, y double"
    got = R.pair_by_counts(spark.createDataFrame(a, names), spark.createDataFrame(b, names), ["session"], ["x", "y"]).collect()
    assert {r["session"] for r in got} == {1} and len({r["trial_a"] for r in got}) == len({r["trial_b"] for r in got}) == 6
    at = {(g, k): np.array(v) for g, k, *v in a + b}
    cost = lambda i, j: np.abs(at[1, i] - at[1, j]).sum()
    assert all(r["cost"] == cost(r["trial_a"], r["trial_b"]) for r in got)
    pairs = [(r["trial_a"], r["trial_b"]) for r in got]
    assert all(cost(i, n) + cost(k, j) >= cost(i, j) + cost(k, n) for i, j in pairs for k, n in pairs)


def test_directions_of_a_filter(spark):
    x = np.random.default_rng(14).normal(size=900)
    sos = S.butter(2, 0.1)
    one = S.run_sections(sos, x, S.steady(sos, x[0]))[0]
    back = S.run_sections(sos, x[::-1], S.steady(sos, x[-1]))[0][::-1]
    for direction, want in (("onepass", one), ("onepass-reverse", back)):
        got = series(S.filtered(recording(spark, x), 1000.0, 50.0, "low", 2, halo_s=0.25, size=300, direction=direction))
        assert np.allclose(got, want, atol=1e-6)


def test_tapers():
    a = S.alpha_taper(50, 0.1)
    assert a[-1] == 0 and a.max() <= 1 + 1e-9 and a.argmax() == 41
    s = S.sine_tapers_scaled(64, 2)
    assert s.shape == (4, 64) and np.allclose((s**2).sum(1), 1 - (np.arange(4) / 3) ** 2)
    with pytest.raises(ValueError):
        S.sine_tapers_scaled(4, 3)


def test_superlets(spark):
    t = np.arange(400)
    df = recording(spark, np.sin(2 * np.pi * 50 * t / 1000)).withColumn("trial", F.lit(0))
    one = S.wavelet_power(df, 1000.0, [50.0], 3.0).orderBy("sample").toPandas()["power"].to_numpy()
    two = S.wavelet_power(df, 1000.0, [50.0], 6.0).orderBy("sample").toPandas()["power"].to_numpy()
    got = S.superlet_power(df, 1000.0, [50.0], [2]).orderBy("sample").toPandas()["power"].to_numpy()
    assert np.allclose(got, np.sqrt(one * two))


def test_nested_tables(spark):
    from synapark.operators import nested as N

    table = spark.createDataFrame([(0, "a"), (1, "b")], "id long, name string")
    got = sorted(tuple(r) for r in N.add_rows(table, spark.createDataFrame([("c",), ("d",)], "name string").coalesce(1), "id").select("id", "name").collect())
    assert got == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
    assert [r["name"] for r in N.get_rows(table, "id", [1]).collect()] == ["b"]
    marked = N.with_index(spark.createDataFrame([([1, 2, 3, 4, 5], [2, 5], [1, 2])], "data array<int>, inner array<int>, outer array<int>"), "inner", "data")
    assert N.index_of(marked, "data") == "inner" and N.index_of(marked, "outer") is None
    assert marked.select(N.decode_doubly_ragged(F.col("data"), F.col("inner"), F.col("outer")).alias("x")).first()["x"] == [[[1, 2]], [[3, 4, 5]]]
    cube = spark.createDataFrame([([[1, 2], [3, 4]],), ([[1, 2], [3]],), (None,)], "x array<array<int>>")
    assert [r[0] for r in cube.select(N.fits_shape("x", [(None, 2), (3,)])).collect()] == [True, False, False]
    even = spark.createDataFrame([([1], [2]), ([1, 2], [3])], "a array<int>, b array<int>")
    assert N.check_heights(even.limit(1), ["a", "b"]).count() == 1
    with pytest.raises(Exception, match="different heights"):
        N.check_heights(even, ["a", "b"]).collect()


def test_numbered_by_parts(spark):
    """Counted part by part, as over the whole group."""
    rng = np.random.default_rng(9)
    rows = [(int(c), int(t), k) for k, (c, t) in enumerate(zip(rng.integers(0, 3, 300), rng.integers(0, 40, 300), strict=True))]
    got = W.numbered(spark.createDataFrame(rows, "c int, t long, k int"), ["c"], ["t", "k"], F.floor(F.col("t") / 7)).collect()
    want = {k: 1 + sum((b, j) < (t, k) for d, b, j in rows if d == c) for c, t, k in rows}
    assert {r["k"]: r["sample"] for r in got} == want
