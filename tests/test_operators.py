"""Operators against direct computation, and plans that have to hold at scale."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from synapark.functions import scalar as X
from synapark.operators import aligned as A
from synapark.operators import intervals as I
from synapark.operators import nested, sets
from synapark.operators import signal as S
from synapark.operators import stats
from synapark.operators import windows as W


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aligned_spikes_round_trip(spark):
    """Spikes built around events come back as they were built, under a condition too."""
    rng = random.Random(3)
    spikes, trials, built, k = [], [], {}, 0
    for trial in range(15):
        t0 = 10_000.0 * (trial + 1)
        trials.append((trial, t0, rng.choice([1, 2])))
        for unit in range(10):
            rel = sorted(rng.uniform(-1000, 1000) for _ in range(rng.randint(1, 60)))
            built[unit, trial] = rel
            for r in rel:
                spikes.append((unit, k, t0 + r))
                k += 1
    s = spark.createDataFrame(spikes, "unit int, spike_id long, t double")
    r = spark.createDataFrame(trials, "trial int, t0 double, cond int")
    for chosen in (r, r.where("cond = 1")):
        got = {}
        for row in A.align(s, chosen, 1000, 1000, closed="both").collect():
            got.setdefault((row["unit"], row["trial"]), []).append(row["rel"])
        ids = {x["trial"] for x in chosen.collect()}
        assert set(got) == {x for x in built if x[1] in ids}
        assert all(np.allclose(sorted(v), built[key], atol=1e-9) for key, v in got.items())


@pytest.mark.parametrize("closed", ["left", "right", "both", "neither"])
def test_range_join_is_the_naive_one(spark, closed):
    rng = random.Random(closed)
    points = [(i, rng.randint(-50, 50)) for i in range(120)]
    ranges = [(j, a := rng.randint(-50, 50), a + rng.randint(0, 30)) for j in range(40)]
    p = spark.createDataFrame(points, "i int, t long")
    r = spark.createDataFrame(ranges, "j int, start long, end long")
    out = I.range_join(p, r, 7, closed=closed)
    low = {"left": lambda t, a: t >= a, "both": lambda t, a: t >= a}.get(closed, lambda t, a: t > a)
    high = {"right": lambda t, b: t <= b, "both": lambda t, b: t <= b}.get(closed, lambda t, b: t < b)
    assert sorted((x["i"], x["j"]) for x in out.collect()) == sorted((i, j) for i, t in points for j, a, b in ranges if low(t, a) and high(t, b))
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


def test_overlap_and_band_join(spark):
    rng = random.Random(1)
    a = [(i, s := rng.randint(0, 100), s + rng.randint(1, 30)) for i in range(40)]
    b = [(j, s := rng.randint(0, 100), s + rng.randint(1, 30)) for j in range(40)]
    out = I.overlap_join(spark.createDataFrame(a, "i int, a_start long, a_end long"), spark.createDataFrame(b, "j int, b_start long, b_end long"), 9)
    assert sorted((x["i"], x["j"]) for x in out.collect()) == sorted((i, j) for i, s, e in a for j, p, q in b if s < q and p < e)
    out = I.band_join(spark.createDataFrame(a, "i int, t_a long, x long"), spark.createDataFrame(b, "j int, t_b long, y long"), 6)
    assert sorted((x["i"], x["j"]) for x in out.collect()) == sorted((i, j) for i, s, _ in a for j, p, _ in b if abs(s - p) <= 6)


def test_correlogram_mirrors(spark):
    rng = random.Random(2)
    s = spark.createDataFrame([(rng.randint(0, 3), k, rng.randint(0, 3000)) for k in range(200)], "unit int, spike_id long, t long")
    got = {(r["unit_a"], r["unit_b"], r["bin"]): r["n"] for r in A.correlogram(s, s, 100, 10).collect()}
    assert got and all(got.get((b, a, -k)) == n for (a, b, k), n in got.items())


@pytest.mark.parametrize("looked_at", [1 << 20, 7])
@pytest.mark.parametrize("pairs", ["all", "same", "upper"])
def test_correlogram_counts(spark, pairs, looked_at, monkeypatch):
    """Against every pair of spikes, on bin edges too, in stretches of several sizes, with few and with many near."""
    monkeypatch.setattr(A, "LOOKED_AT", looked_at)
    rng = random.Random(5)
    rows = [(rng.randint(0, 3), k, rng.randint(-300, 900)) for k in range(250)]
    s = spark.createDataFrame(rows, "unit int, spike_id long, t long")
    for lag, width in ((100, 10), (95, 190), (3, 10)):
        want = {}
        for ua, ia, ta in rows:
            for ub, ib, tb in rows:
                gap = tb - ta
                if abs(gap) <= lag and ia != ib and (pairs == "all" or (ua == ub if pairs == "same" else ua <= ub)):
                    k = (1 if gap >= 0 else -1) * int((abs(gap) + width / 2) // width)
                    want[ua, ub, k] = want.get((ua, ub, k), 0) + 1
        for size in (37, 10 * lag, None):
            got = {(r["unit_a"], r["unit_b"], r["bin"]): r["n"] for r in A.correlogram(s, s, lag, width, pairs=pairs, size=size).collect()}
            assert got == want
    assert A.correlogram(s.limit(0), s, 10, 2).count() == 0 and A.correlogram(s, s.limit(0), 10, 2).count() == 0


def test_psth_of_known_spikes(spark):
    """A unit with spikes at fixed places has counts in their bins alone."""
    at = np.linspace(0.1, 0.9, 9)
    rows = [(0, i, k, 1000 * k + 1000 * float(t)) for k in range(20) for i, t in enumerate(at)]
    s = spark.createDataFrame([(u, 100 * k + i, t) for u, i, k, t in rows], "unit int, spike_id long, t double")
    e = spark.createDataFrame([(k, 1000.0 * k) for k in range(20)], "trial int, t0 double")
    out = A.psth(A.align(s, e, 0, 1000), ["unit"], 0.0, 5.0, 200, e.agg(F.count("*").alias("n_events"))).collect()
    assert len(out) == 200 and sum(r["n"] for r in out) == 180 and sum(r["n"] > 0 for r in out) == 9


def test_asof_and_nearest_against_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = np.unique(rng.integers(0, 1000, 80)), np.unique(rng.integers(0, 1000, 30))
    left, right = spark.createDataFrame([(int(x),) for x in a], "t long"), spark.createDataFrame([(int(x), float(x)) for x in b], "t long, v double")
    back = {r["t"]: r["t_right"] for r in I.asof_join(left, right, t="t", values=["v"]).collect()}
    assert back == {int(x): (int(b[b <= x].max()) if (b <= x).any() else None) for x in a}
    near = {r["t"]: abs(r["gap"]) for r in I.nearest(left, right, t="t").collect()}
    assert near == {int(x): int(np.abs(b - x).min()) for x in a}
    for width in (7, 90, 5000):  # the same in stretches of time
        for direction in ("backward", "forward"):
            one = I.asof_join(left, right, t="t", values=["v"], direction=direction).collect()
            assert sorted(one) == sorted(I.asof_join(left, right, t="t", values=["v"], direction=direction, width=width).collect())
        assert near == {r["t"]: abs(r["gap"]) for r in I.nearest(left, right, t="t", width=width).collect()}
    keyed = lambda df: df.withColumn("k", F.col("t") % 3)
    assert sorted(I.asof_join(keyed(left), keyed(right), t="t", values=["v"], by=["k"]).collect()) == sorted(I.asof_join(keyed(left), keyed(right), t="t", values=["v"], by=["k"], width=50).collect())
    lerp = {r["t"]: r["v"] for r in I.interpolate_at(left, right.withColumn("v", F.col("v") * 2), t="t", value="v").collect()}
    assert all(v is None if x < b[0] or x > b[-1] else abs(v - 2 * x) < 1e-9 for x, v in lerp.items())


def recording(spark, n=4000, channels=3):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(channels, n)) + np.sin(2 * np.pi * 10 * np.arange(n) / 1000)
    return x, spark.createDataFrame([(c, i, float(x[c, i])) for c in range(channels) for i in range(n)], "channel int, sample long, v double")


def test_filter_in_stretches_is_the_whole_filter(spark):
    x, df = recording(spark)
    sos = S.butter(4, 0.2, "low")
    out = S.filtered(df, 1000.0, 100.0, "low", 4, size=1000, halo_s=0.4).orderBy("channel", "sample").toPandas()
    want = np.concatenate([S.zero_phase(sos, row) for row in x])
    assert np.abs(out["v"].to_numpy() - want).max() < 1e-6 and len(out) == x.size


@pytest.mark.parametrize(("kind", "cut", "passes", "stops"), [("low", 0.2, 0.05, 0.6), ("high", 0.4, 0.8, 0.05), ("band", (0.2, 0.4), 0.28, 0.8), ("stop", (0.2, 0.4), 0.05, 0.2836)])
def test_butterworth_response(kind, cut, passes, stops):
    sos = S.butter(4, cut, kind)
    at = lambda f: abs(np.prod([np.polyval(r[:3], z := np.exp(1j * np.pi * f)) / np.polyval([1, *r[3:]], z) for r in sos]))
    assert abs(at(passes) - 1) < 0.02 and at(stops) < 0.02
    edges = np.atleast_1d(cut)
    assert all(abs(at(e) - np.sqrt(0.5)) < 0.01 for e in edges)
    assert all(np.abs(np.roots([1, *r[3:]])).max() < 1 for r in sos)


def test_filter_state_carries_over():
    x = np.random.default_rng(1).normal(size=500)
    sos = S.butter(3, 0.3)
    whole, _ = S.run_sections(sos, x)
    a, state = S.run_sections(sos, x[:123])
    b, _ = S.run_sections(sos, x[123:], state)
    assert np.allclose(np.r_[a, b], whole)
    flat, _ = S.run_sections(sos, np.ones(50) * 3, S.steady(sos, 3.0))
    assert np.allclose(flat, 3)


def test_envelope_and_spectrum(spark):
    t = np.arange(1024)
    x = np.cos(2 * np.pi * 64 * t / 1024) * 2
    assert np.allclose(np.abs(S.analytic(x)), 2)
    df = spark.createDataFrame([(0, 0, int(i), float(v)) for i, v in enumerate(x)], "trial int, channel int, sample long, v double")
    top = S.spectrum(df, 1024.0, 3).orderBy(F.desc("power")).first()
    assert abs(top["freq"] - 64) <= 2
    top = S.wavelet_power(df, 1024.0, [32.0, 64.0, 128.0]).groupBy("freq").agg(F.avg("power").alias("p")).orderBy(F.desc("p")).first()
    assert top["freq"] == 64


def test_pvalues(spark):
    df = spark.createDataFrame([(0.0, 5), (2.570581836, 5), (1.959963985, 10**7), (12.7062047, 1)], "t double, df long")
    p = [r["p"] for r in df.select(S.t_pvalue("t", "df").alias("p")).collect()]
    assert np.allclose(p, [1.0, 0.05, 0.05, 0.05], atol=1e-6)


def test_isolation_against_numpy(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(40, 3)), rng.normal(size=(90, 3)) + 4])
    unit = [0] * 40 + [1] * 90
    out = {r["unit"]: r for r in S.isolation(spark.createDataFrame([(u, k, v.tolist()) for k, (u, v) in enumerate(zip(unit, x, strict=True))], "unit int, spike_id long, x array<double>")).collect()}
    own, other = x[:40], x[40:]
    d2 = np.einsum("ij,jk,ik->i", other - own.mean(0), np.linalg.inv(np.cov(own.T)), other - own.mean(0))
    assert abs(out[0]["isolation"] - np.sort(d2)[39]) < 1e-6


def test_scalars(spark):
    one = spark.range(1).select(
        X.to_int16(F.lit(2.5)).alias("a"), X.to_int16(F.lit(-2.5)).alias("b"), X.to_int16(F.lit(1e9)).alias("c"), X.bits_to_number([F.lit(1), F.lit(0), F.lit(7)]).alias("d"),
        X.clip(F.lit(9.0), 1.0, 4.0).alias("e"), X.number_to_bits(F.lit(5), 4).alias("f"), X.euler_to_quaternion(F.lit(np.pi), F.lit(0.0), F.lit(0.0)).alias("g"),
    ).first()
    assert (one["a"], one["b"], one["c"], one["d"], one["e"], one["f"]) == (3, -3, 32767, 5, 4.0, [1, 0, 1, 0])
    assert np.allclose(one["g"], [0, 0, 0, 1])
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],)], "x array<double>")
    got = df.select(X.pad("x", 2).alias("m"), X.pad("x", 1, "edge").alias("e"), X.pad("x", 1, "zero").alias("z"), X.pad("x", 1, "mean").alias("u")).first()
    assert got["m"] == [3, 2, 1, 2, 3, 4, 3, 2] and got["e"] == [1, 1, 2, 3, 4, 4] and got["z"] == [0, 1, 2, 3, 4, 0] and got["u"] == [2.5, 1, 2, 3, 4, 2.5]


def test_hazen(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],), ([7.0],)], "x array<double>")
    assert [r["p"] for r in df.select(W.hazen(F.col("x"), 0.9).alias("p")).collect()] == [4.0, 7.0]
    assert [r["p"] for r in df.select(W.hazen(F.col("x"), 0.5).alias("p")).collect()] == [2.5, 7.0]


def test_nested(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 1)], "unit string, t int")
    assert [tuple(r) for r in nested.ragged_index(df, "unit").orderBy("unit").collect()] == [("a", 1, 1), ("b", 2, 3)]
    assert sorted(tuple(r) for r in nested.unpack(nested.pack(df, "unit", ["t"]), "unit").collect()) == [("a", 0, 1), ("b", 0, 1), ("b", 1, 2)]
    flat = spark.createDataFrame([([1, 2, 3, 4], [1, 1, 4])], "data array<int>, bounds array<int>").select(nested.decode_ragged(F.col("data"), F.col("bounds")).alias("r")).first()["r"]
    assert flat == [[1], [], [2, 3, 4]]
    with pytest.raises(Exception, match="value changes"):
        spark.createDataFrame([(1.5,)], "x double").select(nested.cast_checked(F.col("x"), "int")).collect()
    assert nested.flatten(spark.range(1).select(F.struct(F.struct(F.lit(1).alias("c")).alias("b")).alias("a"))).columns == ["a.b.c"]


def test_sets(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, u string"), spark.createDataFrame([(2, 5)], "k int, w int")
    assert sets.append(a, b).count() == 2 and sets.append_unique("k", a, b).count() == 2
    with pytest.raises(Exception, match="more than one part"):
        sets.append_unique("k", a, a).collect()


def test_statistics_against_numpy(spark):
    rng = np.random.default_rng(7)
    x, g = rng.normal(size=60), np.arange(60) % 2
    row = spark.createDataFrame([(float(v), bool(k)) for v, k in zip(x, g, strict=True)], "x double, g boolean").agg(*stats.independent_t("x", F.col("g"))).first()
    a, b = x[g == 1], x[g == 0]
    pooled = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(x) - 2)
    assert abs(row["t"] - (a.mean() - b.mean()) / np.sqrt(pooled * (1 / len(a) + 1 / len(b)))) < 1e-9 and row["df"] == 58


def test_common_reference_leaves_median_zero(spark):
    from synapark.plans import catalog

    out = catalog.queries()["common_median_reference"](spark, "/root/testdata/sf0.001")
    assert out.groupBy("sample").agg(F.median("car").alias("m")).where("abs(m) > 1e-9").count() == 0


def test_pushdown(spark):
    from synapark.plans import catalog

    text = plan(catalog.queries()["event_filter"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [" in text and "event_type" in text.split("PushedFilters")[1]
    assert "p_name" not in plan(catalog.queries()["unit_type"](spark, "/root/testdata/sf0.001"))


def test_quantiles_bit_for_bit(spark):
    """As DuckDB has them, also where percentile's two roundings differ; a unit of one spike has color 0."""
    import duckdb

    rng = random.Random(9)
    rows = [(g, round(rng.uniform(0, 200), 2)) for g in range(200) for _ in range(rng.randint(1, 60))] + [(0, None)]
    df = spark.createDataFrame(rows, "g long, v double")
    got = {r["g"]: (r["lo"], r["hi"]) for r in W.quantiles(df, "v", ["g"], {"lo": 0.1, "hi": 0.9}).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE x (g BIGINT, v DOUBLE)")
    con.executemany("INSERT INTO x VALUES (?, ?)", rows)
    want = {g: (lo, hi) for g, lo, hi in con.execute("SELECT g, quantile_cont(v, 0.1), quantile_cont(v, 0.9) FROM x GROUP BY g").fetchall()}
    assert got == want


def test_quantile_color_of_a_single_spike(spark, tmp_path):
    from synapark.plans import catalog

    rows = [(1, "2024-01-01 00:00:00", 1, "click", 5.0, "1"), (2, "2024-01-01 00:00:01", 2, "view", 1.0, "1"), (3, "2024-01-01 00:00:02", 2, "view", 9.0, "1")]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(f"{tmp_path}/events.parquet")
    got = {r["spike_id"]: r["color"] for r in catalog.queries()["quantile_color"](spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 0, 3: 19}
