"""Directed influence, permutation statistics, spatial filters, clusters and table functions against direct computation."""

import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from synapark.operators import aligned as A
from synapark.operators import directed as D
from synapark.operators import models as M
from synapark.operators import permutation as P
from synapark.operators import trials as R
from synapark.operators import units as U
from synapark.operators import windows as W

COUPLED = np.array([[[0.5, 0.0, 0.0], [0.4, 0.3, 0.0], [0.0, 0.35, 0.4]], [[-0.3, 0.0, 0.0], [0.2, -0.2, 0.0], [0.0, 0.2, -0.1]]])


def series(seed, n, a=COUPLED):
    """Trials of a model in which the first channel drives the second, and that the third."""
    rng = np.random.default_rng(seed)
    p = a.shape[1]
    x = np.zeros((n + 50, p))
    for t in range(len(a), len(x)):
        x[t] = sum(a[k] @ x[t - 1 - k] for k in range(len(a))) + rng.normal(size=p)
    return x[50:]


@pytest.fixture(scope="module")
def recorded(spark):
    data = {(g, k): series(10 * g + k, 400, COUPLED if g == 0 else COUPLED[:, ::-1, ::-1].copy()) for g in range(2) for k in range(4)}
    rows = [(g, k, t, row.tolist()) for (g, k), x in data.items() for t, row in enumerate(x)]
    return data, spark.createDataFrame(rows, "grp int, trial int, sample long, x array<double>").repartition(5)


def test_fit_equals_least_squares(spark, recorded):
    data, df = recorded
    for r in D.fit(df, 2, ["grp"], ["grp", "trial"]).collect():
        z = np.concatenate([np.c_[x[2:], x[1:-1], x[:-2]] for (g, _), x in data.items() if g == r["grp"]])
        w, *_ = np.linalg.lstsq(z[:, 3:], z[:, :3], rcond=None)
        assert r["n"] == len(z) and np.allclose(np.reshape(r["a"], (2, 3, 3)), w.T.reshape(3, 2, 3).transpose(1, 0, 2), atol=1e-9)
        left = z[:, :3] - z[:, 3:] @ w
        assert np.allclose(np.reshape(r["noise"], (3, 3)), left.T @ left / len(z), atol=1e-9)
    assert D.fit(df.limit(0), 2, ["grp"], ["grp", "trial"]).count() == 0


def test_levinson(spark, recorded):
    """The recursion solves the block Toeplitz system of the covariances, and is stable."""
    data, df = recorded
    for order in (1, 2, 4):
        for r in D.fit(df, order, ["grp"], ["grp", "trial"], method="levinson").collect():
            own = [x for (g, _), x in data.items() if g == r["grp"]]
            n = sum(map(len, own))
            cov = [sum(x[k:].T @ x[: len(x) - k] for x in own) / n for k in range(order + 1)]
            whole = np.block([[cov[j - i] if j >= i else cov[i - j].T for j in range(order)] for i in range(order)])
            want = np.hstack(cov[1:]) @ np.linalg.inv(whole)
            a = np.array(r["a"]).reshape(order, 3, 3)
            assert np.allclose(np.hstack(list(a)), want, atol=1e-9)
            assert np.allclose(np.reshape(r["noise"], (3, 3)), cov[0] - want @ np.vstack([c.T for c in cov[1:]]), atol=1e-9)
            companion = np.eye(3 * order, k=-3)
            companion[:3] = np.hstack(list(a))
            assert np.abs(np.linalg.eigvals(companion)).max() < 1


def test_directed_shares(spark, recorded):
    """Who drives whom is seen, and figures are those of the matrices."""
    _, df = recorded
    models = D.fit(df, 2, ["grp"], ["grp", "trial"])
    freqs = [0.0, 40.0, 90.0]
    waves = D.transfer(models, ["grp"], freqs, 250.0)
    dtf = {(r["grp"], r["freq"], r["to"], r["from"]): r["value"] for r in D.directed_transfer(waves, ["grp"]).collect()}
    pdc = {(r["grp"], r["freq"], r["to"], r["from"]): r["value"] for r in D.partial_directed(waves, ["grp"]).collect()}
    for m in models.collect():
        a = np.array(m["a"]).reshape(2, 3, 3)
        for f in freqs:
            c = np.eye(3) - sum(a[k] * np.exp(-2j * np.pi * f / 250 * (k + 1)) for k in range(2))
            h = np.linalg.inv(c)
            for i, j in itertools.product(range(3), repeat=2):
                assert abs(dtf[m["grp"], f, i, j] - abs(h[i, j]) / np.linalg.norm(h[i])) < 1e-9
                assert abs(pdc[m["grp"], f, i, j] - abs(c[i, j]) / np.linalg.norm(c[:, j])) < 1e-9
    assert all(pdc[0, f, 1, 0] > 0.2 and pdc[0, f, 0, 1] < 0.15 and pdc[1, f, 1, 2] > 0.2 for f in freqs)


def residual(y, past):
    left = y - past @ np.linalg.lstsq(past, y, rcond=None)[0]
    return np.linalg.slogdet(left.T @ left)[1]


@pytest.mark.parametrize("conditional", [True, False])
def test_granger(spark, recorded, conditional):
    """Alone, given all others, and of blocks, against regressions one by one."""
    data, df = recorded
    models = D.fit(df, 2, ["grp"], ["grp", "trial"])
    for blocks in (None, [[0], [1, 2]]):
        parts = blocks or [[0], [1], [2]]
        for r in D.granger(models, ["grp"], 2, blocks, conditional).collect():
            z = np.concatenate([np.c_[x[2:], x[1:-1], x[:-2]] for (g, _), x in data.items() if g == r["grp"]])
            known = [c for k, b in enumerate(parts) for c in b if conditional or k in (r["from"], r["to"])]
            past = lambda cs: z[:, [3 + lag * 3 + c for lag in range(2) for c in cs]]  # noqa: E731, B023
            y = z[:, parts[r["to"]]]
            want = residual(y, past([c for c in known if c not in parts[r["from"]]])) - residual(y, past(known))
            assert abs(r["value"] - want) < 1e-8
    spectral = D.spectral_granger(models, ["grp"], 2, [float(f) for f in range(1, 125, 4)], 250.0).toPandas()
    mean = spectral.groupby(["grp", "from", "to"])["value"].mean()
    assert (spectral["value"] > -1e-9).all() and mean[0, 0, 1] > 10 * mean[0, 1, 0] and mean[1, 2, 1] > 10 * mean[1, 1, 2]


def test_interaction(spark, recorded):
    """Unchanged by mixing inside a block, none where the cross-spectrum is real."""
    _, df = recorded
    waves = D.transfer(D.fit(df, 2, ["grp"], ["grp", "trial"]), ["grp"], [30.0], 250.0)
    mixed = df.withColumn("x", F.array(F.col("x")[0], F.col("x")[1] + 2 * F.col("x")[2], F.col("x")[2] - F.col("x")[1]))
    other = D.transfer(D.fit(mixed, 2, ["grp"], ["grp", "trial"]), ["grp"], [30.0], 250.0)
    one, two = ({r["grp"]: r["value"] for r in D.interaction(w, ["grp"], [[0], [1, 2]]).collect()} for w in (waves, other))
    assert one[0] > 0.01 and all(abs(one[g] - two[g]) < 1e-6 for g in one)


def test_spatial_patterns(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(5, 5))
    one, two = (rng.normal(size=(800, 5)) * np.array(s) @ mix.T for s in ([3, 1, 1, 1, 0.3], [1, 1, 1, 1, 2]))
    rows = [(7, True, r.tolist()) for r in one] + [(7, False, r.tolist()) for r in two]
    df = spark.createDataFrame(rows, "grp int, one boolean, x array<double>").repartition(4)
    found = D.spatial_patterns(df, ["grp"], "one", 5)
    w = np.array([r["w"] for r in found.orderBy("filter").collect()])
    c1, c2 = one.T @ one / 800, two.T @ two / 800
    assert np.allclose(w @ (c1 + c2) @ w.T, np.eye(5), atol=1e-8)
    inner = w @ c1 @ w.T
    assert np.allclose(inner, np.diag(np.diag(inner)), atol=1e-8) and (np.diff(np.diag(inner)) <= 1e-12).all()
    ends = [r["filter"] for r in D.spatial_patterns(df, ["grp"], "one", 2).orderBy("filter").collect()]
    assert ends == [0, 4] and abs(np.dot(w[0] @ mix, np.eye(5)[0]) / np.linalg.norm(w[0] @ mix)) > 0.95
    out = D.apply_patterns(df, found, ["grp"])
    assert out.count() == 1600 * 5 and np.allclose(sorted(r["y"] for r in out.where("filter = 2").collect()), sorted(np.r_[one, two] @ w[2]))


def test_phase_linearity(spark):
    rng = np.random.default_rng(5)
    t = np.arange(600) / 300
    steady, noise = np.exp(2j * np.pi * 20 * t), rng.normal(size=600)
    x = np.c_[steady.real, (steady * np.exp(1j)).real, noise]
    df = spark.createDataFrame([(1, k, row.tolist()) for k, row in enumerate(x)], "trial int, sample long, x array<double>").repartition(3)
    got = {(r["a"], r["b"]): r["value"] for r in D.phase_linearity(df, ["trial"], 300.0, 2.0).collect()}
    assert got[0, 1] > 0.99 and max(got[0, 2], got[1, 2]) < 0.3
    same = df.withColumn("x", F.array(F.col("x")[0], F.col("x")[0] * 2))
    assert D.phase_linearity(same, ["trial"], 300.0, 2.0).first()["value"] < 0.01


@pytest.mark.parametrize("sent", [P.SENT, 0])
def test_permuted_t(spark, sent, monkeypatch):
    """Draws are permutations, inside blocks too; statistics and shares are those of each draw by itself."""
    monkeypatch.setattr(P, "SENT", sent)
    rng = np.random.default_rng(6)
    obs = [(k, k % 3 == 0, k % 2) for k in range(40)]
    labels = spark.createDataFrame(obs, "obs int, label boolean, subject int")
    for block in ((), ("subject",)):
        bits = {r["obs"]: r["bits"] for r in P.draws(labels, 30, block).collect()}
        assert all(bits[k][0] == label for k, label, _ in obs) and len({tuple(bits[k][d] for k in range(40)) for d in range(31)}) == 31
        for part in ([0, 1],) if not block else ([0], [1]):
            own = [(k, label) for k, label, s in obs if s in part]
            assert all(sum(bits[k][d] for k, _ in own) == sum(label for _, label in own) for d in range(31))
    values = {(k, f): float(v) for k in range(40) for f, v in enumerate(rng.normal(size=6) + (k % 3 == 0) * np.array([0, 0, 0, 2, 1, 0]))}
    values.pop((3, 1))
    df = spark.createDataFrame([(k, f, v) for (k, f), v in values.items()] + [(39, 9, None), (38, 8, 1.0)], "obs int, feature int, x double")
    bits = {r["obs"]: r["bits"] for r in P.draws(labels, 30).collect()}
    t = P.permuted_t(df, labels, 30, ["feature"])
    got = {(r["feature"], r["draw"]): r["t"] for r in t.collect()}

    def by_hand(f, d):
        a, b = ([v for (k, g), v in values.items() if g == f and bits[k][d] == side] for side in (True, False))
        pooled = ((len(a) - 1) * np.var(a, ddof=1) + (len(b) - 1) * np.var(b, ddof=1)) / (len(a) + len(b) - 2)
        return (np.mean(a) - np.mean(b)) / np.sqrt(pooled * (1 / len(a) + 1 / len(b)))

    assert got.keys() == {(f, d) for f in range(6) for d in range(31)} and all(abs(v - by_hand(f, d)) < 1e-8 for (f, d), v in got.items())
    for r in P.permutation_p(t, ["feature"]).collect():
        own = [got[r["feature"], d] for d in range(1, 31)]
        most = [max(got[f, d] for f in range(6)) for d in range(1, 31)]
        assert abs(r["p_high"] - np.mean(np.array(own) >= r["t"])) < 1e-9 and abs(r["p_max"] - np.mean(np.array(most) >= r["t"])) < 1e-9
    assert min(r["p_max"] for r in P.permutation_p(t, ["feature"]).collect()) == 0


def test_cluster_test(spark):
    """Masses of neighbouring features in every draw, by flooding each draw's grid."""
    rng = np.random.default_rng(7)
    n, side = 25, 8
    t = {(d, f): float(np.round(rng.normal() + (d == 0 and f in (10, 11, 18, 19, 27)) * 3, 6)) for d in range(n + 1) for f in range(side * side)}
    near = [(f, f + 1) for f in range(side * side) if f % side < side - 1] + [(f, f + side) for f in range(side * (side - 1))]
    df = spark.createDataFrame([(d, f, v) for (d, f), v in t.items()], "draw int, feature int, t double")

    def masses(d):
        open_, out = {f for f in range(side * side) if abs(t[d, f]) > 1.2}, []
        while open_:
            todo, held = [open_.pop()], []
            while todo:
                f = todo.pop()
                held.append(f)
                for g in [b for a, b in near if a == f] + [a for a, b in near if b == f]:
                    if g in open_ and t[d, g] * t[d, f] > 0:
                        open_.remove(g)
                        todo.append(g)
            out.append((min(held), 1 if t[d, held[0]] > 0 else -1, len(held), round(sum(t[d, f] for f in held), 6)))
        return out

    edges = spark.createDataFrame(near, "a int, b int")
    rows = P.cluster_test(df, 1.2, edges, n).collect()
    assert sorted((r["cluster"], r["sign"], r["size"], round(r["mass"], 6)) for r in rows) == sorted(masses(0))
    largest = {s: [max([abs(m) for _, g, _, m in masses(d) if g == s], default=0) for d in range(1, n + 1)] for s in (1, -1)}
    assert all(abs(r["p"] - np.mean(np.array(largest[r["sign"]]) >= abs(r["mass"]) - 1e-9)) < 1e-9 for r in rows)
    assert min(r["p"] for r in rows) == 0 and P.cluster_test(df.where("draw = 0"), 99.0, edges, n).count() == 0


@pytest.mark.parametrize("sent", [M.SENT, 0])
def test_silhouette(spark, sent, monkeypatch):
    monkeypatch.setattr(M, "SENT", sent)
    rng = np.random.default_rng(8)
    x, c = rng.normal(size=(60, 4)), rng.integers(0, 4, 60)
    x += c[:, None]
    c[0] = 9
    df = spark.createDataFrame([(k, int(c[k]), x[k].tolist()) for k in range(60)], "id int, cluster int, x array<double>")
    apart = ((x[:, None] - x[None]) ** 2).sum(-1)
    for r in M.silhouette(df).collect():
        k = r["id"]
        own = [j for j in range(60) if c[j] == c[k] and j != k]
        b = min(apart[k, c == o].mean() for o in set(c.tolist()) - {c[k]})
        a = apart[k, own].mean() if own else None
        assert abs(r["s"] - ((b - a) / max(a, b) if own else 0)) < 1e-9


def naive_ward(x, near, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        best = None
        for i, j in itertools.combinations(range(len(groups)), 2):
            if near is None or any((min(a, b), max(a, b)) in near for a in groups[i] for b in groups[j]):
                d = len(groups[i]) * len(groups[j]) / (len(groups[i]) + len(groups[j])) * ((x[groups[i]].mean(0) - x[groups[j]].mean(0)) ** 2).sum()
                if best is None or d < best[0]:
                    best = (d, i, j)
        groups[best[1]] += groups.pop(best[2])
    return {i: min(g) for g in groups for i in g}


def test_ward(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(26, 3)) + rng.integers(0, 3, (26, 1)) * 3
    df = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "id long, x array<double>")
    every = spark.createDataFrame(list(itertools.combinations(range(26), 2)), "a long, b long")
    for k in (1, 5):
        assert {r["id"]: r["cluster"] for r in M.ward(df, every, k).collect()} == naive_ward(x, None, k)
    alone = M.ward(df.limit(3), every.limit(0), 2).collect()
    assert len(alone) == 3 and all(r["id"] == r["cluster"] for r in alone)


def test_separable(spark):
    """The first pair of singular vectors."""
    rng = np.random.default_rng(10)
    maps = {u: np.outer(rng.normal(size=7), rng.normal(size=5)) * 2 + rng.normal(size=(7, 5)) * 0.4 for u in range(3)}
    df = spark.createDataFrame([(u, i, j, float(m[i, j])) for u, m in maps.items() for i in range(7) for j in range(5)], "unit int, x int, y int, v double").repartition(3)
    along_x, along_y = (d.toPandas() for d in U.separable(df))
    for u, m in maps.items():
        left, size, right = np.linalg.svd(m)
        a = along_x[along_x["unit"] == u].sort_values("x")["u"].to_numpy()
        b = along_y[along_y["unit"] == u].sort_values("y")["w"].to_numpy()
        assert np.allclose(np.outer(a, b), size[0] * np.outer(left[:, 0], right[0]), atol=1e-6) and abs(np.linalg.norm(a) - 1) < 1e-9


@pytest.mark.parametrize("width", [None, 10, 37, 4000])
def test_duplicates_over_stretches(spark, width):
    """What is kept depends on all that was kept before; stretches of any width give the same."""
    rng = random.Random(3)
    rows = [(c, k, t) for c in range(3) for k, t in enumerate(sorted(rng.choice([rng.randrange(400), 4 * rng.randrange(100), 1000 + rng.randrange(60)]) for _ in range(150)))]
    got = {(r["channel"], r["spike_id"]) for r in R.drop_duplicates_within(spark.createDataFrame(rows, "channel int, spike_id long, t long"), 9, width=width).collect()}
    want = set()
    for c in range(3):
        last = -(10**9)
        for _, k, t in [r for r in rows if r[0] == c]:
            if t - last > 9:
                want.add((c, k))
                last = t
    assert got == want


@pytest.mark.parametrize("width", [None, 10, 45, 4000])
def test_resolved_over_stretches(spark, width):
    """Larger spikes and busier units win, pair after pair along a channel, wherever stretches end."""
    rng = random.Random(4)
    rows = [(c, k, t, rng.randrange(5), rng.randrange(3), float(rng.randrange(9))) for c in range(2) for k, t in enumerate(sorted(rng.randrange(500) for _ in range(140)))]
    df = spark.createDataFrame(rows, "channel int, spike_id long, t long, unit int, template int, ampl double")
    sizes = pd.Series([r[3] for r in rows]).value_counts()
    want = set()
    for c in range(2):
        own = [r for r in rows if r[0] == c]
        kept = [True] * len(own)
        for i, j in itertools.combinations(range(len(own)), 2):
            if kept[i] and kept[j] and own[j][2] - own[i][2] <= 9:
                a, b = (own[i][5], own[j][5]) if own[i][4] == own[j][4] else (sizes[own[i][3]], sizes[own[j][3]])
                kept[j if b <= a else i] = False
        want |= {r[:2] for r, k in zip(own, kept, strict=True) if k}
    got = R.resolve_duplicates(df, 9, width=width)
    assert {(r["channel"], r["spike_id"]) for r in got.collect()} == want and got.columns == df.columns


def test_table_function(spark):
    rows = [(s, k, kind, 10 * k, float(k)) for s in range(2) for k, kind in enumerate("abbcaabcb")]
    spark.createDataFrame(rows, "subject int, k int, event_type string, t long, v double").createOrReplaceTempView("some_events")
    R.register_trial_functions(spark)
    out = spark.sql("SELECT * FROM trials_from(TABLE(some_events) PARTITION BY subject ORDER BY (t), 'a', 'b', subject => 'subject', copy => 'v, k')")
    assert out.columns == ["subject", "nth", "start", "end", "v", "k"] and dict(out.dtypes)["v"] == "double"
    assert sorted(tuple(r) for r in out.where("subject = 0").collect()) == [(0, 1, 0, 10, 0.0, 0), (0, 2, 50, 60, 5.0, 5)]
    assert spark.sql("SELECT * FROM trials_from(TABLE(some_events) PARTITION BY subject ORDER BY (t), 'a', 'c', longest => 15)").count() == 0
    with pytest.raises(Exception, match="missing"):
        spark.sql("SELECT * FROM trials_from(TABLE(some_events), 'a', 'b', copy => 'missing')").collect()


def test_predict(spark):
    spikes = spark.createDataFrame([(0, 5, 2.0), (1, 6, 1.0), (2, 9, 1.0)], "template int, at long, ampl double")
    templates = spark.createDataFrame([(0, 0, 0, 1.0), (0, 0, 1, -1.0), (1, 0, 0, 5.0), (1, 1, 2, 3.0)], "template int, channel int, offset int, w double")
    assert {(r["channel"], r["sample"]): r["raw"] for r in A.predict(spikes, templates).collect()} == {(0, 5): 2.0, (0, 6): 3.0, (1, 8): 3.0}


def test_detrended_line(spark):
    rng = np.random.default_rng(1)
    t = np.sort(rng.integers(0, 10**6, 200)) + 10**12
    x = 3.0 + 2e-5 * (t - 10**12) + rng.normal(size=200)
    df = spark.createDataFrame([(k % 2, int(t[k]), float(x[k]) if k % 7 else None) for k in range(200)] + [(5, 1, 2.0)], "g int, t long, x double")
    got = W.detrended(df, "x", "t", ["g"], "r").toPandas()
    for g in (0, 1):
        own = got[(got["g"] == g) & got["x"].notna()]
        fit = np.polyfit(own["t"] - 10**12, own["x"], 1)
        assert np.allclose(own["r"], own["x"] - np.polyval(fit, own["t"] - 10**12), atol=1e-8)
    assert got[got["g"] == 5]["r"].tolist() == [0.0] and pd.isna(got[got["x"].isna()]["r"]).all()
