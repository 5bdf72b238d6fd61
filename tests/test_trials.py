"""Trials, duplicates and fits."""

import random

import numpy as np
from pyspark.sql import functions as F

from synapark.operators import models as M
from synapark.operators import trials as R


def test_duplicates_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 2), k, rng.randint(0, 400)) for k in range(200)]
    got = {r["spike_id"] for r in R.drop_duplicates_within(spark.createDataFrame(rows, "channel int, spike_id long, t long"), 5).collect()}
    want, last = set(), {}
    for c, k, t in sorted(rows, key=lambda r: (r[2], r[1])):
        if t - last.get(c, -(10**9)) > 5:
            want.add(k)
            last[c] = t
    assert got == want


def test_random_rows(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    out = R.random_per_group(df, ["g"], 7, "id")
    assert out.groupBy("g").count().where("count = 7").count() == 3 and sorted(out.collect()) == sorted(R.random_per_group(df, ["g"], 7, "id").collect())


def test_registered_trial_functions(spark):
    events = spark.createDataFrame([("a", 10), ("b", 20), ("a", 95)], "event_type string, t long")
    got = R.TRIAL_FUNCTIONS["around_events"](events, ["a", "b"], 5, 5).collect()
    assert [(r["start"], r["end"]) for r in got] == [(15, 25)]  # the others reach past the recording


def test_least_squares(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = 1 + x @ [2.0, -3.0]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)], "a double, b double, y double")
    assert np.allclose(M.least_squares(df, "y", ["a", "b"]), [1, 2, -3])


def test_event_kernels(spark):
    v = np.zeros(200)
    events = [("x", 20), ("x", 60), ("y", 62), ("y", 120)]
    for kind, at in events:
        for lag, w in enumerate((1.0, 2.0, 3.0) if kind == "x" else (-1.0, 0.5, 4.0)):
            v[at + lag] += w
    found = M.event_kernels(spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "sample int, v double"), spark.createDataFrame(events, "kind string, sample int"), [0, 1, 2])
    assert np.allclose([found[k, i] for k in "xy" for i in range(3)], [1, 2, 3, -1, 0.5, 4])


def test_regress_out(spark):
    rng = np.random.default_rng(2)
    ref, own = rng.normal(size=100), rng.normal(size=100)
    own -= own.mean() + ((own - own.mean()) @ (ref - ref.mean())) / ((ref - ref.mean()) @ (ref - ref.mean())) * (ref - ref.mean())
    samples = spark.createDataFrame([(0, i, float(own[i] + 5 * ref[i])) for i in range(100)], "channel int, sample int, v double")
    out = M.regress_out(samples, spark.createDataFrame([(i, float(ref[i])) for i in range(100)], "sample int, r double"), ["r"]).orderBy("sample").toPandas()
    assert np.abs(out["v"] - out["v"].mean() - own).max() < 1e-9


def test_components_and_clusters(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(30, 4)), rng.normal(size=(30, 4)) + 20])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i int, x array<double>")
    first = np.array([r["pc"][0] for r in M.components(df, k=2).orderBy("i").collect()])
    assert abs(first[:30].mean() - first[30:].mean()) > 30
    labels = [r["cluster"] for r in M.clusters(df, 2).orderBy("i").collect()]
    assert len(set(labels[:30])) == len(set(labels[30:])) == 1 and labels[0] != labels[30]
