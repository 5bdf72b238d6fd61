"""Small operators and sinks that no other test names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from synapark.functions import scalar as X
from synapark.operators import nested as N
from synapark.operators import units as U
from synapark.plans import catalog
from synapark.plans import tables as T
from synapark.sources import sinks as K
from synapark.streaming import stream as R


def test_gaussian_cut(spark):
    got = [r["y"] for r in spark.createDataFrame([(float(x),) for x in range(-3, 8)], "x double").select(X.gaussian_cut(F.col("x"), 2.0, 1.0, 1.5, 0.0).alias("y")).collect()]
    assert np.allclose(got, [0.0 if x < 0 else 2 * np.exp(-((x - 1) ** 2) / 4.5) for x in range(-3, 8)])


def test_every_nth(spark):
    got = R.every_nth(spark.range(20).withColumnRenamed("id", "sample"), 6, 2)
    assert [r["sample"] for r in got.orderBy("sample").collect()] == [2, 8, 14]


def test_spike_spectrum(spark):
    """Each whole window of 33 samples round a mark, by numpy's transform of three sine tapers."""
    folder = "/root/testdata/sf0.001"
    rows = T.samples(spark, folder).toPandas().sort_values(["channel", "sample"])
    series = {c: p["v"].to_numpy() for c, p in rows.groupby("channel")}
    marks = {((r["user_id"] % 100), r["depth"]) for r in T.events(spark, folder).where("event_type = 'error'").collect()}
    k = np.arange(1, 34)
    bank = np.array([np.sin(np.pi * (m + 1) * k / 34) for m in range(3)])
    bank /= np.linalg.norm(bank, axis=1, keepdims=True)
    want = {}
    for c, at in marks:
        if c in series and at is not None and at - 16 >= 1 and at + 16 <= len(series[c]):
            x = series[c][at - 17 : at + 16]
            for f, p in zip(np.fft.rfftfreq(33, 1e-3), (np.abs(np.fft.rfft(bank * (x - x.mean()), axis=1)) ** 2).mean(0), strict=True):
                want[(c << 40) + at, round(f, 4)] = p
    got = {(r["trial"], r["freq"]): r["power"] for r in catalog.queries()["spike_spectrum"](spark, folder).collect()}
    assert got.keys() == want.keys() and len(want) > 0 and all(abs(got[key] - want[key]) < 1e-4 for key in want)


def test_acg_time_constants(spark):
    lags = np.arange(-40, 41)
    rows = [(u, int(k), 50 * np.exp(-abs(k) * 2.0 / tau)) for u, tau in ((1, 12.0), (2, 30.0)) for k in lags]
    got = {r["unit"]: (r["tau_rise"], r["tau_decay"]) for r in U.acg_time_constants(spark.createDataFrame([(u, k, float(n)) for u, k, n in rows], "unit int, bin int, n double"), 2.0).collect()}
    for unit, tau in ((1, 12.0), (2, 30.0)):
        assert abs(got[unit][0] - tau) < 1e-3 and abs(abs(got[unit][1]) - tau) < 1e-3


def test_small_tables(spark, tmp_path):
    K.write_label(spark.createDataFrame([(3, 0.5), (1, 2.0)], "unit int, snr double"), "unit", "snr", str(tmp_path))
    assert (tmp_path / "cluster_snr.tsv").read_text() == "cluster_id\tsnr\n1\t2.0\n3\t0.5\n"
    K.write_params(str(tmp_path), dat_path="a.bin", n_channels_dat=4, hp_filtered=False)
    assert (tmp_path / "params.py").read_text() == "dat_path = 'a.bin'\nn_channels_dat = 4\nhp_filtered = False\n"
    with pytest.raises(ValueError, match="over 5 rows"):
        K.write_table(spark.range(6), str(tmp_path / "x.tsv"), most=5)


def test_iso_micros(spark):
    day = 19_782 * 86_400_000_000  # 2024-02-29
    cases = {
        "2024-02-29T12:30:05Z": day + 45_005_000_000, "2024-02-29 12:30:05.5+02:00": day + 37_805_500_000, "2024-02-29T12:30-0530": day + 64_800_000_000, "2024-02-29T123005,1234567": day + 45_005_123_456,
        "2024-02-29T00:15+01": day - 2_700_000_000, " 2024-02-29T00:00:00z ": day, "2023-02-29T00:00": None, "2024-02-29T24:00": None, "2024-02-29": None, "2024-02-29T12:30:05 CET": None, "": None, None: None,
    }
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(cases)], "k int, t string").select("k", X.iso_micros(F.col("t")).alias("m")).orderBy("k").collect()
    assert [r["m"] for r in rows] == list(cases.values())


def test_dynamic_round_trip(spark):
    """Ragged columns as flat values and ends, and back with every type; several tasks and stretches."""
    rng = np.random.default_rng(3)
    rows = [(int(k), float(k) / 3, rng.integers(0, 9, int(n)).tolist(), [f"u{j}" for j in range(int(m))], bool(k % 2)) for k, n, m in zip(range(300), rng.integers(0, 4, 300), rng.integers(0, 3, 300), strict=True)]
    df = spark.createDataFrame(rows, "k int, x double, spikes array<int>, tags array<string>, good boolean").repartition(5)
    table = N.to_dynamic(df, ["k"])
    held = table.rows.orderBy("id").collect()
    assert [r["spikes_index"] for r in held] == np.cumsum([len(r[2]) for r in rows]).tolist() and [r["id"] for r in held] == list(range(300))
    flat = [r["value"] for r in table.data["tags"].orderBy("k").collect()]
    assert flat == [t for r in rows for t in r[3]] and "spikes" not in table.rows.columns
    for width in (7, 1 << 16):
        back = N.from_dynamic(table, width)
        assert back.dtypes == df.dtypes and sorted(tuple(r) for r in back.collect()) == sorted((a, b, c, d, e) for a, b, c, d, e in rows)
    none = N.from_dynamic(N.to_dynamic(spark.createDataFrame([(1, None), (2, [])], "k int, v array<long>"), ["k"]))
    assert sorted(tuple(r) for r in none.collect()) == [(1, []), (2, [])]
