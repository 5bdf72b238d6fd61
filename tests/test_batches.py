"""Trials worked on together: no call a trial, and the same results whatever the batch."""

import numpy as np
import pytest

from synapark.operators import signal as S
from synapark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
BATCHED = ["gappy_spectrum", "paired_trials", "superlets", "wavelet_power", "phase_linearity", "multitaper_spectrum"]


@pytest.mark.parametrize("name", BATCHED)
def test_no_call_a_trial(spark, name):
    text = catalog.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in text and "MapInArrow" in text


def test_gappy_fits_one_by_one(spark):
    """Trials of several lengths and gaps in one batch, sparse ones whose fits are nearly or wholly singular, and an empty one."""
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for trial in range(30):
        n = 16 if trial % 3 else 9
        x = rng.normal(size=n)
        x[rng.random(n) < (0.2, 0.8, 0.95, 0.5)[trial % 4]] = np.nan
        if trial == 29:
            x[:] = np.nan
        rows += [(trial, 0, k, None if np.isnan(v) else float(v)) for k, v in enumerate(x)]
        there = np.isfinite(x)
        for k in range(n // 2 + 1):
            turn = 2 * np.pi * k * np.arange(n)[there] / n
            base = np.stack([np.cos(turn), np.zeros(there.sum()) if k == 0 or 2 * k == n else np.sin(turn)], 1)
            a, b = np.linalg.lstsq(base, x[there], rcond=None)[0] if there.any() else (np.nan, np.nan)
            want[trial, k] = (a, -b)
    got = S.gappy_spectrum(spark.createDataFrame(rows, "trial int, channel int, sample long, v double"), 1.0).collect()
    assert len(got) == len(want)
    for r in got:
        n = 16 if r["trial"] % 3 else 9
        assert np.allclose((r["re"], r["im"]), want[r["trial"], round(r["freq"] * n)], atol=1e-8, equal_nan=True)


#: Queries whose tasks must grow in number with the rows, or each would hold ever more.
DEALT = ["fill_gaps", "band_interpolated", "spike_interpolated", "median_filter_padded", "threshold_crossings", "spaced_peaks", "kernel_smooth", "selection_slabs", "directed_transfer", "partial_directed"]


@pytest.mark.parametrize("name", DEALT)
def test_tasks_grow_with_rows(spark, name, monkeypatch):
    """With room for 300 rows a task the 6,000 items take 20 tasks, not the session's 4; the rows stay the same."""
    import pandas as pd

    from synapark.plans import tables

    few = catalog.queries()[name](spark, FOLDER)
    monkeypatch.setattr(tables, "ROWS", 300)
    many = catalog.queries()[name](spark, FOLDER)
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    a, b = (df.toPandas().sort_values(list(df.columns)).reset_index(drop=True) for df in (few, many))
    pd.testing.assert_frame_equal(a, b)
