"""Neighbours in time counted without pairs, against every pair."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from synapark.operators import aligned as A
from synapark.operators import nearby as N
from synapark.plans import catalog

FOLDER = "/root/testdata/sf0.001"
#: Queries whose pairs of rows would grow with the square of the rows.
NO_PAIRS = [
    "events_in_trials",
    "binned_array",
    "padded_interaction_join",
    "aligned_rate",
    "psth",
    "psth_by_depth",
    "points_within_ranges",
    "psth_centers",
]


@pytest.mark.parametrize("name", NO_PAIRS)
def test_no_pair_is_a_row(spark, name):
    """Rows of two tables never meet in a join; a broadcast row of totals is none."""
    text = catalog.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "HashJoin" not in text and "Cartesian" not in text and "FlatMapCoGroups" in text


def tables(spark, seed):
    rng = random.Random(seed)
    own = [(i, rng.randint(-60, 60)) for i in range(60)] + [(60, None)]
    others = [(j if j % 7 else None, rng.choice("ab") if j % 9 else None, rng.randint(-60, 60)) for j in range(90)] + [(90, "a", None)]
    return own, others, spark.createDataFrame(own, "i long, t long"), spark.createDataFrame(others, "j long, kind string, at long")


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("size", [None, 3, 200])
def test_counts_sums_and_leasts(spark, closed, size):
    own, others, o, x = tables(spark, 1)
    for low, high in ((-10, 7), (0, 25), (-9, -4)):
        near, kinds = {}, {}
        for i, t in own:
            for j, kind, at in others:
                if t is not None and at is not None and low <= at - t and (at - t <= high if closed == "both" else at - t < high):
                    near.setdefault(i, []).append((at, j))
                    kinds.setdefault((i, kind), []).append(at - t)
        want = {i: (len(v), min(at for at, _ in v), min((j for _, j in v if j is not None), default=None)) for i, v in near.items()}
        got = {r["i"]: (r["n"], r["first"], r["least"]) for r in N.count_near(o, x, low, high, closed=closed, least="j", size=size).collect()}
        assert got == want
        got = {(r["i"], r["kind"]): (r["n"], r["total"]) for r in N.sum_near(o, x, low, high, "kind", closed=closed, size=size).collect()}
        assert got == {k: (len(v), sum(v)) for k, v in kinds.items()}


@pytest.mark.parametrize("closed", ["left", "both"])
def test_counts_by_gap(spark, closed):
    own, others, o, x = tables(spark, 2)
    edges = [-8, -1, 0, 5, 6]
    want = {}
    for i, t in own:
        for _, _, at in others:
            if t is not None and at is not None:
                for k in range(4):
                    if edges[k] <= t - at < edges[k + 1] or (k == 3 and closed == "both" and t - at == edges[4]):
                        want[i % 5, k] = want.get((i % 5, k), 0) + 1
    n = N.counts_by_gap(o, x, edges, closed=closed, size=11)
    key = (F.col("i") % 5).alias("key")
    assert {(r["key"], r["bin"]): r["n"] for r in N.bins_of(n, [key], 4).collect()} == want
    full = {(r["key"], r["bin"]): r["n"] for r in N.bins_of(n, [key], 4, empty=True).collect()}
    assert full == {(k, b): want.get((k, b), 0) for k in {k for k, _ in want} for b in range(4)}


def test_units_of_bins(spark):
    own, others, o, _ = tables(spark, 3)
    times = sorted({(j % 6, at) for j, (_, _, at) in enumerate(others) if at is not None})
    rows = [(u, at, max((a for v, a in times if v == u and a < at), default=None)) for u, at in times]
    want = {}
    for i, t in own:
        for u, at in times:
            if t is not None and -9 <= at - t < 12:
                want.setdefault((i, (at - t + 9) // 7), []).append(u)
    got = N.held_bins(o, spark.createDataFrame(rows, "unit long, at long, was long"), -9, 7, 3).collect()
    assert {(r["i"], r["bin"]): (r["units"], r["n"]) for r in got} == {k: (len(set(v)), len(v)) for k, v in want.items()}


@pytest.mark.parametrize("handed", [1 << 20, 5])
def test_every_unit(spark, handed, monkeypatch):
    """Units without rows nearby, without a name, rows without a time, and pieces smaller than the units."""
    monkeypatch.setattr(N, "HANDED", handed)
    own, others, o, _ = tables(spark, 4)
    rows = [(u, at) for u, (_, _, at) in enumerate(others)] + [(u % 9, at) for u, (_, _, at) in enumerate(others)] + [(None, 5)]
    got = N.every_unit(o, spark.createDataFrame(rows, "unit long, at long"), -9, 4, key="i", size=17).collect()
    want = {}
    for i, t in own:
        for u in {u for u, _ in rows}:
            gaps = [at - t for v, at in rows if v == u and u is not None and at is not None and t is not None and -9 <= at - t < 4]
            want[u, i] = (len(gaps), sum(gaps))
    assert len(got) == len(want) and {(r["unit"], r["i"]): (r["n"], r["total"]) for r in got} == want


@pytest.mark.parametrize("tile", [256, 3])
def test_every_unit_in_blocks(spark, tile, monkeypatch):
    """The same in blocks of both, some without rows, with times that many share, and without any rows."""
    monkeypatch.setattr(N, "TILE", tile)
    rng = random.Random(9)
    own = [(i, rng.choice([-40, 0, 0, 3, 55, None])) for i in range(40)]
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice([-44, -8, 0, 5, 60, None])) for _ in range(70)] + [("d", None)]
    o, x = spark.createDataFrame(own, "i long, t long"), spark.createDataFrame(rows, "unit string, at long")
    want = {}
    for i, t in own:
        for u in "a", "b", "c", "d", None:
            gaps = [at - t for v, at in rows if v == u and u is not None and at is not None and t is not None and -9 <= at - t < 6]
            want[u, i] = (len(gaps), sum(gaps))
    for blocks in ((3, 2), (7, 9)):
        got = N.every_unit(o, x, -9, 6, key="i", blocks=blocks).collect()
        assert len(got) == len(want) and {(r["unit"], r["i"]): (r["n"], r["total"]) for r in got} == want
    assert not N.every_unit(o.where("false"), x, -9, 6, key="i").count() and not N.every_unit(o, x.where("false"), -9, 6, key="i").count()


@pytest.mark.parametrize("name", ["spikes_to_trials", "cross_correlogram"])
def test_no_row_is_dealt_to_many_tasks(spark, name):
    """Rows are shuffled once and packed, not copied for all tasks that need them."""
    text = catalog.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in text and "Generate" not in text and "Sort " not in text


def test_spikes_to_trials_joins_no_pairs(spark):
    text = catalog.queries()["spikes_to_trials"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "HashJoin" not in text


@pytest.mark.parametrize("looked_at", [1 << 20, 7])
@pytest.mark.parametrize("pairs", ["all", "upper"])
def test_sparse_correlogram(spark, pairs, looked_at, monkeypatch):
    """As the other form, in one share and in many, in pieces that end inside a unit; counts are not shuffled."""
    monkeypatch.setattr(A, "LOOKED_AT", looked_at)
    rng = random.Random(6)
    s = spark.createDataFrame([(rng.randint(0, 12), k, rng.randint(-300, 900)) for k in range(250)], "unit int, spike_id long, t long")
    for lag, width in ((100, 10), (95, 190)):
        want = sorted(map(tuple, A.correlogram(s, s, lag, width, pairs=pairs).collect()))
        for shares in (1, 4, None):
            out = A.sparse_correlogram(s, s, lag, width, pairs=pairs, shares=shares)
            assert sorted(map(tuple, out.collect())) == want
    assert "HashAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_cross_correlogram_sums_no_counts(spark):
    assert "HashAggregate" not in catalog.queries()["cross_correlogram"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pairs", ["all", "upper"])
def test_sparse_correlogram_of_two_trains(spark, pairs):
    """Two trains keep their sides in every order of their shares; one without spikes has no pairs."""
    rng = random.Random(8)
    trains = [[(rng.choice("abcdefgh"), k, rng.choice([None, *range(200)])) for k in range(first, 120)] for first in (0, 30)]
    a, b = (spark.createDataFrame(rows, "unit string, spike_id long, t long") for rows in trains)
    want = Counter()
    for u, i, x in trains[0]:
        for v, j, y in trains[1]:
            if None not in (x, y) and abs(y - x) <= 40 and (u, i) != (v, j) and (pairs == "all" or u <= v):
                want[u, v, (1 if y > x else -1) * int((abs(y - x) + 3.5) // 7)] += 1
    for shares in (1, 5):
        out = A.sparse_correlogram(a, b, 40, 7, pairs=pairs, shares=shares).collect()
        assert len(out) == len(want) and {tuple(r)[:3]: r["n"] for r in out} == want
    assert not A.sparse_correlogram(a, b.where("false"), 40, 7, pairs=pairs).count()
