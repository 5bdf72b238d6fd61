"""Event-aligned counting: rasters, peri-event histograms, firing rates, correlograms."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import packed, parts, product
from .intervals import range_join


def align(spikes: DataFrame, events: DataFrame, before: float, after: float, *, t: str = "t", t0: str = "t0", closed: str = "left", on: Sequence[str] = ()) -> DataFrame:
    """Spikes of each event's window with ``rel``, their time from the event; times of events far from all spikes are cut first."""
    ranges = events.withColumns({"_s": F.col(t0) - before, "_e": F.col(t0) + after})
    found = range_join(spikes, ranges, float(before + after), t=t, start="_s", end="_e", on=on, closed=closed)
    return found.withColumn("rel", F.col(t) - F.col(t0)).drop("_s", "_e")


def bin_index(x: Column, low: float, width: float, bins: int | None = None, last_closed: bool = False) -> Column:
    """Bin of ``x`` from ``low`` on; with ``last_closed`` the last of ``bins`` takes its right edge too. Null outside."""
    raw = F.floor((x - low) / width).cast("long")
    if bins is None:
        return raw
    if last_closed:
        raw = F.when(x == low + width * bins, F.lit(bins - 1)).otherwise(raw)
    return F.when((raw >= 0) & (raw < bins), raw)


def center_bin(x: Column, low: float, width: float, bins: int) -> Column:
    """Bin by centres low, low+width, ..: edges halfway between, the outer two take the tails."""
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((x - (low - width / 2)) / width))).cast("long")


def grid(keys: DataFrame, name: str, low: int, high: int) -> DataFrame:
    """Every key with every whole number low..high."""
    return keys.withColumn(name, F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"))))


def fill(counts: DataFrame, full: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """``counts`` over the whole grid, 0 where there is none."""
    return full.join(counts, list(on), "left").withColumn(value, F.coalesce(F.col(value), F.lit(0)))


def psth(aligned: DataFrame, keys: Sequence[str], low: float, width: float, bins: int, n_events: DataFrame | None = None, per: float = 1000.0) -> DataFrame:
    """Counts by key and bin over the zero-filled grid and, with a one-row ``n_events``, the mean rate an event and second."""
    counts = aligned.withColumn("bin", bin_index(F.col("rel"), low, width, bins)).where("bin IS NOT NULL").groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    out = fill(counts, grid(aligned.select(*keys).distinct(), "bin", 0, bins - 1), [*keys, "bin"], "n")
    if n_events is not None:
        out = out.join(F.broadcast(n_events.limit(1))).withColumn("rate", F.col("n") / F.col("n_events") / F.lit(width) * per)
    return out


def hopping(aligned: DataFrame, keys: Sequence[str], low: float, high: float, step: float, size: float) -> DataFrame:
    """Counts in windows [b, b+size) that begin every ``step`` from low to below high: a row goes to each window that covers it."""
    most = int(-(-(high - low) // step)) - 1
    last = F.floor((F.col("rel") - low) / step)
    first = F.floor((F.col("rel") - low - size) / step) + 1
    first, last = F.greatest(first, F.lit(0)), F.least(last, F.lit(most))
    spread = aligned.where(first <= last).withColumn("bin", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    return spread.groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def gap_edges(lag: float, width: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Gaps at which bins end, which of them belong to the bin below, and the outermost bin's number.

    The middle bin is centred on 0, and bins mirror each other: those of positive
    gaps hold their lower edge, those of negative ones their upper edge.
    """
    most = int((lag + width / 2) // width)
    inner = np.arange(1, most + 1) * width - width / 2
    edges = np.r_[-lag, -inner[::-1], inner, lag]
    return edges, np.r_[False, np.ones(most, bool), np.zeros(most, bool), True], most


#: Pairs of spikes that a task looks at in one go, and places of a search.
LOOKED_AT = 1 << 20
#: Parts that units are dealt to where each is only counted with itself.
SHARES = 16


def correlogram(a: DataFrame, b: DataFrame, lag: float, width: float, *, pairs: str = "all", size: float | None = None) -> DataFrame:
    """Counts of t_b - t_a by unit pair and bin, for |t_b - t_a| <= lag: ``unit_a, unit_b, bin, n``.

    Columns: ``unit, spike_id, t`` on both sides. ``pairs``: ``all``, ``same`` (a unit
    with itself) or ``upper`` (unit_a <= unit_b); a spike is never paired with itself.

    A task holds a stretch of time (``size``, four lags unless given) of both
    trains, ``b`` with a halo of a lag, sorted. Binary search finds which spikes lie
    within the lag of each; where these are few their bins are counted, some at a
    time; where they are more than the bins of all units, it finds how far each bin
    reaches in each unit's times instead. No pair of spikes is ever a row: what is
    shuffled are the spikes, once with halos, and a stretch's counts.
    """
    size = float(size or 4 * lag)
    edges, right, most = gap_edges(float(lag), float(width))
    below, above, bins = edges[1 : most + 1], edges[most + 1 : -1], len(edges) - 1
    columns = ["unit_a", "unit_b", "bin", "n"]

    def reaches(times: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Spikes of one train in each bin, over all of another."""
        n = np.zeros(bins, np.int64)
        step = max(1, LOOKED_AT // len(edges))
        for k in range(0, len(at), step):
            out = np.empty((len(at[k : k + step]), len(edges)), np.int64)
            for side in (False, True):
                some = np.flatnonzero(right == side)
                out[:, some] = np.searchsorted(times, at[k : k + step, None] + edges[some], "right" if side else "left")
            n += np.diff(out, axis=1).sum(0)
        return n

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        units, code = np.unique(pdf["unit"].to_numpy(), return_inverse=True)
        pdf = pdf.assign(code=code)
        by = ["code", "t"] if pairs == "same" else ["t"]
        own, other = (pdf[pdf["own"] == side].sort_values(by, kind="stable") for side in (True, False))
        ca, cb, ta, tb, ia, ib = (df[c].to_numpy() for c in ("code", "t", "spike_id") for df in (own, other))
        if not len(ta) or not len(tb):
            return pd.DataFrame({c: [] for c in columns})
        if pairs == "same":
            lo, hi = np.zeros(len(ta), np.int64), np.zeros(len(ta), np.int64)
            cut_a, cut_b = (np.searchsorted(c, np.arange(len(units) + 1)) for c in (ca, cb))
            for i, j, p, q in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:], strict=True):
                lo[i:j], hi[i:j] = p + np.searchsorted(tb[p:q], ta[i:j] - lag, "left"), p + np.searchsorted(tb[p:q], ta[i:j] + lag, "right")
        else:
            lo, hi = np.searchsorted(tb, ta - lag, "left"), np.searchsorted(tb, ta + lag, "right")
        near, found = np.cumsum(hi - lo), []
        if near[-1] <= len(ta) * len(edges) * (1 if pairs == "same" else len(np.unique(cb))):
            i = 0
            while i < len(ta):
                j = max(i + 1, int(np.searchsorted(near, (near[i - 1] if i else 0) + LOOKED_AT, "right")))
                many = hi[i:j] - lo[i:j]
                x = np.repeat(np.arange(i, j), many)
                y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many - lo[i:j], many)
                keep = (ca[x] != cb[y]) | (ia[x] != ib[y])
                x, y = (x[keep], y[keep]) if pairs != "upper" else (x[keep & (ca[x] <= cb[y])], y[keep & (ca[x] <= cb[y])])
                gap = tb[y] - ta[x]
                at = np.searchsorted(below, gap, "left") + np.searchsorted(above, gap, "right")
                found.append(np.unique((ca[x] * len(units) + cb[y]) * bins + at, return_counts=True))
                i = j
        else:
            first, second = ({k: train[c == k] for k in np.unique(c).tolist()} for train, c in ((ta, ca), (tb, cb)))
            for x, at in first.items():
                for y, times in second.items():
                    if pairs == "all" or x == y or (pairs == "upper" and x < y):
                        n = reaches(times, at)
                        if x == y:
                            n[most] -= np.isin(ia[ca == x], ib[cb == y]).sum()
                        found.append(((x * len(units) + y) * bins + np.arange(bins), n))
        key, which = np.unique(np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)]), return_inverse=True)
        n = np.bincount(which, np.concatenate([f[1] for f in found] or [np.zeros(0)]), len(key)).astype(np.int64)
        key, n = key[n > 0], n[n > 0]
        return pd.DataFrame({"unit_a": units[key // bins // len(units)], "unit_b": units[key // bins % len(units)], "bin": key % bins - most, "n": n})

    def side(df: DataFrame, own: bool) -> DataFrame:
        low, high = (F.col("t"), F.col("t")) if own else (F.col("t") - lag, F.col("t") + lag)
        parts = F.explode(F.sequence(F.floor(low / size).cast("long"), F.floor(high / size).cast("long")))
        share = F.pmod(F.xxhash64("unit"), F.lit(SHARES)) if pairs == "same" else F.lit(0).cast("long")
        return df.select("unit", "spike_id", "t", parts.alias("part"), share.alias("share"), F.lit(own).alias("own"))

    unit = a.schema["unit"].dataType.simpleString()
    counts = side(a, True).unionByName(side(b, False)).groupBy("part", "share").applyInPandas(count, f"unit_a {unit}, unit_b {unit}, bin long, n long")
    return counts.groupBy("unit_a", "unit_b", "bin").agg(F.sum("n").alias("n"))


def sparse_correlogram(a: DataFrame, b: DataFrame, lag: float, width: float, *, pairs: str = "all", shares: int | None = None) -> DataFrame:
    """``correlogram`` (``all`` or ``upper``) where units are many and most counts are of one pair or two.

    There counts are nearly as many as pairs, and summing them over stretches would shuffle
    them all. So units are dealt to shares, and a task has all times of two shares:
    its counts are final. It goes through the first train unit by unit, in pieces of
    ``LOOKED_AT`` pairs, whose counts follow by unit and bin, so that files hold runs; what
    it holds are its spikes and one piece. A share is written
    once and packed (``blocks.py``), however many others it meets; shares (by the root of
    the spikes unless given) of one train meet in one order only where ``upper`` is asked.
    """
    edges, _, most = gap_edges(float(lag), float(width))
    below, above, bins, looked_at = edges[1 : most + 1], edges[most + 1 : -1], len(edges) - 1, LOOKED_AT
    once = pairs == "upper" and a is b
    a, b = (df.where("unit IS NOT NULL AND t IS NOT NULL").select("unit", "spike_id", "t") for df in (a, b))
    shares = shares or parts(a.count())
    names, kind = ["unit_a", "unit_b", "bin", "n"], a.schema["unit"].dataType.simpleString()

    def made(left: pa.Table, right: pa.Table, same: bool) -> Iterator[pa.RecordBatch]:
        (ua, ta, ia), (ub, tb, ib) = ([x.column(c).to_numpy() for c in ("unit", "t", "spike_id")] for x in (left, right))
        units, code = np.unique(np.concatenate([ua, ub]), return_inverse=True)
        first, second = np.lexsort((ta, code[: len(ua)])), np.argsort(tb, kind="stable")
        ca, ta, ia, cb, tb, ib = code[first], ta[first], ia[first], code[len(ua) :][second], tb[second], ib[second]
        # two shares of one train hold no unit both, and meet once: pairs whose units stand the other way round are turned
        turned = once and not same
        lo, hi = np.searchsorted(tb, ta - lag, "left"), np.searchsorted(tb, ta + lag, "right")
        near, last = np.cumsum(hi - lo), np.searchsorted(ca, ca, "right")
        i, keys, counts, kind = 0, np.zeros(0, np.int64), np.zeros(0, np.int64), left.schema.field("unit").type

        while i < len(ta):
            j = max(i + 1, int(np.searchsorted(near, (near[i - 1] if i else 0) + looked_at, "right")))
            many = hi[i:j] - lo[i:j]
            x = np.repeat(np.arange(i, j), many)
            y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many - lo[i:j], many)
            if not turned:
                keep = (ca[x] != cb[y]) | (ia[x] != ib[y])
                if pairs == "upper":
                    keep &= ca[x] <= cb[y]
                x, y = x[keep], y[keep]
            gap = tb[y] - ta[x]
            at = np.searchsorted(below, gap, "left") + np.searchsorted(above, gap, "right")
            some, n = np.unique((ca[x] * bins + at) * len(units) + cb[y], return_counts=True)
            if len(keys):
                keys, which = np.unique(np.r_[keys, some], return_inverse=True)
                counts = np.bincount(which, np.r_[counts, n], len(keys)).astype(np.int64)
            else:
                keys, counts = some, n
            # all but the unit that goes on in the next piece is done
            done = len(keys) if j == len(ta) or last[j - 1] == j else int(np.searchsorted(keys, ca[j - 1] * len(units) * bins, "left"))
            k, n, keys, counts = keys[:done], counts[:done], keys[done:], counts[done:]
            one, other, at = k // (bins * len(units)), k % len(units), k // len(units) % bins - most
            turn = one > other if turned else np.zeros(len(k), bool)
            for some, p, q, sign in ((~turn, one, other, 1), (turn, other, one, -1)):
                if some.any():
                    yield pa.RecordBatch.from_arrays([pa.array(units[p[some]], kind), pa.array(units[q[some]], kind), pa.array(sign * at[some], pa.int64()), pa.array(n[some], pa.int64())], names=names)
            i = j

    left, right = (packed(df.repartition(shares, "unit"), shares, side) for df, side in ((a, "a"), (b, "b")))
    fields = f"unit_a {kind}, unit_b {kind}, bin long, n long"
    return product(left, right, made, fields, F.col("a_block") <= F.col("b_block") if once else None)


def correlogram_norms(counts: DataFrame, spikes: DataFrame, span: DataFrame, width: float) -> DataFrame:
    """Counts (unit_a, unit_b, bin, n) as rates: ``hz`` by spikes of a and bin width, ``hz2`` by recorded time and width, ``scaled`` by what chance gives.

    ``spikes`` has unit and spikes; ``span`` is one row with the recorded time in the unit of ``width``.
    """
    a = spikes.select(F.col("unit").alias("unit_a"), F.col("spikes").alias("_a"))
    b = spikes.select(F.col("unit").alias("unit_b"), F.col("spikes").alias("_b"))
    rows = counts.join(a, "unit_a").join(b, "unit_b").join(F.broadcast(span.limit(1)))
    out = rows.withColumns({"hz": F.col("n") / (F.col("_a") * width), "hz2": F.col("n") / (F.col("span") * width), "scaled": F.col("n") * F.col("span") / (F.lit(width) * F.col("_a") * F.col("_b"))})
    return out.drop("_a", "_b", "span")


def subtract_template(series: DataFrame, marks: DataFrame, before: int, after: int, template: DataFrame | None = None, on: Sequence[str] = ("channel",)) -> DataFrame:
    """``series`` (.., sample, v) without a template at each mark (.., at); by default the template is the mean around all marks.

    Where windows overlap all their templates go. Samples apart from marks stay as they are.
    """
    spread = marks.select(*on, "at", F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("offset")).withColumn("sample", F.col("at") + F.col("offset"))
    if template is None:
        template = spread.join(series, [*on, "sample"]).groupBy("offset").agg(F.avg("v").alias("template"))
    gone = spread.join(template.select("offset", "template"), "offset").groupBy(*on, "sample").agg(F.sum("template").alias("_gone"))
    return series.join(gone, [*on, "sample"], "left").withColumn("v", F.col("v") - F.coalesce("_gone", F.lit(0.0))).drop("_gone")


def triggered(series: DataFrame, events: DataFrame, before: int, after: int, *, every: int = 1, on: Sequence[str] = ()) -> DataFrame:
    """Samples around each event's sample, by exploded offsets and an equi-join: ``offset`` and the sample's columns."""
    spread = events.withColumn("offset", F.explode(F.sequence(F.lit(-before), F.lit(after), F.lit(every)))).withColumn("sample", F.col("at") + F.col("offset"))
    return spread.join(series, [*on, "sample"])


def predict(spikes: DataFrame, templates: DataFrame) -> DataFrame:
    """``channel, sample, raw``: the sum of all spikes' templates times their amplitudes.

    Spikes: template, at, ampl; templates: template, channel, offset, w. A spike is
    its template's samples, which are summed where they were made before they move; samples that no template reaches aren't made.
    """
    spread = spikes.join(templates, "template").select("channel", (F.col("at") + F.col("offset")).alias("sample"), (F.col("ampl") * F.col("w")).alias("_w"))
    return spread.groupBy("channel", "sample").agg(F.sum("_w").alias("raw"))
