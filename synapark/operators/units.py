"""Measures of units: waveforms, correlograms, templates, and all of them in one row."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import windows as W
from .graph import written


def prominent(x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, prominences and widths (at half prominence) of the peaks of at least a prominence; a flat peak is at its first sample."""
    n = len(x)
    places, heights, widths = [], [], []
    step = np.flatnonzero(np.diff(x) != 0) + 1  # where a new level begins
    starts = np.r_[0, step]
    levels = x[starts]
    for k in range(1, len(starts) - 1):
        if not (levels[k] > levels[k - 1] and levels[k] > levels[k + 1]):
            continue
        at, top = starts[k], levels[k]
        higher = np.flatnonzero(x > top)
        left, right = higher[higher < at], higher[higher > at]
        low, high = (left[-1] if len(left) else 0), (right[0] if len(right) else n - 1)
        tall = top - max(x[low : at + 1].min(), x[at : high + 1].min())
        if tall < least or tall <= 0:
            continue
        half, i, j = top - tall / 2, at, at
        while i > low and x[i] > half:
            i -= 1
        while j < high and x[j] > half:
            j += 1
        a = i + (half - x[i]) / (x[i + 1] - x[i]) if x[i] < half else float(i)
        b = j - (half - x[j]) / (x[j - 1] - x[j]) if x[j] < half else float(j)
        places.append(at)
        heights.append(tall)
        widths.append(b - a)
    return np.array(places, int), np.array(heights, float), np.array(widths, float)


WAVE = "n_peaks int, n_troughs int, peak_before double, peak_after double, trough double, width_before double, width_after double, width_trough double, trough_at int, peak_at int, duration_us double, half_width_ms double, peak_to_trough double, first_peak_to_trough double"


def _side(x: np.ndarray, offset: int, least: float, weak: float) -> tuple[float, int, float, bool, np.ndarray]:
    """The main peak on one side of the trough: size, place, width, whether it fell short of the prominence, and all places."""
    if len(x) > 3:
        for bound, short in ((least, False), (weak, True)):
            at, tall, wide = prominent(x, bound)
            if len(at):
                best = int(tall.argmax())
                if short:
                    at, tall, wide = at[[best]], tall[[best]], wide[[best]]
                    best = 0
                main = int(x[at].argmax())
                return float(x[at[main]]), offset + int(at[main]), float(wide[best]), short, offset + at
    top = int(x.argmax())
    return float(x[top]), offset + top, np.nan, True, np.array([offset + top])


def wave_shape(x: np.ndarray, share: float, rate: float) -> tuple:
    """Peaks and troughs of one waveform, in the order of ``WAVE``.

    The trough is the largest negative peak of enough prominence (``share`` of the
    largest absolute value), else the minimum. Peaks before and after it count if
    prominent enough, else the most prominent of a hundredth, else the maximum;
    if both sides fell short, the lower side's does not count as one.
    """
    largest = np.abs(x).max() if len(x) else 0.0
    if not len(x) or not np.isfinite(x).all() or largest == 0:
        return (None, None, *[None] * 12)
    least, weak = share * largest, 0.01 * largest
    at, tall, wide = prominent(-x, least)
    n_troughs, width = (len(at), float(wide[tall.argmax()])) if len(at) else (1, np.nan)
    trough = int(at[(-x[at]).argmax()]) if len(at) else int(x.argmin())
    before = _side(x[: trough + 1], 0, least, weak)
    after = _side(x[trough:], trough, least, weak)
    lacks_before, lacks_after = before[3], after[3]
    if lacks_before and lacks_after:
        lacks_before, lacks_after = (False, True) if before[0] > after[0] else (True, False)
    if lacks_before and before[0] < least / 2:
        peaks = after[4]
    elif lacks_after and after[0] < least / 2:
        peaks = before[4]
    else:
        peaks = np.r_[before[4], after[4]]
    main = int(peaks[-1])
    above = np.flatnonzero(x >= x[trough] / 2)
    left, right = above[above < main], above[above > main]
    half = (right[0] - left[-1]) / rate * 1e3 if len(left) and len(right) else np.nan
    depth = x[trough]
    ratio = [abs(v / depth) if depth else np.nan for v in (x[main], x[: trough + 1].max())]
    lag = abs(after[1] - trough) / rate * 1e6
    return (len(peaks), n_troughs, before[0], after[0], float(depth), before[2], after[2], width, trough, main, lag, half, *ratio)


def wave_properties(wave: str, share: float = 0.2, rate: float = 30_000.0) -> Column:
    """Struct of ``WAVE`` for an array column; all null where a value is missing or the wave is flat."""

    @F.pandas_udf(WAVE)
    def run(waves: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in WAVE.split(", ")]
        out = pd.DataFrame([wave_shape(np.asarray([] if w is None else [np.nan if v is None else v for v in w], float), share, rate) for w in waves], columns=names, dtype=object)
        return out.astype({n: "Int32" if f.endswith(" int") else "float64" for n, f in zip(names, WAVE.split(", "), strict=True)})

    return run(F.col(wave).cast("array<double>"))


def acg_landmarks(acg: DataFrame, by: Sequence[str] = ("unit",), value: str = "n", bins: int = 500) -> DataFrame:
    """Suppression and refractory lag of correlograms on the grid of bins -bins..bins: rows by, bin, value.

    Suppression is the first lag from 0 on (counted from 1) that reaches the mean of
    the lags from a fifth to four fifths of the half; the refractory lag is the first
    positive one above the least value plus a (sample) deviation.
    """
    lag, x = F.col("bin"), F.col(value).cast("double")
    plateau = F.avg(F.when(lag.between(bins // 5, bins * 4 // 5), x))
    whole = acg.groupBy(*by).agg(plateau.alias("_mean"), (F.min(x) + F.stddev_samp(x)).alias("_least"))
    both = acg.join(whole, list(by))
    return both.groupBy(*by).agg(
        F.min(F.when((lag >= 0) & (x >= F.col("_mean")), lag + 1)).alias("suppression"),
        F.min(F.when((lag > 0) & (x > F.col("_least")), lag)).alias("refractory"),
    )


def decay(lags: np.ndarray, y: np.ndarray, rounds: int = 200) -> float:
    """Time constant 1 / b of the least-squares a * exp(-b * lag), by damped Gauss-Newton steps from b = 1."""
    keep = np.isfinite(y)
    lags, y = lags[keep], y[keep]
    if len(y) < 3 or not y.any():
        return float("nan")
    scale = np.abs(lags).max() or 1.0
    u = lags / scale
    a, b, damp = float(y.max()), 1.0 * scale if scale < 1 else 1.0, 1e-3
    error = lambda a, b: ((y - a * np.exp(np.clip(-b * u, -50, 50))) ** 2).sum()
    now = error(a, b)
    for _ in range(rounds):
        e = np.exp(np.clip(-b * u, -50, 50))
        slopes = np.stack([e, -a * u * e], 1)
        gram, right = slopes.T @ slopes, slopes.T @ (y - a * e)
        da, db = np.linalg.solve(gram + damp * np.diag(np.diag(gram) + 1e-12), right)
        new = error(a + da, b + db)
        if new < now:
            a, b, damp, gain = a + da, b + db, damp / 3, now - new
            now = new
            if gain < 1e-14 * (now + 1e-300):
                break
        else:
            damp *= 4
            if damp > 1e12:
                break
    return float(scale / b) if b else float("nan")


def acg_time_constants(acg: DataFrame, width: float, by: Sequence[str] = ("unit",), value: str = "n") -> DataFrame:
    """Exponential time constants of the right and the left half of correlograms, in units of ``width``; a group is one correlogram."""
    kinds = ", ".join(f"{c} {acg.schema[c].dataType.simpleString()}" for c in by)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", kind="stable")
        lag, y = pdf["bin"].to_numpy(float) * width, pdf[value].to_numpy(float)
        return pdf[list(by)].head(1).assign(tau_rise=decay(lag[lag >= 0], y[lag >= 0]), tau_decay=decay(lag[lag <= 0], y[lag <= 0]))

    return acg.groupBy(*by).applyInPandas(run, f"{kinds}, tau_rise double, tau_decay double")


def isi_measures(spikes: DataFrame, long: float, *, unit: str = "unit", t: str = "t", key: str = "spike_id") -> DataFrame:
    """Variation of intervals: cv, cv2 (mean step over mean interval), skewness (population), share of time in long ones."""
    order = W.ordered([unit], [t, key])
    x = spikes.withColumn("isi", W.interval(t, order)).withColumn("_was", F.lag("isi").over(order))
    both = F.col("isi") + F.col("_was")
    span = F.max(t) - F.min(t)
    return x.groupBy(unit).agg(
        (F.stddev_samp("isi") / F.avg("isi")).alias("cv"),
        (2 * F.avg(F.abs(F.col("isi") - F.col("_was"))) / F.nullif(F.avg(both / 2), F.lit(0.0))).alias("cv2"),
        F.skewness("isi").alias("skewness"),
        (F.coalesce(F.sum(F.when(F.col("isi") > long, F.col("isi"))), F.lit(0)) / F.nullif(span, F.lit(0))).alias("long_share"),
    )


def rate_measures(spikes: DataFrame, width: int, *, unit: str = "unit", t: str = "t") -> DataFrame:
    """Mean, Fano factor, 95th and 5th percentile (Hazen) of counts in bins of ``width`` from the unit's first spike to its last, empty ones too."""
    ends = spikes.groupBy(unit).agg(F.min(t).alias("_lo"), (F.floor((F.max(t) - F.min(t)) / width) + 1).alias("bins"))
    counts = spikes.join(ends, unit).groupBy(unit, "bins", F.floor((F.col(t) - F.col("_lo")) / width).alias("_bin")).agg(F.count("*").cast("double").alias("_n"))
    # empty bins are counted, not made
    found = counts.groupBy(unit, "bins").agg(F.sum("_n").alias("_s"), F.sum(F.col("_n") * F.col("_n")).alias("_q"), F.count("*").alias("_k"), F.sort_array(F.collect_list("_n")).alias("_v"))
    mean, n = F.col("_s") / F.col("bins"), F.col("bins")
    var = (F.col("_q") - n * mean * mean) / F.nullif(n - 1, F.lit(0))

    def percentile(p: float) -> Column:
        at = F.lit(p) * n + 0.5
        value = lambda k: F.when(k <= n - F.col("_k"), F.lit(0.0)).otherwise(F.element_at("_v", (k - (n - F.col("_k"))).cast("int")))
        low, high = F.greatest(F.lit(1), F.least(n, F.floor(at))), F.greatest(F.lit(1), F.least(n, F.floor(at) + 1))
        return value(low) + (value(high) - value(low)) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), at - F.floor(at)))

    return found.select(unit, "bins", mean.alias("mean"), (var / mean).alias("fano"), percentile(0.95).alias("p95"), percentile(0.05).alias("p5"))


def template_places(templates: DataFrame, positions: DataFrame, cut: float = 0.3) -> DataFrame:
    """Amplitude, depth, peak channel and trough-to-peak duration of templates (template, channel, wave) by channel positions (channel, y).

    A channel weighs by its peak-to-peak size, not at all below ``cut`` of the template's largest.
    """
    size = F.array_max("wave") - F.array_min("wave")
    rows = templates.select("template", "channel", "wave", size.alias("size")).join(positions, "channel")
    top = F.max("size").over(Window.partitionBy("template"))
    rows = rows.withColumn("_top", top).withColumn("_w", F.when(F.col("size") >= cut * F.col("_top"), F.col("size")).otherwise(0.0))
    low = F.array_position("wave", F.array_min("wave"))
    after = F.slice("wave", low.cast("int"), F.size("wave"))
    duration = F.array_position(after, F.array_max(after)) - 1
    out = rows.groupBy("template").agg(
        F.max("size").alias("ampl"), (F.sum(F.col("_w") * F.col("y")) / F.sum("_w")).alias("depth"), F.max(F.struct("size", (-F.col("channel")).alias("neg"), duration.alias("duration"))).alias("_x")
    )
    return out.select("template", "ampl", "depth", (-F.col("_x.neg")).alias("channel"), F.col("_x.duration").alias("duration"))


def all_properties(spikes: DataFrame, acg: DataFrame, waves: DataFrame, *, width: float, bin_ms: int, long: float, rate: float = 30_000.0) -> DataFrame:
    """A row a unit: spikes (unit, spike_id, t), correlogram (unit, bin, n), waves (unit, channel, wave) of the largest channel.

    cluster_id and phy_id (one less), acg, suppression, refractory, tau_rise, tau_decay, long_share,
    cv, cv2, skewness, duration_us, half_width_ms, the two peak ratios, n_peaks, n_troughs,
    mean, fano, p95 and p5 of the counts, channel. Units without spikes are absent.
    """
    shape = F.col("_wave")
    grid = acg.groupBy("unit").agg(F.transform(F.sort_array(F.collect_list(F.struct("bin", "n"))), lambda x: x["n"]).alias("acg"))
    waved = waves.select("unit", "channel", wave_properties("wave", rate=rate).alias("_wave"))
    waved = waved.select("unit", "channel", *[shape[c].alias(c) for c in ("duration_us", "half_width_ms", "peak_to_trough", "first_peak_to_trough", "n_peaks", "n_troughs")])
    out = isi_measures(spikes, long).join(rate_measures(spikes, bin_ms).drop("bins"), "unit")
    for part in (grid, acg_landmarks(acg), acg_time_constants(acg, width), waved):
        out = out.join(part, "unit", "left")
    return out.withColumnsRenamed({"unit": "cluster_id"}).withColumn("phy_id", F.col("cluster_id") - 1)


def separable(maps: DataFrame, by: Sequence[str] = ("unit",), x: str = "x", y: str = "y", value: str = "v", doublings: int = 6) -> tuple[DataFrame, DataFrame]:
    """The product of one profile along ``x`` and one along ``y`` that is nearest to each map: (by, x, u) of length one, and (by, y, w) with the map's strength.

    Power iteration over aggregates: the products of the map's rows, once summed, are
    squared ``doublings`` times, which stands for 2**doublings steps; the column of
    the largest diagonal is then the profile. The sign is that of its largest element.
    """
    rows = maps.select(*by, F.col(x).alias("i"), F.col(y).alias("j"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    other = rows.select(*by, F.col("i").alias("k"), "j", F.col("v").alias("z"))
    gram = rows.join(other, [*by, "j"]).groupBy(*by, "i", "k").agg(F.sum(F.col("v") * F.col("z")).alias("g"))
    for _ in range(doublings + 1):
        trace = gram.groupBy(*by).agg(F.sum(F.when(F.col("i") == F.col("k"), F.col("g"))).alias("_t"))
        gram = written(gram.join(trace, list(by)).where("_t > 0").select(*by, "i", "k", (F.col("g") / F.col("_t")).alias("g")))
        last, right = gram, gram.select(*by, F.col("i").alias("k"), F.col("k").alias("m"), F.col("g").alias("h"))
        gram = gram.join(right, [*by, "k"]).groupBy(*by, "i", "m").agg(F.sum(F.col("g") * F.col("h")).alias("g")).withColumnRenamed("m", "k")
    peak = last.where("i = k").groupBy(*by).agg(F.max_by("i", F.struct("g", "i")).alias("k"))
    column = last.join(peak, [*by, "k"])
    size = column.groupBy(*by).agg(F.sqrt(F.sum(F.col("g") * F.col("g"))).alias("_s"))
    along_x = column.join(size, list(by)).select(*by, "i", (F.col("g") / F.col("_s")).alias("u"))
    along_y = rows.join(along_x, [*by, "i"]).groupBy(*by, "j").agg(F.sum(F.col("v") * F.col("u")).alias("w"))
    return along_x.withColumnRenamed("i", x), along_y.withColumnRenamed("j", y)
