"""Structured Streaming versions of online operators; each gives what its batch form gives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.signal import run_sections, steady, welch


def blocks(stream: DataFrame, size: str, late: str = "0 seconds", by: tuple[str, ...] = ("channel",), value: str = "v", ts: str = "ts") -> DataFrame:
    """Count and mean of every block of time; rows later than ``late`` are dropped."""
    w = F.window(ts, size)
    return stream.withWatermark(ts, late).groupBy(*by, w.alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(*by, F.col("w.start").alias("start"), "n", "mean")


def overlapping(stream: DataFrame, size: str, slide: str, late: str = "0 seconds", by: tuple[str, ...] = ("channel",), value: str = "v", ts: str = "ts") -> DataFrame:
    """Blocks that begin every ``slide``."""
    w = F.window(ts, size, slide)
    return stream.withWatermark(ts, late).groupBy(*by, w.alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(*by, F.col("w.start").alias("start"), "n", "mean")


def sessions(stream: DataFrame, gap: str, late: str = "0 seconds", by: tuple[str, ...] = ("channel",), ts: str = "ts") -> DataFrame:
    """Recordings parted by breaks."""
    w = F.session_window(ts, gap)
    return stream.withWatermark(ts, late).groupBy(*by, w.alias("w")).agg(F.count("*").alias("n")).select(*by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def triggered(samples: DataFrame, triggers: DataFrame, before: int, after: int, late: str = "1 minute") -> DataFrame:
    """Samples (channel, ts, v) from ``before`` to ``after`` whole seconds around triggers (trigger, at).

    A stream-stream join needs an equality: each trigger goes to the stretches of
    time that its window touches. The watermarks bound the state on both sides.
    """
    width = before + after
    s = samples.withWatermark("ts", late).withColumn("_b", F.floor(F.unix_timestamp("ts") / width))
    at = F.unix_timestamp("at")
    t = triggers.withWatermark("at", late).withColumn("_b", F.explode(F.sequence(F.floor((at - before) / width), F.floor((at + after) / width))))
    bounds = f"ts >= at - INTERVAL {before} SECONDS AND ts < at + INTERVAL {after} SECONDS"
    return s.join(t, (s["_b"] == t["_b"]) & F.expr(bounds)).drop("_b")


def running_average(stream: DataFrame, by: tuple[str, ...] = ("channel", "offset"), value: str = "v") -> DataFrame:
    """Average over trials so far; one state row a key, whatever the number of trials."""
    return stream.groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))


def every_nth(stream: DataFrame, factor: int, first: int = 0) -> DataFrame:
    """Downsampling by the absolute sample number needs no state."""
    return stream.where((F.col("sample") - first) % factor == 0)


def _columns(stream: DataFrame) -> str:
    return f"channel {stream.schema['channel'].dataType.simpleString()}, sample long, v double"


def online_filter(stream: DataFrame, sos: np.ndarray) -> DataFrame:
    """A causal filter over each channel's samples; its delay line is the state between batches.

    Rows of a batch are ordered by sample; a sample that comes after later ones
    were filtered is dropped, as a filter that runs forward has it.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("sample", kind="stable")
        last, line = (state.get[0], np.array(state.get[1]).reshape(len(sos), 2)) if state.exists else (None, None)
        if last is not None:
            rows = rows[rows["sample"] > last]
        if not len(rows):
            return
        x = rows["v"].to_numpy(float)
        y, line = run_sections(sos, x, steady(sos, x[0]) if line is None else line)
        state.update((int(rows["sample"].iloc[-1]), line.ravel().tolist()))
        yield pd.DataFrame({"channel": key[0], "sample": rows["sample"].to_numpy(), "v": y})

    return stream.groupBy("channel").applyInPandasWithState(run, _columns(stream), "last long, line array<double>", "append", GroupStateTimeout.NoTimeout)


def online_standardise(stream: DataFrame) -> DataFrame:
    """Each sample against mean and deviation of its channel's samples up to its batch."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("sample", kind="stable")
        n, s, ss = state.get if state.exists else (0, 0.0, 0.0)
        x = rows["v"].to_numpy(float)
        n, s, ss = n + len(x), s + float(x.sum()), ss + float((x * x).sum())
        state.update((n, s, ss))
        sd = np.sqrt(max(0.0, (ss - s * s / n) / max(1, n - 1)))
        yield pd.DataFrame({"channel": key[0], "sample": rows["sample"].to_numpy(), "v": (x - s / n) / sd if sd else x * 0})

    return stream.groupBy("channel").applyInPandasWithState(run, _columns(stream), "n long, s double, ss double", "append", GroupStateTimeout.NoTimeout)


def adaptive_threshold(stream: DataFrame, kept: int = 100, factor: float = 0.5) -> DataFrame:
    """-1, 0 or 1 as a value lies below, in or above mean +- factor * deviation of the last ``kept`` values."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("sample", kind="stable")
        ring = np.array(state.get[0] if state.exists else [], float)
        x = rows["v"].to_numpy(float)
        both = np.r_[ring, x]
        middle = both.mean() if len(both) else 0.0
        sums, squares = (np.r_[0.0, np.cumsum(v)] for v in (both - middle, (both - middle) ** 2))
        end = len(ring) + 1 + np.arange(len(x))
        start = np.maximum(0, end - kept)
        mean = (sums[end] - sums[start]) / (end - start)
        sd = np.sqrt(np.maximum(0.0, (squares[end] - squares[start]) / (end - start) - mean**2))
        out = (x - middle > mean + factor * sd).astype(float) - (x - middle < mean - factor * sd)
        ring = both[-kept:].tolist()
        state.update((ring,))
        yield pd.DataFrame({"channel": key[0], "sample": rows["sample"].to_numpy(), "v": out})

    return stream.groupBy("channel").applyInPandasWithState(run, _columns(stream), "ring array<double>", "append", GroupStateTimeout.NoTimeout)


def filter_and_decimate(stream: DataFrame, sos: np.ndarray, factor: int) -> DataFrame:
    return every_nth(online_filter(stream, sos), factor)


def power_estimate(stream: DataFrame, rate: float, block: int, band: tuple[float, float]) -> DataFrame:
    """Mean power density in a band (low, high] of every ``block`` samples of a channel, and the largest so far.

    What doesn't fill a block waits as state, less than a block a channel. ``sample`` is the block's first.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("sample", kind="stable")
        first, held, largest = state.get if state.exists else (int(rows["sample"].iloc[0]), [], 0.0)
        x = np.r_[np.array(held, float), rows["v"].to_numpy(float)]
        out = []
        for at in range(0, len(x) - block + 1, block):
            part = x[at : at + block]
            freq, power = welch(part - part.mean(), rate, block)
            inside = power[(freq > band[0]) & (freq <= band[1])]
            value = float(inside.mean()) if len(inside) else 0.0
            largest = max(largest, value)
            out.append((key[0], first + at, value, largest))
        done = len(out) * block
        state.update((first + done, x[done:].tolist(), largest))
        yield pd.DataFrame(out, columns=["channel", "sample", "power", "largest"])

    return stream.groupBy("channel").applyInPandasWithState(run, f"channel {stream.schema['channel'].dataType.simpleString()}, sample long, power double, largest double", "first long, held array<double>, largest double", "append", GroupStateTimeout.NoTimeout)


def after(stream: DataFrame, last: int, by: str = "sample") -> DataFrame:
    """Events behind a sample that was handled before; within one query the checkpoint's offsets keep that place."""
    return stream.where(F.col(by) > last)
