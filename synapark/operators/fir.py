"""Linear-phase filters: windowed-sinc design, and overlap-save convolution over stretches whose halos are exactly the filter's half length."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import STRETCH, stretches

# Width of the transition band, in parts of the sampling rate over the order, that each window gives.
TRANSITION = {"rect": 0.9, "hann": 3.1, "hamming": 3.3, "blackman": 5.5}
# The cosine terms of each window.
COSINES = {"rect": (1.0,), "hann": (0.5, 0.5), "hamming": (0.54, 0.46), "blackman": (0.42, 0.5, 0.08)}


def taper(name: str, n: int, beta: float = 0.0) -> np.ndarray:
    """A symmetric window of ``n`` points; ``kaiser`` takes ``beta``."""
    t = np.arange(n) / max(1, n - 1)
    if name == "kaiser":
        return np.i0(beta * np.sqrt(np.maximum(0.0, 1 - (2 * t - 1) ** 2))) / np.i0(beta)
    return sum(a * (-1) ** k * np.cos(2 * np.pi * k * t) for k, a in enumerate(COSINES[name]))


def kaiser_beta(deviation: float) -> float:
    """Shape of a Kaiser window whose filter strays by so much at most (Kaiser's fit)."""
    decibel = -20 * np.log10(deviation)
    if decibel > 50:
        return 0.1102 * (decibel - 8.7)
    return 0.5842 * (decibel - 21) ** 0.4 + 0.07886 * (decibel - 21) if decibel > 21 else 0.0


def even_order(rate: float, transition: float, window: str = "hamming", deviation: float = 0.001) -> int:
    """The least even order whose transition band is no wider than asked."""
    share = transition / rate
    if window == "kaiser":
        raw = (max(21.0, -20 * np.log10(deviation)) - 7.95) / (2.285 * 2 * np.pi * share)
    else:
        raw = TRANSITION[window] / share
    return int(2 * np.ceil(raw / 2))


def sinc_kernel(rate: float, cut: float | tuple[float, float], kind: str = "low", order: int | None = None, transition: float | None = None, window: str = "hamming", beta: float = 0.0, scaled: str = "dc") -> np.ndarray:
    """Taps of a ``low``, ``high``, ``band`` or ``stop`` filter of an even order.

    Half the amplitude is left at each cut. ``scaled``: ``dc`` makes each low-pass
    part of unit gain at 0; ``pass`` makes the whole filter so in the middle of its (first) passband.
    """
    if order is None:
        order = even_order(rate, transition or min(np.atleast_1d(cut)) / 2, window)
    if order < 2 or order % 2:
        raise ValueError("the order has to be even, 2 at least")
    edges = np.atleast_1d(np.array(cut, float)) / rate
    if (edges <= 0).any() or (edges >= 0.5).any() or len(edges) != (2 if kind in ("band", "stop") else 1):
        raise ValueError("cuts have to lie between 0 and half the rate, two for a band")
    at, shape = np.arange(order + 1) - order / 2, taper(window, order + 1, beta)
    low = [2 * f * np.sinc(2 * f * at) * shape for f in edges]
    if scaled == "dc":
        low = [k / k.sum() for k in low]
    whole = (at == 0).astype(float)  # lets everything through
    taps = {"low": lambda: low[0], "high": lambda: whole - low[0], "band": lambda: low[1] - low[0], "stop": lambda: whole - low[1] + low[0]}[kind]()
    if scaled == "pass":
        middle = {"low": 0.0, "high": 0.5, "stop": 0.0, "band": edges.mean()}[kind]
        taps = taps / abs(np.sum(taps * np.exp(-2j * np.pi * middle * at)))
    return taps


def hilbert_kernel(half: int, window: str = "hamming") -> np.ndarray:
    """Taps that turn every wave by a quarter, from about 2 / half up to 1 - 2 / half of half the rate."""
    at = np.arange(-half, half + 1)
    odd = at % 2 != 0
    return np.where(odd, 2 / (np.pi * np.where(odd, at, 1)), 0.0) * taper(window, 2 * half + 1)


def overlap_save(x: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """Convolution where the filter lies wholly on ``x``: blocks through the Fourier transform, of which the first of each, as long as the filter, are cut."""
    m, n = len(taps), len(x) - len(taps) + 1
    if n < 1:
        return np.zeros(0)
    if m < 32:
        return np.convolve(x, taps, "valid")
    size = 1 << int(np.ceil(np.log2(8 * m)))
    step = size - m + 1
    number = -(-n // step)
    long = np.zeros(number * step + m - 1)
    long[: len(x)] = x
    response, out = np.fft.rfft(taps, size), np.empty(number * step)
    blocks = np.lib.stride_tricks.sliding_window_view(long, size)[::step]
    for i in range(0, number, 64):
        done = np.fft.irfft(np.fft.rfft(blocks[i : i + 64], axis=1) * response, size, axis=1)[:, m - 1 :]
        out[i * step : i * step + done.size] = done.ravel()
    return out[:n]


def convolved(x: np.ndarray, kernels: list[np.ndarray]) -> list[np.ndarray]:
    """The same for several filters of one length; where one reaches a value that isn't there nothing comes out, and nothing else is touched."""
    lost = ~np.isfinite(x)
    if not lost.any():
        return [overlap_save(x, k) for k in kernels]
    reach = np.cumsum(np.r_[0, lost])
    m = len(kernels[0])
    hit = reach[m:] > reach[:-m]
    return [np.where(hit, np.nan, overlap_save(np.where(lost, 0.0, x), k)) for k in kernels]


def over_taps(samples: DataFrame, kernels: list[np.ndarray], combine: Callable[..., np.ndarray], value: str = "v", size: int = STRETCH) -> DataFrame:
    """``combine`` of each channel's signal and its convolutions with the kernels (of one odd length), in stretches.

    A stretch holds exactly the samples that its own ones depend on, so the result
    doesn't know where stretches end. Before a channel's first sample and behind its
    last one these two go on. Samples of a channel are numbered without gaps.
    """
    half = len(kernels[0]) // 2

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("sample", kind="stable")
        own = pdf["own"].to_numpy()
        at = np.flatnonzero(own)
        if not len(at):  # a part behind the channel's end
            return pdf[["channel", "sample", value]][own]
        x = pdf[value].to_numpy(float)
        low, high = at[0], len(x) - 1 - at[-1]
        x = np.pad(x, (half - low, half - high), mode="edge")
        out = combine(x[half : len(x) - half], *convolved(x, kernels))
        return pdf[own][["channel", "sample"]].assign(**{value: out})

    rows = stretches(samples.select("channel", "sample", F.col(value).cast("double").alias(value)), size, half)
    return rows.groupBy("channel", "part").applyInPandas(run, f"channel {samples.schema['channel'].dataType.simpleString()}, sample long, {value} double")


def filtered(samples: DataFrame, taps: np.ndarray, value: str = "v", size: int = STRETCH, direction: str = "zerophase") -> DataFrame:
    """Each channel through a filter of odd length: ``zerophase`` (its delay taken out), ``onepass`` (causal), ``twopass`` (squared gain) or ``reverse``."""
    taps = np.asarray(taps, float)
    if len(taps) % 2 == 0:
        raise ValueError("an odd number of taps is needed")
    idle = np.zeros(len(taps) - 1)  # puts a filter's first tap, which meets the present sample, in the middle
    kernel = {"zerophase": lambda: taps, "onepass": lambda: np.r_[idle, taps], "reverse": lambda: np.r_[taps[::-1], idle], "twopass": lambda: np.convolve(taps, taps[::-1])}[direction]()
    return over_taps(samples, [kernel], lambda _, y: y, value, size)


def hilbert(samples: DataFrame, kind: str = "abs", half: int = 512, value: str = "v", size: int = STRETCH, window: str = "hamming") -> DataFrame:
    """Envelope, phase or parts of the analytic signal of recordings of any length, see ``signal.hilbert`` for trials.

    The imaginary part is a filter of 2 * ``half`` + 1 taps, so the answer is that of
    the whole channel wherever stretches end. An unwrapped phase goes on across
    stretches: whole turns between neighbours are summed over the stretches before.
    """
    take = {
        "abs": np.abs, "angle": np.angle, "real": np.real, "imag": np.imag, "absreal": lambda z: np.abs(np.real(z)), "absimag": lambda z: np.abs(np.imag(z)),
        "unwrap": lambda z: np.unwrap(np.angle(z)),
    }[kind]
    out = over_taps(samples, [hilbert_kernel(half, window)], lambda x, y: take(x + 1j * y), value, size)
    if kind != "unwrap":
        return out
    turn = 2 * np.pi
    parts = out.withColumn("part", F.floor(F.col("sample") / size))
    edges = parts.groupBy("channel", "part").agg(F.min_by(value, "sample").alias("first"), F.max_by(value, "sample").alias("last"))
    w = Window.partitionBy("channel").orderBy("part")
    edges = edges.withColumn("add", F.coalesce(F.round((F.lag("last").over(w) - F.col("first")) / turn), F.lit(0.0)) * turn)
    edges = edges.select("channel", "part", F.sum("add").over(w).alias("add"))
    return parts.join(edges, ["channel", "part"]).select("channel", "sample", (F.col(value) + F.col("add")).alias(value))
