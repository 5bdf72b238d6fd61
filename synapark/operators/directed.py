"""Directed influence between channels: autoregressive fits from lagged sums, transfer functions, shares of influence."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .signal import analytic, over_trials


def vectors(samples: DataFrame, channels: Sequence, keys: Sequence[str], value: str = "v", channel: str = "channel") -> DataFrame:
    """Rows of ``keys`` with an array ``x`` of the listed channels' values; a row that lacks one isn't made."""
    found = samples.where(F.col(channel).isin(*channels)).groupBy(*keys).agg(*[F.max(F.when(F.col(channel) == c, F.col(value))).cast("double").alias(f"_{k}") for k, c in enumerate(channels)])
    return found.select(*keys, F.array(*[f"_{k}" for k in range(len(channels))]).alias("x")).where(~F.exists("x", F.isnull))


def _kinds(df: DataFrame, by: Sequence[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)


def gram(rows: DataFrame, by: Sequence[str], z: str = "z") -> DataFrame:
    """``n``, ``total`` and ``gram``: how many rows a group has, the sum of their arrays, and of the products of all pairs of elements, row by row.

    A task multiplies what it reads, a batch at a time, and elements are added up
    where they were made before they are shuffled: what moves doesn't grow with the rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in batch.groupby(list(by), sort=False, dropna=False) if by else [((), batch)]:
                if len(part):
                    m = np.stack(part[z].to_numpy()).astype(float)
                    sums = np.r_[float(len(m)), m.sum(0), (m.T @ m).ravel()]
                    out = pd.DataFrame({"at": np.arange(len(sums)), "s": sums})
                    for name, k in zip(by, key, strict=True):
                        out[name] = [k] * len(out)
                    yield out[[*by, "at", "s"]]

    parts = rows.select(*by, z).mapInPandas(run, f"{_kinds(rows, by)}at int, s double")
    sums = parts.groupBy(*by, "at").agg(F.sum("s").alias("s"))
    whole = sums.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", "s"))).alias("x")).withColumn("s", F.col("x.s"))
    width = ((F.sqrt(4 * F.size("s") - 3) - 1) / 2).cast("int")  # of 1 + w + w * w sums
    return whole.select(*by, F.col("s")[0].cast("long").alias("n"), F.slice("s", 2, width).alias("total"), F.slice("s", width + 2, width * width).alias("gram"))


def lagged(rows: DataFrame, order: int, trial: Sequence[str], x: str = "x", t: str = "sample", padded: bool = False) -> DataFrame:
    """``z``: each row's array with those of the ``order`` rows before it in its trial; first rows go, or take zeros for what is before the trial (``padded``)."""
    w = Window.partitionBy(*trial).orderBy(t)
    zero = F.transform(F.col(x), lambda v: v * 0)
    past = [F.coalesce(F.lag(x, k).over(w), zero) if padded else F.lag(x, k).over(w) for k in range(1, order + 1)]
    made = rows.withColumn("z", F.concat(x, *past))
    return made.where("z IS NOT NULL")


def least_squares(n: int, sums: np.ndarray, p: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (order, p, p) and noise covariance that leave the least squares, from the products of z."""
    y, past = sums[:p, :p], sums[p:, p:]
    both = sums[:p, p:]
    a = both @ np.linalg.pinv(past)
    return a.reshape(p, order, p).transpose(1, 0, 2), (y - a @ both.T) / n


def levinson(covariances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (order, p, p) and noise covariance from the covariances of lags 0.. order (x now, x before), by block recursion.

    Each order adds one coefficient ahead and one back from what the last order's
    predictions leave; the fit of a stationary model is always stable.
    """
    r = np.asarray(covariances, float)
    p = r.shape[1]
    ahead, back = np.zeros((0, p, p)), np.zeros((0, p, p))
    noise, noise_back = r[0].copy(), r[0].copy()
    for m in range(1, len(r)):
        left = r[m] - sum((ahead[k] @ r[m - 1 - k] for k in range(m - 1)), np.zeros((p, p)))
        new, new_back = left @ np.linalg.pinv(noise_back), left.T @ np.linalg.pinv(noise)
        ahead, back = np.concatenate([ahead - new @ back[::-1], new[None]]), np.concatenate([back - new_back @ ahead[::-1], new_back[None]])
        noise, noise_back = noise - new @ left.T, noise_back - new_back @ left
    return ahead, noise


def fit(rows: DataFrame, order: int, by: Sequence[str], trial: Sequence[str], x: str = "x", t: str = "sample", method: str = "least_squares") -> DataFrame:
    """An autoregressive model a group: ``n, p, a`` (coefficients by lag, to, from), ``noise``, and ``gram`` for the models inside it.

    ``least_squares`` fits the rows that have all their past; ``levinson`` solves for
    the covariances of whole trials, and is stable. ``trial`` names the columns, ``by`` among them, that bound a trial.
    """
    sums = gram(lagged(rows, order, trial, x, t, method == "levinson"), by)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for n, flat in zip(batch["n"], batch["gram"], strict=True):
                size = int(np.sqrt(len(flat)))
                p, m = size // (order + 1), np.asarray(flat, float).reshape(size, size)
                if method == "levinson":
                    a, noise = levinson(np.stack([m[:p, k * p : (k + 1) * p] for k in range(order + 1)]) / n)
                else:
                    a, noise = least_squares(n, m, p, order)
                out.append((p, a.ravel(), noise.ravel()))
            yield batch[[*by, "n", "gram"]].assign(p=[o[0] for o in out], a=[o[1] for o in out], noise=[o[2] for o in out])

    return sums.mapInPandas(run, f"{_kinds(sums, by)}n long, gram array<double>, p int, a array<double>, noise array<double>")


def _over_models(models: DataFrame, by: Sequence[str], fields: str, f: Callable[[dict], pd.DataFrame]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                out = f(row)
                for name in by:
                    out[name] = [row[name]] * len(out)
                yield out

    return models.mapInPandas(run, f"{fields}{''.join(f', `{c}` {models.schema[c].dataType.simpleString()}' for c in by)}")


def _waves(row: dict, freqs: np.ndarray, rate: float) -> np.ndarray:
    """What the coefficients leave of a channel at each frequency: (frequency, to, from)."""
    p = int(row["p"])
    a = np.asarray(row["a"], float).reshape(-1, p, p)
    turn = np.exp(-2j * np.pi * np.outer(freqs / rate, np.arange(1, len(a) + 1)))
    return np.eye(p) - np.tensordot(turn, a, 1)


def transfer(models: DataFrame, by: Sequence[str], freqs: Sequence[float], rate: float) -> DataFrame:
    """``freq, to, from`` with the transfer function ``h``, the coefficients' transform ``c`` and the cross-spectrum ``s``, each as real and imaginary part."""
    at = np.array(freqs, float)

    def run(row: dict) -> pd.DataFrame:
        c = _waves(row, at, rate)
        h = np.linalg.inv(c)
        p = c.shape[1]
        s = h @ np.asarray(row["noise"], float).reshape(p, p) @ h.conj().transpose(0, 2, 1)
        f, i, j = (k.ravel() for k in np.meshgrid(np.arange(len(at)), np.arange(p), np.arange(p), indexing="ij"))
        out = {"freq": at[f], "to": i, "from": j}
        return pd.DataFrame(out | {f"{n}_{part}": get(m).ravel() for n, m in (("h", h), ("c", c), ("s", s)) for part, get in (("re", np.real), ("im", np.imag))})

    return _over_models(models, by, "freq double, to int, `from` int, h_re double, h_im double, c_re double, c_im double, s_re double, s_im double", run)


def _share(waves: DataFrame, by: Sequence[str], name: str, side: str) -> DataFrame:
    size = F.col(f"{name}_re") ** 2 + F.col(f"{name}_im") ** 2
    own = waves.select(*by, "freq", "to", "from", size.alias("_s"))
    whole = own.groupBy(*by, "freq", side).agg(F.sum("_s").alias("_w"))
    return own.join(whole, [*by, "freq", side]).select(*by, "freq", "to", "from", F.sqrt(F.col("_s") / F.col("_w")).alias("value"))


def directed_transfer(waves: DataFrame, by: Sequence[str]) -> DataFrame:
    """How much of what reaches a channel comes from each: |h| over the root of its row's squares."""
    return _share(waves, by, "h", "to")


def partial_directed(waves: DataFrame, by: Sequence[str]) -> DataFrame:
    """How much of what a channel sends goes to each: |c| over the root of its column's squares."""
    return _share(waves, by, "c", "from")


def granger(models: DataFrame, by: Sequence[str], order: int, blocks: Sequence[Sequence[int]] | None = None, conditional: bool = True) -> DataFrame:
    """``from, to, value``: ln of the noise that blocks of channels have without another block's past, over that with it.

    ``conditional``: all other channels' past is known either way; otherwise only the two blocks'. Blocks are single channels unless given. The smaller
    models are solved from the products that the sums hold already; the series isn't read again.
    """

    def run(row: dict) -> pd.DataFrame:
        p, size = int(row["p"]), int(np.sqrt(len(row["gram"])))
        sums = np.asarray(row["gram"], float).reshape(size, size)
        parts = [list(b) for b in blocks] if blocks else [[k] for k in range(p)]

        def left(of: list[int], past: list[int]) -> float:
            at = [p + lag * p + c for lag in range(order) for c in past]
            y, both = sums[np.ix_(of, of)], sums[np.ix_(of, at)]
            return float(np.linalg.slogdet(y - both @ np.linalg.pinv(sums[np.ix_(at, at)]) @ both.T)[1])

        out = []
        for j, source in enumerate(parts):
            for i, sink in enumerate(parts):
                if i != j:
                    known = [c for k, b in enumerate(parts) for c in b if conditional or k in (i, j)]
                    out.append((j, i, left(sink, [c for c in known if c not in source]) - left(sink, known)))
        return pd.DataFrame(out, columns=["from", "to", "value"])

    return _over_models(models, by, "`from` int, to int, value double", run)


def spectral_granger(models: DataFrame, by: Sequence[str], order: int, freqs: Sequence[float], rate: float) -> DataFrame:
    """``freq, from, to, value`` of each pair of channels by itself: ln of a channel's power over what the other's noise doesn't explain of it."""
    at = np.array(freqs, float)

    def run(row: dict) -> pd.DataFrame:
        p, size = int(row["p"]), int(np.sqrt(len(row["gram"])))
        sums, out = np.asarray(row["gram"], float).reshape(size, size), []
        for i in range(p):
            for j in range(i + 1, p):
                pick = [lag * p + c for lag in range(order + 1) for c in (i, j)]
                a, noise = least_squares(int(row["n"]), sums[np.ix_(pick, pick)], 2, order)
                h = np.linalg.inv(_waves({"p": 2, "a": a.ravel()}, at, rate))
                power = np.einsum("fij,jk,fik->fi", h, noise, h.conj()).real
                for to, frm, names in ((0, 1, (i, j)), (1, 0, (j, i))):
                    rest = (noise[frm, frm] - noise[to, frm] ** 2 / noise[to, to]) * np.abs(h[:, to, frm]) ** 2
                    out.append(pd.DataFrame({"freq": at, "from": names[1], "to": names[0], "value": np.log(power[:, to] / (power[:, to] - rest))}))
        return pd.concat(out) if out else pd.DataFrame({"freq": [], "from": [], "to": [], "value": []})

    return _over_models(models, by, "freq double, `from` int, to int, value double", run)


def interaction(waves: DataFrame, by: Sequence[str], blocks: Sequence[Sequence[int]]) -> DataFrame:
    """``freq, a, b, value``: the multivariate interaction of two blocks of channels, from the imaginary part of their cross-spectrum, whatever linear mixing is inside each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = int(pdf["to"].max()) + 1
        s = np.zeros((p, p), complex)
        s[pdf["to"], pdf["from"]] = pdf["s_re"].to_numpy() + 1j * pdf["s_im"].to_numpy()
        out = []
        for a in range(len(blocks)):
            for b in range(a + 1, len(blocks)):
                x, y = list(blocks[a]), list(blocks[b])
                between = s[np.ix_(x, y)].imag
                value = np.trace(np.linalg.pinv(s[np.ix_(x, x)].real) @ between @ np.linalg.pinv(s[np.ix_(y, y)].real) @ between.T)
                out.append((*[pdf[c].iloc[0] for c in (*by, "freq")], a, b, value))
        return pd.DataFrame(out, columns=[*by, "freq", "a", "b", "value"])

    return waves.groupBy(*by, "freq").applyInPandas(run, f"{_kinds(waves, by)}freq double, a int, b int, value double")


def spatial_patterns(rows: DataFrame, by: Sequence[str], first: str, m: int, x: str = "x") -> DataFrame:
    """Filters (``by``, filter, share, w) that make the variance of rows for which ``first`` holds large and of the others small, and the other way round.

    The two classes' covariances are sums over Spark; the small problem is solved a
    group: W (C1 + C2) W' = 1 and W C1 W' diagonal, falling. ``m`` filters stay, those at both ends. Directions without variance are left out.
    """
    sums = gram(rows.withColumn("_first", F.expr(first)), [*by, "_first"], x)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        size = int(np.sqrt(len(pdf["gram"].iloc[0])))
        cov = {bool(f): np.asarray(g, float).reshape(size, size) / n for f, g, n in zip(pdf["_first"], pdf["gram"], pdf["n"], strict=True)}
        c1, c2 = (cov.get(k, np.zeros((size, size))) for k in (True, False))
        value, axis = np.linalg.eigh(c1 + c2)
        some = value > value.max() * 1e-14
        white = axis[:, some].T / np.sqrt(value[some])[:, None]
        share, turn = np.linalg.eigh(white @ c1 @ white.T)
        w = (turn[:, ::-1].T @ white) * 1.0
        w *= np.sign(w[np.arange(len(w)), np.abs(w).argmax(1)])[:, None]
        keep = sorted({*range(-(-m // 2)), *range(len(w) - m // 2, len(w))} & set(range(len(w))))
        out = pd.DataFrame({"filter": keep, "share": share[::-1][keep], "w": [w[k] for k in keep]})
        return out.assign(**{c: [pdf[c].iloc[0]] * len(out) for c in by})[[*by, "filter", "share", "w"]]

    return sums.groupBy(*by).applyInPandas(run, f"{_kinds(rows, by)}filter int, share double, w array<double>")


def apply_patterns(rows: DataFrame, patterns: DataFrame, by: Sequence[str], x: str = "x") -> DataFrame:
    """Each row once a filter, with the filter's output ``y``."""
    joined = rows.join(patterns, list(by)) if by else rows.join(F.broadcast(patterns))  # a few filters
    return joined.withColumn("y", F.aggregate(F.zip_with(x, "w", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)).drop("w")


def phase_linearity(trials: DataFrame, keys: Sequence[str], rate: float, band: float, least: float = 0.1, x: str = "x", t: str = "sample") -> DataFrame:
    """``keys, a, b, value``: how much of the spectrum of two channels' interferometric signal lies within ``band`` of 0, trial by trial.

    The signal is one channel's analytic signal times the other's conjugate; a
    steady phase difference below ``least``, as common sources make, doesn't count. Trials are whole: ``keys`` name one.
    """

    def made(rows: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        z = analytic(rows.transpose(2, 0, 1))
        freq, out = np.fft.fftfreq(z.shape[2], 1 / rate), []
        pairs = [(a, b) for a in range(len(z)) for b in range(a + 1, len(z))]
        for a, b in pairs:
            spectra = np.fft.fft(z[a] * z[b].conj(), axis=1)
            spectra[:, 0] *= np.abs(np.angle(spectra[:, 0])) > least
            power = np.abs(spectra) ** 2
            with np.errstate(invalid="ignore"):
                out.append(power[:, np.abs(freq) < band].sum(1) / power.sum(1))
        shape = (len(rows), len(pairs))
        ends = np.array(pairs, np.int32).reshape(-1, 2)
        return {"a": np.broadcast_to(ends[:, 0], shape), "b": np.broadcast_to(ends[:, 1], shape), "value": np.stack(out, 1) if out else np.zeros(shape)}

    return over_trials(trials, made, "a int, b int, value double", x, keys, t)
