"""Permutation statistics: true relabellings of observations, all draws in one pass, clusters by mass."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import connected, written

#: Bytes of all labels up to which they are sent to every task; beyond, they are joined.
SENT = 64 << 20


def draws(labels: DataFrame, n: int, block: Sequence[str] = ()) -> DataFrame:
    """``obs, bits``: the label of each observation as it is, and in ``n`` relabellings.

    Each draw is a permutation: observations are ranked by a hash of ``obs`` and the
    draw, and as many of the first get the label as had it, inside each ``block``
    (a subject, for designs within subjects) if there is one. The k-th draw is the
    same wherever it is made.
    """
    kept = labels.select("obs", *block, F.col("label").cast("boolean").alias("label"))
    each = kept.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n))))
    order = Window.partitionBy("k", *block).orderBy(F.md5(F.concat_ws("/", F.col("obs").cast("string"), F.col("k").cast("string")).cast("binary")), "obs")
    marked = kept.groupBy(*block).agg(F.count_if("label").alias("_n"))
    each = (each.join(marked, list(block)) if block else each.join(F.broadcast(marked))).withColumn("_r", F.row_number().over(order))
    drawn = F.when(F.col("k") == 0, F.col("label")).otherwise(F.col("_r") <= F.col("_n"))
    return each.select("obs", F.struct("k", drawn.alias("bit")).alias("x")).groupBy("obs").agg(F.array_sort(F.collect_list("x")).alias("x")).select("obs", F.col("x.bit").alias("bits"))


def permuted_t(values: DataFrame, labels: DataFrame, n: int, features: Sequence[str], x: str = "x", block: Sequence[str] = ()) -> DataFrame:
    """Two-sample t of every feature in the observed labelling (draw 0) and in ``n`` relabellings: features, draw, t.

    Values (obs, features, x) are shuffled once, by feature; labels are sent to the
    tasks while all of them are small, which is checked, and joined otherwise. A
    feature's task has one value an observation and takes all draws in two matrix
    products. t is rounded to nine places, so that equal draws are equal; where a
    side has no value or nothing varies there is none.
    """
    bits = written(draws(labels, n, block))
    small = bits.count() * (n + 1) <= SENT

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("obs", kind="stable")
        mask, v = np.stack(pdf["bits"].to_numpy()).astype(float), pdf[x].to_numpy(float)
        v = v - v.mean()
        ones = mask.sum(0)
        rest = len(v) - ones
        with np.errstate(divide="ignore", invalid="ignore"):
            s, ss = v @ mask, (v * v) @ mask
            inside = ss - s * s / ones + (v @ v - ss) - (v.sum() - s) ** 2 / rest
            inside = np.where((len(v) > 2) & (ones > 0) & (rest > 0) & (inside > 1e-9), inside, np.nan)
            t = (s / ones - (v.sum() - s) / rest) / np.sqrt(inside / (len(v) - 2) * (1 / ones + 1 / rest))
        out = pd.DataFrame({f: [pdf[f].iloc[0]] * len(t) for f in features})
        return out.assign(draw=np.arange(len(t)), t=np.where(np.isfinite(t), np.round(t, 9) + 0.0, np.nan))

    rows = values.where(F.col(x).isNotNull()).select("obs", *features, F.col(x).cast("double").alias(x))
    joined = rows.repartition(*features).join(F.broadcast(bits), "obs") if small else rows.join(bits, "obs")
    kinds = ", ".join(f"`{f}` {values.schema[f].dataType.simpleString()}" for f in features)
    return joined.groupBy(*features).applyInPandas(run, f"{kinds}, draw int, t double").where(F.col("t").isNotNull() & ~F.isnan("t"))


def permutation_p(t: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features, t, ``p_high`` and ``p_low`` (share of draws at or beyond it), ``p_max`` and ``p_min`` (of draws whose largest, least t over all features is)."""
    seen = t.where("draw = 0").select(*features, F.col("t").alias("seen"))
    ends = t.where("draw > 0").groupBy("draw").agg(F.max("t").alias("high"), F.min("t").alias("low"))
    ends = ends.agg(F.array_sort(F.collect_list("high")).alias("highs"), F.array_sort(F.collect_list("low")).alias("lows"))  # a figure a draw
    own = t.where("draw > 0").join(seen, list(features)).groupBy(*features).agg(F.avg((F.col("t") >= F.col("seen")).cast("double")).alias("p_high"), F.avg((F.col("t") <= F.col("seen")).cast("double")).alias("p_low"))
    share = lambda name, test: F.size(F.filter(name, test)) / F.size(name)
    both = seen.join(own, list(features)).join(F.broadcast(ends))
    return both.select(*features, F.col("seen").alias("t"), "p_high", "p_low", share("highs", lambda e: e >= F.col("seen")).alias("p_max"), share("lows", lambda e: e <= F.col("seen")).alias("p_min"))


def cluster_masses(t: DataFrame, threshold: float, near: DataFrame, feature: str = "feature") -> DataFrame:
    """``draw, sign, cluster, size, mass``: sets of neighbouring features beyond the threshold, on each side, and the sum of their t.

    ``near`` has pairs of neighbouring features (a, b). All draws' sets are found at
    once, as the connected sets of one graph whose nodes bear their draw.
    """
    over = written(t.where(F.abs("t") > threshold).select("draw", F.signum("t").cast("int").alias("sign"), F.col(feature).alias("_f"), "t"))
    node = lambda c: F.struct("draw", "sign", F.col(c).alias("f"))
    pairs = near.select("a", "b").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = over.select("draw", "sign", F.col("_f").alias("a")).join(pairs, "a").join(over.select("draw", "sign", F.col("_f").alias("b")), ["draw", "sign", "b"]).where("a < b")
    sets = connected(over.select(node("_f").alias("node")), edges.select(node("a").alias("a"), node("b").alias("b")))
    named = sets.select(F.col("node.draw").alias("draw"), F.col("node.sign").alias("sign"), F.col("node.f").alias("_f"), F.col("cluster.f").alias("cluster"))
    return over.join(named, ["draw", "sign", "_f"]).groupBy("draw", "sign", "cluster").agg(F.count("*").alias("size"), F.round(F.sum("t"), 6).alias("mass"))


def cluster_test(t: DataFrame, threshold: float, near: DataFrame, n: int, feature: str = "feature") -> DataFrame:
    """``cluster, sign, size, mass, p`` of the observed sets: the share of the ``n`` draws whose largest mass of that side is no smaller; a draw without a set has mass 0."""
    masses = written(cluster_masses(t, threshold, near, feature))
    largest = masses.where("draw > 0").groupBy("draw", "sign").agg(F.max(F.abs("mass")).alias("most"))
    largest = largest.groupBy("sign").agg(F.collect_list("most").alias("largest"))  # a figure a draw
    seen = masses.where("draw = 0").join(F.broadcast(largest), "sign", "left")
    beyond = F.coalesce(F.size(F.filter("largest", lambda m: m >= F.abs("mass"))), F.lit(0))
    return seen.select("cluster", "sign", "size", "mass", (F.greatest(beyond, F.lit(0)) / n).alias("p"))
