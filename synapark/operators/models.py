"""Fits on Spark: principal components, clusters, event kernels, regressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import connected, written


def components(df: DataFrame, x: str = "x", k: int = 3) -> DataFrame:
    """The first principal components of arrays, as an array ``pc``."""
    rows = df.withColumn("_v", array_to_vector(F.col(x)))
    model = PCA(k=k, inputCol="_v", outputCol="_pc").fit(rows)
    return model.transform(rows).withColumn("pc", vector_to_array("_pc")).drop("_v", "_pc")


def clusters(df: DataFrame, k: int, x: str = "x", seed: int = 1) -> DataFrame:
    """k-means labels of arrays, as ``cluster``."""
    rows = df.withColumn("_v", array_to_vector(F.col(x)))
    return KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(rows).transform(rows).drop("_v")


def least_squares(df: DataFrame, y: str, xs: Sequence[str], ridge: float = 0.0) -> np.ndarray:
    """Weights of a regression with intercept first: sums over all rows in one aggregate, one small system on the driver."""
    cols = [F.lit(1.0), *[F.col(c).cast("double") for c in xs]]
    n = len(cols)
    sums = [F.sum(cols[i] * cols[j]) for i in range(n) for j in range(i, n)] + [F.sum(c * F.col(y)) for c in cols]
    found = list(df.where(F.col(y).isNotNull()).agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first())
    gram, at = np.zeros((n, n)), 0
    for i in range(n):
        for j in range(i, n):
            gram[i, j] = gram[j, i] = found[at]
            at += 1
    gram[range(1, n), range(1, n)] += ridge
    return np.linalg.lstsq(gram, np.array(found[at:], float), rcond=None)[0]


def event_kernels(signal: DataFrame, events: DataFrame, lags: Sequence[int], ridge: float = 0.0) -> dict:
    """Kernels of events in a signal (sample, v): one lagged predictor an event kind and lag.

    The design is sparse and stays on Spark: its normal equations are counts of
    pairs of predictors on a sample, kinds times lags squared in number.
    """
    shifted = events.select("kind", F.col("sample").alias("_at"), F.explode(F.array(*[F.lit(k) for k in lags])).alias("lag")).select("kind", "lag", (F.col("_at") + F.col("lag")).alias("sample"))
    on = shifted.join(signal.select("sample", "v"), "sample").groupBy("kind", "lag", "sample").agg(F.count("*").cast("double").alias("x"), F.first("v").alias("v"))
    y = {(r["kind"], r["lag"]): r["s"] for r in on.groupBy("kind", "lag").agg(F.sum(F.col("x") * F.col("v")).alias("s")).collect()}  # kinds x lags rows
    names = sorted(y)
    other = on.select("sample", F.col("kind").alias("k2"), F.col("lag").alias("l2"), F.col("x").alias("x2"))
    gram = np.zeros((len(names), len(names)))
    for r in on.join(other, "sample").groupBy("kind", "lag", "k2", "l2").agg(F.sum(F.col("x") * F.col("x2")).alias("s")).collect():
        gram[names.index((r["kind"], r["lag"])), names.index((r["k2"], r["l2"]))] = r["s"]
    gram[np.diag_indices(len(names))] += ridge
    return dict(zip(names, np.linalg.lstsq(gram, np.array([y[n] for n in names]), rcond=None)[0].tolist(), strict=True))


def regress_out(samples: DataFrame, references: DataFrame, names: Sequence[str]) -> DataFrame:
    """Samples (channel, sample, v) without what each channel has of reference signals (sample, names..)."""
    both = samples.join(references, "sample")
    n = len(names)
    pairs = [F.covar_pop(a, b).alias(f"c{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names)] + [F.covar_pop("v", a).alias(f"y{i}") for i, a in enumerate(names)] + [F.avg(a).alias(f"m{i}") for i, a in enumerate(names)]
    moments = both.groupBy("channel").agg(*pairs)

    def solve(batches):
        import pandas as pd

        for pdf in batches:
            w = [(np.linalg.pinv(np.array([[r[f"c{i}_{j}"] for j in range(n)] for i in range(n)], float)) @ np.array([r[f"y{i}"] for i in range(n)], float)).tolist() for _, r in pdf.iterrows()]
            yield pd.DataFrame({"channel": pdf["channel"], "w": w, "m": [[r[f"m{i}"] for i in range(n)] for _, r in pdf.iterrows()]})

    weights = moments.mapInPandas(solve, f"channel {samples.schema['channel'].dataType.simpleString()}, w array<double>, m array<double>")
    fit = sum(((F.col("w")[i] * (F.col(a) - F.col("m")[i])) for i, a in enumerate(names)), F.lit(0.0))
    return both.join(weights, "channel").select("channel", "sample", (F.col("v") - fit).alias("v"))


#: Elements of all clusters' sums up to which they are sent to every task.
SENT = 4 << 20


def silhouette(points: DataFrame, x: str = "x", cluster: str = "cluster", key: str = "id") -> DataFrame:
    """``key, cluster, a, b, s``: mean squared distance of each point to the others of its cluster, to the nearest other cluster, and (b - a) / max(a, b).

    Exact without a pair of points: the squared distances to a cluster sum up to
    n |x|^2 - 2 x . sum + sum of |.|^2. The clusters' sums are sent to the tasks while
    they are small, which is checked, and dealt to the points' elements by a join
    otherwise. A point alone in its cluster, or in the only one, has s = 0.
    """
    square = F.aggregate(F.transform(x, lambda v: v * v), F.lit(0.0), lambda p, q: p + q)
    rows = points.select(key, F.col(cluster).alias("_own"), F.col(x).cast("array<double>").alias(x)).withColumn("_sq", square)
    sums = rows.select("_own", F.posexplode(x).alias("d", "v")).groupBy("_own", "d").agg(F.sum("v").alias("v"))
    sizes = written(rows.groupBy("_own").agg(F.count("*").alias("n"), F.sum("_sq").alias("q")))
    width = rows.select(F.max(F.size(x))).first()[0] or 0
    if sizes.count() * width <= SENT:
        vectors = sums.groupBy("_own").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "v"))), lambda e: e["v"]).alias("s"))
        table = vectors.join(sizes, "_own").agg(F.collect_list(F.struct(F.col("_own").alias("c"), "n", "q", "s")).alias("_all"))
        dot = lambda e: F.aggregate(F.zip_with(x, e["s"], lambda p, q: p * q), F.lit(0.0), lambda p, q: p + q)
        each = F.transform("_all", lambda e: F.struct(e["c"].alias("c"), e["n"].alias("n"), (e["n"] * F.col("_sq") - 2 * dot(e) + e["q"]).alias("sum")))
        found = rows.join(F.broadcast(table)).select(key, "_own", F.explode(each).alias("e")).select(key, "_own", "e.*")  # checked above
    else:
        elements = rows.select(key, "_own", "_sq", F.posexplode(x).alias("d", "v"))
        dots = elements.join(sums.select(F.col("_own").alias("c"), "d", F.col("v").alias("s")), "d").groupBy(key, "_own", "_sq", "c").agg(F.sum(F.col("v") * F.col("s")).alias("dot"))
        found = dots.join(sizes.withColumnRenamed("_own", "c"), "c").select(key, "_own", "c", "n", (F.col("n") * F.col("_sq") - 2 * F.col("dot") + F.col("q")).alias("sum"))
    own = F.col("c") == F.col("_own")
    mean = F.greatest(F.lit(0.0), F.when(own, F.col("sum") / F.nullif(F.col("n") - 1, F.lit(0))).otherwise(F.col("sum") / F.col("n")))
    out = found.withColumn("m", mean).groupBy(key, "_own").agg(F.max(F.when(own & (F.col("n") > 1), F.col("m"))).alias("a"), F.min(F.when(~own, F.col("m"))).alias("b"))
    return out.select(key, F.col("_own").alias(cluster), "a", "b", F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0)).alias("s"))


def ward(points: DataFrame, near: DataFrame, k: int, x: str = "x", key: str = "id") -> DataFrame:
    """``key, cluster``: ``k`` clusters by merging those whose union adds least to the squared distances from the means (Ward), among neighbours.

    ``near`` has pairs (a, b) of points that may be merged; of all pairs it gives plain
    Ward clustering. In each round all clusters that are each other's nearest merge
    at once, which finds the same tree as one merge at a time, since a union is
    never nearer to a third than the nearer of its parts. A cluster is a row of
    its sums, a neighbourhood an edge; edges are joined with both sums and
    reduced to the nearest, so nothing is gathered. The tree's dearest merges are
    then undone to leave ``k``. Clusters bear their least point's key.
    """
    state = written(points.select(F.col(key).alias("c"), F.lit(1).cast("long").alias("n"), F.col(x).cast("array<double>").alias("s")))
    whole = state.count()
    order = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(near.where("a <> b").select(order.alias("e")).distinct().select("e.*"))
    merges: DataFrame | None = None
    while not edges.isEmpty():
        side = lambda name: state.select(F.col("c").alias(name), F.col("n").alias(f"n{name}"), F.col("s").alias(f"s{name}"))
        both = edges.join(side("a"), "a").join(side("b"), "b")
        apart = F.aggregate(F.zip_with("sa", "sb", lambda p, q: (p / F.col("na") - q / F.col("nb")) ** 2), F.lit(0.0), lambda p, q: p + q)
        cost = written(both.select(F.struct((apart * F.col("na") * F.col("nb") / (F.col("na") + F.col("nb"))).alias("cost"), "a", "b").alias("e")))
        nearest = cost.select(F.explode(F.array("e.a", "e.b")).alias("c"), "e").groupBy("c").agg(F.min("e").alias("e"))
        pairs = written(nearest.groupBy("e").agg(F.count("*").alias("m")).where("m = 2").select("e.*"))
        merges = pairs if merges is None else merges.unionByName(pairs)
        to = pairs.select(F.col("b").alias("c"), F.col("a").alias("to"))
        moved = state.join(to, "c", "left").select(F.coalesce("to", "c").alias("c"), "n", F.posexplode_outer("s").alias("d", "v"))
        sums = moved.groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        state = written(sums.groupBy("c").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("d", "v"))), lambda e: e["v"]).alias("s")))
        move = lambda df, name: df.join(to.select(F.col("c").alias(name), F.col("to").alias("_to")), name, "left").withColumn(name, F.coalesce("_to", name)).drop("_to")
        edges = written(move(move(edges, "a"), "b").where("a <> b").select(order.alias("e")).distinct().select("e.*"))
    nodes = points.select(F.col(key).alias("node"))
    kept = nodes.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))
    if merges is not None:
        kept = merges.orderBy("cost", "a", "b").limit(max(0, whole - k)).select("a", "b")
    return connected(nodes, kept).select(F.col("node").alias(key), "cluster")
