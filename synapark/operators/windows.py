"""Column builders over ordered windows: differences, smoothing, states, baselines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(by: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order)


def centred(w: WindowSpec, half: int) -> WindowSpec:
    return w.rowsBetween(-half, half)


#: Samples of a stretch: what one task of a windowed pass holds of a channel.
STRETCH = 1 << 16


def dealt(df: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Rows by keys in so many tasks, where a number that grows with the rows is known: with the session's fixed number each task would hold ever more."""
    return df if tasks is None else df.repartition(tasks, *keys)


def stretches(samples: DataFrame, size: int, halo: int, order: str = "sample") -> DataFrame:
    """Each sample in its stretch, and in the halos of as many stretches as reach it: ``part``, ``own`` says whether it is its stretch."""
    here = F.floor(F.col(order) / size).cast("long")
    low, high = F.floor((F.col(order) - halo) / size).cast("long"), F.floor((F.col(order) + halo) / size).cast("long")
    parts = F.sequence(F.greatest(low, F.least(here, F.lit(0).cast("long"))), high)
    return samples.withColumn("part", F.explode(parts)).withColumn("own", F.col("part") == F.floor(F.col(order) / size))


def over_stretches(samples: DataFrame, half: int, made: dict[str, Callable[[WindowSpec], Column]], by: Sequence[str] = ("channel",), order: str = "sample", size: int = STRETCH, tasks: int | None = None) -> DataFrame:
    """Columns over frames that reach ``half`` samples to each side, one after the other, in stretches with halos: no task sorts a whole channel.

    Samples of a channel are numbered without gaps.
    """
    rows = dealt(stretches(samples, size, half, order), tasks, *by, "part")
    for name, build in made.items():
        rows = rows.withColumn(name, build(ordered([*by, "part"], [order])))
    return rows.where("own").drop("part", "own")


def carried(df: DataFrame, x: Column, name: str, by: Sequence[str] = ("channel",), order: str = "sample", forward: bool = False, size: int = STRETCH, tasks: int | None = None) -> DataFrame:
    """``x`` of the last row at or before each that has one (``forward``: of the next one), stretch by stretch.

    A stretch's last value goes on to the stretches behind it by a window over
    stretches, of which a channel has few.
    """
    rows = dealt(df.withColumns({"_x": x, "_part": F.floor(F.col(order) / size)}), tasks, *by, "_part")
    inside, over = ordered([*by, "_part"], [order]), ordered(by, ["_part"])
    pair = F.when(F.col("_x").isNotNull(), F.struct(order, F.col("_x").alias("x")))
    if forward:
        own = F.first("_x", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing))
        edge, past = F.min(pair), F.first("_edge", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing))
    else:
        own = F.last("_x", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        edge, past = F.max(pair), F.last("_edge", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))
    edges = rows.groupBy(*by, "_part").agg(edge.alias("_edge")).select(*by, "_part", past.alias("_past"))
    return rows.withColumn("_own", own).join(edges, [*by, "_part"]).withColumn(name, F.coalesce("_own", "_past.x")).drop("_x", "_part", "_own", "_past")


def demeaned(df: DataFrame, x: str, by: Sequence[str], name: str) -> DataFrame:
    """x without its group's mean: a sum by group, joined back."""
    return df.join(df.groupBy(*by).agg(F.avg(x).alias("_m")), list(by)).withColumn(name, F.col(x) - F.col("_m")).drop("_m")


def detrended(df: DataFrame, x: str, t: str, by: Sequence[str], name: str, order: int = 1) -> DataFrame:
    """x without its group's least-squares polynomial: sums by group, a small system each, joined back.

    A line is one aggregate. For more, times are taken from -1 to 1 within a group,
    which keeps the power sums well apart.
    """
    if order == 1:
        known = df.where(F.col(x).isNotNull()).groupBy(*by).agg(F.avg(x).alias("_m"), F.avg(t).alias("_c"), F.coalesce(F.regr_slope(x, t), F.lit(0.0)).alias("_k"))
        return df.join(known, list(by), "left").withColumn(name, F.col(x) - F.col("_m") - F.col("_k") * (F.col(t) - F.col("_c"))).drop("_m", "_c", "_k")
    import numpy as np
    import pandas as pd

    ends = df.groupBy(*by).agg(F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    rows = df.join(ends, list(by)).withColumn("_u", F.when(F.col("_hi") > F.col("_lo"), (2 * F.col(t) - F.col("_lo") - F.col("_hi")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0))
    known = rows.where(F.col(x).isNotNull())
    powers = [F.sum(F.pow(F.col("_u"), F.lit(float(k)))).alias(f"p{k}") for k in range(2 * order + 1)]
    sums = known.groupBy(*by).agg(*powers, *[F.sum(F.pow(F.col("_u"), F.lit(float(k))) * F.col(x)).alias(f"y{k}") for k in range(order + 1)])

    def solve(batches):
        for pdf in batches:
            gram = np.stack([[pdf[f"p{i + j}"].to_numpy(float) for j in range(order + 1)] for i in range(order + 1)]).transpose(2, 0, 1)
            right = np.stack([pdf[f"y{i}"].to_numpy(float) for i in range(order + 1)], 1)
            yield pd.concat([pdf[list(by)], pd.Series(list((np.linalg.pinv(gram) @ right[..., None])[..., 0]), index=pdf.index, name="_w")], axis=1)

    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by)
    weights = sums.mapInPandas(solve, f"{kinds}, _w array<double>")
    fit = sum((F.col("_w")[k] * F.pow(F.col("_u"), F.lit(float(k))) for k in range(order + 1)), F.lit(0.0))
    return rows.join(weights, list(by)).withColumn(name, F.col(x) - fit).drop("_lo", "_hi", "_u", "_w")


def normalised(df: DataFrame, x: str, by: Sequence[str], name: str) -> DataFrame:
    """(x - mean) / population deviation of the group; null where nothing varies."""
    found = df.groupBy(*by).agg(F.avg(x).alias("_m"), F.stddev_pop(x).alias("_s"))
    return df.join(found, list(by)).withColumn(name, (F.col(x) - F.col("_m")) / F.nullif(F.col("_s"), F.lit(0.0))).drop("_m", "_s")


def interval(t: str, w: WindowSpec) -> Column:
    """Time since the row before; null for the first."""
    return F.col(t) - F.lag(t).over(w)


def moving_average(x: str, w: WindowSpec, half: int) -> Column:
    return F.avg(x).over(centred(w, half))


def median_filter(x: str, w: WindowSpec, half: int) -> Column:
    return F.percentile(F.col(x), F.lit(0.5)).over(centred(w, half))


def padded_median(df: DataFrame, x: str, half: int, name: str, by: Sequence[str] = ("channel",), order: str = "sample", pad: int | None = None, size: int = STRETCH, tasks: int | None = None) -> DataFrame:
    """Median of ``half`` values to each side, where past both ends of a channel stands the mean of the ``pad`` values next to that end (``half`` unless given, half the channel at most).

    Samples are numbered without gaps. The two means are an aggregate; medians are taken in stretches with halos.
    """
    pad = half if pad is None else pad
    ends = df.groupBy(*by).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"))
    df = dealt(df, tasks, *by)  # the ends, and what is joined to them, stay there
    rows = df.join(ends, list(by)).withColumn("_p", F.least(F.lit(pad), F.floor((F.col("_hi") - F.col("_lo") + 1) / 2)))
    means = rows.groupBy(*by).agg(F.avg(F.when(F.col(order) < F.col("_lo") + F.col("_p"), F.col(x))).alias("_left"), F.avg(F.when(F.col(order) > F.col("_hi") - F.col("_p"), F.col(x))).alias("_right"))
    both = over_stretches(rows.join(means, list(by)), half, {"_near": lambda w: F.collect_list(x).over(centred(w, half))}, by, order, size, tasks)
    short = lambda gap: F.greatest(F.lit(0), F.lit(half) - gap).cast("int")
    whole = F.concat("_near", F.array_repeat("_left", short(F.col(order) - F.col("_lo"))), F.array_repeat("_right", short(F.col("_hi") - F.col(order))))
    # a channel of one value has no ends to take means of
    values = F.sort_array(F.filter(whole, lambda v: v.isNotNull()))
    at = (F.size(values) / 2).cast("int")
    middle = F.when(F.size(values) % 2 == 1, F.get(values, at)).otherwise((F.get(values, at) + F.get(values, at - 1)) / 2)
    return both.withColumn(name, middle).drop("_lo", "_hi", "_p", "_left", "_right", "_near")


def kernel_smooth(x: str, w: WindowSpec, kernel: Sequence[float], before: Column | None = None, after: Column | None = None) -> Column:
    """Weighted mean under a kernel of odd length; past the ends stand ``before`` and ``after``, or nothing (weights are then made up to one)."""
    half = len(kernel) // 2
    total, weight = F.lit(0.0), F.lit(0.0)
    for k, share in enumerate(kernel):
        near = F.lag(x, half - k).over(w) if k <= half else F.lead(x, k - half).over(w)
        near = F.coalesce(near, before if k < half else after) if before is not None and k != half else near
        total, weight = total + F.coalesce(near * share, F.lit(0.0)), weight + F.when(near.isNotNull(), share).otherwise(0.0)
    return total / weight


def running_total(df: DataFrame, x: Column, name: str, by: Sequence[str] = ("channel",), order: str = "sample", size: int = STRETCH) -> DataFrame:
    """Sum of x up to each row: inside a stretch, on top of the stretches before it."""
    rows = df.withColumns({"_x": x, "_part": F.floor(F.col(order) / size)})
    own = F.sum("_x").over(ordered([*by, "_part"], [order]).rowsBetween(Window.unboundedPreceding, 0))
    sums = rows.groupBy(*by, "_part").agg(F.sum("_x").alias("_s"))
    past = F.coalesce(F.sum("_s").over(ordered(by, ["_part"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sums = sums.select(*by, "_part", past.alias("_past"))
    return rows.withColumn("_own", own).join(sums, [*by, "_part"]).withColumn(name, F.col("_own") + F.col("_past")).drop("_x", "_part", "_own", "_past")


def positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Place of each row in the order of the whole table, from 0: rows are dealt by ranges and counted within them, and only ranges are summed in one place."""
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*order)
    rows = ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", before.alias("_before"))
    return rows.join(F.broadcast(counts), "_part").withColumn(name, F.col("_before") + F.col("_k")).drop("_part", "_k", "_before")  # a row a partition


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], part: Column, name: str = "sample", tasks: int | None = None) -> DataFrame:
    """Number of each row in the order of its group, from 1. ``part`` rises with the order: rows are counted inside a part, on top of the parts before it, so no task sorts a whole group."""
    rows = df.withColumn("_part", part)
    counts = rows.groupBy(*by, "_part").agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(ordered(by, ["_part"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*by, "_part", before.alias("_before"))
    inside = F.row_number().over(ordered([*by, "_part"], order))
    return dealt(rows, tasks, *by, "_part").withColumn("_k", inside).join(counts, [*by, "_part"]).withColumn(name, (F.col("_before") + F.col("_k")).cast("long")).drop("_part", "_k", "_before")


def sliding_range(x: str, w: WindowSpec, half: int) -> Column:
    """max - min of an odd window, over the root of its width; the ends have shorter windows."""
    frame = centred(w, half)
    return (F.max(x).over(frame) - F.min(x).over(frame)) / F.sqrt(F.lit(2 * half + 1.0))


def gradient(x: str, w: WindowSpec) -> Column:
    """Central differences, one-sided at both ends."""
    low, high = F.lag(x).over(w), F.lead(x).over(w)
    return F.when(low.isNull(), high - F.col(x)).when(high.isNull(), F.col(x) - low).otherwise((high - low) / 2)


def baseline(x: str, at_rest: Column, by: Sequence[str], kind: str = "zscore") -> Column:
    """x against the group's rows at rest: ``zscore``, ``relchange``, ``absolute`` or ``db``."""
    w = Window.partitionBy(*by)
    mean = F.avg(F.when(at_rest, F.col(x))).over(w)
    if kind == "absolute":
        return F.col(x) - mean
    if kind == "relchange":
        return (F.col(x) - mean) / F.nullif(mean, F.lit(0.0))
    if kind == "db":
        return F.lit(10.0) * F.log10(F.col(x) / F.nullif(mean, F.lit(0.0)))
    return (F.col(x) - mean) / F.nullif(F.stddev_samp(F.when(at_rest, F.col(x))).over(w), F.lit(0.0))


def debounce(df: DataFrame, t: str, gap: float, by: Sequence[str]) -> DataFrame:
    """Of changes closer than ``gap`` the last stays."""
    after = F.lead(t).over(ordered(by, [t]))
    return df.withColumn("_after", after).where(F.col("_after").isNull() | (F.col("_after") - F.col(t) >= gap)).drop("_after")


def changes(df: DataFrame, value: str, order: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows whose value differs from the row before."""
    return df.withColumn("_was", F.lag(value).over(ordered(by, order))).where(F.col("_was").isNotNull() & (F.col("_was") != F.col(value))).drop("_was")


def forward_or(code: str, t: str, span: int, by: Sequence[str]) -> Column:
    """Bits set in any row from here to ``span`` later."""
    return F.bit_or(F.col(code)).over(Window.partitionBy(*by).orderBy(t).rangeBetween(0, span))


def fill_gaps(df: DataFrame, x: str, by: Sequence[str] = ("channel",), order: str = "sample", size: int = STRETCH, tasks: int | None = None) -> DataFrame:
    """Nulls of x by the line between the nearest values on both sides; the ends stay null. Stretch by stretch, see ``carried``."""
    pair = F.when(F.col(x).isNotNull(), F.struct(F.col(order).alias("t"), F.col(x).alias("x")))
    both = carried(carried(df, pair, "_low", by, order, size=size, tasks=tasks), pair, "_high", by, order, forward=True, size=size)  # both by the same keys
    line = F.col("_low.x") + (F.col(order) - F.col("_low.t")) / (F.col("_high.t") - F.col("_low.t")) * (F.col("_high.x") - F.col("_low.x"))
    return both.withColumn(x, F.coalesce(F.col(x), line)).drop("_low", "_high")


def hazen(values: Column, p: float) -> Column:
    """Percentile of a sorted array with points at (i - 1/2) / n, linear between, flat outside."""
    n = F.size(values)
    at = F.lit(float(p)) * n + 0.5
    low = F.greatest(F.lit(1), F.least(n, F.floor(at).cast("int")))
    high = F.greatest(F.lit(1), F.least(n, F.floor(at).cast("int") + 1))
    a, b = F.element_at(values, low), F.element_at(values, high)
    return F.when(n > 0, a + (b - a) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), at - F.floor(at))))


def quantiles(df: DataFrame, x: str, by: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """Percentiles of a group's values, linear between neighbours: a column for each name of ``shares``.

    Bit for bit those of DuckDB, whose build multiplies and adds with one rounding:
    ``percentile`` rounds twice, and a value that lies on the edge of a bin may then fall to the other side.
    """
    rows = df.where(F.col(x).isNotNull()).select(*by, x, (F.row_number().over(ordered(by, [x])) - 1).alias("_k"), F.count("*").over(Window.partitionBy(*by)).alias("_n"))
    at = {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in shares.items()}
    nth = lambda k: F.max(F.when(F.col("_k") == k, F.col(x).cast("double")))
    found = rows.groupBy(*by, "_n").agg(*[c for n, q in at.items() for c in (nth(F.floor(q)).alias(f"_{n}0"), nth(F.ceil(q)).alias(f"_{n}1"))])

    def between(name: str) -> Column:
        a, b, d = F.col(f"_{name}0"), F.col(f"_{name}1"), at[name] - F.floor(at[name])
        return F.when(d == 0, a).otherwise(F.reflect(F.lit("java.lang.Math"), F.lit("fma"), a, 1 - d, b * d).cast("double"))

    return found.select(*by, *[between(name).alias(name) for name in shares])


def first_n(by: Sequence[str], order: Sequence[str], n: int) -> Column:
    return F.row_number().over(ordered(by, order)) <= n


def early(by: Sequence[str], order: Sequence[str]) -> Column:
    """Whether a row is in the first half, of floor(n / 2) rows."""
    return F.row_number().over(ordered(by, order)) <= F.floor(F.count("*").over(Window.partitionBy(*by)) / 2)
