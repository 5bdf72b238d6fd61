"""Joins of points and intervals, runs, and neighbours in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_bucket"


def bucket(t: Column, width: float) -> Column:
    """Number of the stretch of ``width`` that holds ``t``; floors below zero too."""
    return F.floor(t / F.lit(width)).cast("long")


def within(t: Column, start: Column, end: Column, closed: str = "left") -> Column:
    """Whether ``t`` lies in an interval: ``left`` is [start, end), ``both`` is [start, end], ``right`` (start, end]."""
    low = t > start if closed in ("right", "neither") else t >= start
    high = t <= end if closed in ("right", "both") else t < end
    return low & high


def range_join(points: DataFrame, ranges: DataFrame, width: float, *, t: str = "t", start: str = "start", end: str = "end", on: Sequence[str] = (), closed: str = "left") -> DataFrame:
    """Points paired with the intervals that hold them.

    Spark has no sort-based plan for a join on inequalities alone, so each
    interval goes to every stretch of ``width`` that it touches and a point to
    its own: an equi-join with the exact bounds as a residual condition. A point
    has one stretch, so a pair is found once. ``width`` near the usual interval
    length keeps copies at about two an interval.
    """
    spread = ranges.where(F.col(start) <= F.col(end)).withColumn(_BUCKET, F.explode(F.sequence(bucket(F.col(start), width), bucket(F.col(end), width))))
    keyed = points.withColumn(_BUCKET, bucket(F.col(t), width))
    joined = keyed.join(spread, [*on, _BUCKET])
    return joined.where(within(F.col(t), F.col(start), F.col(end), closed)).drop(_BUCKET)


def overlap_join(a: DataFrame, b: DataFrame, width: float, *, on: Sequence[str] = (), a_span: tuple[str, str] = ("a_start", "a_end"), b_span: tuple[str, str] = ("b_start", "b_end")) -> DataFrame:
    """Pairs of intervals [start, end) that overlap; a pair is taken in the stretch where the later one starts."""
    (s, e), (p, q) = a_span, b_span
    left = a.withColumn(_BUCKET, F.explode(F.sequence(bucket(F.col(s), width), bucket(F.col(e), width))))
    right = b.withColumn(_BUCKET, F.explode(F.sequence(bucket(F.col(p), width), bucket(F.col(q), width))))
    joined = left.join(right, [*on, _BUCKET]).where((F.col(s) < F.col(q)) & (F.col(p) < F.col(e)))
    return joined.where(F.col(_BUCKET) == bucket(F.greatest(F.col(s), F.col(p)), width)).drop(_BUCKET)


def band_join(a: DataFrame, b: DataFrame, lag: float, *, t_a: str = "t_a", t_b: str = "t_b", on: Sequence[str] = ()) -> DataFrame:
    """Pairs of rows with |t_b - t_a| <= lag: ``b`` in stretches of ``lag``, ``a`` in its own and both neighbours."""
    here = bucket(F.col(t_a), lag)
    left = a.withColumn(_BUCKET, F.explode(F.array(here - 1, here, here + 1)))
    right = b.withColumn(_BUCKET, bucket(F.col(t_b), lag))
    return left.join(right, [*on, _BUCKET]).where(F.abs(F.col(t_b) - F.col(t_a)) <= lag).drop(_BUCKET)


def asof_join(left: DataFrame, right: DataFrame, *, t: str, values: Sequence[str], by: Sequence[str] = (), direction: str = "backward", width: float | None = None) -> DataFrame:
    """Each left row with ``values`` of the last right row at or before it (``forward``: first at or after).

    A union ordered in time carries the right row along, and no pair of rows is
    ever formed. With ``width`` it does so inside stretches of that much time, and
    the last right row of a stretch goes on to those behind it by one row a stretch:
    no task holds a whole ``by`` group, whatever its length. Without it a group is one
    window. The right row's time is ``<t>_right``.
    """
    side, back = "_side", direction == "backward"
    held = F.struct(F.col(t).alias(f"{t}_right"), *[F.col(v) for v in values])
    kept = [c for c in left.columns]
    # of equal times the right row comes first backward, last forward
    first = 0 if back else 1
    l = left.select(*kept, F.lit(1 - first).alias(side), F.lit(None).cast(right.select(held.alias("x")).schema["x"].dataType).alias("_held"))
    r = right.select(*[F.col(c) if c in (t, *by) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in kept], F.lit(first).alias(side), held.alias("_held"))
    rows = l.withColumn("_left", F.lit(True)).unionByName(r.withColumn("_left", F.lit(False)))
    if width is not None:
        rows = rows.withColumn("_part", bucket(F.col(t), width))
    keys = [*by, "_part"] if width is not None else list(by)
    frame = Window.partitionBy(*keys).orderBy(t, side)
    if back:
        found = F.last("_held", ignorenulls=True).over(frame.rowsBetween(Window.unboundedPreceding, 0))
    else:
        found = F.first("_held", ignorenulls=True).over(frame.rowsBetween(0, Window.unboundedFollowing))
    out = rows.withColumn("_found", found).where("_left")
    if width is None:
        return out.select(*kept, "_found.*")
    # of equal times that which the window would take as well: the greatest row, or the least
    parts = rows.groupBy(*by, "_part").agg((F.max if back else F.min)("_held").alias("_edge"))
    over = Window.partitionBy(*by).orderBy("_part")
    past = F.last("_edge", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)) if back else F.first("_edge", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing))
    parts = parts.select(*by, "_part", past.alias("_past"))
    return out.join(parts, [*by, "_part"], "left").withColumn("_found", F.coalesce("_found", "_past")).select(*kept, "_found.*")


def interpolate_at(at: DataFrame, track: DataFrame, *, t: str, value: str, by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """``value`` of a track, linear between its two neighbours; null outside. Equal times count once, by their mean."""
    once = track.groupBy(*by, t).agg(F.avg(value).alias(value))
    low = asof_join(at, once, t=t, values=[value], by=by, width=width).withColumnsRenamed({f"{t}_right": "_t0", value: "_v0"})
    both = asof_join(low, once, t=t, values=[value], by=by, direction="forward", width=width).withColumnsRenamed({f"{t}_right": "_t1", value: "_v1"})
    share = (F.col(t) - F.col("_t0")) / (F.col("_t1") - F.col("_t0"))
    found = F.when(F.col("_t0") == F.col("_t1"), F.col("_v0")).otherwise(F.col("_v0") + share * (F.col("_v1") - F.col("_v0")))
    return both.withColumn(value, found).drop("_t0", "_t1", "_v0", "_v1")


def nearest(a: DataFrame, b: DataFrame, *, t: str, by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Signed distance of each row to the nearest time in ``b`` (the earlier one on a tie)."""
    times = b.select(*by, t).distinct()
    low = asof_join(a, times, t=t, values=[], by=by, width=width).withColumnRenamed(f"{t}_right", "_low")
    both = asof_join(low, times, t=t, values=[], by=by, direction="forward", width=width).withColumnRenamed(f"{t}_right", "_high")
    down, up = F.col(t) - F.col("_low"), F.col("_high") - F.col(t)
    best = F.when(up.isNull() | (down <= up), F.col("_low")).otherwise(F.col("_high"))
    return both.withColumn("nearest", best).withColumn("gap", F.col(t) - F.col("nearest")).drop("_low", "_high")


def runs(df: DataFrame, flag: Column, *, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Intervals of consecutive rows in which ``flag`` holds: first, last, length of each."""
    window = Window.partitionBy(*by).orderBy(order)
    numbered = df.select(*by, order, flag.alias("_on"), F.row_number().over(window).alias("_n"))
    on = numbered.where("_on").withColumn("_island", F.col("_n") - F.row_number().over(window))
    return on.groupBy(*by, "_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length")).drop("_island")


def coverage(ranges: DataFrame, *, start: str = "start", end: str = "end", by: Sequence[str] = ()) -> DataFrame:
    """Stretches between interval edges with how many [start, end) intervals cover each: a sweep over the edges."""
    edges = ranges.select(*by, F.col(start).alias("at"), F.lit(1).alias("step")).unionByName(ranges.select(*by, F.col(end).alias("at"), F.lit(-1).alias("step")))
    summed = edges.groupBy(*by, "at").agg(F.sum("step").alias("step"))
    window = Window.partitionBy(*by).orderBy("at")
    swept = summed.select(*by, F.col("at").alias("start"), F.lead("at").over(window).alias("end"), F.sum("step").over(window).alias("depth"))
    return swept.where("end IS NOT NULL AND depth > 0")


def expand(ranges: DataFrame, *, start: str = "start", end: str = "end", name: str = "sample") -> DataFrame:
    """One row for every whole number of each [start, end]."""
    return ranges.withColumn(name, F.explode(F.sequence(F.col(start), F.col(end)))).drop(start, end)


def cycles(points: DataFrame, reference: DataFrame, *, t: str = "t", by: Sequence[str] = (), width: float | None = None) -> DataFrame:
    """Which reference interval each point is in, with its time since the interval began."""
    marks = reference.select(*by, t).distinct()
    found = asof_join(points, marks, t=t, values=[], by=by, width=width)
    return found.withColumn("since", F.col(t) - F.col(f"{t}_right"))


def fit_clock(to: DataFrame, frm: DataFrame, *, t: str, by: Sequence[str], key: str) -> DataFrame:
    """The line from one device's time to another's, through their pulses in order: n, slope, offset.

    Only as many pulses as both have count; where some are missing, see ``fit_clock_nearest``.
    """
    w = Window.partitionBy(*by).orderBy(t, key)
    nth = lambda df, name: df.select(*by, F.col(t).alias(name), F.row_number().over(w).alias("_k"))
    both = nth(to, "_y").join(nth(frm, "_x"), [*by, "_k"])
    return both.groupBy(*by).agg(F.count("*").alias("n"), F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("offset"))


def fit_clock_nearest(to: DataFrame, frm: DataFrame, *, t: str, by: Sequence[str], rounds: int = 8) -> DataFrame:
    """The same where pulses are missing: each round pairs every pulse under the last line with its nearest, and fits through those pairs.

    Starts from slope 1 and the offset of the first pulses; the slope stays between 0.5 and 1.5.
    """
    first = lambda df, name: df.groupBy(*by).agg(F.min(t).alias(name))
    line = first(to, "_a").join(first(frm, "_b"), list(by)).select(*by, F.lit(1.0).alias("slope"), (F.col("_a") - F.col("_b")).alias("offset"))
    for _ in range(rounds):
        moved = frm.join(line, list(by)).select(*by, F.col(t).alias("_x"), (F.col(t) * F.col("slope") + F.col("offset")).alias(t))
        pairs = nearest(moved, to, t=t, by=by).withColumn("_far", F.abs("gap"))
        # a pulse whose partner is missing lies far from any other
        pairs = pairs.join(pairs.groupBy(*by).agg(F.percentile("_far", F.lit(0.5)).alias("_usual")), list(by)).where("_far <= 3 * _usual")
        slope = F.greatest(F.lit(0.5), F.least(F.lit(1.5), F.coalesce(F.regr_slope("nearest", "_x"), F.lit(1.0))))
        line = pairs.groupBy(*by).agg(slope.alias("slope"), F.avg("nearest").alias("_m"), F.avg("_x").alias("_n")).select(*by, "slope", (F.col("_m") - F.col("slope") * F.col("_n")).alias("offset"))
    return line
