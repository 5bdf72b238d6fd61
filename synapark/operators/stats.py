"""Statistics as column expressions and small grouped plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def safe(x: Column, y: Column) -> Column:
    return x / F.nullif(y, F.lit(0.0))


def sides(x: str, first: Column) -> tuple[Column, Column]:
    """Values of the two conditions of a contrast."""
    return F.when(first, F.col(x)), F.when(~first, F.col(x))


def independent_t(x: str, first: Column) -> list[Column]:
    """Two-sample t with pooled variance, and its degrees of freedom."""
    a, b = sides(x, first)
    n1, n2 = F.count(a), F.count(b)
    pooled = safe((n1 - 1) * F.var_samp(a) + (n2 - 1) * F.var_samp(b), (n1 + n2 - 2).cast("double"))
    t = safe(F.avg(a) - F.avg(b), F.sqrt(pooled * (1 / n1 + 1 / n2)))
    return [t.alias("t"), (n1 + n2 - 2).alias("df")]


def paired_t(delta: str) -> list[Column]:
    n = F.count(delta)
    return [safe(F.sqrt(n.cast("double")) * F.avg(delta), F.stddev_samp(delta)).alias("t"), (n - 1).alias("df")]


def cohens_d(x: str, first: Column) -> Column:
    """Difference of means over the pooled deviation (divisor n1 + n2 - 1)."""
    a, b = sides(x, first)
    n1, n2 = F.count(a), F.count(b)
    pooled = safe((n1 - 1) * F.var_samp(a) + (n2 - 1) * F.var_samp(b), (n1 + n2 - 1).cast("double"))
    return safe(F.avg(a) - F.avg(b), F.sqrt(pooled))


def paired_d(delta: str) -> Column:
    """Mean over deviation of the differences within pairs."""
    return safe(F.avg(delta), F.stddev_samp(delta))


def pooled_difference(x: str, first: Column) -> list[Column]:
    """Difference of means; difference of sums over the root of the number."""
    a, b = sides(x, first)
    return [(F.avg(a) - F.avg(b)).alias("diff"), safe(F.sum(a) - F.sum(b), F.sqrt(F.count(x).cast("double"))).alias("pooled")]


def correlation_t(x: str, y: str) -> list[Column]:
    """Pearson's r, and t with n - 2 degrees of freedom."""
    r, n = F.corr(x, y), F.count(F.col(x) + F.col(y))
    return [r.alias("r"), safe(r * F.sqrt((n - 2).cast("double")), F.sqrt(1 - r * r)).alias("t"), (n - 2).alias("df")]


def regression_t(y: str, x: str) -> list[Column]:
    """Slope of y on x and its t, over rows with both."""
    n = F.regr_count(y, x)
    slope = F.regr_slope(y, x)
    rest = F.regr_syy(y, x) - slope * F.regr_sxy(y, x)
    return [slope.alias("slope"), safe(slope, F.sqrt(safe(rest, (n - 2).cast("double")) / F.nullif(F.regr_sxx(y, x), F.lit(0.0)))).alias("t"), (n - 2).alias("df")]


def blocked_regression_t(df: DataFrame, y: str, x: str, block: str, by: Sequence[str]) -> DataFrame:
    """Slope of y on x with a constant for each block, and its t with n - blocks - 1 degrees of freedom.

    A block's constant takes its means out, so sums of products within blocks say all.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    cells = rows.groupBy(*by, block).agg(F.count("*").alias("n"), F.regr_sxx(y, x).alias("xx"), F.regr_syy(y, x).alias("yy"), F.regr_sxy(y, x).alias("xy"))
    out = cells.groupBy(*by).agg(F.sum("n").alias("n"), F.count("*").alias("blocks"), *[F.sum(c).alias(c) for c in ("xx", "yy", "xy")])
    slope, df_ = safe(F.col("xy"), F.col("xx")), F.col("n") - F.col("blocks") - 1
    rest = F.col("yy") - slope * F.col("xy")
    return out.select(*by, slope.alias("slope"), safe(slope, F.sqrt(safe(safe(rest, df_.cast("double")), F.col("xx")))).alias("t"), df_.alias("df"))


def rank_sum(df: DataFrame, x: str, positive: Column, by: Sequence[str]) -> DataFrame:
    """``ranked_auc`` with the rank sum's z, variance less ties."""
    ties = df.groupBy(*by, x).agg(F.count("*").alias("n"), F.sum(positive.cast("long")).alias("p"))
    rank = F.sum("n").over(Window.partitionBy(*by).orderBy(x)) - (F.col("n") - 1) / 2
    cube = F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")
    out = ties.withColumns({"_rank": rank, "_tie": cube}).groupBy(*by).agg(
        F.sum(F.col("_rank") * F.col("p")).alias("_r"), F.sum("p").alias("n_pos"), F.sum(F.col("n") - F.col("p")).alias("n_neg"), F.sum("_tie").alias("_t")
    )
    a, b, n = F.col("n_pos").cast("double"), F.col("n_neg").cast("double"), (F.col("n_pos") + F.col("n_neg")).cast("double")
    u = F.col("_r") - a * (a + 1) / 2
    spread = a * b / 12 * (n + 1 - safe(F.col("_t"), n * (n - 1)))
    return out.select(*by, "n_pos", "n_neg", safe(u, a * b).alias("auc"), safe(u - a * b / 2, F.sqrt(spread)).alias("z"))


def family_wise(p: str, q: float, by: Sequence[str]) -> Column:
    """Whether p holds at rate q for all of a family together (Bonferroni)."""
    return F.col(p) <= F.lit(q) / F.count("*").over(Window.partitionBy(*by))


def one_way(df: DataFrame, x: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """One-way analysis of variance: SS and df of effect and error, F, eta squared, omega squared."""
    cells = df.where(F.col(x).isNotNull()).groupBy(*by, group).agg(F.count("*").alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v"))
    total = F.sum(F.col("n") * F.col("m")) / F.sum("n")
    out = cells.groupBy(*by).agg(
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("_q"), total.alias("_m"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("ss_error"), (F.count("*") - 1).alias("df_effect")
    )
    out = out.withColumn("ss_effect", F.col("_q") - F.col("n") * F.col("_m") * F.col("_m")).withColumn("df_error", F.col("n") - F.col("df_effect") - 1)
    ms = safe(F.col("ss_error"), F.col("df_error").cast("double"))
    return out.select(
        *by,
        "ss_effect",
        "ss_error",
        "df_effect",
        "df_error",
        safe(safe(F.col("ss_effect"), F.col("df_effect").cast("double")), ms).alias("f"),
        safe(F.col("ss_effect"), F.col("ss_effect") + F.col("ss_error")).alias("eta2"),
        safe(F.col("ss_effect") - F.col("df_effect") * ms, F.col("ss_effect") + F.col("ss_error") + ms).alias("omega2"),
    )


def repeated_measures(df: DataFrame, y: str, subject: str, level: str) -> DataFrame:
    """Repeated-measures F over complete subjects: one value a subject and level."""
    cells = df.groupBy(subject, level).agg(F.avg(y).alias("y"))
    levels = cells.agg(F.countDistinct(level).alias("k"))
    whole = cells.groupBy(subject).agg(F.count("y").alias("_n"), F.avg("y").alias("_s")).join(F.broadcast(levels)).where("_n = k")
    full = cells.join(whole, subject)
    by_level = full.groupBy(level).agg(F.avg("y").alias("_l"), F.count("*").alias("_ns"))
    grand = full.agg(F.avg("y").alias("_m"), F.count("*").alias("_all"), F.first("k").alias("k"), F.var_pop("y").alias("_v"))
    subjects = whole.agg(F.var_pop("_s").alias("_vs"), F.count("*").alias("n"))
    effect = by_level.agg(F.var_pop("_l").alias("_vl"))
    one = grand.join(F.broadcast(subjects)).join(F.broadcast(effect))  # one row each
    ss_tot, ss_sub, ss_fac = F.col("_v") * F.col("_all"), F.col("_vs") * F.col("n") * F.col("k"), F.col("_vl") * F.col("k") * F.col("n")
    ms_err = (ss_tot - ss_sub - ss_fac) / ((F.col("n") - 1) * (F.col("k") - 1))
    return one.select("n", "k", (ss_fac / (F.col("k") - 1) / ms_err).alias("f"), (F.col("k") - 1).alias("df1"), ((F.col("n") - 1) * (F.col("k") - 1)).alias("df2"))


def ranked_auc(df: DataFrame, x: str, positive: Column, by: Sequence[str]) -> DataFrame:
    """Area under the ROC curve from average ranks: ties count half. Equal values are summed before ranks are run."""
    ties = df.groupBy(*by, x).agg(F.count("*").alias("n"), F.sum(positive.cast("long")).alias("p"))
    run = F.sum("n").over(Window.partitionBy(*by).orderBy(x))
    rank = run - (F.col("n") - 1) / 2
    out = ties.withColumn("_rank", rank).groupBy(*by).agg(F.sum(F.col("_rank") * F.col("p")).alias("_r"), F.sum("p").alias("n_pos"), F.sum(F.col("n") - F.col("p")).alias("n_neg"))
    auc = safe(F.col("_r") - F.col("n_pos") * (F.col("n_pos") + 1) / 2, (F.col("n_pos") * F.col("n_neg")).cast("double"))
    return out.select(*by, "n_pos", "n_neg", auc.alias("auc"))


def mutual_information(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Bits that x and y share, from their joint counts."""
    joint = df.groupBy(*by, x, y).agg(F.count("*").alias("n"))
    w = lambda *c: Window.partitionBy(*by, *c)
    n = F.sum("n").over(w()) if by else F.sum("n").over(Window.partitionBy(F.lit(0)))
    bits = F.col("n") / n * F.log2(F.col("n") * n / (F.sum("n").over(w(x)) * F.sum("n").over(w(y))))
    return joint.withColumn("_b", bits).groupBy(*by).agg(F.sum("_b").alias("bits"))


def false_discovery(df: DataFrame, p: str, key: str, q: float, by: Sequence[str], dependent: bool = True) -> DataFrame:
    """Which p values stay at rate q: p <= i / n * q / c, with c = 1 or the harmonic sum under dependence."""
    w = Window.partitionBy(*by)
    i = F.row_number().over(w.orderBy(p, key))
    n = F.count("*").over(w)
    ranked = df.withColumns({"_i": i, "_n": n})
    c = F.sum(1 / F.col("_i")).over(w) if dependent else F.lit(1.0)
    cut = F.max(F.when(F.col(p) <= F.col("_i") / F.col("_n") * q / c, F.col(p))).over(w)
    return ranked.withColumn("_cut", cut).withColumn("kept", F.coalesce(F.col(p) <= F.col("_cut"), F.lit(False))).drop("_i", "_n", "_cut")


def phase_coherence(re: str, im: str) -> Column:
    """Length of the mean unit vector."""
    size = F.nullif(F.hypot(re, im), F.lit(0.0))
    return F.hypot(F.avg(F.col(re) / size), F.avg(F.col(im) / size))


def ppc(re: str, im: str) -> Column:
    """Pairwise phase consistency: (|sum of unit vectors|^2 - n) / (n (n - 1))."""
    size = F.nullif(F.hypot(re, im), F.lit(0.0))
    n = F.count(F.col(re) / size)
    s = F.pow(F.sum(F.col(re) / size), 2) + F.pow(F.sum(F.col(im) / size), 2)
    return safe(s - n, (n * (n - 1)).cast("double"))


def wpli(im: str, debiased: bool = False) -> Column:
    """Weighted phase lag index of imaginary parts; the debiased square leaves out the pairs of a trial with itself."""
    if not debiased:
        return safe(F.abs(F.sum(im)), F.sum(F.abs(im)))
    own = F.sum(F.col(im) * F.col(im))
    return safe(F.pow(F.sum(im), 2) - own, F.pow(F.sum(F.abs(im)), 2) - own)


def kurtosis(x: str) -> Column:
    """Fourth standardised moment (3 for a normal distribution)."""
    return F.kurtosis(x) + 3


def orthogonal_power_correlation(a_re: str, a_im: str, b_re: str, b_im: str) -> Column:
    """Correlation of log powers of two signals, each time with one of them less what it shares in phase with the other; the mean of both ways.

    Standardised by the sample deviation and averaged over rows.
    """
    power = lambda re, im: F.col(re) * F.col(re) + F.col(im) * F.col(im)
    cross = F.col(b_im) * F.col(a_re) - F.col(b_re) * F.col(a_im)  # imaginary part of b times the conjugate of a
    logs = lambda x: F.log10(F.nullif(x, F.lit(0.0)))
    pa, pb = power(a_re, a_im), power(b_re, b_im)
    x, y = logs(pa), logs(cross * cross / F.nullif(pa, F.lit(0.0)))
    u, v = logs(pb), logs(cross * cross / F.nullif(pb, F.lit(0.0)))
    n = F.count("*")
    return (F.corr(x, y) + F.corr(u, v)) / 2 * (n - 1) / n
