"""Contrasts, effect sizes, ranks, coherence measures."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import stats as S
from . import tables as T
from .registry import query

C = T.CONDITIONS


def rounded(columns, digits=8):
    return [F.round(c, digits).alias(n) for c, n in columns]


@query(f"""WITH {C}, g AS (SELECT session, count(*) FILTER (outcome = 'F') AS n1, count(*) FILTER (outcome <> 'F') AS n2, avg(x) FILTER (outcome = 'F') AS m1, avg(x) FILTER (outcome <> 'F') AS m2, coalesce(var_samp(x) FILTER (outcome = 'F'), 0) AS v1, coalesce(var_samp(x) FILTER (outcome <> 'F'), 0) AS v2 FROM cond GROUP BY session)
 SELECT session, round((m1 - m2) / nullif(sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / nullif(n1 + n2 - 2, 0) * (1.0 / n1 + 1.0 / n2)), 0), 8) AS t, n1 + n2 - 2 AS df FROM g WHERE n1 > 1 AND n2 > 1""")
def independent_t(spark, d):
    """Two-sample t of outcome F against the others, by session."""
    first = F.col("outcome") == "F"
    out = T.conditions(spark, d).groupBy("session").agg(*S.independent_t("x", first), F.count(F.when(first, 1)).alias("n1"), F.count(F.when(~first, 1)).alias("n2"))
    return out.where("n1 > 1 AND n2 > 1").select("session", F.round("t", 8).alias("t"), "df")


@query(f"""WITH {C}, u AS (SELECT session, avg(x) FILTER (block <= 2) - avg(x) FILTER (block > 2) AS delta FROM cond GROUP BY session)
 SELECT round(sqrt(count(delta)) * avg(delta) / stddev_samp(delta), 8) AS t, count(delta) - 1 AS df FROM u""")
def paired_t(spark, d):
    """Paired t over sessions of early against late blocks."""
    a, b = S.sides("x", F.col("block") <= 2)
    u = T.conditions(spark, d).groupBy("session").agg((F.avg(a) - F.avg(b)).alias("delta"))
    return u.agg(*S.paired_t("delta")).select(F.round("t", 8).alias("t"), "df")


@query(f"""WITH {C}, a AS (SELECT session, avg(x) AS m FROM cond WHERE block = 1 GROUP BY session), u AS (SELECT c.session, avg(c.x) - any_value(a.m) AS delta FROM cond c JOIN a ON a.session = c.session WHERE c.block > 1 GROUP BY c.session)
 SELECT round(sqrt(count(delta)) * avg(delta) / stddev_samp(delta), 8) AS t, count(delta) - 1 AS df FROM u""")
def activation_vs_baseline(spark, d):
    """Paired t of activation against its session's baseline."""
    c = T.conditions(spark, d)
    base = c.where("block = 1").groupBy("session").agg(F.avg("x").alias("m"))
    u = c.where("block > 1").groupBy("session").agg(F.avg("x").alias("x")).join(base, "session").select((F.col("x") - F.col("m")).alias("delta"))
    return u.agg(*S.paired_t("delta")).select(F.round("t", 8).alias("t"), "df")


@query(f"""WITH {C}, c AS (SELECT outcome, block, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM cond GROUP BY ALL), o AS (SELECT block, sum(n * m) / sum(n) AS gm FROM c GROUP BY block),
 s AS (SELECT c.block, sum(n * (m - gm) * (m - gm)) AS se, sum(n * v) AS sw, count(*) - 1 AS dfe, sum(n) - count(*) AS dfw FROM c JOIN o ON o.block = c.block GROUP BY c.block)
 SELECT block, round(se / dfe / (sw / dfw), 6) AS f, dfe AS df_effect, CAST(dfw AS BIGINT) AS df_error, round(se / (se + sw), 8) AS eta2, round((se - dfe * sw / dfw) / (se + sw + sw / dfw), 8) AS omega2 FROM s""")
def one_way_anova(spark, d):
    """F and effect sizes of the outcome, by block."""
    out = S.one_way(T.conditions(spark, d), "x", "outcome", ["block"])
    return out.select("block", F.round("f", 6).alias("f"), "df_effect", "df_error", F.round("eta2", 8).alias("eta2"), F.round("omega2", 8).alias("omega2"))


@query(f"""WITH {C}, c AS (SELECT session, block, avg(x) AS y FROM cond GROUP BY ALL), k AS (SELECT count(DISTINCT block) AS k FROM c), w AS (SELECT session, avg(y) AS s FROM c CROSS JOIN k GROUP BY session, k HAVING count(*) = k),
 f AS (SELECT c.*, w.s FROM c JOIN w ON w.session = c.session), g AS (SELECT avg(y) AS m, count(*) AS a, var_pop(y) AS v FROM f), l AS (SELECT block, avg(y) AS l FROM f GROUP BY block),
 z AS (SELECT a * v AS tot, (SELECT var_pop(s) * count(*) FROM w) * k AS sub, (SELECT var_pop(l) FROM l) * a AS fac, k, (SELECT count(*) FROM w) AS n FROM g, k)
 SELECT n, k, round(fac / (k - 1) / ((tot - sub - fac) / ((n - 1) * (k - 1))), 6) AS f, k - 1 AS df1, (n - 1) * (k - 1) AS df2 FROM z""")
def repeated_measures(spark, d):
    """Repeated-measures F of the block over sessions with all blocks."""
    return S.repeated_measures(T.conditions(spark, d), "x", "session", "block").select("n", "k", F.round("f", 6).alias("f"), "df1", "df2")


@query(f"WITH {T.SAMPLES}, g AS (SELECT channel, corr(v, w) AS r, count(*) AS n FROM smp GROUP BY channel) SELECT channel, round(r, 8) AS r, round(r * sqrt(n - 2) / sqrt(1 - r * r), 8) AS t, n - 2 AS df FROM g")
def correlation_t(spark, d):
    """Correlation of two signals by channel."""
    out = T.samples(spark, d).groupBy("channel").agg(*S.correlation_t("v", "w"))
    return out.select("channel", *rounded([("r", "r"), ("t", "t")]), "df")


@query(f"WITH {T.SAMPLES}, g AS (SELECT channel, regr_slope(v, w) AS b, regr_syy(v, w) - regr_slope(v, w) * regr_sxy(v, w) AS e, regr_sxx(v, w) AS sx, count(*) AS n FROM smp GROUP BY channel) SELECT channel, round(b, 8) AS slope, round(b / sqrt(e / (n - 2) / sx), 6) AS t, n - 2 AS df FROM g")
def regression_t(spark, d):
    """Slope of one signal on the other by channel, and its t."""
    out = T.samples(spark, d).groupBy("channel").agg(*S.regression_t("v", "w"))
    return out.select("channel", F.round("slope", 8).alias("slope"), F.round("t", 6).alias("t"), "df")


@query(f"WITH {C}, u AS (SELECT session, regr_slope(x, block) AS delta FROM cond GROUP BY session) SELECT round(sqrt(count(delta)) * avg(delta) / stddev_samp(delta), 6) AS t, count(delta) - 1 AS df FROM u WHERE NOT isnan(delta)")
def dependent_regression_t(spark, d):
    """A slope for every session, then t over sessions."""
    u = T.conditions(spark, d).groupBy("session").agg(F.regr_slope("x", "block").alias("delta")).where("delta IS NOT NULL AND NOT isnan(delta)")
    return u.agg(*S.paired_t("delta")).select(F.round("t", 6).alias("t"), "df")


@query(f"""WITH {C}, g AS (SELECT block, count(*) FILTER (outcome = 'F') AS n1, count(*) FILTER (outcome <> 'F') AS n2, avg(x) FILTER (outcome = 'F') AS m1, avg(x) FILTER (outcome <> 'F') AS m2, var_samp(x) FILTER (outcome = 'F') AS v1, var_samp(x) FILTER (outcome <> 'F') AS v2, sum(x) FILTER (outcome = 'F') AS s1, sum(x) FILTER (outcome <> 'F') AS s2 FROM cond GROUP BY block)
 SELECT block, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 1)), 8) AS d, round(m1 - m2, 8) AS diff, round((s1 - s2) / sqrt(n1 + n2), 3) AS pooled FROM g""")
def effect_size(spark, d):
    """Cohen's d, difference of means and pooled difference by block."""
    first = F.col("outcome") == "F"
    out = T.conditions(spark, d).groupBy("block").agg(S.cohens_d("x", first).alias("d"), *S.pooled_difference("x", first))
    return out.select("block", F.round("d", 8).alias("d"), F.round("diff", 8).alias("diff"), F.round("pooled", 3).alias("pooled"))


@query(f"""WITH {T.EVENTS}, t AS (SELECT user_id, value, count(*) AS n, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS p FROM ev GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY value) - (n - 1) / 2.0 AS rk FROM t),
 g AS (SELECT user_id, CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n - p) AS BIGINT) AS n_neg, sum(rk * p) AS s FROM r GROUP BY user_id) SELECT user_id, n_pos, n_neg, round((s - n_pos * (n_pos + 1) / 2.0) / nullif(n_pos * n_neg, 0), 9) AS auc FROM g""")
def roc_area(spark, d):
    """How well a value tells clicks from other events, by user."""
    out = S.ranked_auc(T.events(spark, d), "value", F.col("event_type") == "click", ["user_id"])
    return out.select("user_id", "n_pos", "n_neg", F.round("auc", 9).alias("auc"))


@query(f"""WITH {C}, j AS (SELECT session % 10 AS grp, outcome, block, count(*) AS n FROM cond GROUP BY ALL), m AS (SELECT *, sum(n) OVER (PARTITION BY grp) AS a, sum(n) OVER (PARTITION BY grp, outcome) AS o, sum(n) OVER (PARTITION BY grp, block) AS b FROM j)
 SELECT grp, round(sum(n / a * log2(n * a / (o * b))), 9) AS bits FROM m GROUP BY grp""")
def mutual_information(spark, d):
    """Bits that outcome and block share."""
    c = T.conditions(spark, d).withColumn("grp", F.col("session") % 10)
    return S.mutual_information(c, "outcome", "block", ["grp"]).select("grp", F.round("bits", 9).alias("bits"))


@query("""WITH p AS (SELECT l_suppkey AS family, l_orderkey * 10 + l_linenumber AS test, min(l_extendedprice) / 200000.0 AS p FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY p, test) AS i, count(*) OVER (PARTITION BY family) AS n FROM p),
 c AS (SELECT *, sum(1.0 / i) OVER (PARTITION BY family) AS c FROM r), k AS (SELECT *, max(CASE WHEN p <= i / n::DOUBLE * 0.9 / c THEN p END) OVER (PARTITION BY family) AS cut FROM c) SELECT family, count(*) AS n, CAST(sum(CASE WHEN p <= cut THEN 1 ELSE 0 END) AS BIGINT) AS n_kept FROM k GROUP BY family""")
def false_discovery(spark, d):
    """How many of a family's p values stay under dependence."""
    rows = T.read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("family"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("test")).agg((F.min("l_extendedprice") / 200000.0).alias("p"))
    out = S.false_discovery(rows, "p", "test", 0.9, ["family"])
    return out.groupBy("family").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("long")).alias("n_kept"))


Z = "z AS (SELECT user_id, event_id, event_type, cos(value) * depth AS re, sin(value) * depth AS im FROM ev WHERE depth > 0)"


def phases(spark, d):
    return T.events(spark, d).where("depth > 0").select("user_id", "event_id", "event_type", (F.cos("value") * F.col("depth")).alias("re"), (F.sin("value") * F.col("depth")).alias("im"))


@query(f"WITH {T.EVENTS}, {Z}, u AS (SELECT user_id, count(*) AS n, sum(re / sqrt(re * re + im * im)) AS a, sum(im / sqrt(re * re + im * im)) AS b FROM z GROUP BY user_id) SELECT user_id, round(sqrt(a * a + b * b) / n, 9) AS itc, round((a * a + b * b - n) / nullif(n * (n - 1), 0), 9) AS ppc FROM u")
def phase_consistency(spark, d):
    """Inter-trial coherence and pairwise phase consistency."""
    return phases(spark, d).groupBy("user_id").agg(F.round(S.phase_coherence("re", "im"), 9).alias("itc"), F.round(S.ppc("re", "im"), 9).alias("ppc"))


@query(f"WITH {T.EVENTS}, {Z} SELECT user_id, round(abs(sum(im)) / nullif(sum(abs(im)), 0), 9) AS wpli, round((sum(im) * sum(im) - sum(im * im)) / nullif(sum(abs(im)) * sum(abs(im)) - sum(im * im), 0), 8) AS debiased FROM z GROUP BY user_id HAVING count(*) > 1")
def weighted_phase_lag(spark, d):
    """Weighted phase lag index, plain and debiased."""
    return phases(spark, d).groupBy("user_id").agg(F.count("*").alias("n"), F.round(S.wpli("im"), 9).alias("wpli"), F.round(S.wpli("im", True), 8).alias("debiased")).where("n > 1").drop("n")


@query(f"""WITH {T.EVENTS}, {Z}, u AS (SELECT user_id, event_type = 'click' AS c, avg(re / sqrt(re * re + im * im)) AS a, avg(im / sqrt(re * re + im * im)) AS b FROM z GROUP BY ALL), p AS (SELECT user_id, max(CASE WHEN c THEN a END) AS a1, max(CASE WHEN c THEN b END) AS b1, max(CASE WHEN NOT c THEN a END) AS a2, max(CASE WHEN NOT c THEN b END) AS b2 FROM u GROUP BY user_id)
 SELECT user_id, round(sqrt(a1 * a1 + b1 * b1) - sqrt(a2 * a2 + b2 * b2), 9) AS diffabs, round(sqrt((a1 - a2) * (a1 - a2) + (b1 - b2) * (b1 - b2)), 9) AS absdiff FROM p""")
def coherence_difference(spark, d):
    """Difference of inter-trial coherence between two conditions, in both orders."""
    z = phases(spark, d).withColumn("c", F.col("event_type") == "click")
    size = F.hypot("re", "im")
    m = {f"{x}{k}": F.avg(F.when(F.col("c") if k == 1 else ~F.col("c"), F.col(n) / size)) for k in (1, 2) for x, n in (("a", "re"), ("b", "im"))}
    out = z.groupBy("user_id").agg(*[v.alias(k) for k, v in m.items()])
    return out.select("user_id", F.round(F.hypot("a1", "b1") - F.hypot("a2", "b2"), 9).alias("diffabs"), F.round(F.hypot(F.col("a1") - F.col("a2"), F.col("b1") - F.col("b2")), 9).alias("absdiff"))


@query(f"""WITH {T.EVENTS}, {Z}, k AS (SELECT user_id % 8 AS chan, event_id // 20 AS trial, sum(re) AS re, sum(im) AS im FROM z GROUP BY ALL)
 SELECT a.chan AS chan_a, b.chan AS chan_b, count(*) AS n, round(avg(a.re * b.re + a.im * b.im), 6) AS re, round(avg(a.im * b.re - a.re * b.im), 6) AS im FROM k a JOIN k b ON a.trial = b.trial AND a.chan < b.chan GROUP BY ALL""")
def cross_spectrum(spark, d):
    """Cross-spectra of channel pairs over trials."""
    k = phases(spark, d).groupBy((F.col("user_id") % 8).alias("chan"), F.expr("event_id div 20").alias("trial")).agg(F.sum("re").alias("re"), F.sum("im").alias("im"))
    a = k.select("trial", *[F.col(c).alias(f"{c}_a") for c in ("chan", "re", "im")])
    b = k.select("trial", *[F.col(c).alias(f"{c}_b") for c in ("chan", "re", "im")])
    pairs = a.join(b, "trial").where("chan_a < chan_b")
    return pairs.groupBy("chan_a", "chan_b").agg(F.count("*").alias("n"), F.round(F.avg(F.expr("re_a * re_b + im_a * im_b")), 6).alias("re"), F.round(F.avg(F.expr("im_a * re_b - re_a * im_b")), 6).alias("im"))


@query(f"""WITH {T.EVENTS}, {Z}, k AS (SELECT user_id % 8 AS chan, event_id // 20 AS trial, event_type = 'click' AS c, sum(re) AS re, sum(im) AS im FROM z GROUP BY ALL),
 p AS (SELECT a.chan AS chan_a, b.chan AS chan_b, a.c, count(*) AS n, sqrt(pow(sum(a.re * b.re + a.im * b.im), 2) + pow(sum(a.im * b.re - a.re * b.im), 2)) / sqrt(sum(a.re * a.re + a.im * a.im) * sum(b.re * b.re + b.im * b.im)) AS coh FROM k a JOIN k b ON a.trial = b.trial AND a.c = b.c AND a.chan < b.chan GROUP BY ALL HAVING count(*) > 2),
 q AS (SELECT chan_a, chan_b, max(CASE WHEN c THEN coh END) AS c1, max(CASE WHEN NOT c THEN coh END) AS c2, max(CASE WHEN c THEN 2 * n END) AS d1, max(CASE WHEN NOT c THEN 2 * n END) AS d2 FROM p GROUP BY ALL)
 SELECT chan_a, chan_b, round((atanh(c1) - 1.0 / (d1 - 2) - atanh(c2) + 1.0 / (d2 - 2)) / sqrt(1.0 / (d1 - 2) + 1.0 / (d2 - 2)), 7) AS z FROM q WHERE c1 IS NOT NULL AND c2 IS NOT NULL""")
def coherence_z(spark, d):
    """Difference of coherence between conditions in units of its deviation, by channel pair."""
    k = phases(spark, d).groupBy((F.col("user_id") % 8).alias("chan"), F.expr("event_id div 20").alias("trial"), (F.col("event_type") == "click").alias("c")).agg(F.sum("re").alias("re"), F.sum("im").alias("im"))
    a = k.select("trial", "c", *[F.col(x).alias(f"{x}_a") for x in ("chan", "re", "im")])
    b = k.select("trial", "c", *[F.col(x).alias(f"{x}_b") for x in ("chan", "re", "im")])
    s = lambda e: F.sum(F.expr(e))
    coh = F.hypot(s("re_a * re_b + im_a * im_b"), s("im_a * re_b - re_a * im_b")) / F.sqrt(s("re_a * re_a + im_a * im_a") * s("re_b * re_b + im_b * im_b"))
    p = a.join(b, ["trial", "c"]).where("chan_a < chan_b").groupBy("chan_a", "chan_b", "c").agg(F.count("*").alias("n"), coh.alias("coh")).where("n > 2")
    q = p.groupBy("chan_a", "chan_b").agg(*[F.max(F.when(F.col("c") if k == 1 else ~F.col("c"), F.col(x) * (2 if x == "n" else 1))).alias(f"{x}{k}") for k in (1, 2) for x in ("coh", "n")])
    z = F.expr("(atanh(coh1) - 1.0D / (n1 - 2) - atanh(coh2) + 1.0D / (n2 - 2)) / sqrt(1.0D / (n1 - 2) + 1.0D / (n2 - 2))")
    return q.where("coh1 IS NOT NULL AND coh2 IS NOT NULL").select("chan_a", "chan_b", F.round(z, 7).alias("z"))


@query(f"""WITH {C}, n AS (SELECT session, count(*) AS n, sum(x) AS s FROM cond GROUP BY session) SELECT c.session, c.trial, round((s - x) / nullif(n - 1, 0), 8) AS jack FROM cond c JOIN n ON n.session = c.session""")
def jackknife(spark, d):
    """Mean of a session without each of its trials."""
    w = Window.partitionBy("session")
    return T.conditions(spark, d).select("session", "trial", F.round(S.safe(F.sum("x").over(w) - F.col("x"), (F.count("*").over(w) - 1).cast("double")), 8).alias("jack"))


@query(f"""WITH {T.SAMPLES}, m AS (SELECT channel, sample // 50 AS trial, v FROM smp), a AS (SELECT channel, trial, count(*) AS n, var_pop(v) AS var, max(v) - min(v) AS span, max(abs(v)) AS maxabs, avg(v) AS m FROM m GROUP BY ALL)
 SELECT channel, trial, n, round(var, 7) AS var, span, maxabs, round(1.0 / nullif(var, 0), 7) AS inverse FROM a""")
def artifact_metrics(spark, d):
    """Measures of each trial and channel by which artifacts are found."""
    m = T.samples(spark, d).groupBy("channel", F.expr("sample div 50").alias("trial")).agg(F.count("*").alias("n"), F.var_pop("v").alias("var"), (F.max("v") - F.min("v")).alias("span"), F.max(F.abs("v")).alias("maxabs"))
    return m.select("channel", "trial", "n", F.round("var", 7).alias("var"), "span", "maxabs", F.round(S.safe(F.lit(1.0), F.col("var")), 7).alias("inverse"))


@query(f"""WITH {T.SAMPLES}, z AS (SELECT channel, sample, (v - avg(v) OVER (PARTITION BY channel)) / stddev_pop(v) OVER (PARTITION BY channel) AS z FROM smp), s AS (SELECT sample, sum(z) / sqrt(count(*)) AS z, count(*) AS n FROM z GROUP BY sample) SELECT sample, n, round(z, 8) AS z FROM s WHERE z >= 1.5""")
def artifact_zvalue(spark, d):
    """Samples whose z values, summed over channels, are beyond a cutoff."""
    w = Window.partitionBy("channel")
    z = T.samples(spark, d).select("sample", ((F.col("v") - F.avg("v").over(w)) / F.stddev_pop("v").over(w)).alias("z"))
    return z.groupBy("sample").agg((F.sum("z") / F.sqrt(F.count("*"))).alias("z"), F.count("*").alias("n")).where("z >= 1.5").select("sample", "n", F.round("z", 8).alias("z"))
