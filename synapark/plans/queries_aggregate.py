"""Spike-train measures, unit quality, templates, maps."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import windows as W
from . import tables as T
from .registry import query

H = T.HOUR
S, SM, C = T.SPIKES, T.SAMPLES, T.CONDITIONS
ISI = S + ", isi AS (SELECT unit, t, spike_id, t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike_id) AS isi FROM spike)"


def isi(spark, d):
    return T.spikes(spark, d).select("unit", "t", "spike_id", W.interval("t", W.ordered(["unit"], ["t", "spike_id"])).alias("isi"))


@query(f"WITH {ISI} SELECT unit, CAST(CASE WHEN isi = {200 * H} THEN 199 ELSE isi // {H} END AS BIGINT) AS bin, count(*) AS n FROM isi WHERE isi BETWEEN 0 AND {200 * H} GROUP BY ALL")
def isi_histogram(spark, d):
    """Intervals by hour up to 200, of which the last bin has its right edge too."""
    x = isi(spark, d).where(f"isi BETWEEN 0 AND {200 * H}")
    return x.groupBy("unit", F.when(F.col("isi") == 200 * H, 199).otherwise(F.expr(f"isi div {H}")).cast("long").alias("bin")).agg(F.count("*").alias("n"))


@query(f"WITH {ISI}, p AS (SELECT *, lag(isi) OVER (PARTITION BY unit ORDER BY t, spike_id) AS was FROM isi) SELECT unit, count(isi) AS n, round(stddev_samp(isi) / avg(isi), 9) AS cv, round(2 * avg(abs(isi - was)) / nullif(avg((isi + was) / 2), 0), 9) AS cv2, round(avg(CASE WHEN isi < {6 * H} THEN 1.0 ELSE 0.0 END) , 9) AS short FROM p WHERE isi IS NOT NULL GROUP BY unit")
def isi_properties(spark, d):
    """Variation of a unit's intervals, and the share of short ones."""
    x = isi(spark, d)
    p = x.withColumn("was", F.lag("isi").over(W.ordered(["unit"], ["t", "spike_id"]))).where("isi IS NOT NULL")
    return p.groupBy("unit").agg(
        F.count("isi").alias("n"),
        F.round(F.stddev_samp("isi") / F.avg("isi"), 9).alias("cv"),
        F.round(2 * F.avg(F.abs(F.col("isi") - F.col("was"))) / F.nullif(F.avg((F.col("isi") + F.col("was")) / 2), F.lit(0.0)), 9).alias("cv2"),
        F.round(F.avg((F.col("isi") < 6 * H).cast("double")), 9).alias("short"),
    )


@query(f"""WITH {S}, b AS (SELECT unit, t // {24 * H} AS bin, count(*) AS n FROM spike GROUP BY ALL), r AS (SELECT min(t // {24 * H}) AS lo, max(t // {24 * H}) AS hi FROM spike), g AS (SELECT unit, k AS bin FROM (SELECT DISTINCT unit FROM spike), r, generate_series(lo, hi) x(k)),
 f AS (SELECT g.unit, coalesce(n, 0) AS n FROM g LEFT JOIN b ON b.unit = g.unit AND b.bin = g.bin) SELECT unit, count(*) AS bins, round(avg(n), 9) AS rate, round(var_samp(n) / nullif(avg(n), 0), 9) AS fano FROM f GROUP BY unit""")
def rate_and_fano(spark, d):
    """Mean count a day and its Fano factor over days, empty ones too."""
    s = T.spikes(spark, d).withColumn("bin", F.expr(f"t div {24 * H}"))
    r = s.agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"))
    g = s.select("unit").distinct().join(F.broadcast(r)).withColumn("bin", F.explode(F.sequence("lo", "hi"))).select("unit", "bin")
    n = F.coalesce("n", F.lit(0))
    f = g.join(s.groupBy("unit", "bin").agg(F.count("*").alias("n")), ["unit", "bin"], "left").withColumn("n", n)
    return f.groupBy("unit").agg(F.count("*").alias("bins"), F.round(F.avg("n"), 9).alias("rate"), F.round(F.var_samp("n") / F.nullif(F.avg("n"), F.lit(0.0)), 9).alias("fano"))


@query(f"""WITH {S}, b AS (SELECT unit, t // {24 * H} AS bin, CAST(count(*) AS DOUBLE) AS n FROM spike GROUP BY ALL), l AS (SELECT unit, list_sort(list(n)) AS v FROM b GROUP BY unit), q AS (SELECT unit, v, len(v) AS k, 0.9 * len(v) + 0.5 AS p FROM l),
 z AS (SELECT unit, v, k, v[greatest(1, least(k, CAST(floor(p) AS BIGINT)))] AS a, v[greatest(1, least(k, CAST(floor(p) AS BIGINT) + 1))] AS c, least(1, greatest(0, p - floor(p))) AS f FROM q)
 SELECT unit, round(a + (c - a) * f, 9) AS p90, round(len(list_filter(v, lambda x: x >= 0.05 * (a + (c - a) * f))) / k::DOUBLE, 9) AS presence FROM z""")
def presence_ratio(spark, d):
    """Share of days with a twentieth of the 90th percentile (Hazen) of daily counts."""
    b = T.spikes(spark, d).groupBy("unit", F.expr(f"t div {24 * H}").alias("bin")).agg(F.count("*").cast("double").alias("n"))
    v = b.groupBy("unit").agg(F.sort_array(F.collect_list("n")).alias("v")).withColumn("p90", W.hazen(F.col("v"), 0.9))
    return v.select("unit", F.round("p90", 9).alias("p90"), F.round(F.size(F.filter("v", lambda x: x >= 0.05 * F.col("p90"))) / F.size("v"), 9).alias("presence"))


@query(f"""WITH {S}, b AS (SELECT unit, t // {72 * H} AS bin, median(depth) AS m FROM spike GROUP BY ALL), s AS (SELECT *, abs(m - lag(m) OVER (PARTITION BY unit ORDER BY bin)) AS step FROM b)
 SELECT unit, max(m) - min(m) AS range, coalesce(sum(step), 0) AS path FROM s GROUP BY unit""")
def drift(spark, d):
    """Range and path of a unit's median depth over time."""
    b = T.spikes(spark, d).groupBy("unit", F.expr(f"t div {72 * H}").alias("bin")).agg(F.median("depth").alias("m"))
    s = b.withColumn("step", F.abs(F.col("m") - F.lag("m").over(W.ordered(["unit"], ["bin"]))))
    return s.groupBy("unit").agg((F.max("m") - F.min("m")).alias("range"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("path"))


@query(f"WITH {S} SELECT unit, count(*) AS n, round(avg(ampl), 8) AS ampl, count(DISTINCT depth) AS depths FROM spike GROUP BY unit")
def cluster_summary(spark, d):
    """Number, mean amplitude and different depths of a unit's spikes."""
    return T.spikes(spark, d).groupBy("unit").agg(F.count("*").alias("n"), F.round(F.avg("ampl"), 8).alias("ampl"), F.countDistinct("depth").alias("depths"))


@query(f"WITH {S} SELECT depth, count(*) AS n FROM spike GROUP BY depth")
def count_values(spark, d):
    """How often each depth occurs."""
    return T.spikes(spark, d).groupBy("depth").agg(F.count("*").alias("n"))


@query(f"WITH {S}, c AS (SELECT unit, depth % 10 AS template, count(*) AS n FROM spike GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY n DESC, template) AS k FROM c) SELECT unit, template, n FROM r WHERE k = 1")
def modal_template(spark, d):
    """The commonest template of each unit, the lowest of equals."""
    c = T.spikes(spark, d).groupBy("unit", (F.col("depth") % 10).alias("template")).agg(F.count("*").alias("n"))
    return c.groupBy("unit").agg(F.max(F.struct("n", (-F.col("template")).alias("neg"))).alias("x")).select("unit", (-F.col("x.neg")).alias("template"), "x.n")


@query("""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), a AS (SELECT vec_id, label, max(v) - min(v) AS ampl, arg_max(i, v) AS top, arg_min(i, v) AS low FROM p GROUP BY ALL)
 SELECT vec_id, label, round(ampl, 7) AS ampl, CAST(top AS INT) AS top, CAST(low AS INT) AS low, CAST(top - low AS INT) AS width FROM a""")
def template_shape(spark, d):
    """Peak-to-peak size, peak and trough places of each waveform."""
    e = T.read(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    high, low = F.array_max("v"), F.array_min("v")
    top, bottom = F.array_position("v", high).cast("int") - 1, F.array_position("v", low).cast("int") - 1
    return e.select("vec_id", "label", F.round(high - low, 7).alias("ampl"), top.alias("top"), bottom.alias("low"), (top - bottom).alias("width"))


@query("""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), m AS (SELECT label, i, avg(v) AS m FROM p GROUP BY ALL) SELECT label, CAST(i AS INT) AS i, round(m, 9) AS mean FROM m""")
def mean_waveform(spark, d):
    """Mean waveform of each cluster."""
    p = T.read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    return p.groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 9).alias("mean"))


@query("""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), r AS (SELECT vec_id, label, sum(greatest(v, 0) * greatest(v, 0) * i) / nullif(sum(greatest(v, 0) * greatest(v, 0)), 0) AS com FROM p GROUP BY ALL) SELECT vec_id, round(com, 8) AS depth FROM r""")
def drift_map(spark, d):
    """Centre of mass of each spike over channels, negative components as zero."""
    e = T.read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return e.select("vec_id", F.round(X.center_of_mass("v"), 8).alias("depth"))


@query("""WITH p AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), m AS (SELECT label AS c, i, avg(v) AS m FROM p GROUP BY ALL), d AS (SELECT p.vec_id, p.label, m.c, sum(v * m) AS s FROM p JOIN m ON m.i = p.i GROUP BY ALL)
 SELECT CAST(c AS INT) AS label, round((avg(s) FILTER (label = c) - avg(s) FILTER (label <> c)) / stddev_samp(s) FILTER (label <> c), 7) AS snr FROM d GROUP BY c""")
def projection_snr(spark, d):
    """How far a cluster's spikes project on its mean beyond the others."""
    p = T.read(spark, d, "embeddings").select("vec_id", "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v"))
    m = p.groupBy(F.col("label").alias("c"), "i").agg(F.avg("v").alias("m"))
    s = p.join(m, "i").groupBy("vec_id", "label", "c").agg(F.sum(F.col("v") * F.col("m")).alias("s"))
    own, other = F.when(F.col("label") == F.col("c"), F.col("s")), F.when(F.col("label") != F.col("c"), F.col("s"))
    return s.groupBy(F.col("c").alias("label")).agg(F.round((F.avg(own) - F.avg(other)) / F.stddev_samp(other), 7).alias("snr"))


@query(f"""WITH {S}, b AS (SELECT depth // 10 AS depth_bin, CAST(floor(ampl / 25) AS BIGINT) AS ampl_bin, count(*) AS n FROM spike GROUP BY ALL) SELECT depth_bin, ampl_bin, n, CAST(sum(n) OVER (PARTITION BY depth_bin ORDER BY ampl_bin DESC) AS BIGINT) AS at_least FROM b""")
def amplitude_depth_map(spark, d):
    """Spikes by depth and amplitude, and those of at least the amplitude."""
    b = T.spikes(spark, d).groupBy(F.expr("depth div 10").alias("depth_bin"), F.floor(F.col("ampl") / 25).alias("ampl_bin")).agg(F.count("*").alias("n"))
    return b.select("depth_bin", "ampl_bin", "n", F.sum("n").over(Window.partitionBy("depth_bin").orderBy(F.desc("ampl_bin"))).alias("at_least"))


@query(f"WITH {SM}, m AS (SELECT channel, v, v - median(v) OVER (PARTITION BY channel) AS r FROM smp WHERE sample <= 320) SELECT channel, round(sqrt(avg(v * v)), 8) AS rms, median(abs(r)) AS mad FROM m GROUP BY channel")
def rms_and_mad(spark, d):
    """Root mean square and median deviation of each channel's first 320 samples; that noise is measured on a recording's beginning is the feature."""
    first = T.samples(spark, d).where("sample <= 320")
    middle = first.groupBy("channel").agg(F.percentile("v", F.lit(0.5)).alias("m"))
    m = first.join(middle, "channel").withColumn("r", F.abs(F.col("v") - F.col("m")))
    return m.groupBy("channel").agg(F.round(F.sqrt(F.avg(F.col("v") * F.col("v"))), 8).alias("rms"), F.median("r").alias("mad"))


@query(f"WITH {S} SELECT depth // 10 AS x, CAST(floor(ampl / 20) AS BIGINT) AS y, count(*) AS n, round(sum(ampl) / greatest(count(*), 1), 7) AS rate FROM spike GROUP BY ALL")
def occupancy_map(spark, d):
    """Mean rate on a grid of two positions."""
    return T.spikes(spark, d).groupBy(F.expr("depth div 10").alias("x"), F.floor(F.col("ampl") / 20).alias("y")).agg(F.count("*").alias("n"), F.round(F.sum("ampl") / F.greatest(F.count("*"), F.lit(1)), 7).alias("rate"))


@query(f"WITH {C} SELECT session, count(x) AS n, round(avg(x), 8) AS mean, round(stddev_samp(x) / sqrt(count(x)), 6) AS sem FROM cond GROUP BY session")
def mean_and_sem(spark, d):
    """Mean and its standard error over a session's trials."""
    return T.conditions(spark, d).groupBy("session").agg(F.count("x").alias("n"), F.round(F.avg("x"), 8).alias("mean"), F.round(F.stddev_samp("x") / F.sqrt(F.count("x")), 6).alias("sem"))


@query(f"WITH {C} SELECT session, block, outcome, CAST(grouping(block) AS INT) AS by_outcome, count(*) AS n, round(avg(x), 8) AS rate FROM cond GROUP BY GROUPING SETS ((session, block), (session, outcome))")
def block_and_stimulus(spark, d):
    """Rates by block and by stimulus from one pass."""
    c = T.conditions(spark, d)
    c.createOrReplaceTempView("block_and_stimulus_input")
    return c.sparkSession.sql("SELECT session, block, outcome, CAST(grouping(block) AS INT) AS by_outcome, count(*) AS n, round(avg(x), 8) AS rate FROM block_and_stimulus_input GROUP BY GROUPING SETS ((session, block), (session, outcome))")


@query(f"WITH {T.EVENTS} SELECT user_id, t // {48 * H} AS trial, CAST(sum(CASE WHEN event_type IN ('signup', 'purchase') THEN 1 ELSE 0 END) AS BIGINT) = 2 AS correct, bool_or(event_type = 'error') AS omission, count(*) AS n FROM ev GROUP BY ALL")
def trial_flags(spark, d):
    """Outcome of each trial from the codes in it."""
    codes = F.col("event_type").isin("signup", "purchase")
    return T.events(spark, d).groupBy("user_id", F.expr(f"t div {48 * H}").alias("trial")).agg((F.sum(codes.cast("long")) == 2).alias("correct"), F.bool_or(F.col("event_type") == "error").alias("omission"), F.count("*").alias("n"))


@query(f"WITH {SM} SELECT sample, count(*) AS n, round(stddev_pop(v), 8) AS gmf FROM smp GROUP BY sample")
def global_mean_field(spark, d):
    """Deviation over channels at each sample."""
    return T.samples(spark, d).groupBy("sample").agg(F.count("*").alias("n"), F.round(F.stddev_pop("v"), 8).alias("gmf"))


@query(f"WITH {SM}, c AS (SELECT channel, sample // 100 AS chunk, avg(v) AS m, count(*) AS n FROM smp GROUP BY ALL), g AS (SELECT channel, chunk, m > 25 AS good, chunk - row_number() OVER (PARTITION BY channel, m > 25 ORDER BY chunk) AS k FROM c), r AS (SELECT channel, min(chunk) AS first, count(*) AS length, row_number() OVER (PARTITION BY channel ORDER BY count(*) DESC, min(chunk)) AS nth FROM g WHERE good GROUP BY channel, k) SELECT channel, first, length FROM r WHERE nth = 1")
def good_chunks(spark, d):
    """Longest run of chunks that meet a threshold."""
    c = T.samples(spark, d).groupBy("channel", F.expr("sample div 100").alias("chunk")).agg(F.avg("v").alias("m")).where("m > 25")
    k = c.withColumn("k", F.col("chunk") - F.row_number().over(W.ordered(["channel"], ["chunk"])))
    r = k.groupBy("channel", "k").agg(F.min("chunk").alias("first"), F.count("*").alias("length"))
    return r.groupBy("channel").agg(F.max(F.struct("length", (-F.col("first")).alias("neg"))).alias("x")).select("channel", (-F.col("x.neg")).alias("first"), "x.length")


@query(f"""WITH {SM}, a AS (SELECT channel, max(v) - min(v) AS peak FROM smp GROUP BY channel), p AS (SELECT channel // 10 AS grp, channel % 10 AS dist, peak FROM a) SELECT grp, round(regr_slope(peak, dist), 8) AS slope, round(regr_intercept(peak, dist), 8) AS base FROM p GROUP BY grp""")
def spatial_decay(spark, d):
    """Slope of the peak over the distance from the first channel."""
    a = T.samples(spark, d).groupBy("channel").agg((F.max("v") - F.min("v")).alias("peak"))
    p = a.select(F.expr("channel div 10").alias("grp"), (F.col("channel") % 10).alias("dist"), "peak")
    return p.groupBy("grp").agg(F.round(F.regr_slope("peak", "dist"), 8).alias("slope"), F.round(F.regr_intercept("peak", "dist"), 8).alias("base"))


@query("""SELECT p_partkey, CASE WHEN p_size < 5 THEN 0 WHEN p_retailprice < 1000 THEN 2 WHEN p_size > 40 THEN 3 ELSE 1 END AS unit_type FROM part""")
def unit_type(spark, d):
    """Units by thresholds on their measures; the first that matches counts."""
    return T.read(spark, d, "part").select("p_partkey", X.first_match([(F.col("p_size") < 5, 0), (F.col("p_retailprice") < 1000, 2), (F.col("p_size") > 40, 3)], 1).alias("unit_type"))


@query(f"""WITH {ISI}, m AS (SELECT unit, count(*) AS n, avg(CASE WHEN isi > {48 * H} THEN 1.0 ELSE 0.0 END) AS long, median(isi) AS mid FROM isi WHERE isi IS NOT NULL GROUP BY unit) SELECT unit, CASE WHEN mid > {40 * H} AND long > 0.3 THEN 'MSN' WHEN mid > {40 * H} THEN 'TAN' WHEN long <= 0.3 THEN 'FSI' ELSE 'UIN' END AS cell FROM m""")
def cell_type(spark, d):
    """Cell types from interval measures."""
    m = isi(spark, d).where("isi IS NOT NULL").groupBy("unit").agg(F.avg((F.col("isi") > 48 * H).cast("double")).alias("long"), F.median("isi").alias("mid"))
    slow, long = F.col("mid") > 40 * H, F.col("long") > 0.3
    return m.select("unit", X.first_match([(slow & long, "MSN"), (slow, "TAN"), (~long, "FSI")], "UIN").alias("cell"))


@query(f"""WITH {ISI}, a AS (SELECT unit, count(*) AS n, median(ampl) AS ampl, median(depth) AS depth FROM spike GROUP BY unit), b AS (SELECT unit, stddev_samp(isi) / avg(isi) AS cv, avg(CASE WHEN isi < {H} THEN 1.0 ELSE 0.0 END) AS rpv FROM isi WHERE isi IS NOT NULL GROUP BY unit)
 SELECT a.unit, n, ampl, depth, round(cv, 8) AS cv, round(rpv, 9) AS rpv FROM a LEFT JOIN b ON b.unit = a.unit""")
def unit_properties(spark, d):
    """All measures of a unit in one row."""
    s = T.spikes(spark, d).withColumn("isi", W.interval("t", W.ordered(["unit"], ["t", "spike_id"])))
    return s.groupBy("unit").agg(
        F.count("*").alias("n"), F.median("ampl").alias("ampl"), F.median("depth").alias("depth"), F.round(F.stddev_samp("isi") / F.avg("isi"), 8).alias("cv"), F.round(F.avg((F.col("isi") < H).cast("double")), 9).alias("rpv")
    )


@query(f"""WITH {S}, q AS (SELECT unit, quantile_cont(ampl, 0.1) AS lo, quantile_cont(ampl, 0.9) AS hi FROM spike GROUP BY unit) SELECT s.spike_id, CAST(CASE WHEN hi = lo THEN 0 ELSE greatest(0, least(19, floor((ampl - lo) / ((hi - lo) / 20)))) END AS BIGINT) AS color FROM spike s JOIN q ON q.unit = s.unit""")
def quantile_color(spark, d):
    """Twenty bins of amplitude between a unit's outer deciles."""
    s = T.spikes(spark, d)
    q = W.quantiles(s, "ampl", ["unit"], {"lo": 0.1, "hi": 0.9})
    bin_ = F.floor((F.col("ampl") - F.col("lo")) / F.nullif((F.col("hi") - F.col("lo")) / 20, F.lit(0.0)))
    # greatest and least pass over nulls, so a unit of equal deciles is told first
    color = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(19), bin_)))
    return s.join(q, "unit", "left").where("unit IS NOT NULL").select("spike_id", color.cast("long").alias("color"))


CYCLES = SM + ", whole AS (SELECT *, count(*) OVER (PARTITION BY channel) // 20 * 20 AS last FROM smp)"


def whole_cycles(spark, d):
    """Each channel up to its own last whole cycle of 20 samples."""
    s = T.samples(spark, d)
    last = s.groupBy("channel").agg((F.expr("count(*) div 20") * 20).alias("last"))
    return s.join(last, "channel").where("sample <= last")


@query(f"""WITH {CYCLES} SELECT channel, round(2 * sqrt(pow(avg(v * cos(2 * pi() * sample / 20)), 2) + pow(avg(v * sin(2 * pi() * sample / 20)), 2)), 7) AS line FROM whole WHERE sample <= last GROUP BY channel""")
def line_noise(spark, d):
    """Amplitude of the line frequency over whole cycles."""
    return whole_cycles(spark, d).groupBy("channel").agg(F.round(X.tone("v", "sample", 20), 7).alias("line"))


@query(f"""WITH {CYCLES}, x AS (SELECT channel, sample, v, last, cos(2 * pi() * sample / 20) AS c, sin(2 * pi() * sample / 20) AS s FROM whole), m AS (SELECT channel, 2 * avg(v * c) AS a, 2 * avg(v * s) AS b FROM x WHERE sample <= last GROUP BY channel) SELECT x.channel, sample, round(v - a * c - b * s, 7) AS clean FROM x JOIN m ON m.channel = x.channel""")
def dft_filter(spark, d):
    """Samples without the line frequency, fitted over whole cycles and taken out of all."""
    turn = F.lit(2.0) * F.pi() * F.col("sample") / 20
    c, s = F.cos(turn), F.sin(turn)
    fit = whole_cycles(spark, d).groupBy("channel").agg((2 * F.avg(F.col("v") * c)).alias("a"), (2 * F.avg(F.col("v") * s)).alias("b"))
    return T.samples(spark, d).join(fit, "channel").select("channel", "sample", F.round(F.col("v") - F.col("a") * c - F.col("b") * s, 7).alias("clean"))


@query(f"""WITH {C}, m AS (SELECT session, block, avg(x) AS r FROM cond GROUP BY ALL), v AS (SELECT session, sum(r * cos(2 * pi() * block / 5)) AS a, sum(r * sin(2 * pi() * block / 5)) AS b, sum(r) AS s, min(r) AS lo, max(r) AS hi FROM m GROUP BY session) SELECT session, round(sqrt(a * a + b * b) / s, 9) AS osi, round(1 - lo / hi, 9) AS di FROM v""")
def orientation_tuning(spark, d):
    """Selectivity over block directions."""
    m = T.conditions(spark, d).groupBy("session", "block").agg(F.avg("x").alias("r"))
    turn = F.lit(2.0) * F.pi() * F.col("block") / 5
    v = m.groupBy("session").agg(F.sum(F.col("r") * F.cos(turn)).alias("a"), F.sum(F.col("r") * F.sin(turn)).alias("b"), F.sum("r").alias("s"), F.min("r").alias("lo"), F.max("r").alias("hi"))
    return v.select("session", F.round(F.hypot("a", "b") / F.col("s"), 9).alias("osi"), F.round(1 - F.col("lo") / F.col("hi"), 9).alias("di"))
