"""Recordings and tables in further forms: sensors, references, kernels, conversions, spectra, contrasts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import aligned as A
from ..operators import models
from ..operators import sets
from ..operators import signal as G
from ..operators import stats as S
from ..operators import trials as R
from ..operators import windows as W
from . import tables as T
from .queries_interval import marks
from .registry import query

H = T.HOUR
SP, SM, C = T.SPIKES, T.SAMPLES, T.CONDITIONS
OVER = "OVER (PARTITION BY channel ORDER BY sample"


@query(f"""WITH {SM}, x AS (SELECT channel, (sample - 1) // 3 AS i, (sample - 1) % 3 AS axis, round((v * 1000 - 25000) / 32768 * 4, 9) AS g FROM smp)
 SELECT channel, i, round(1704067200000 + i * (1000.0::DOUBLE / 30), 6) AS t_ms, max(g) FILTER (axis = 0) AS x, max(g) FILTER (axis = 1) AS y, max(g) FILTER (axis = 2) AS z FROM x GROUP BY channel, i""")
def motion_axes(spark, d):
    """Interleaved counts of a motion sensor as scaled axes with their times."""
    g = F.round(X.scale_motion(F.col("v") * 1000 - 25000, 16, 4.0), 9)
    s = T.samples(spark, d).select("channel", F.expr("(sample - 1) div 3").alias("i"), ((F.col("sample") - 1) % 3).alias("axis"), g.alias("g"))
    axes = [F.max(F.when(F.col("axis") == k, F.col("g"))).alias(n) for k, n in enumerate("xyz")]
    return s.groupBy("channel", "i").agg(*axes).withColumn("t_ms", F.round(X.evenly(F.lit(1704067200000.0), F.col("i"), 30.0), 6))


@query(f"WITH {SM} SELECT channel, sample, round((v * 500 - 12000 + 32767) / 65535, 9) AS signed, round(v * 500 / 65536, 9) AS plain FROM smp")
def audio_scale(spark, d):
    """Audio counts from 0 to 1, of signed and of unsigned types."""
    return T.samples(spark, d).select("channel", "sample", F.round(X.scale_audio(F.col("v") * 500 - 12000, 16, True), 9).alias("signed"), F.round(X.scale_audio(F.col("v") * 500, 16, False), 9).alias("plain"))


@query(f"WITH {SM}, r AS (SELECT sample, avg(v) FILTER (channel % 4 = 1) AS ref FROM smp GROUP BY sample) SELECT s.channel, s.sample, round(v - ref, 9) AS v FROM smp s JOIN r ON r.sample = s.sample WHERE ref IS NOT NULL")
def subset_reference(spark, d):
    """Samples without the mean of the reference channels; samples without one go."""
    s = T.samples(spark, d)
    ref = s.where("channel % 4 = 1").groupBy("sample").agg(F.avg("v").alias("ref"))
    return s.join(ref, "sample").select("channel", "sample", F.round(F.col("v") - F.col("ref"), 9).alias("v"))


@query(f"""WITH {SM}, m AS (SELECT channel, sample AS freq, CASE WHEN sample % 100 BETWEEN 47 AND 53 THEN NULL ELSE v END AS power FROM smp), b AS (SELECT *, freq // 100 AS band FROM m), e AS (SELECT channel, freq // 100 AS band, max(power) FILTER (freq % 100 = 46) AS lo, max(power) FILTER (freq % 100 = 54) AS hi FROM m GROUP BY ALL)
 SELECT b.channel, b.freq, round(coalesce(power, lo + (freq % 100 - 46) / 8.0::DOUBLE * (hi - lo)), 8) AS power FROM b JOIN e ON e.channel = b.channel AND e.band = b.band""")
def band_interpolated(spark, d):
    """Spectra with bands of line noise masked, and bridged by a line."""
    s = T.samples(spark, d).select("channel", F.col("sample").alias("freq"), F.when(~F.expr("sample % 100 BETWEEN 47 AND 53"), F.col("v")).alias("power"))
    return W.fill_gaps(s, "power", order="freq", tasks=T.tasks(spark, d)).select("channel", "freq", F.round("power", 8).alias("power"))


@query("WITH a AS (SELECT p_brand AS label, p_partkey AS at_a, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part WHERE p_size <= 30), b AS (SELECT p_brand AS label, p_partkey AS at_b, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS k FROM part WHERE p_size > 20) SELECT a.label, at_a, at_b FROM a JOIN b ON a.label = b.label AND a.k = b.k")
def match_labels(spark, d):
    """Labels of two lists with their places in both; repeated labels pair in their order."""
    p = T.read(spark, d, "part").select(F.col("p_brand").alias("label"), F.col("p_partkey").alias("at"), "p_size")
    return sets.match(p.where("p_size <= 30").withColumnRenamed("at", "a"), p.where("p_size > 20").withColumnRenamed("at", "b"), "label", "a", "b")


@query(f"WITH {SM}, r AS (SELECT channel, sample, v, abs(v - 25.4) AS far FROM smp) SELECT channel, arg_min(sample, far * 1000000 + sample) AS nearest, min(sample) FILTER (v >= 20 AND v <= 22) AS first_inside, max(sample) FILTER (v >= 20 AND v <= 22) AS last_inside FROM r GROUP BY channel")
def nearest_index(spark, d):
    """The sample nearest to a value (the first on a tie), and the outermost ones inside an interval, ends included."""
    inside = F.when(F.col("v").between(20, 22), F.col("sample"))
    return T.samples(spark, d).groupBy("channel").agg(F.min(F.struct(F.abs(F.col("v") - 25.4).alias("far"), "sample"))["sample"].alias("nearest"), F.min(inside).alias("first_inside"), F.max(inside).alias("last_inside"))


@query(f"""WITH {T.EVENTS}, {SM}, e AS (SELECT DISTINCT user_id % 100 AS channel, depth AS pos FROM ev WHERE event_type = 'error'), x AS (SELECT e.channel, o, s.sample, v FROM e, generate_series(-3, 3) g(o) JOIN smp s ON s.channel = e.channel AND s.sample = e.pos + o),
 t AS (SELECT o, avg(v) AS m FROM x GROUP BY o), k AS (SELECT x.channel, x.sample, sum(m) AS m FROM x JOIN t ON t.o = x.o GROUP BY ALL) SELECT s.channel, s.sample, round(s.v - coalesce(m, 0), 8) AS v FROM smp s LEFT JOIN k ON k.channel = s.channel AND k.sample = s.sample""")
def template_subtracted(spark, d):
    """Samples without the mean artifact around each mark."""
    s = T.samples(spark, d).select("channel", "sample", "v")
    return A.subtract_template(s, marks(spark, d).distinct(), 3, 3).select("channel", "sample", F.round("v", 8).alias("v"))


@query(f"""WITH {SM}, e AS (SELECT channel, avg(v) FILTER (sample <= 2) AS head, avg(v) FILTER (sample > n - 2) AS tail FROM (SELECT *, count(*) OVER (PARTITION BY channel) AS n FROM smp) GROUP BY channel),
 x AS (SELECT channel, sample, v, lag(v, 2) {OVER}) AS a, lag(v) {OVER}) AS b, lead(v) {OVER}) AS c, lead(v, 2) {OVER}) AS f FROM smp) SELECT x.channel, sample, round((coalesce(a, head) + 2 * coalesce(b, head) + 3 * v + 2 * coalesce(c, tail) + coalesce(f, tail)) / 9, 8) AS smooth FROM x JOIN e ON e.channel = x.channel""")
def kernel_smooth(spark, d):
    """Samples under a kernel of five weights; past the ends stands the mean of the two outermost."""
    s = T.samples(spark, d)
    last = s.groupBy("channel").agg(F.max("sample").alias("last"))
    ends = s.join(last, "channel").groupBy("channel").agg(F.avg(F.when(F.col("sample") <= 2, F.col("v"))).alias("head"), F.avg(F.when(F.col("sample") > F.col("last") - 2, F.col("v"))).alias("tail"))
    made = {"smooth": lambda x: W.kernel_smooth("v", x, [1.0, 2.0, 3.0, 2.0, 1.0], F.col("head"), F.col("tail"))}
    return W.over_stretches(s.join(ends, "channel"), 2, made, tasks=T.tasks(spark, d)).select("channel", "sample", F.round("smooth", 8).alias("smooth"))


@query(f"""WITH {SM}, x AS (SELECT *, lag(v) {OVER}) AS a, lead(v) {OVER}) AS b FROM smp), g AS (SELECT channel, sample, CASE WHEN a IS NULL THEN b - v WHEN b IS NULL THEN v - a ELSE (b - a) / 2 END AS v FROM x), y AS (SELECT *, lag(v) {OVER}) AS a, lead(v) {OVER}) AS b FROM g)
 SELECT channel, sample, CASE WHEN a IS NULL THEN b - v WHEN b IS NULL THEN v - a ELSE (b - a) / 2 END AS bend FROM y""")
def second_gradient(spark, d):
    """Central differences, twice."""
    return W.over_stretches(T.samples(spark, d), 2, {"slope": lambda x: W.gradient("v", x), "bend": lambda x: W.gradient("slope", x)}).select("channel", "sample", "bend")


@query()
def detrend_quadratic(spark, d):
    """Samples without their channel's least-squares parabola."""
    return W.detrended(T.samples(spark, d), "v", "sample", ["channel"], "flat2", order=2).select("channel", "sample", F.round("flat2", 6).alias("flat2"))


@query(f"WITH {T.EVENTS} SELECT event_id, event_type AS value, t AS start, t + greatest(1, depth - 20) - 1 AS stop, CAST(CASE WHEN depth % 2 = 0 THEN -depth ELSE 0 END AS BIGINT) AS \"offset\", greatest(1, depth - 20) AS duration FROM ev")
def trial_table(spark, d):
    """Events as trials, and their duration from the trials again."""
    e = T.events(spark, d).select("event_id", F.col("event_type").alias("value"), F.col("t").alias("sample"), (F.col("depth") - 20).alias("duration"), F.when(F.col("depth") % 2 == 0, -F.col("depth")).alias("offset"))
    trials = R.events_to_trials(e)
    back = R.trials_to_events(trials).select("event_id", "duration")
    return trials.join(back, "event_id").select("event_id", "value", "start", F.col("end").alias("stop"), "offset", "duration")


@query(f"WITH {SP} SELECT spike_id, row_number() OVER (ORDER BY t, spike_id) - 1 AS position FROM spike")
def sorted_positions(spark, d):
    """Place of every spike in the order of time."""
    return W.positions(T.spikes(spark, d).select("spike_id", "t"), ["t", "spike_id"]).select("spike_id", F.col("position").cast("long").alias("position"))


@query(f"""WITH {C}, k AS (SELECT session, count(*) FILTER (block = 1) AS b1, count(*) FILTER (block = 2) AS b2, count(*) FILTER (block = 3) AS b3, avg(x) AS mean FROM cond GROUP BY session) SELECT session, row_number() OVER (ORDER BY b1, b2, b3, session) - 1 AS position, round(mean, 7) AS mean FROM k""")
def row_order(spark, d):
    """Sessions in the order of their counts by block, which orders another block of values too."""
    k = T.conditions(spark, d).groupBy("session").agg(*[F.count(F.when(F.col("block") == b, 1)).alias(f"b{b}") for b in (1, 2, 3)])
    order = W.positions(k, ["b1", "b2", "b3", "session"]).select("session", F.col("position").cast("long").alias("position"))
    other = T.conditions(spark, d).groupBy("session").agg(F.round(F.avg("x"), 7).alias("mean"))
    return order.join(other, "session")


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings) SELECT vec_id, round(list_sum(v[1:3]) / 3, 8) AS local_head, round(list_sum(v[62:64]) / 3, 8) AS local_tail, CAST(len(v) - 6 AS INT) AS rest, round(v[4], 8) AS mirrored, round(v[64], 8) AS edge FROM e""")
def padded_waveforms(spark, d):
    """What stands before and after each waveform under several paddings."""
    e = T.read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    p = e.select("vec_id", X.pad("v", 3, "localmean").alias("l"), X.pad("v", 3, "remove").alias("r"), X.pad("v", 3, "mirror").alias("m"), X.pad("v", 3, "edge").alias("e"))
    first = lambda c: F.round(F.element_at(c, 1), 8)
    return p.select("vec_id", first("l").alias("local_head"), F.round(F.element_at("l", -1), 8).alias("local_tail"), F.size("r").alias("rest"), first("m").alias("mirrored"), F.round(F.element_at("e", -1), 8).alias("edge"))


@query(f"""WITH {SM}, x AS (SELECT *, lag(v) {OVER}) AS a, lead(v) {OVER}) AS b FROM smp), g AS (SELECT channel, CASE WHEN a IS NULL THEN b - v WHEN b IS NULL THEN v - a ELSE (b - a) / 2 END AS s FROM x)
 SELECT channel, round(sqrt((sum(s * s) - sum(s) * sum(s) / (count(*) + 100)) / (count(*) + 99)), 8) AS neuvar FROM g GROUP BY channel""")
def neuronal_variance(spark, d):
    """Deviation of each channel's slope over its length and 100 zeros of padding."""
    g = W.over_stretches(T.samples(spark, d), 1, {"s": lambda x: W.gradient("v", x)})
    n = F.count("*") + 100
    return g.groupBy("channel").agg(F.round(F.sqrt((F.sum(F.col("s") * F.col("s")) - F.sum("s") * F.sum("s") / n) / (n - 1)), 8).alias("neuvar"))


@query(f"WITH {SM}, r AS (SELECT channel, min(sample) AS lo, max(sample) AS hi FROM smp GROUP BY channel) SELECT s.channel, s.sample AS freq, CAST(1 + round(19 * (sample - lo)::DOUBLE / (hi - lo)) AS INT) AS \"order\", round(CASE WHEN v < 12 THEN 0 ELSE 3 * exp(-pow(v - 20, 2) / (2 * 36)) END, 9) AS g FROM smp s JOIN r ON r.channel = s.channel")
def superlet_order(spark, d):
    """Order of each frequency's superlet, and a normal curve with a cut."""
    s = T.samples(spark, d)
    ends = s.groupBy("channel").agg(F.min("sample").alias("lo"), F.max("sample").alias("hi"))
    return s.join(ends, "channel").select("channel", F.col("sample").alias("freq"), X.superlet_order(F.col("sample"), F.col("lo"), F.col("hi"), 1, 20).alias("order"), F.round(X.gaussian_cut(F.col("v"), 3.0, 20.0, 6.0, 12.0), 9).alias("g"))


@query(f"WITH {SM}, d AS (SELECT channel, sample, sum(sqrt(v * v + w * w / 1e6) * 0.01::DOUBLE) {OVER}) AS path, w / 10000 AS heading FROM smp) SELECT channel, sample, round(path, 6) AS path, round(path * cos(heading), 6) AS dx, round(path * sin(heading), 6) AS dy FROM d")
def dead_reckoning(spark, d):
    """Path along the summed size of an acceleration, and its parts under a heading."""
    s = T.samples(spark, d)
    p = W.running_total(s, F.sqrt(F.col("v") * F.col("v") + F.col("w") * F.col("w") / 1e6) * 0.01, "path")
    turn = F.col("w") / 10000
    return p.select("channel", "sample", F.round("path", 6).alias("path"), F.round(F.col("path") * F.cos(turn), 6).alias("dx"), F.round(F.col("path") * F.sin(turn), 6).alias("dy"))


@query("""SELECT event_id, epoch_us(ts) // 1000000 AS seconds, epoch_us(ts) // 1000 % 86400000 AS ms_of_day, '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS json FROM events""")
def timestamps(spark, d):
    """Times out of ISO texts with a zone, milliseconds since midnight, and a row as JSON."""
    e = T.read(spark, d, "events").select("event_id", "event_type", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("iso"))
    at = F.to_timestamp("iso")
    return e.select("event_id", F.unix_micros(at).alias("us"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))).alias("json")).select("event_id", F.expr("us div 1000000").alias("seconds"), F.expr("us div 1000 % 86400000").alias("ms_of_day"), "json")


@query(f"""WITH {C}, x AS (SELECT *, lead(t) OVER (PARTITION BY session ORDER BY t, trial) - t AS gap FROM cond) SELECT session, count(*) AS n_all, count(*) FILTER (outcome = 'F') AS n_init, min(t) FILTER (block = 2) - min(t) AS phase_start, max(t) FILTER (block = 2) - min(t) AS phase_end, max(gap) AS longest_gap FROM x GROUP BY session""")
def session_summary(spark, d):
    """Numbers of trials, a phase's start and end since the first trial, and the longest gap of each session."""
    x = T.conditions(spark, d).withColumn("gap", F.lead("t").over(W.ordered(["session"], ["t", "trial"])) - F.col("t"))
    phase = F.when(F.col("block") == 2, F.col("t"))
    return x.groupBy("session").agg(F.count("*").alias("n_all"), F.count(F.when(F.col("outcome") == "F", 1)).alias("n_init"), (F.min(phase) - F.min("t")).alias("phase_start"), (F.max(phase) - F.min("t")).alias("phase_end"), F.max("gap").alias("longest_gap"))


@query(f"WITH {C} SELECT outcome, block, count(*) AS n, round(avg(x), 7) AS mean, round(stddev_pop(x), 6) AS sd, round(quantile_cont(x, 0.95), 6) AS top FROM cond GROUP BY GROUPING SETS ((outcome, block), ())")
def bar_means(spark, d):
    """Mean, population deviation and upper limit of each bar, and over all."""
    c = T.conditions(spark, d)
    made = lambda g: g.agg(F.count("*").alias("n"), F.round(F.avg("x"), 7).alias("mean"), F.round(F.stddev_pop("x"), 6).alias("sd"), F.round(F.percentile("x", F.lit(0.95)), 6).alias("top"))
    whole = made(c.groupBy()).select(F.lit(None).cast("string").alias("outcome"), F.lit(None).cast("int").alias("block"), "n", "mean", "sd", "top")
    return made(c.groupBy("outcome", "block")).unionByName(whole)


@query(f"""WITH {SM}, s AS (SELECT channel, sample, last_value(CASE WHEN v >= 40 THEN 1 WHEN v <= 10 THEN 0 END IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM smp),
 n AS (SELECT channel, sample, row_number() {OVER}) AS k FROM s WHERE state = 1), r AS (SELECT channel, min(sample) AS up, max(sample) AS down, count(*) AS width FROM (SELECT channel, sample, sample - row_number() {OVER}) AS g FROM s WHERE state = 1) GROUP BY channel, g) SELECT * FROM r WHERE width >= 8""")
def schmitt_pulses(spark, d):
    """Pulses of a two-threshold state that last eight samples."""
    from ..operators import intervals as I

    s = W.carried(T.samples(spark, d), F.when(F.col("v") >= 40, 1).when(F.col("v") <= 10, 0), "state")
    found = I.runs(s.where("state IS NOT NULL"), F.col("state") == 1, order="sample", by=["channel"])
    return found.where("length >= 8").select("channel", F.col("first").alias("up"), F.col("last").alias("down"), F.col("length").alias("width"))


@query(f"""WITH {T.EVENTS}, b AS (SELECT event_type = 'purchase' AS pos, value, unnest([t // {120 * H} - 1, t // {120 * H}, t // {120 * H} + 1]) AS bin FROM ev), t AS (SELECT bin, value, count(*) AS n, sum(CASE WHEN pos THEN 1 ELSE 0 END) AS p FROM b GROUP BY ALL),
 r AS (SELECT *, sum(n) OVER (PARTITION BY bin ORDER BY value) - (n - 1) / 2.0 AS rk FROM t), g AS (SELECT bin, CAST(sum(p) AS DOUBLE) AS a, CAST(sum(n - p) AS DOUBLE) AS b, sum(rk * p) AS s, sum(n::DOUBLE * n * n - n) AS tie FROM r GROUP BY bin)
 SELECT bin, CAST(a AS BIGINT) AS n_pos, CAST(b AS BIGINT) AS n_neg, round((s - a * (a + 1) / 2) / nullif(a * b, 0), 9) AS auc, round((s - a * (a + 1) / 2 - a * b / 2) / nullif(sqrt(a * b / 12 * (a + b + 1 - tie / ((a + b) * (a + b - 1)))), 0), 7) AS z FROM g""")
def sliding_choice(spark, d):
    """Area under the ROC curve and rank-sum z in boxes of three stretches that slide by one."""
    rows = T.events(spark, d).withColumn("bin", F.explode(F.array(*[F.expr(f"t div {120 * H}") + k for k in (-1, 0, 1)])))
    out = S.rank_sum(rows, "value", F.col("event_type") == "purchase", ["bin"])
    return out.select("bin", "n_pos", "n_neg", F.round("auc", 9).alias("auc"), F.round("z", 7).alias("z"))


@query(f"""WITH {SM}, c AS (SELECT channel, sample % 4 AS blk, count(*) AS n, regr_sxx(v, w) AS xx, regr_syy(v, w) AS yy, regr_sxy(v, w) AS xy FROM smp GROUP BY ALL), g AS (SELECT channel, sum(n) AS n, count(*) AS k, sum(xx) AS xx, sum(yy) AS yy, sum(xy) AS xy FROM c GROUP BY channel)
 SELECT channel, round(xy / xx, 8) AS slope, round(xy / xx / sqrt((yy - xy * xy / xx) / (n - k - 1) / xx), 6) AS t, CAST(n - k - 1 AS BIGINT) AS df FROM g""")
def blocked_regression(spark, d):
    """Slope and t of one signal on the other with a constant for each block."""
    out = S.blocked_regression_t(T.samples(spark, d).withColumn("blk", F.col("sample") % 4), "v", "w", "blk", ["channel"])
    return out.select("channel", F.round("slope", 8).alias("slope"), F.round("t", 6).alias("t"), "df")


@query(f"WITH {C}, u AS (SELECT block, session, avg(x) FILTER (outcome = 'F') - avg(x) FILTER (outcome = 'O') AS delta FROM cond GROUP BY ALL) SELECT block, count(delta) AS n, round(avg(delta) / stddev_samp(delta), 8) AS d FROM u GROUP BY block")
def paired_effect(spark, d):
    """Effect size of the difference of two conditions within sessions."""
    side = lambda o: F.avg(F.when(F.col("outcome") == o, F.col("x")))
    u = T.conditions(spark, d).groupBy("block", "session").agg((side("F") - side("O")).alias("delta"))
    return u.groupBy("block").agg(F.count("delta").alias("n"), F.round(S.paired_d("delta"), 8).alias("d"))


@query("""WITH p AS (SELECT l_suppkey AS family, l_orderkey * 10 + l_linenumber AS test, min(l_extendedprice) / 200000.0 AS p FROM lineitem GROUP BY ALL) SELECT family, test, p <= 0.9::DOUBLE / count(*) OVER (PARTITION BY family) AS kept FROM p""")
def family_wise(spark, d):
    """Which of a family's p values hold for all of it."""
    rows = T.read(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("family"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("test")).agg((F.min("l_extendedprice") / 200000.0).alias("p"))
    return rows.select("family", "test", S.family_wise("p", 0.9, ["family"]).alias("kept"))


@query(f"""WITH {SM}, c AS (SELECT sample, CAST(bit_or(CAST(CASE WHEN v > 49 THEN 1 << CAST(channel % 16 AS INT) ELSE 0 END AS BIGINT)) AS BIGINT) AS code FROM smp GROUP BY sample), q AS (SELECT min(sample) AS quiet FROM c WHERE code = 0),
 u AS (SELECT sample, code FROM c, q WHERE code <> 0 AND (quiet IS NULL OR sample > quiet)), o AS (SELECT sample FROM (SELECT sample, sample - lag(sample) OVER (ORDER BY sample) AS gap FROM u) WHERE gap IS NULL OR gap > 4)
 SELECT o.sample, CAST(coalesce(bit_or(u.code), 0) & 15 AS BIGINT) AS standard, CAST(coalesce(bit_or(u.code), 0) & ~15 AS BIGINT) AS extra FROM o LEFT JOIN u ON u.sample BETWEEN o.sample + 3 AND o.sample + 9 GROUP BY o.sample""")
def digital_codes(spark, d):
    """Codes of pulses on digital lines, read a little after their onset."""
    pins = T.samples(spark, d).select("sample", (F.col("channel") % 16 + 1).cast("int").alias("pin"), (F.col("v") > 49).cast("int").alias("v"))
    x = R.digital_events(pins, 3, 6, gap=4)
    return x.select("sample", F.col("standard").cast("long").alias("standard"), F.col("extra").cast("long").alias("extra"))


FREQS = (1, 2, 4, 8, 16, 24, 31)


@query(f"""WITH {SM}, p AS (SELECT channel, (sample - 1) // 64 AS trial, f AS freq, sum(v * cos(2 * pi() * f * sample / 64)) AS re, sum(v * sin(2 * pi() * f * sample / 64)) AS im, count(*) AS n FROM smp, (SELECT unnest({list(FREQS)}) AS f) GROUP BY ALL), m AS (SELECT channel, freq, avg(re * re + im * im) AS p FROM p WHERE n = 64 GROUP BY ALL)
 SELECT channel, CAST(freq AS INT) AS freq, round(p / max(p) OVER (PARTITION BY freq), 8) AS rel FROM m""")
def laminar_profile(spark, d):
    """Mean power of each channel over trials of 64 samples, relative to the largest at its frequency."""
    s = T.samples(spark, d).withColumn("trial", F.expr("(sample - 1) div 64"))
    turn = lambda f: F.lit(2.0) * F.pi() * f * F.col("sample") / 64
    parts = [g(F.col("v") * h(turn(f))).alias(f"{n}{f}") for f in FREQS for g, h, n in ((F.sum, F.cos, "re"), (F.sum, F.sin, "im"))]
    p = s.groupBy("channel", "trial").agg(F.count("*").alias("n"), *parts).where("n = 64")
    m = p.groupBy("channel").agg(*[F.avg(F.col(f"re{f}") * F.col(f"re{f}") + F.col(f"im{f}") * F.col(f"im{f}")).alias(f"p{f}") for f in FREQS])
    long = m.select("channel", F.explode(F.array(*[F.struct(F.lit(f).alias("freq"), F.col(f"p{f}").alias("p")) for f in FREQS])).alias("x")).select("channel", "x.*")
    return long.select("channel", "freq", F.round(F.col("p") / F.max("p").over(Window.partitionBy("freq")), 8).alias("rel"))


@query()
def band_power(spark, d):
    """Welch power of every channel in three bands over clips of 256 samples."""
    x = G.band_power(T.samples(spark, d), 1000.0, {"low": (0.0, 60.0), "mid": (60.0, 150.0), "high": (150.0, 500.0)}, 256, 64)
    return x.select("channel", "band", F.round("power", 6).alias("power"), F.round("var", 6).alias("var"), "clips")


@query()
def resampled(spark, d):
    """Every channel at two thirds of its rate."""
    return G.resampled(T.samples(spark, d), 2, 3).select("channel", "sample", F.round("v", 6).alias("v"))


@query()
def gappy_spectrum(spark, d):
    """Spectra of trials of 64 samples of which the large ones are missing."""
    s = T.samples(spark, d).select("channel", F.expr("(sample - 1) div 64").alias("trial"), "sample", F.when(F.col("v") <= 45, F.col("v")).alias("v"))
    return G.gappy_spectrum(s, 1000.0).select("trial", "channel", F.round("freq", 4).alias("freq"), F.round("re", 5).alias("re"), F.round("im", 5).alias("im"))


@query()
def sliding_spectrum(spark, d):
    """Power in windows of 64 samples that slide by half, along trials of 256."""
    s = T.samples(spark, d).withColumn("trial", F.expr("(sample - 1) div 256"))
    return G.sliding_spectrum(s, 1000.0, 64, 32, 3).select("trial", "channel", "at", F.round("freq", 4).alias("freq"), F.round("power", 6).alias("power"))


@query()
def copula_information(spark, d):
    """Bits that two signals share under a Gaussian copula, by channel."""
    x = G.copula_information(T.samples(spark, d), "v", "w", ["channel"], "sample")
    return x.select("channel", "n", F.round("bits", 6).alias("bits"))


@query()
def bayes_factors(spark, d):
    """How much likelier a paired difference is with an effect than without, by block."""
    side = lambda o: F.avg(F.when(F.col("outcome") == o, F.col("x")))
    u = T.conditions(spark, d).groupBy("block", "session").agg((side("F") - side("O")).alias("delta"))
    t = u.groupBy("block").agg(F.count("delta").alias("n"), *S.paired_t("delta"))
    return t.select("block", "n", F.round("t", 6).alias("t"), F.round(G.bayes_factor("t", "n", "df"), 6).alias("bf10"))


@query()
def multivariate_f(spark, d):
    """Repeated-measures F of the block over sessions by the multivariate way, with its p."""
    x = G.multivariate_f(T.conditions(spark, d), "x", "session", "block")
    return x.select(F.round("f", 6).alias("f"), "df1", "df2", F.round(G.f_pvalue("f", "df1", "df2"), 6).alias("p"))


@query(f"WITH {SM}, r AS (SELECT sample, avg(v) AS common FROM smp GROUP BY sample), j AS (SELECT s.channel, s.sample, s.v, r.common FROM smp s JOIN r ON r.sample = s.sample), k AS (SELECT channel, covar_pop(v, common) / nullif(var_pop(common), 0) AS b, avg(common) AS m FROM j GROUP BY channel) SELECT j.channel, sample, round(v - coalesce(b, 0) * (common - m), 6) AS v FROM j JOIN k ON k.channel = j.channel")
def regressed_out(spark, d):
    """Samples without what they have of the mean over channels."""
    s = T.samples(spark, d)
    ref = s.groupBy("sample").agg(F.avg("v").alias("common"))
    return models.regress_out(s.select("channel", "sample", "v"), ref, ["common"]).select("channel", "sample", F.round("v", 6).alias("v"))


@query(f"""WITH {SM}, p AS (SELECT a.channel, a.v AS ar, a.w / 1000 - 50 AS ai, b.v - 20 AS br, b.w / 1000 - 40 AS bi FROM smp a JOIN smp b ON b.channel = a.channel + 1 AND b.sample = a.sample), c AS (SELECT channel, log10(nullif(ar * ar + ai * ai, 0)) AS x, log10(nullif(pow(bi * ar - br * ai, 2) / (ar * ar + ai * ai), 0)) AS y, log10(nullif(br * br + bi * bi, 0)) AS u, log10(nullif(pow(bi * ar - br * ai, 2) / (br * br + bi * bi), 0)) AS z FROM p)
 SELECT channel, round((corr(x, y) + corr(u, z)) / 2 * (count(*) - 1) / count(*), 7) AS c FROM c GROUP BY channel""")
def power_correlation(spark, d):
    """Orthogonalised correlation of power between neighbouring channels."""
    s = T.samples(spark, d)
    a = s.select("channel", "sample", F.col("v").alias("ar"), (F.col("w") / 1000 - 50).alias("ai"))
    b = s.select((F.col("channel") - 1).alias("channel"), "sample", (F.col("v") - 20).alias("br"), (F.col("w") / 1000 - 40).alias("bi"))
    return a.join(b, ["channel", "sample"]).groupBy("channel").agg(F.round(S.orthogonal_power_correlation("ar", "ai", "br", "bi"), 7).alias("c"))


@query(f"""WITH {T.EVENTS}, {SM}, e AS (SELECT DISTINCT user_id % 100 AS channel, depth AS pos FROM ev WHERE event_type = 'error' AND depth > 4), h AS (SELECT DISTINCT e.channel, pos + o AS sample FROM e, generate_series(-2, 2) g(o)), g AS (SELECT s.channel, s.sample, CASE WHEN h.sample IS NULL THEN v END AS x FROM smp s LEFT JOIN h ON h.channel = s.channel AND h.sample = s.sample),
 f AS (SELECT *, last_value(x IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x0, last_value(CASE WHEN x IS NOT NULL THEN sample END IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s0,
 first_value(x IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x1, first_value(CASE WHEN x IS NOT NULL THEN sample END IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS s1 FROM g)
 SELECT channel, sample, round(coalesce(x, x0 + (sample - s0)::DOUBLE / (s1 - s0) * (x1 - x0)), 8) AS v FROM f""")
def spike_interpolated(spark, d):
    """Samples around each mark replaced by the line between what lies on both sides."""
    s = T.samples(spark, d).select("channel", "sample", "v")
    gone = marks(spark, d).where("at > 4").select("channel", F.explode(F.sequence(F.col("at") - 2, F.col("at") + 2)).alias("sample")).distinct().withColumn("gone", F.lit(True))
    held = s.join(gone, ["channel", "sample"], "left").select("channel", "sample", F.when(F.col("gone").isNull(), F.col("v")).alias("v"))
    return W.fill_gaps(held, "v", tasks=T.tasks(spark, d)).select("channel", "sample", F.round("v", 8).alias("v"))


@query(f"WITH {SP}, m AS (SELECT unit % 10 AS grp, depth // 20 AS x, CAST(floor(ampl / 40) AS BIGINT) AS y, count(*) AS n FROM spike GROUP BY ALL), z AS (SELECT grp, avg(n) AS m, stddev_samp(n) AS s FROM m GROUP BY grp) SELECT m.grp, x, y, n, round((n - m) / nullif(s, 0), 8) AS z, n = max(n) OVER (PARTITION BY m.grp) AS peak FROM m JOIN z ON z.grp = m.grp")
def field_peaks(spark, d):
    """Counts by place of the stimulus against the map's mean and deviation, and where they peak."""
    m = T.spikes(spark, d).groupBy((F.col("unit") % 10).alias("grp"), F.expr("depth div 20").alias("x"), F.floor(F.col("ampl") / 40).alias("y")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("grp")
    return m.select("grp", "x", "y", "n", F.round((F.col("n") - F.avg("n").over(w)) / F.nullif(F.stddev_samp("n").over(w), F.lit(0.0)), 8).alias("z"), (F.col("n") == F.max("n").over(w)).alias("peak"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(ts) // 1000000 * 1000000 - 5400000000 WHEN 2 THEN epoch_us(ts) // 60000000 * 60000000 + 18000000000 ELSE epoch_us(ts) // 1000 * 1000 END AS micros FROM events""")
def zoned_times(spark, d):
    """Times written with and without seconds, fractions and zones, read back as microseconds in UTC."""
    shape = lambda form, zone: F.concat(F.date_format("ts", form), F.lit(zone))
    k = F.col("event_id") % 4
    text = F.when(k == 0, shape("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "Z")).when(k == 1, shape("yyyy-MM-dd HH:mm:ss", "+01:30")).when(k == 2, shape("yyyy-MM-dd'T'HH:mm", "-0500")).otherwise(shape("yyyy-MM-dd'T'HH:mm:ss.SSS", ""))
    return T.read(spark, d, "events").select("event_id", X.iso_micros(text).alias("micros"))


@query()
def decay_constants(spark, d):
    """Exponential decay of the peak over the distance from the first channel."""
    from ..operators import units as U

    a = T.samples(spark, d).groupBy("channel").agg((F.max("v") - F.min("v") + 50 - F.col("channel") % 10 * 3).alias("n"))
    p = a.select(F.expr("channel div 10").alias("unit"), (F.col("channel") % 10).alias("bin"), "n")
    return U.acg_time_constants(p, 1.0).select("unit", F.round("tau_rise", 4).alias("tau"))


@query()
def superlets(spark, d):
    """Power under superlets of rising order in stretches of 256 samples."""
    s = T.samples(spark, d).withColumn("trial", F.expr("(sample - 1) div 256"))
    x = G.superlet_power(s, 1000.0, [40.0, 90.0], [1, 3])
    return x.select("trial", "channel", "freq", "sample", F.round("power", 6).alias("power"))


@query()
def spike_spectrum(spark, d):
    """Spectrum of the 33 samples around each mark."""
    found = A.triggered(T.samples(spark, d), marks(spark, d).distinct(), 16, 16, on=["channel"])
    trials = found.select((F.shiftleft(F.col("channel").cast("long"), 40) + F.col("at")).alias("trial"), "channel", "sample", "v")
    whole = trials.groupBy("trial").agg(F.count("*").alias("n")).where("n = 33").select("trial")
    return G.spectrum(trials.join(whole, "trial"), 1000.0, 3).select("trial", "channel", F.round("freq", 4).alias("freq"), F.round("power", 5).alias("power"))


@query()
def paired_trials(spark, d):
    """Trials of two outcomes paired by price and block within sessions."""
    c = T.conditions(spark, d).select("session", "trial", "outcome", "block", (F.col("x") / 1000).alias("x"))
    side = lambda o: c.where(F.col("outcome") == o).drop("outcome")
    return R.pair_by_counts(side("F"), side("O"), ["session"], ["x", "block"]).select("session", "trial_a", "trial_b", F.round("cost", 6).alias("cost"))
