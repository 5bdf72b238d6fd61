"""Windows: intervals between spikes, states, smoothing, baselines, runs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import intervals as I
from ..operators import windows as W
from . import tables as T
from .registry import query

H = T.HOUR
BY, ORDER = ["channel"], ["sample"]
OVER = "OVER (PARTITION BY channel ORDER BY sample"


def w():
    return W.ordered(BY, ORDER)


@query(f"WITH {T.SPIKES} SELECT unit, spike_id, t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike_id) AS isi FROM spike")
def interspike_interval(spark, d):
    """Time since the unit's spike before."""
    return T.spikes(spark, d).select("unit", "spike_id", W.interval("t", W.ordered(["unit"], ["t", "spike_id"])).alias("isi"))


@query(f"WITH {T.EVENTS}, x AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY t, event_id) AS was FROM ev) SELECT event_id, user_id, event_type FROM x WHERE was IS NOT NULL AND was <> event_type")
def state_change(spark, d):
    """Events that differ in type from the user's event before."""
    return W.changes(T.events(spark, d), "event_type", ["t", "event_id"], ["user_id"]).select("event_id", "user_id", "event_type")


@query(f"WITH {T.EVENTS}, x AS (SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t) - t AS gap FROM ev) SELECT event_id, user_id, t FROM x WHERE gap IS NULL OR gap >= {2 * H}")
def debounce(spark, d):
    """Of a user's events within two hours the last stays."""
    return W.debounce(T.events(spark, d), "t", 2 * H, ["user_id"]).select("event_id", "user_id", "t")


@query(f"WITH {T.EVENTS} SELECT event_id, CAST(bit_or(CAST(1 << (depth % 16) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN CURRENT ROW AND {12 * H} FOLLOWING) AS BIGINT) AS code FROM ev")
def forward_or(spark, d):
    """Pins set by any of the user's events within twelve hours."""
    e = T.events(spark, d).withColumn("pin", F.expr("shiftleft(1L, CAST(depth % 16 AS INT))"))
    return e.select("event_id", W.forward_or("pin", "t", 12 * H, ["user_id"]).alias("code"))


@query(f"WITH {T.SAMPLES}, a AS (SELECT channel, sample, sample - lag(sample) {OVER}) AS gap FROM smp WHERE v > 40) SELECT channel, sample FROM a WHERE gap IS NULL OR gap > 2")
def refractory_onset(spark, d):
    """Active samples after at least two others without activity."""
    a = T.samples(spark, d).where("v > 40").withColumn("gap", W.interval("sample", w()))
    return a.where("gap IS NULL OR gap > 2").select("channel", "sample")


@query(f"WITH {T.SAMPLES}, x AS (SELECT channel, sample, CAST(v AS BIGINT) AS word, lag(CAST(v AS BIGINT)) {OVER}) AS was FROM smp) SELECT channel, sample, b AS pin, CASE WHEN (word >> b) & 1 = 1 THEN 'rise' ELSE 'fall' END AS edge FROM x, generate_series(0, 5) g(b) WHERE was IS NOT NULL AND ((word >> b) & 1) <> ((was >> b) & 1)")
def bit_edges(spark, d):
    """Rising and falling edges of each bit of a word."""
    x = T.samples(spark, d).select("channel", "sample", F.col("v").cast("long").alias("word")).withColumn("was", F.lag("word").over(w())).where("was IS NOT NULL")
    x = x.withColumn("pin", F.explode(F.sequence(F.lit(0), F.lit(5))))
    now, was = F.expr("shiftright(word, pin) & 1"), F.expr("shiftright(was, pin) & 1")
    return x.where(now != was).select("channel", "sample", F.col("pin").cast("long").alias("pin"), F.when(now == 1, "rise").otherwise("fall").alias("edge"))


@query(f"""WITH {T.SAMPLES}, s AS (SELECT channel, sample, last_value(CASE WHEN v >= 40 THEN 1 WHEN v <= 10 THEN 0 END IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM smp)
 SELECT channel, sample, CAST(state AS INT) AS state FROM (SELECT *, lag(state) {OVER}) AS was FROM s) WHERE was IS NOT NULL AND was <> state""")
def schmitt_trigger(spark, d):
    """Flips of a two-threshold state."""
    state = F.when(F.col("v") >= 40, 1).when(F.col("v") <= 10, 0)
    s = W.over_stretches(W.carried(T.samples(spark, d), state, "state"), 1, {"was": lambda x: F.lag("state").over(x)})
    return s.where("was <> state").select("channel", "sample", "state")


@query(f"WITH {T.SAMPLES} SELECT channel, sample, round(avg(v) {OVER} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 9) AS smooth FROM smp")
def moving_average(spark, d):
    """Box of five samples."""
    return W.over_stretches(T.samples(spark, d), 2, {"smooth": lambda x: F.round(W.moving_average("v", x, 2), 9)}).select("channel", "sample", "smooth")


@query(f"WITH {T.SAMPLES} SELECT channel, sample, quantile_cont(v, 0.5) {OVER} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS tonic FROM smp")
def median_filter(spark, d):
    """Median of five samples."""
    return W.over_stretches(T.samples(spark, d), 2, {"tonic": lambda x: W.median_filter("v", x, 2)}).select("channel", "sample", "tonic")


@query(f"""WITH {T.SAMPLES}, n AS (SELECT channel, max(sample) AS n FROM smp GROUP BY channel), e AS (SELECT channel, n, avg(v) FILTER (sample <= 4) AS l, avg(v) FILTER (sample > n - 4) AS r FROM smp JOIN n USING (channel) GROUP BY ALL),
 x AS (SELECT s.channel, s.sample, CASE WHEN s.sample + o < 1 THEN l WHEN s.sample + o > n THEN r ELSE b.v END AS v FROM smp s JOIN e ON e.channel = s.channel CROSS JOIN generate_series(-4, 4) g(o) LEFT JOIN smp b ON b.channel = s.channel AND b.sample = s.sample + o)
 SELECT channel, sample, round(median(v), 8) AS tonic FROM x GROUP BY ALL""")
def median_filter_padded(spark, d):
    """Running median of nine samples, each end going on with the mean of the four samples next to it."""
    out = W.padded_median(T.samples(spark, d).select("channel", "sample", "v"), "v", 4, "tonic", tasks=T.tasks(spark, d))
    return out.select("channel", "sample", F.round("tonic", 8).alias("tonic"))


@query(f"WITH {T.SAMPLES} SELECT channel, sample, round((max(v) {OVER} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) - min(v) {OVER} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) / sqrt(7.0), 9) AS span FROM smp")
def sliding_range(spark, d):
    """Range of seven samples over the root of their number."""
    return W.over_stretches(T.samples(spark, d), 3, {"span": lambda x: F.round(W.sliding_range("v", x, 3), 9)}).select("channel", "sample", "span")


@query(f"WITH {T.SAMPLES}, x AS (SELECT *, lag(v) {OVER}) AS a, lead(v) {OVER}) AS b FROM smp) SELECT channel, sample, CASE WHEN a IS NULL THEN b - v WHEN b IS NULL THEN v - a ELSE (b - a) / 2 END AS slope FROM x")
def gradient(spark, d):
    """Central differences."""
    return W.over_stretches(T.samples(spark, d), 1, {"slope": lambda x: W.gradient("v", x)}).select("channel", "sample", "slope")


@query(f"WITH {T.SAMPLES} SELECT channel, sample, round(v - avg(v) OVER (PARTITION BY channel), 9) AS flat0 FROM smp")
def detrend_constant(spark, d):
    """Samples without their channel's mean."""
    return W.demeaned(T.samples(spark, d), "v", BY, "flat0").select("channel", "sample", F.round("flat0", 9).alias("flat0"))


@query(f"WITH {T.SAMPLES}, r AS (SELECT channel, avg(v) AS mv, avg(sample) AS ms, coalesce(covar_pop(v, sample) / nullif(var_pop(sample), 0), 0) AS k FROM smp GROUP BY channel) SELECT s.channel, s.sample, round(v - mv - k * (sample - ms), 9) AS flat1 FROM smp s JOIN r ON r.channel = s.channel")
def detrend_linear(spark, d):
    """Samples without their channel's least-squares line."""
    return W.detrended(T.samples(spark, d), "v", "sample", BY, "flat1").select("channel", "sample", F.round("flat1", 9).alias("flat1"))


@query(f"WITH {T.SPIKES} SELECT unit, spike_id, CAST(count(*) OVER (PARTITION BY unit ORDER BY t, spike_id) AS BIGINT) AS n, round(sum(ampl) OVER (PARTITION BY unit ORDER BY t, spike_id), 8) AS total FROM spike")
def running_totals(spark, d):
    """Running count and sum of a unit's spikes."""
    x = W.ordered(["unit"], ["t", "spike_id"])
    return T.spikes(spark, d).select("unit", "spike_id", F.count("*").over(x).alias("n"), F.round(F.sum("ampl").over(x), 8).alias("total"))


@query(f"""WITH {T.CONDITIONS}, c AS (SELECT session, block, avg(x) AS x FROM cond GROUP BY ALL), b AS (SELECT session, avg(x) AS m, stddev_samp(x) AS sd FROM c WHERE block <= 2 GROUP BY session)
 SELECT c.session, c.block, round((x - m) / nullif(sd, 0), 9) AS z FROM c LEFT JOIN b ON b.session = c.session""")
def zscore_baseline(spark, d):
    """Block means of each session against its first two blocks."""
    c = T.conditions(spark, d).groupBy("session", "block").agg(F.avg("x").alias("x"))
    return c.select("session", "block", F.round(W.baseline("x", F.col("block") <= 2, ["session"]), 9).alias("z"))


@query(f"WITH {T.CONDITIONS}, c AS (SELECT session, block, avg(x) AS x FROM cond GROUP BY ALL), b AS (SELECT session, avg(x) AS m FROM c WHERE block <= 2 GROUP BY session) SELECT c.session, c.block, round(10 * log10(x / nullif(m, 0)), 9) AS db, round((x - m) / nullif(m, 0), 9) AS rel FROM c LEFT JOIN b ON b.session = c.session")
def db_baseline(spark, d):
    """The same in decibel and as relative change."""
    c = T.conditions(spark, d).groupBy("session", "block").agg(F.avg("x").alias("x"))
    rest = F.col("block") <= 2
    return c.select("session", "block", F.round(W.baseline("x", rest, ["session"], "db"), 9).alias("db"), F.round(W.baseline("x", rest, ["session"], "relchange"), 9).alias("rel"))


@query(f"WITH {T.SAMPLES}, n AS (SELECT channel, sample, row_number() {OVER}) AS k, v > 30 AS f FROM smp), i AS (SELECT channel, sample, k - row_number() {OVER}) AS g FROM n WHERE f) SELECT channel, min(sample) AS first, max(sample) AS last, count(*) AS length FROM i GROUP BY channel, g HAVING count(*) >= 3")
def runs(spark, d):
    """Runs of at least three high samples."""
    return I.runs(T.samples(spark, d), F.col("v") > 30, order="sample", by=BY).where("length >= 3").select("channel", "first", "last", "length")


@query(f"WITH {T.SAMPLES}, n AS (SELECT channel, sample, row_number() {OVER}) AS k, v > 30 AS f FROM smp), i AS (SELECT channel, sample, k - row_number() {OVER}) AS g FROM n WHERE f), r AS (SELECT channel, min(sample) AS a, max(sample) AS b, count(*) AS c FROM i GROUP BY channel, g), l AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY c DESC, a) AS nth FROM r) SELECT channel, a AS first, b AS last, c AS length FROM l WHERE nth = 1")
def longest_run(spark, d):
    """The longest run of each channel, the first of equals."""
    found = I.runs(T.samples(spark, d), F.col("v") > 30, order="sample", by=BY)
    return found.groupBy("channel").agg(F.max(F.struct("length", (-F.col("first")).alias("neg"), "last")).alias("x")).select("channel", (-F.col("x.neg")).alias("first"), "x.last", "x.length")


@query(f"WITH {T.SAMPLES} SELECT channel, sample FROM smp WHERE v > 45")
def intervals_to_samples(spark, d):
    """Intervals of high samples, expanded again into the samples."""
    return I.expand(I.runs(T.samples(spark, d), F.col("v") > 45, order="sample", by=BY).drop("length"), start="first", end="last").select("channel", "sample")


@query(f"""WITH {T.SAMPLES}, g AS (SELECT channel, sample, CASE WHEN v > 45 THEN NULL ELSE v END AS x FROM smp),
 f AS (SELECT *, last_value(x IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x0, last_value(CASE WHEN x IS NOT NULL THEN sample END IGNORE NULLS) {OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s0,
 first_value(x IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x1, first_value(CASE WHEN x IS NOT NULL THEN sample END IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS s1 FROM g)
 SELECT channel, sample, round(coalesce(x, x0 + (sample - s0)::DOUBLE / (s1 - s0) * (x1 - x0)), 9) AS x FROM f""")
def fill_gaps(spark, d):
    """Artifact samples replaced by the line between their neighbours."""
    g = T.samples(spark, d).withColumn("x", F.when(F.col("v") <= 45, F.col("v")))
    g = W.fill_gaps(g, "x", tasks=T.tasks(spark, d))
    return g.select("channel", "sample", F.round("x", 9).alias("x"))


@query(f"WITH {T.SAMPLES}, x AS (SELECT *, lag(v) {OVER}) AS a, lead(v) {OVER}) AS b FROM smp) SELECT channel, sample, v FROM x WHERE v > a AND v > b AND v > 40")
def local_peaks(spark, d):
    """Samples above a threshold and both neighbours."""
    near = W.over_stretches(T.samples(spark, d), 1, {"l": lambda x: F.lag("v").over(x), "r": lambda x: F.lead("v").over(x)})
    return near.where("v > l AND v > r AND v > 40").select("channel", "sample", "v")


@query(f"WITH {T.SAMPLES} SELECT channel, sample, v FROM smp WHERE (sample - 5) % 32 = 0")
def downsample(spark, d):
    """Every 32nd sample from the fifth on."""
    return T.samples(spark, d).where("(sample - 5) % 32 = 0").select("channel", "sample", "v")


@query(f"WITH {T.CONDITIONS}, x AS (SELECT *, lag(block) OVER (PARTITION BY session ORDER BY t, trial) AS was FROM cond) SELECT session, trial, block FROM x WHERE block > was")
def block_change(spark, d):
    """Trials in which the block number rises."""
    x = T.conditions(spark, d).withColumn("was", F.lag("block").over(W.ordered(["session"], ["t", "trial"])))
    return x.where("block > was").select("session", "trial", "block")


@query(f"WITH {T.CONDITIONS} SELECT session, trial, row_number() OVER (PARTITION BY session ORDER BY t, trial) <= floor(count(*) OVER (PARTITION BY session) / 2.0) AS early FROM cond")
def early_late(spark, d):
    """First half of each session's trials."""
    return T.conditions(spark, d).select("session", "trial", W.early(["session"], ["t", "trial"]).alias("early"))


@query(f"WITH {T.CONDITIONS} SELECT session, trial, round(x - avg(CASE WHEN outcome = 'F' THEN x END) OVER (PARTITION BY session), 8) AS x FROM cond WHERE block > 0")
def subtract_condition_mean(spark, d):
    """Trials without the mean of another condition of their session."""
    m = F.avg(F.when(F.col("outcome") == "F", F.col("x"))).over(Window.partitionBy("session"))
    return T.conditions(spark, d).select("session", "trial", F.round(F.col("x") - m, 8).alias("x"))


@query(f"WITH {T.CONDITIONS} SELECT trial, outcome, row_number() OVER (PARTITION BY session, outcome ORDER BY t, trial) <= 2 AS train FROM cond")
def train_test_split(spark, d):
    """The first two trials of each outcome and session are for training."""
    return T.conditions(spark, d).select("trial", "outcome", W.first_n(["session", "outcome"], ["t", "trial"], 2).alias("train"))


@query(f"""WITH {T.SAMPLES}, x AS (SELECT *, lead(v) {OVER}) AS v1, lead(w) {OVER}) AS w1 FROM smp), p AS (SELECT channel, sample, v * w1 - w * v1 AS im FROM x)
 SELECT channel, sample, round(sum(im) {OVER} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 3) AS psi FROM p""")
def phase_slope(spark, d):
    """Imaginary part of neighbouring products, summed over a frame."""
    made = {"im": lambda x: F.col("v") * F.lead("w").over(x) - F.col("w") * F.lead("v").over(x), "psi": lambda x: F.round(F.sum("im").over(W.centred(x, 2)), 3)}
    return W.over_stretches(T.samples(spark, d), 3, made).select("channel", "sample", "psi")


@query(f"WITH {T.SAMPLES} SELECT channel, sample, round((v - avg(v) OVER (PARTITION BY channel)) / nullif(stddev_pop(v) OVER (PARTITION BY channel), 0), 9) AS z FROM smp")
def channel_normalise(spark, d):
    """Samples in units of their channel's deviation."""
    return W.normalised(T.samples(spark, d), "v", BY, "z").select("channel", "sample", F.round("z", 9).alias("z"))


@query(f"WITH {T.SAMPLES} SELECT channel, sample, v - median(v) OVER (PARTITION BY sample) AS car FROM smp")
def common_median_reference(spark, d):
    """Samples without the median over channels."""
    return T.samples(spark, d).select("channel", "sample", (F.col("v") - F.percentile("v", F.lit(0.5)).over(Window.partitionBy("sample"))).alias("car"))


@query(f"WITH {T.SAMPLES}, m AS (SELECT *, channel // 32 AS bank, CASE WHEN channel % 32 = 7 THEN NULL ELSE v END AS x FROM smp) SELECT channel, sample, bank, x - median(x) OVER (PARTITION BY bank, sample) AS car FROM m")
def bank_reference(spark, d):
    """The same by bank of 32 channels, noisy channels masked."""
    m = T.samples(spark, d).select("channel", "sample", F.expr("channel div 32").alias("bank"), F.when(F.col("channel") % 32 != 7, F.col("v")).alias("x"))
    return m.select("channel", "sample", "bank", (F.col("x") - F.percentile("x", F.lit(0.5)).over(Window.partitionBy("bank", "sample"))).alias("car"))


@query(f"WITH {T.SAMPLES}, m AS (SELECT channel, sample, v - median(v) OVER (PARTITION BY channel, sample // 100) AS x FROM smp) SELECT channel, sample, x - median(x) OVER (PARTITION BY sample) AS car FROM m")
def chunk_then_median(spark, d):
    """First each chunk's channel median goes, then the sample's median."""
    m = T.samples(spark, d).select("channel", "sample", (F.col("v") - F.percentile("v", F.lit(0.5)).over(Window.partitionBy("channel", F.expr("sample div 100")))).alias("x"))
    return m.select("channel", "sample", (F.col("x") - F.percentile("x", F.lit(0.5)).over(Window.partitionBy("sample"))).alias("car"))


@query(f"""WITH {T.CONDITIONS}, g AS (SELECT session, trial, t - lag(t) OVER (PARTITION BY session ORDER BY t, trial) AS gap FROM cond), m AS (SELECT session, median(gap) AS m FROM g GROUP BY session)
 SELECT g.session, g.trial, g.gap FROM g JOIN m ON m.session = g.session WHERE gap > 1.2 * m""")
def time_breaks(spark, d):
    """Gaps between trials longer than 1.2 times the session's median."""
    g = T.conditions(spark, d).select("session", "trial", W.interval("t", W.ordered(["session"], ["t", "trial"])).alias("gap"))
    m = F.percentile("gap", F.lit(0.5)).over(Window.partitionBy("session"))
    return g.withColumn("m", m).where("gap > 1.2 * m").select("session", "trial", "gap")


@query(f"WITH {T.SPIKES}, x AS (SELECT *, t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike_id) AS gap FROM spike), s AS (SELECT *, sum(CASE WHEN gap > {48 * H} THEN 1 ELSE 0 END) OVER (PARTITION BY unit ORDER BY t, spike_id) AS k FROM x) SELECT unit, min(t) AS start, max(t) AS stop, count(*) AS n FROM s GROUP BY unit, k")
def session_windows(spark, d):
    """Bursts of spikes parted by two days of silence."""
    x = T.spikes(spark, d).withColumn("gap", W.interval("t", W.ordered(["unit"], ["t", "spike_id"])))
    k = F.sum(F.when(F.col("gap") > 48 * H, 1).otherwise(0)).over(W.ordered(["unit"], ["t", "spike_id"]))
    return x.withColumn("k", k).groupBy("unit", "k").agg(F.min("t").alias("start"), F.max("t").alias("stop"), F.count("*").alias("n")).drop("k")
