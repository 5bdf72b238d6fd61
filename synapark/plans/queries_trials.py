"""Trial definitions, maps, duplicates, models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import aligned as A
from ..operators import intervals as I
from ..operators import models
from ..operators import stats as S
from ..operators import trials as R
from . import tables as T
from .registry import query

H = T.HOUR


@query(f"WITH {T.EVENTS}, m AS (SELECT min(t) AS lo, max(t) AS hi FROM ev) SELECT event_id, t - {H} AS start, t + {2 * H} AS stop FROM ev, m WHERE event_type IN ('signup', 'error') AND t - {H} >= lo AND t + {2 * H} <= hi")
def trials_around_events(spark, d):
    """Windows around events that lie inside the recording."""
    return R.TRIAL_FUNCTIONS["around_events"](T.events(spark, d), ["signup", "error"], H, 2 * H).select("event_id", "start", F.col("end").alias("stop"))


@query(f"WITH {T.EVENTS}, p AS (SELECT *, lead(event_type) OVER (PARTITION BY user_id ORDER BY t) AS nxt, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS stop FROM ev) SELECT event_id, t AS start, stop FROM p WHERE event_type = 'click' AND nxt = 'view'")
def trials_consecutive(spark, d):
    """From a click to the view that follows at once."""
    return R.TRIAL_FUNCTIONS["consecutive"](T.events(spark, d), "click", "view", by=["user_id"]).select("event_id", "start", F.col("end").alias("stop"))


@query(f"""WITH RECURSIVE {T.SAMPLES}, u AS (SELECT channel, sample, v, lag(v) OVER (PARTITION BY channel ORDER BY sample) AS was FROM smp), c AS (SELECT channel, sample FROM u WHERE v >= 40 AND was < 40),
 k AS (SELECT channel, min(sample) AS sample FROM c GROUP BY channel UNION ALL SELECT c.channel, min(c.sample) FROM k JOIN c ON c.channel = k.channel AND c.sample > k.sample + 3 GROUP BY c.channel) SELECT channel, sample FROM k""")
def threshold_crossings(spark, d):
    """Rises through a threshold, none within three samples of the last one kept."""
    return R.crossings(T.samples(spark, d), 40, 3, tasks=T.tasks(spark, d)).select("channel", "sample")


@query(f"WITH {T.SPIKES} SELECT depth // 20 AS x, CAST(floor(ampl / 40) AS BIGINT) AS y, count(*) AS n, round(avg(t % 86400000), 6) AS mean FROM spike GROUP BY ALL")
def receptive_field(spark, d):
    """Mean response by place of the stimulus."""
    s = T.spikes(spark, d)
    return s.groupBy(F.expr("depth div 20").alias("x"), F.floor(F.col("ampl") / 40).alias("y")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("t") % 86_400_000), 6).alias("mean"))


@query(f"""WITH {T.EVENTS}, b AS (SELECT event_id, t // {120 * H} AS bin, event_type, value FROM ev), t AS (SELECT bin, value, count(*) AS n, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p FROM b GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY bin ORDER BY value) - (n - 1) / 2.0 AS rk FROM t),
 g AS (SELECT bin, CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n - p) AS BIGINT) AS n_neg, sum(rk * p) AS s FROM r GROUP BY bin) SELECT bin, n_pos, n_neg, round((s - n_pos * (n_pos + 1) / 2.0) / nullif(n_pos * n_neg, 0), 9) AS auc FROM g""")
def choice_probability(spark, d):
    """Area under the ROC curve in each stretch of time."""
    rows = T.events(spark, d).withColumn("bin", F.expr(f"t div {120 * H}"))
    out = S.ranked_auc(rows, "value", F.col("event_type") == "purchase", ["bin"])
    return out.select("bin", "n_pos", "n_neg", F.round("auc", 9).alias("auc"))


@query(f"""WITH {T.SPIKES}, {T.SAMPLES}, c AS (SELECT unit % 100 AS channel, depth AS sample, count(*) AS n FROM spike GROUP BY ALL) SELECT s.channel, s.sample, s.v, coalesce(c.n, 0) AS spikes FROM smp s LEFT JOIN c ON c.channel = s.channel AND c.sample = s.sample""")
def append_spikes(spark, d):
    """Number of spikes on each sample."""
    s = T.spikes(spark, d).select((F.col("unit") % 100).alias("channel"), (F.col("depth") / 1000.0).alias("t_s"))
    return R.append_spikes(T.samples(spark, d).select("channel", "sample", "v"), s, 1000.0)


@query(f"""WITH {T.SAMPLES}, m AS (SELECT channel, sample, v, w FROM smp), p AS (SELECT DISTINCT channel // 2 * 2 AS plus, channel // 2 * 2 + 1 AS minus FROM smp)
 SELECT plus, minus, a.sample AS t, round((a.v - b.v + b.w - a.w) / 2, 6) AS lrp FROM p JOIN m a ON a.channel = plus JOIN m b ON b.channel = minus AND b.sample = a.sample""")
def lateralized_potential(spark, d):
    """Half the sum of hemispheric differences of channel pairs."""
    s = T.samples(spark, d)
    side = lambda c: s.select("channel", F.col("sample").alias("t"), F.col(c).alias("v"))
    even = F.expr("channel div 2") * 2
    pairs = s.select(even.alias("plus"), (even + 1).alias("minus")).distinct()
    return R.lateralized(side("v"), side("w"), pairs).select("plus", "minus", "t", F.round("lrp", 6).alias("lrp"))


@query(f"WITH {T.SPIKES}, a AS (SELECT unit, spike_id, t, depth FROM spike), r AS (SELECT unit, min(t) AS lo, max(t) AS hi FROM a GROUP BY unit) SELECT a.unit AS unit, CAST(floor((t - lo) * 10 / greatest(hi - lo, 1)) AS BIGINT) AS phase, count(*) AS n FROM a JOIN r ON r.unit = a.unit GROUP BY ALL")
def phase_histogram(spark, d):
    """Spikes by tenth of their unit's recording."""
    w = Window.partitionBy("unit")
    lo, hi = F.min("t").over(w), F.max("t").over(w)
    return T.spikes(spark, d).select("unit", F.floor((F.col("t") - lo) * 10 / F.greatest(hi - lo, F.lit(1))).alias("phase")).groupBy("unit", "phase").agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT label AS template, min(vec_id) AS vec_id FROM embeddings GROUP BY label), w AS (SELECT template, embedding FROM f JOIN embeddings USING (vec_id)), t AS (SELECT template, CAST(k // 16 AS INT) AS channel, CAST(k % 16 AS INT) AS o, CAST(embedding[k + 1] AS DOUBLE) AS w FROM w, generate_series(0, 63) g(k)),
 s AS (SELECT user_id % 10 AS template, epoch_us(ts) // 60000000 AS mark, value FROM events WHERE event_type IN ('click', 'view')) SELECT channel, mark + o AS sample, round(sum(value * w), 6) AS raw FROM s JOIN t ON t.template = s.template GROUP BY ALL""")
def predicted_raw(spark, d):
    """What each channel records where every spike is its template times its amplitude: sixteen samples on four channels a template."""
    e = T.read(spark, d, "embeddings").select(F.col("label").alias("template"), "vec_id", "embedding").groupBy("template").agg(F.min_by("embedding", "vec_id").alias("e"))
    waves = e.select("template", F.posexplode("e").alias("k", "w")).select("template", F.expr("CAST(k DIV 16 AS INT)").alias("channel"), (F.col("k") % 16).alias("offset"), F.col("w").cast("double").alias("w"))
    spikes = T.spikes(spark, d).select((F.col("unit") % 10).alias("template"), F.expr("t DIV 60000").alias("at"), "ampl")
    return A.predict(spikes, waves).select("channel", "sample", F.round("raw", 6).alias("raw"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(cos(l_tax) * cos(l_discount), 9) AS w, round(sin(l_tax) * cos(l_discount), 9) AS z FROM lineitem")
def rotation(spark, d):
    """Quaternions of two turns."""
    q = X.euler_to_quaternion(F.col("l_tax") * 2, F.col("l_discount") * 2, F.lit(0.0))
    return T.read(spark, d, "lineitem").withColumn("q", q).select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("q")[0], 9).alias("w"), F.round(F.col("q")[3], 9).alias("z"))


@query()
def duplicate_spikes(spark, d):
    """Spikes of a channel without those within an hour of the last kept one."""
    s = T.spikes(spark, d).withColumn("channel", F.col("unit") % 10)
    return R.drop_duplicates_within(s.select("channel", "unit", "spike_id", "t"), H)


@query()
def waveform_components(spark, d):
    """First principal components of waveforms, up to sign."""
    e = T.read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return models.components(e, k=3).select("vec_id", F.transform("pc", lambda v: F.round(F.abs(v), 6)).alias("pc"))


@query()
def waveform_clusters(spark, d):
    """k-means of waveforms."""
    e = T.read(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return models.clusters(e, 10).select("vec_id", "cluster")


@query(f"""WITH {T.EVENTS}, p AS (SELECT user_id, t, avg(value) AS value FROM ev WHERE event_type = 'error' GROUP BY ALL), c AS (SELECT event_id, user_id, o * {H} AS "offset", t + o * {H} AS t FROM ev, generate_series(-2, 2) g(o) WHERE event_type = 'click'),
 a AS (SELECT c.*, p.t AS t0, p.value AS v0 FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.t >= p.t), b AS (SELECT a.*, p.t AS t1, p.value AS v1 FROM a ASOF LEFT JOIN p ON a.user_id = p.user_id AND a.t <= p.t),
 i AS (SELECT "offset", CASE WHEN t0 = t1 THEN v0 ELSE v0 + (t - t0) / (t1 - t0)::DOUBLE * (v1 - v0) END AS value FROM b) SELECT "offset", count(value) AS n, round(avg(value), 6) AS mean FROM i GROUP BY "offset" """)
def spike_triggered_average(spark, d):
    """Interpolated track around each unit's spikes, by hour of offset."""
    e = T.events(spark, d)
    spikes = e.where("event_type = 'click'").select("event_id", "user_id", F.explode(F.array(*[F.lit(k * H).cast("long") for k in (-2, -1, 0, 1, 2)])).alias("offset"), "t")
    at = spikes.select("event_id", "user_id", "offset", (F.col("t") + F.col("offset")).alias("t"))
    out = I.interpolate_at(at, e.where("event_type = 'error'").select("user_id", "t", "value"), t="t", value="value", by=["user_id"], width=30 * 24 * T.HOUR)
    return out.groupBy("offset").agg(F.count("value").alias("n"), F.round(F.avg("value"), 6).alias("mean"))
