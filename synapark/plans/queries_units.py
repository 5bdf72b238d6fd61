"""Unit measures in one place: waveforms, correlograms, rates, templates, trial masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aligned as A
from ..operators import graph
from ..operators import intervals as I
from ..operators import trials as R
from ..operators import units as U
from ..operators import windows as W
from . import tables as T
from .registry import query

H = T.HOUR
S, SM, C = T.SPIKES, T.SAMPLES, T.CONDITIONS
ISI = S + ", isi AS (SELECT unit, t, spike_id, t - lag(t) OVER (PARTITION BY unit ORDER BY t, spike_id) AS isi FROM spike)"


@query(f"""WITH {ISI}, p AS (SELECT *, lag(isi) OVER (PARTITION BY unit ORDER BY t, spike_id) AS was FROM isi), m AS (SELECT unit, avg(isi / {H}) AS m, var_pop(isi / {H}) AS v FROM p GROUP BY unit)
 SELECT p.unit, round(stddev_samp(isi) / avg(isi), 8) AS cv, round(2 * avg(abs(isi - was)) / nullif(avg((isi + was) / 2), 0), 8) AS cv2, round(avg(pow(isi / {H} - m, 3)) / nullif(pow(any_value(v), 1.5), 0), 6) AS skewness,
 round(coalesce(sum(isi) FILTER (isi > {48 * H}), 0) / nullif(max(t) - min(t), 0), 8) AS long_share FROM p JOIN m ON m.unit = p.unit GROUP BY p.unit""")
def isi_shape(spark, d):
    """Variation, skewness and share of long intervals of every unit."""
    x = U.isi_measures(T.spikes(spark, d), 48 * H)
    return x.select("unit", F.round("cv", 8).alias("cv"), F.round("cv2", 8).alias("cv2"), F.round("skewness", 6).alias("skewness"), F.round("long_share", 8).alias("long_share"))


@query(f"""WITH {S}, e AS (SELECT unit, min(t) AS lo, CAST((max(t) - min(t)) // {24 * H} AS BIGINT) AS last FROM spike GROUP BY unit), g AS (SELECT e.unit, lo, b FROM e, generate_series(0, last) x(b)), c AS (SELECT s.unit, (t - lo) // {24 * H} AS b, count(*) AS n FROM spike s JOIN e ON e.unit = s.unit GROUP BY ALL),
 f AS (SELECT g.unit, CAST(coalesce(n, 0) AS DOUBLE) AS n FROM g LEFT JOIN c ON c.unit = g.unit AND c.b = g.b), l AS (SELECT unit, list_sort(list(n)) AS v, avg(n) AS mean, var_samp(n) AS var, count(*) AS k FROM f GROUP BY unit)
 SELECT unit, k AS bins, round(mean, 9) AS mean, round(var / mean, 8) AS fano, """ + ", ".join(
    f"round(v[greatest(1, least(k, CAST(floor({p} * k + 0.5) AS BIGINT)))] + (v[greatest(1, least(k, CAST(floor({p} * k + 0.5) AS BIGINT) + 1))] - v[greatest(1, least(k, CAST(floor({p} * k + 0.5) AS BIGINT)))]) * least(1, greatest(0, {p} * k + 0.5 - floor({p} * k + 0.5))), 9) AS {n}" for p, n in ((0.95, "p95"), (0.05, "p5"))
) + " FROM l")
def rate_range(spark, d):
    """Daily counts of each unit from its first spike on: mean, Fano factor, outer percentiles."""
    x = U.rate_measures(T.spikes(spark, d), 24 * H)
    return x.select("unit", "bins", F.round("mean", 9).alias("mean"), F.round("fano", 8).alias("fano"), F.round("p95", 9).alias("p95"), F.round("p5", 9).alias("p5"))


ACG_SQL = f"""{S}, c AS (SELECT a.unit, CAST(sign(b.t - a.t) * floor((abs(b.t - a.t) + {2 * H}) / {4 * H}) AS BIGINT) AS bin, count(*) AS n FROM spike a JOIN spike b ON a.unit = b.unit AND a.spike_id <> b.spike_id AND b.t BETWEEN a.t - {202 * H} + 1 AND a.t + {202 * H} - 1 GROUP BY ALL),
 u AS (SELECT DISTINCT unit FROM spike), acg AS (SELECT u.unit, b AS bin, coalesce(n, 0) AS n FROM u CROSS JOIN generate_series(-50, 50) g(b) LEFT JOIN c ON c.unit = u.unit AND c.bin = b)"""


def acg(spark, d):
    """Auto-correlograms on the whole grid of 50 bins of four hours to each side."""
    s = T.spikes(spark, d)
    pairs = A.correlogram(s, s, 202 * H - 1, 4 * H, pairs="same").select(F.col("unit_a").alias("unit"), "bin", "n")
    return A.fill(pairs, A.grid(s.select("unit").distinct(), "bin", -50, 50), ["unit", "bin"], "n")


@query(f"""WITH {ACG_SQL}, m AS (SELECT unit, avg(n) FILTER (bin BETWEEN 10 AND 40) AS m, min(n) + stddev_samp(n) AS k FROM acg GROUP BY unit)
 SELECT acg.unit, min(bin + 1) FILTER (bin >= 0 AND n >= m) AS suppression, min(bin) FILTER (bin > 0 AND n > k) AS refractory FROM acg JOIN m ON m.unit = acg.unit GROUP BY acg.unit""")
def acg_landmarks(spark, d):
    """Suppression and refractory lag of each unit's auto-correlogram."""
    return U.acg_landmarks(acg(spark, d), bins=50)


@query()
def acg_time_constants(spark, d):
    """Exponential time constants of both halves of each unit's auto-correlogram, in hours."""
    x = U.acg_time_constants(acg(spark, d), 4.0)
    return x.select("unit", F.round("tau_rise", 4).alias("tau_rise"), F.round("tau_decay", 4).alias("tau_decay"))


@query(f"""WITH {ACG_SQL}, n AS (SELECT unit, count(*) AS k FROM spike GROUP BY unit), r AS (SELECT (max(t) - min(t)) / {H}.0 AS span FROM spike)
 SELECT acg.unit, bin, round(n * 1.0 / (4 * k), 9) AS hz, round(n / (span * 4), 9) AS hz2, round(n * span / (4.0 * k * k), 8) AS scaled FROM acg JOIN n ON n.unit = acg.unit CROSS JOIN r""")
def correlogram_norms(spark, d):
    """Auto-correlograms as rates, as rates squared and scaled by chance, in hours."""
    s = T.spikes(spark, d)
    span = s.agg(((F.max("t") - F.min("t")) / float(H)).alias("span"))
    x = A.correlogram_norms(acg(spark, d).select(F.col("unit").alias("unit_a"), F.col("unit").alias("unit_b"), "bin", "n"), s.groupBy("unit").agg(F.count("*").alias("spikes")), span, 4.0)
    return x.select(F.col("unit_a").alias("unit"), "bin", F.round("hz", 9).alias("hz"), F.round("hz2", 9).alias("hz2"), F.round("scaled", 8).alias("scaled"))


@query()
def waveform_shape(spark, d):
    """Peaks, troughs, widths and ratios of every waveform."""
    e = T.read(spark, d, "embeddings").select("vec_id", U.wave_properties("embedding").alias("x"))
    number = lambda c: F.round(F.col(c), 6).alias(c)
    return e.select("vec_id", "x.*").select("vec_id", "n_peaks", "n_troughs", "trough_at", "peak_at", *[number(c) for c in ("peak_before", "peak_after", "trough", "width_before", "width_after", "width_trough", "duration_us", "half_width_ms", "peak_to_trough", "first_peak_to_trough")])


@query()
def all_unit_properties(spark, d):
    """Every measure of a unit in one row."""
    waves = T.read(spark, d, "embeddings").groupBy(F.col("label").cast("long").alias("unit")).agg(F.min_by("embedding", "vec_id").alias("wave"), (F.min("vec_id") % 64).alias("channel"))
    x = U.all_properties(T.spikes(spark, d), acg(spark, d), waves, width=4.0, bin_ms=24 * H, long=48 * H)
    return x.select(*[F.round(c, 4).alias(c) if t == "double" else F.col(c) for c, t in x.dtypes if c != "acg"], F.array_join(F.transform("acg", lambda v: v.cast("string")), " ").alias("acg"))


@query("""WITH p AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings), c AS (SELECT vec_id, CAST(i // 8 AS INT) AS channel, max(v) - min(v) AS size, arg_min(i % 8, v) AS low FROM p GROUP BY ALL),
 a AS (SELECT p.vec_id, CAST(p.i // 8 AS INT) AS channel, arg_max(p.i % 8, v) AS top FROM p JOIN c ON c.vec_id = p.vec_id AND c.channel = p.i // 8 AND p.i % 8 >= c.low GROUP BY ALL),
 t AS (SELECT c.*, a.top - c.low AS duration, max(size) OVER (PARTITION BY c.vec_id) AS big FROM c JOIN a ON a.vec_id = c.vec_id AND a.channel = c.channel)
 SELECT vec_id AS template, round(max(size), 8) AS ampl, round(sum(CASE WHEN size >= 0.3 * big THEN size * channel * 20 ELSE 0 END) / sum(CASE WHEN size >= 0.3 * big THEN size ELSE 0 END), 7) AS depth, arg_max(channel, size) AS channel, CAST(arg_max(duration, size) AS BIGINT) AS duration FROM t GROUP BY vec_id""")
def template_places(spark, d):
    """Size, depth, peak channel and duration of templates of eight channels."""
    e = T.read(spark, d, "embeddings").select(F.col("vec_id").alias("template"), F.col("embedding").cast("array<double>").alias("v"))
    t = e.select("template", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("channel"), "v").select("template", "channel", F.slice("v", F.col("channel") * 8 + 1, F.lit(8)).alias("wave"))
    at = spark.range(8).select(F.col("id").cast("int").alias("channel"), (F.col("id") * 20).alias("y"))
    x = U.template_places(t, at)
    return x.select("template", F.round("ampl", 8).alias("ampl"), F.round("depth", 7).alias("depth"), "channel", F.col("duration").cast("long").alias("duration"))


@query(f"""WITH {SM}, n AS (SELECT channel, sample, row_number() OVER (PARTITION BY channel ORDER BY md5(CAST(sample AS VARCHAR) || ':3'), sample) AS nth FROM smp WHERE v > 45)
 SELECT n.channel, o AS "offset", count(*) AS n, median(v) AS mid FROM n, generate_series(-2, 5) g(o) JOIN smp s ON s.channel = n.channel AND s.sample = n.sample + o WHERE nth <= 20 GROUP BY ALL""")
def median_waveform(spark, d):
    """Median of at most twenty large samples of each channel, drawn by a hash, at each offset."""
    s = T.samples(spark, d)
    e = R.random_per_group(s.where("v > 45"), ["channel"], 20, "sample", 3).select("channel", F.col("sample").alias("at"))
    found = A.triggered(s, e, 2, 5, on=["channel"])
    return found.groupBy("channel", F.col("offset").cast("long").alias("offset")).agg(F.count("*").alias("n"), F.percentile("v", F.lit(0.5)).alias("mid"))


@query(f"""WITH {C} SELECT m.mask, session, count(*) AS n, round(avg(x), 8) AS rate FROM cond, (VALUES ('correct'), ('incorrect'), ('omission'), ('allInitiated')) m(mask) WHERE CASE m.mask WHEN 'correct' THEN outcome = 'F' AND block <> 5 WHEN 'incorrect' THEN outcome = 'O' AND block <> 5 WHEN 'omission' THEN outcome = 'P' AND block <> 5 ELSE block <> 5 END GROUP BY ALL""")
def condition_masks(spark, d):
    """Rates over the trials of each named condition; aborted trials are in none."""
    c = T.conditions(spark, d).withColumns({"correct": F.col("outcome") == "F", "incorrect": F.col("outcome") == "O", "omission": F.col("outcome") == "P", "aborted": F.col("block") == 5})
    return R.by_condition(c, R.MASKS).groupBy("mask", "session").agg(F.count("*").alias("n"), F.round(F.avg("x"), 8).alias("rate"))


@query("""WITH e AS (SELECT label AS unit, vec_id, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS nth FROM embeddings) SELECT unit, vec_id, round(embedding[1]::DOUBLE, 7) AS first, round(embedding[64]::DOUBLE, 7) AS last FROM e WHERE nth = 3""")
def unit_waveform(spark, d):
    """The third waveform of each unit."""
    e = R.nth_of(T.read(spark, d, "embeddings"), ["label"], ["vec_id"], 3)
    return e.select(F.col("label").alias("unit"), "vec_id", F.round(F.element_at("embedding", 1).cast("double"), 7).alias("first"), F.round(F.element_at("embedding", 64).cast("double"), 7).alias("last"))


@query(f"""WITH RECURSIVE {SM}, n AS (SELECT channel, sample, (channel::BIGINT << 40) + sample AS id FROM smp WHERE v > 45), h AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.channel = b.channel AND b.sample = a.sample + 1 UNION ALL SELECT a.id, b.id FROM n a JOIN n b ON a.sample = b.sample AND b.channel = a.channel + 1),
 e AS (SELECT a, b FROM h UNION ALL SELECT b, a FROM h), r AS (SELECT id AS node, id AS reached FROM n UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reached) SELECT node, min(reached) AS cluster FROM r GROUP BY node""")
def neighbour_clusters(spark, d):
    """Large samples joined over neighbouring samples and channels."""
    n = T.samples(spark, d).where("v > 45").select("channel", "sample")
    name = F.shiftleft(F.col("channel").cast("long"), 40) + F.col("sample")  # room for 2**40 samples a channel
    near = n.select(name.alias("a"), F.explode(F.array(F.struct("channel", (F.col("sample") + 1).alias("sample")), F.struct((F.col("channel") + 1).alias("channel"), "sample"))).alias("x")).select("a", "x.*")
    edges = near.join(n, ["channel", "sample"]).select("a", name.alias("b"))
    return graph.connected(n.select(name.alias("node")), edges)


@query(f"""WITH RECURSIVE {SM}, u AS (SELECT *, lag(v) OVER (PARTITION BY channel ORDER BY sample) AS a, lead(v) OVER (PARTITION BY channel ORDER BY sample) AS b FROM smp), c AS (SELECT channel, sample FROM u WHERE v > a AND v > b AND v > 30),
 k AS (SELECT channel, min(sample) AS sample FROM c GROUP BY channel UNION ALL SELECT c.channel, min(c.sample) FROM k JOIN c ON c.channel = k.channel AND c.sample > k.sample + 6 GROUP BY c.channel) SELECT channel, sample FROM k""")
def spaced_peaks(spark, d):
    """Peaks above a threshold, none within six samples of the last one kept."""
    near = W.over_stretches(T.samples(spark, d), 1, {"l": lambda x: F.lag("v").over(x), "r": lambda x: F.lead("v").over(x)}, tasks=T.tasks(spark, d)).where("v > l AND v > r AND v > 30")
    return R.drop_duplicates_within(near, 6, t="sample", key="sample").select("channel", "sample")


@query()
def resolved_duplicates(spark, d):
    """Spikes of a channel within an hour of each other, of which the larger or the busier unit's stays."""
    s = T.spikes(spark, d).select((F.col("unit") % 10).alias("channel"), "unit", "spike_id", "t", "ampl", (F.col("depth") % 4).alias("template"))
    return R.resolve_duplicates(s, H).select("unit", "spike_id")


@query(f"""WITH {T.EVENTS}, a AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM ev WHERE event_type = 'error'), b AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM ev WHERE event_type = 'signup'),
 p AS (SELECT a.user_id, (a.t - 1704067200000) / {H}.0 AS y, (b.t - 1704067200000) / {H}.0 AS x FROM a JOIN b ON a.user_id = b.user_id AND a.k = b.k) SELECT user_id, count(*) AS n, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS offset_h FROM p GROUP BY user_id HAVING count(*) > 2""")
def clock_fit(spark, d):
    """Linear clock between the n-th pulses of two devices."""
    e = T.events(spark, d).withColumn("h", (F.col("t") - 1704067200000) / float(H))
    x = I.fit_clock(e.where("event_type = 'error'"), e.where("event_type = 'signup'"), t="h", by=["user_id"], key="event_id").where("n > 2")
    return x.select("user_id", "n", F.round("slope", 6).alias("slope"), F.round("offset", 4).alias("offset_h"))
