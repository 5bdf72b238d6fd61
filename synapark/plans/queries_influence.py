"""Directed influence, spatial filters and permutation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import directed as D
from ..operators import models as M
from ..operators import permutation as P
from ..operators import trials as R
from ..operators import units as U
from ..operators import windows as W
from . import tables as T
from .registry import query

FREQS = (0.0, 50.0, 125.0, 250.0, 400.0)
BY = ["supplier"]

# quantity and price of a supplier's items as two channels, in trials of 128 samples; a model of order 1
PAIR = """d AS (SELECT channel AS supplier, (sample - 1) // 128 AS trial, sample, v - avg(v) OVER (PARTITION BY channel) AS x, w / 1000 - avg(w / 1000) OVER (PARTITION BY channel) AS y FROM smp),
 l AS (SELECT *, lag(x) OVER (PARTITION BY supplier, trial ORDER BY sample) AS x1, lag(y) OVER (PARTITION BY supplier, trial ORDER BY sample) AS y1 FROM d),
 s AS (SELECT supplier, count(*) AS n, sum(x1 * x1) AS p, sum(x1 * y1) AS q, sum(y1 * y1) AS r, sum(x * x1) AS xx, sum(x * y1) AS xy, sum(y * x1) AS yx, sum(y * y1) AS yy, sum(x * x) AS sx, sum(y * y) AS sy FROM l WHERE x1 IS NOT NULL GROUP BY supplier),
 m AS (SELECT *, (xx * r - xy * q) / (p * r - q * q) AS a, (xy * p - xx * q) / (p * r - q * q) AS b, (yx * r - yy * q) / (p * r - q * q) AS c, (yy * p - yx * q) / (p * r - q * q) AS e FROM s)"""
# squared sizes of 1 - a z, b, c, 1 - e z with z = exp(-i turn)
TURNS = "t AS (SELECT supplier, f AS freq, 1 - 2 * a * cos(f * pi() / 500) + a * a AS aa, b * b AS bb, c * c AS cc, 1 - 2 * e * cos(f * pi() / 500) + e * e AS ee FROM m, unnest([0.0, 50.0, 125.0, 250.0, 400.0]) u(f))"


def pair(spark, d):
    both = T.samples(spark, d).select(F.col("channel").alias("supplier"), "sample", F.expr("(sample - 1) div 128").alias("trial"), "v", (F.col("w") / 1000).alias("w"))
    both = W.dealt(both, T.tasks(spark, d), "supplier", "trial")
    means = both.groupBy("supplier").agg(F.avg("v").alias("mv"), F.avg("w").alias("mw"))
    return both.join(means, "supplier").select("supplier", "trial", "sample", F.array(F.col("v") - F.col("mv"), F.col("w") - F.col("mw")).alias("x"))


def models(spark, d):
    return D.fit(pair(spark, d), 1, BY, ["supplier", "trial"])


def shown(out):
    return out.select("supplier", F.round("freq", 3).alias("freq"), F.col("to").alias("sink"), F.col("from").alias("source"), F.round("value", 7).alias("value"))


@query(f"""WITH {T.SAMPLES}, {PAIR}, {TURNS}, o AS (SELECT supplier, freq, unnest([{{'i': 0, 'j': 0, 's': ee / (ee + bb)}}, {{'i': 0, 'j': 1, 's': bb / (ee + bb)}}, {{'i': 1, 'j': 0, 's': cc / (cc + aa)}}, {{'i': 1, 'j': 1, 's': aa / (cc + aa)}}]) AS o FROM t)
 SELECT supplier, CAST(freq AS DOUBLE) AS freq, o.i AS sink, o.j AS source, round(sqrt(o.s), 7) AS value FROM o""")
def directed_transfer(spark, d):
    """Share of what reaches either channel, by frequency, under a fitted model."""
    return shown(D.directed_transfer(D.transfer(models(spark, d), BY, FREQS, 1000.0), BY))


@query(f"""WITH {T.SAMPLES}, {PAIR}, {TURNS}, o AS (SELECT supplier, freq, unnest([{{'i': 0, 'j': 0, 's': aa / (aa + cc)}}, {{'i': 0, 'j': 1, 's': bb / (bb + ee)}}, {{'i': 1, 'j': 0, 's': cc / (aa + cc)}}, {{'i': 1, 'j': 1, 's': ee / (bb + ee)}}]) AS o FROM t)
 SELECT supplier, CAST(freq AS DOUBLE) AS freq, o.i AS sink, o.j AS source, round(sqrt(o.s), 7) AS value FROM o""")
def partial_directed(spark, d):
    """Share of what either channel sends, by frequency."""
    return shown(D.partial_directed(D.transfer(models(spark, d), BY, FREQS, 1000.0), BY))


@query(f"""WITH {T.SAMPLES}, {PAIR} SELECT supplier, 1 AS source, 0 AS sink, round(ln((sx - xx * xx / p) / (sx - a * xx - b * xy)), 9) AS value FROM m
 UNION ALL SELECT supplier, 0, 1, round(ln((sy - yy * yy / r) / (sy - c * yx - e * yy)), 9) FROM m""")
def granger(spark, d):
    """What either channel's past adds to the other's own."""
    out = D.granger(models(spark, d), BY, 1)
    return out.select("supplier", F.col("from").alias("source"), F.col("to").alias("sink"), F.round("value", 9).alias("value"))


@query()
def granger_spectrum(spark, d):
    """The same by frequency."""
    return shown(D.spectral_granger(models(spark, d), BY, 1, FREQS, 1000.0))


@query(f"""WITH {T.SAMPLES}, {PAIR}, v AS (SELECT supplier, trial % 2 = 0 AS one, avg(x * x) AS p, avg(x * y) AS q, avg(y * y) AS r FROM d GROUP BY ALL),
 c AS (SELECT a.supplier, a.p AS p1, a.q AS q1, a.r AS r1, a.p + b.p AS p, a.q + b.q AS q, a.r + b.r AS r FROM v a JOIN v b ON b.supplier = a.supplier AND a.one AND NOT b.one),
 k AS (SELECT *, p * r - q * q AS k2, p1 * r + p * r1 - 2 * q * q1 AS k1, p1 * r1 - q1 * q1 AS k0 FROM c)
 SELECT supplier, 0 AS filter, round((k1 + sqrt(k1 * k1 - 4 * k2 * k0)) / (2 * k2), 9) AS share, 1.0::DOUBLE AS whole FROM k UNION ALL SELECT supplier, 1, round((k1 - sqrt(k1 * k1 - 4 * k2 * k0)) / (2 * k2), 9), 1.0::DOUBLE FROM k""")
def spatial_patterns(spark, d):
    """The share of variance in even trials of the two spatial filters, taken from their outputs."""
    rows = pair(spark, d).withColumn("one", F.expr("trial % 2 = 0"))
    found = D.apply_patterns(rows, D.spatial_patterns(rows, BY, "one", 2), BY)
    v = found.groupBy("supplier", "filter").agg(F.avg(F.when(F.col("one"), F.col("y") ** 2)).alias("a"), F.avg(F.when(~F.col("one"), F.col("y") ** 2)).alias("b"))
    both = F.col("a") + F.col("b")
    return v.where("b IS NOT NULL").select("supplier", "filter", F.round(F.col("a") / both, 9).alias("share"), F.round(both, 7).alias("whole"))


# days as observations of every unit's amplitude; even days have the label
DRAWS = 40
DAYS = f"""val AS (SELECT t // 86400000 AS obs, unit, avg(ampl) AS x FROM spike GROUP BY ALL), lab AS (SELECT DISTINCT obs, obs % 2 = 0 AS label FROM val), nn AS (SELECT count(*) FILTER (label) AS n1 FROM lab),
 rk AS (SELECT obs, k, label, row_number() OVER (PARTITION BY k ORDER BY md5(obs || '/' || k), obs) AS r FROM lab, generate_series(0, {DRAWS}) g(k)), dr AS (SELECT obs, k, CASE WHEN k = 0 THEN label ELSE r <= n1 END AS bit FROM rk, nn)"""


def t_sql(feature: str, value: str) -> str:
    return f"""tt AS (SELECT {feature}, k, count(*) FILTER (bit) AS n1, count(*) FILTER (NOT bit) AS n2, avg(x) FILTER (bit) AS m1, avg(x) FILTER (NOT bit) AS m2, var_pop(x) FILTER (bit) AS v1, var_pop(x) FILTER (NOT bit) AS v2 FROM {value} JOIN dr USING (obs) GROUP BY ALL),
 ts AS (SELECT {feature}, k, round((m1 - m2) / sqrt((n1 * v1 + n2 * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)), 9) AS t FROM tt WHERE n1 > 0 AND n2 > 0 AND n1 + n2 > 2 AND n1 * v1 + n2 * v2 > 1e-9)"""


def days(spark, d):
    values = T.spikes(spark, d).groupBy(F.expr("t div 86400000").alias("obs"), "unit").agg(F.avg("ampl").alias("x"))
    return values, values.select("obs", F.expr("obs % 2 = 0").alias("label")).distinct()


UNITS = f"{DAYS}, {t_sql('unit', 'val')}, o AS (SELECT unit, t FROM ts WHERE k = 0)"


@query(f"""WITH {T.SPIKES}, {UNITS} SELECT o.unit, o.t, round(avg(CASE WHEN s.t >= o.t THEN 1.0 ELSE 0.0 END), 9) AS p_high, round(avg(CASE WHEN s.t <= o.t THEN 1.0 ELSE 0.0 END), 9) AS p_low FROM o JOIN ts s ON s.unit = o.unit AND s.k > 0 GROUP BY o.unit, o.t""")
def randomisation_p(spark, d):
    """Units whose amplitude differs between even and odd days: the share of relabelled days at or beyond."""
    values, labels = days(spark, d)
    out = P.permutation_p(P.permuted_t(values, labels, DRAWS, ["unit"]), ["unit"])
    return out.select("unit", "t", F.round("p_high", 9).alias("p_high"), F.round("p_low", 9).alias("p_low"))


@query(f"""WITH {T.SPIKES}, {UNITS}, e AS (SELECT k, max(t) AS hi, min(t) AS lo FROM ts WHERE k > 0 GROUP BY k)
 SELECT unit, round(least(avg(CASE WHEN hi >= t THEN 1.0 ELSE 0.0 END), avg(CASE WHEN lo <= t THEN 1.0 ELSE 0.0 END)), 9) AS p FROM o, e WHERE unit IN (SELECT unit FROM ts WHERE k > 0) GROUP BY unit""")
def randomisation_corrected(spark, d):
    """Two-sided share of relabellings whose outermost unit lies at or beyond each unit's own t."""
    values, labels = days(spark, d)
    out = P.permutation_p(P.permuted_t(values, labels, DRAWS, ["unit"]), ["unit"])
    return out.select("unit", F.round(F.least("p_max", "p_min"), 9).alias("p"))


# a grid of line numbers by months: neighbours are one line number or one month apart
GRID = f"""val AS (SELECT l_orderkey % 97 AS obs, l_linenumber * 100 + month(l_shipdate) AS feature, avg(l_extendedprice) AS x FROM lineitem GROUP BY ALL), lab AS (SELECT DISTINCT obs, obs % 2 = 0 AS label FROM val), nn AS (SELECT count(*) FILTER (label) AS n1 FROM lab),
 rk AS (SELECT obs, k, label, row_number() OVER (PARTITION BY k ORDER BY md5(obs || '/' || k), obs) AS r FROM lab, generate_series(0, {DRAWS}) g(k)), dr AS (SELECT obs, k, CASE WHEN k = 0 THEN label ELSE r <= n1 END AS bit FROM rk, nn)"""


@query(f"""WITH RECURSIVE {GRID}, {t_sql("feature", "val")}, o AS (SELECT k, CAST(sign(t) AS INT) AS sg, feature, t FROM ts WHERE abs(t) > 1.5),
 w AS (SELECT k, sg, feature, feature AS cluster FROM o UNION SELECT o.k, o.sg, o.feature, w.cluster FROM w JOIN o ON o.k = w.k AND o.sg = w.sg AND abs(o.feature - w.feature) IN (1, 100)),
 c AS (SELECT k, sg, feature, min(cluster) AS cluster FROM w GROUP BY ALL), m AS (SELECT k, sg, cluster, count(*) AS size, round(sum(t), 6) AS mass FROM c JOIN o USING (k, sg, feature) GROUP BY ALL),
 b AS (SELECT k, sg, max(abs(mass)) AS most FROM m WHERE k > 0 GROUP BY ALL)
 SELECT CAST(m.cluster AS INT) AS cluster, m.sg AS sign, m.size, round(m.mass, 6) AS mass, round(count(b.k) / {DRAWS}.0, 9) AS p FROM m LEFT JOIN b ON b.sg = m.sg AND b.most >= abs(m.mass) WHERE m.k = 0 GROUP BY ALL""")
def cluster_permutation(spark, d):
    """Sets of neighbouring line numbers and months whose prices differ between two halves of the orders, by their mass among relabelled ones."""
    feature = (F.col("l_linenumber") * 100 + F.month("l_shipdate")).cast("int")
    values = T.read(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 97).alias("obs"), feature.alias("feature")).agg(F.avg("l_extendedprice").alias("x"))
    labels = values.select("obs", F.expr("obs % 2 = 0").alias("label")).distinct()
    near = values.select(F.col("feature").alias("a")).distinct().select("a", F.explode(F.array(F.col("a") + 1, F.col("a") + 100)).alias("b"))
    return P.cluster_test(P.permuted_t(values, labels, DRAWS, ["feature"]), 1.5, near, DRAWS).withColumn("p", F.round("p", 9))


@query("""WITH p AS (SELECT vec_id AS id, label AS cluster, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS d FROM embeddings), s AS (SELECT cluster, d, sum(x) AS s FROM p GROUP BY ALL), q AS (SELECT id, any_value(cluster) AS cluster, sum(x * x) AS q FROM p GROUP BY id), z AS (SELECT cluster, count(*) AS n, sum(q) AS q FROM q GROUP BY cluster),
 t AS (SELECT p.id, p.cluster, s.cluster AS c, sum(p.x * s.s) AS dot FROM p JOIN s ON s.d = p.d GROUP BY ALL), m AS (SELECT t.id, t.cluster, t.c, z.n, greatest(0, (z.n * q.q - 2 * dot + z.q) / nullif(CASE WHEN t.c = t.cluster THEN z.n - 1 ELSE z.n END, 0)) AS m FROM t JOIN z ON z.cluster = t.c JOIN q ON q.id = t.id),
 a AS (SELECT id, cluster, max(CASE WHEN c = cluster THEN m END) AS a, min(CASE WHEN c <> cluster THEN m END) AS b FROM m GROUP BY ALL) SELECT cluster, count(*) AS n, round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 7) AS s FROM a GROUP BY cluster""")
def silhouette(spark, d):
    """How well labels part the vectors: the mean silhouette of each."""
    e = T.read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"), F.col("embedding").alias("x"))
    return M.silhouette(e).groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("s"), 7).alias("s"))


@query()
def ward_clusters(spark, d):
    """Ward clusters of the labels' mean vectors, where labels up to three apart are neighbours."""
    e = T.read(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("k", "v")).groupBy("label", "k").agg(F.avg("v").alias("v"))
    means = e.groupBy(F.col("label").cast("long").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("x"))
    ids = means.select(F.col("id").alias("a"))
    near = ids.select("a", F.explode(F.array(*[F.col("a") + k for k in (1, 2, 3)])).alias("b")).join(ids.select(F.col("a").alias("b")), "b", "left_semi")
    return M.ward(means, near, 4)


@query()
def separable_field(spark, d):
    """The profiles along depth and amplitude that make up most of each group's map."""
    m = T.spikes(spark, d).groupBy((F.col("unit") % 10).alias("unit"), F.expr("depth div 20").alias("x"), F.floor(F.col("ampl") / 40).alias("y")).agg(F.count("*").alias("v"))
    u, w = U.separable(m)
    both = u.select("unit", F.lit("x").alias("side"), F.col("x").alias("at"), F.col("u").alias("value")).unionByName(w.select("unit", F.lit("y").alias("side"), F.col("y").alias("at"), F.col("w").alias("value")))
    return both.withColumn("value", F.round("value", 7))


@query()
def phase_linearity(spark, d):
    """Steadiness of the phase between a supplier's two channels, trial by trial."""
    out = D.phase_linearity(pair(spark, d), ["supplier", "trial"], 1000.0, 20.0)
    return out.select("supplier", "trial", F.round("value", 7).alias("value"))


@query(f"""WITH {T.EVENTS}, o AS (SELECT user_id, event_type, t, value, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS r FROM ev WHERE event_type IN ('view', 'purchase')),
 n AS (SELECT *, lead(event_type) OVER (PARTITION BY user_id ORDER BY r) AS next, lead(t) OVER (PARTITION BY user_id ORDER BY r) AS stop FROM o), k AS (SELECT * FROM n WHERE event_type = 'view' AND next = 'purchase' AND stop - t <= {48 * T.HOUR})
 SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, r) AS nth, t AS start, stop AS "end", value FROM k""")
def table_function_trials(spark, d):
    """Trials from a view to the purchase behind it, by a table function over each user's events in order."""
    R.register_trial_functions(spark)
    T.events(spark, d).createOrReplaceTempView("trial_events")
    return spark.sql(f"""SELECT user_id, nth, start, end, value FROM trials_from(TABLE(SELECT user_id, event_id, event_type, t, value FROM trial_events) PARTITION BY user_id ORDER BY (t, event_id), 'view', 'purchase', longest => {48.0 * T.HOUR}D, subject => 'user_id', copy => 'value')""")
