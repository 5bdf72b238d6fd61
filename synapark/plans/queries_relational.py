"""Projections, filters, sets, sorts, strings and nested values."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators import sets
from ..operators import windows as W
from . import tables as T
from .registry import query

SM, C, EV, S = T.SAMPLES, T.CONDITIONS, T.EVENTS, T.SPIKES


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(greatest(-32768, least(32767, round((l_quantity * 700 - 32768) * 0.195))) AS INT) AS uv FROM lineitem")
def adc_to_uv(spark, d):
    """Converter counts in microvolt, rounded and saturated."""
    x = T.read(spark, d, "lineitem")
    return x.select("l_orderkey", "l_linenumber", "l_partkey", X.adc_to_uv(F.col("l_quantity") * 700, 1.95e-7).cast("int").alias("uv"))


@query(f"WITH {SM} SELECT channel, sample, abs(v - 25) AS rect, greatest(10, least(40, v)) AS clipped, round(sample / 32000.0, 9) AS t FROM smp")
def rectify_and_clip(spark, d):
    """Absolute and clamped samples with their time."""
    s = T.samples(spark, d)
    return s.select("channel", "sample", F.abs(F.col("v") - 25).alias("rect"), X.clip(F.col("v"), 10.0, 40.0).alias("clipped"), F.round(F.col("sample") / 32000.0, 9).alias("t"))


@query(f"WITH {EV} SELECT event_id, event_type, t, value FROM ev WHERE event_type IN ('click', 'error') AND value BETWEEN 10 AND 60 AND depth >= 20")
def event_filter(spark, d):
    """Events by type and ranges of their values."""
    return T.events(spark, d).where(F.col("event_type").isin("click", "error") & F.col("value").between(10, 60) & (F.col("depth") >= 20)).select("event_id", "event_type", "t", "value")


@query(f"WITH {C}, m AS (SELECT session, min(t) AS a, max(t) AS b FROM cond WHERE outcome = 'F' GROUP BY session) SELECT c.session, c.trial FROM cond c JOIN m ON m.session = c.session WHERE c.t BETWEEN a AND b AND block = 1")
def spike_select(spark, d):
    """Rows inside the latency of selected trials."""
    c = T.conditions(spark, d)
    m = c.where("outcome = 'F'").groupBy("session").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return c.where("block = 1").join(m, "session").where("t BETWEEN a AND b").select("session", "trial")


@query(f"WITH {C} SELECT trial, session FROM cond WHERE outcome = 'O' AND block = 2 AND x > 100000 AND isfinite(x)")
def trial_conjunction(spark, d):
    """Trials that meet all conditions."""
    return T.conditions(spark, d).where("outcome = 'O' AND block = 2 AND x > 100000").select("trial", "session")


@query(f"WITH {EV} SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 7 WHEN 'signup' THEN 64 ELSE -1 END AS code FROM ev")
def event_codes(spark, d):
    """Codes of event names from a dictionary."""
    e = T.events(spark, d)
    names = e.sparkSession.createDataFrame([("click", 1), ("view", 2), ("purchase", 7), ("signup", 64)], "event_type string, code int")
    return e.join(F.broadcast(names), "event_type", "left").select("event_id", F.coalesce("code", F.lit(-1)).alias("code"))  # four rows


@query(f"WITH {SM} SELECT channel, sample, CAST((CASE WHEN v > 25 THEN 1 ELSE 0 END) + (CASE WHEN v > 35 THEN 2 ELSE 0 END) + (CASE WHEN CAST(v AS INT) % 2 = 1 THEN 4 ELSE 0 END) AS BIGINT) AS code FROM smp")
def pins_to_code(spark, d):
    """Whole numbers of pin vectors, lowest pin first."""
    pins = [(F.col("v") > 25).cast("int"), (F.col("v") > 35).cast("int"), F.col("v").cast("int") % 2]
    return T.samples(spark, d).select("channel", "sample", X.bits_to_number(pins).alias("code"))


@query(f"WITH {S} SELECT spike_id, round((t - 1704067200000) * 1.00001::DOUBLE + 12.5, 3) AS fixed FROM spike")
def clock_correction(spark, d):
    """Times under a linear clock."""
    return T.spikes(spark, d).select("spike_id", F.round((F.col("t") - 1704067200000) * F.lit(1.00001) + 12.5, 3).alias("fixed"))


@query("SELECT c.c_custkey, n.n_name, s.n AS suppliers FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY ALL) s ON s.s_nationkey = c.c_nationkey")
def channel_lookup(spark, d):
    """Attributes of each row's channel from dimension tables."""
    c, n, s = (T.read(spark, d, x) for x in ("customer", "nation", "supplier"))
    per = s.groupBy("s_nationkey").agg(F.count("*").alias("suppliers"))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(per, c["c_nationkey"] == per["s_nationkey"]).select("c_custkey", "n_name", "suppliers")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def noise_exclude(spark, d):
    """Rows of units that aren't marked as noise."""
    o = T.read(spark, d, "orders")
    bad = T.read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return o.join(bad, "o_custkey", "left_anti").select("o_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def membership(spark, d):
    """Rows whose key is in a set."""
    good = T.read(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return T.read(spark, d, "orders").join(good, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query(f"WITH {S} SELECT DISTINCT unit, depth // 25 AS bank FROM spike")
def unique_rows(spark, d):
    """Distinct pairs."""
    return T.spikes(spark, d).select("unit", F.expr("depth div 25").alias("bank")).distinct()


@query("SELECT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_tax > 0.07")
def set_difference(spark, d):
    """Keys of one set that aren't in another."""
    x = T.read(spark, d, "lineitem")
    return x.where("l_returnflag = 'R'").select(F.col("l_suppkey").alias("k")).subtract(x.where("l_quantity > 49 AND l_tax > 0.07").select("l_suppkey"))


@query("SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'")
def set_intersection(spark, d):
    """Keys of both sets."""
    x = T.read(spark, d, "lineitem")
    return x.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")).intersect(x.where("l_returnflag = 'A'").select("l_partkey"))


@query("SELECT c_nationkey AS k, 'c' AS src FROM customer UNION ALL SELECT s_nationkey, 's' FROM supplier")
def append_sessions(spark, d):
    """All rows of both tables."""
    return sets.append(T.read(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.lit("c").alias("src")), T.read(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("s").alias("src")))


@query("SELECT k, min(nth) AS nth FROM (SELECT c_nationkey AS k, c_custkey AS nth FROM customer UNION ALL SELECT s_nationkey, 1000000 + s_suppkey FROM supplier) GROUP BY k")
def union_first(spark, d):
    """Union of distinct rows with where each first came."""
    a = T.read(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("nth"))
    b = T.read(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), (F.col("s_suppkey") + 1000000).alias("nth"))
    return sets.union_first(a, b, ["k"], "nth")


@query("WITH a AS (SELECT DISTINCT l_partkey AS k, CAST(l_quantity AS INT) AS q FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey AS k, CAST(l_quantity AS INT) AS q FROM lineitem WHERE l_returnflag = 'A') (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)")
def symmetric_difference(spark, d):
    """Pairs of part and quantity of just one of two sets."""
    x = T.read(spark, d, "lineitem").select(F.col("l_partkey").alias("k"), F.col("l_quantity").cast("int").alias("q"), "l_returnflag")
    return sets.symmetric_difference(x.where("l_returnflag = 'R'").select("k", "q"), x.where("l_returnflag = 'A'").select("k", "q"), ["k", "q"])


@query("SELECT coalesce(c.k, s.k) AS k, c.n AS customers, s.n AS suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY ALL) c FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY ALL) s ON c.k = s.k")
def merge_tables(spark, d):
    """Two tables merged by key, with gaps where one has none."""
    c = T.read(spark, d, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    s = T.read(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return c.join(s, "k", "full").select("k", "customers", "suppliers")


@query(f"WITH {S} SELECT unit, t, spike_id FROM spike ORDER BY t, spike_id LIMIT 100")
def first_spikes(spark, d):
    """The first hundred spikes in time."""
    return T.spikes(spark, d).select("unit", "t", "spike_id").orderBy("t", "spike_id").limit(100)


@query(f"WITH {S}, r AS (SELECT unit, spike_id, ampl, row_number() OVER (PARTITION BY unit ORDER BY ampl DESC, spike_id) AS nth FROM spike) SELECT unit, spike_id, ampl, nth FROM r WHERE nth <= 3")
def top_per_unit(spark, d):
    """The three largest spikes of each unit."""
    w = Window.partitionBy("unit").orderBy(F.desc("ampl"), "spike_id")
    return T.spikes(spark, d).withColumn("nth", F.row_number().over(w)).where("nth <= 3").select("unit", "spike_id", "ampl", F.col("nth").cast("long").alias("nth"))


@query(f"WITH {S}, r AS (SELECT unit, ampl, row_number() OVER (PARTITION BY unit ORDER BY ampl, spike_id) AS nth FROM spike) SELECT unit, ampl FROM r WHERE nth = 5")
def order_statistic(spark, d):
    """The fifth smallest amplitude of each unit."""
    w = W.ordered(["unit"], ["ampl", "spike_id"])
    return T.spikes(spark, d).withColumn("nth", F.row_number().over(w)).where("nth = 5").select("unit", "ampl")


@query(f"WITH {S}, b AS (SELECT unit, t // 86400000 AS bin, count(*) AS n FROM spike GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY n DESC, bin) AS k FROM b) SELECT unit, bin, n FROM r WHERE k = 1")
def peak_bin_order(spark, d):
    """Day of most spikes of each unit, the first of equals."""
    b = T.spikes(spark, d).groupBy("unit", F.expr("t div 86400000").alias("bin")).agg(F.count("*").alias("n"))
    return b.groupBy("unit").agg(F.max(F.struct("n", (-F.col("bin")).alias("neg"))).alias("x")).select("unit", (-F.col("x.neg")).alias("bin"), "x.n")


@query("SELECT p_partkey, regexp_extract(p_brand, '^(\\w+)#([0-9]+)$', 1) AS name, CAST(regexp_extract(p_brand, '^(\\w+)#([0-9]+)$', 2) AS INT) AS code, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS label, len(string_split(p_name, ' ')) AS words, contains(p_name, 'ring') AS ring FROM part")
def string_functions(spark, d):
    """Names taken apart, padded labels, words, substrings."""
    p = T.read(spark, d, "part")
    pattern = r"^(\w+)#([0-9]+)$"
    return p.select(
        "p_partkey", F.regexp_extract("p_brand", pattern, 1).alias("name"), F.regexp_extract("p_brand", pattern, 2).cast("int").alias("code"), F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("label"),
        F.size(F.split("p_name", " ")).cast("long").alias("words"), F.contains("p_name", F.lit("ring")).alias("ring"),
    )


@query("SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, md5(props) AS digest FROM events")
def json_and_hash(spark, d):
    """A field of a JSON text, and the text's digest."""
    return T.read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.md5("props").alias("digest"))


@query(f"WITH {S}, l AS (SELECT unit, count(*) AS n FROM spike GROUP BY unit) SELECT unit, n, CAST(sum(n) OVER (ORDER BY unit) AS BIGINT) AS bound FROM l")
def ragged_index(spark, d):
    """Cumulative bounds of ragged rows, as nested tables keep them."""
    from ..operators import nested

    return nested.ragged_index(T.spikes(spark, d), "unit")


@query(f"WITH {S} SELECT unit, spike_id, t, row_number() OVER (PARTITION BY unit ORDER BY t, spike_id) - 1 AS pos FROM spike")
def ragged_rows(spark, d):
    """Ragged rows gathered by unit and taken apart again."""
    from ..operators import nested

    packed = nested.pack(T.spikes(spark, d), "unit", ["t", "spike_id"])
    return nested.unpack(packed, "unit").select("unit", "spike_id", "t", F.col("pos").cast("long").alias("pos"))


@query("WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS pos FROM embeddings) SELECT vec_id, CAST(label * 64 + pos AS BIGINT) AS col, round(v, 8) AS v FROM e")
def sparse_matrix(spark, d):
    """Rows, columns and values of a sparse matrix."""
    e = T.read(spark, d, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("pos", "v"))
    return e.select("vec_id", (F.col("label").cast("long") * 64 + F.col("pos")).alias("col"), F.round(F.col("v").cast("double"), 8).alias("v"))


@query("WITH m AS (SELECT label, i, avg(v) AS m FROM (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS i FROM embeddings) GROUP BY ALL) SELECT CAST(a.label AS INT) AS a, CAST(b.label AS INT) AS b, round(sqrt(sum((a.m - b.m) * (a.m - b.m))), 8) AS far FROM m a JOIN m b ON a.i = b.i AND a.label < b.label GROUP BY ALL")
def trajectory_distance(spark, d):
    """Distances of cluster means."""
    e = T.read(spark, d, "embeddings").select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v"))
    m = e.groupBy("label", "i").agg(F.avg("v").alias("m"))
    a, b = m.select(F.col("label").alias("a"), "i", F.col("m").alias("x")), m.select(F.col("label").alias("b"), "i", F.col("m").alias("y"))
    return a.join(b, "i").where("a < b").groupBy("a", "b").agg(F.round(F.sqrt(F.sum(F.expr("(x - y) * (x - y)"))), 8).alias("far"))


@query(f"WITH {EV}, f AS (SELECT user_id AS session, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS nle, max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS df1 FROM ev WHERE depth > 95 GROUP BY user_id) SELECT session, CASE WHEN nle = 1 THEN 'DT2' WHEN df1 = 1 THEN 'DF1' ELSE 'none' END AS format, CASE WHEN nle = 1 THEN 0.2::DOUBLE WHEN df1 = 1 THEN 0.195::DOUBLE END AS uv FROM f")
def format_sniffing(spark, d):
    """A session's format from its marker files, with the format's constants."""
    f = T.events(spark, d).where("depth > 95").groupBy(F.col("user_id").alias("session")).agg(F.bool_or(F.col("event_type") == "error").alias("nle"), F.bool_or(F.col("event_type") == "signup").alias("df1"))
    kind = X.first_match([(F.col("nle"), "DT2"), (F.col("df1"), "DF1")], "none")
    return f.select("session", kind.alias("format")).withColumn("uv", F.when(F.col("format") == "DT2", 0.2).when(F.col("format") == "DF1", 0.195))


@query("WITH i AS (SELECT l_suppkey AS g, l_orderkey // 50 AS i FROM lineitem GROUP BY ALL), k AS (SELECT g, i, i - row_number() OVER (PARTITION BY g ORDER BY i) AS k FROM i) SELECT g, min(i) AS start, count(*) AS length FROM k GROUP BY g, k")
def selection_slabs(spark, d):
    """Index lists as the fewest stretches."""
    i = T.read(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), F.expr("l_orderkey div 50").alias("i"))
    i = W.dealt(i, T.tasks(spark, d), "g").distinct()
    k = i.withColumn("k", F.col("i") - F.row_number().over(W.ordered(["g"], ["i"])))
    return k.groupBy("g", "k").agg(F.min("i").alias("start"), F.count("*").alias("length")).drop("k")
