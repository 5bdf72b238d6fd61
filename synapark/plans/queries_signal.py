"""Queries that run numpy inside tasks; the tests hold them against direct computation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fir, models
from ..operators import signal as S
from . import tables as T
from .registry import query


@query()
def signal_bandpass(spark, d):
    """Zero-phase band-pass of every channel."""
    out = S.filtered(T.samples(spark, d), 1000.0, (20.0, 100.0), "band", order=3, halo_s=0.25)
    return out.select("channel", "sample", F.round("v", 6).alias("v"))


NEAR = "n AS (SELECT channel, max(sample) AS n FROM smp GROUP BY channel)"
JOINED = "smp s JOIN n USING (channel) CROSS JOIN k JOIN smp b ON b.channel = s.channel AND b.sample = greatest(1, least(n.n, s.sample + o))"


@query(f"""WITH {T.SAMPLES}, {NEAR}, r AS (SELECT o, (CASE WHEN o = 0 THEN 0.2 ELSE sin(0.2 * pi() * o) / (pi() * o) END) * (0.54 + 0.46 * cos(0.2 * pi() * o)) AS w FROM generate_series(-5, 5) g(o)), k AS (SELECT o, w / sum(w) OVER () AS kw FROM r)
 SELECT s.channel, s.sample, round(sum(b.v * kw), 7) AS v FROM {JOINED} GROUP BY s.channel, s.sample""")
def fir_lowpass(spark, d):
    """Every channel below a tenth of its rate, by a windowed sinc of 11 taps."""
    taps = fir.sinc_kernel(1000.0, 100.0, "low", 10)
    return fir.filtered(T.samples(spark, d), taps).select("channel", "sample", F.round("v", 7).alias("v"))


@query(f"""WITH {T.SAMPLES}, {NEAR}, r AS (SELECT o, (CASE WHEN o = 0 THEN 0.2 ELSE sin(0.2 * pi() * o) / (pi() * o) END) * (0.42 + 0.5 * cos(0.2 * pi() * o) + 0.08 * cos(0.4 * pi() * o)) AS a, (CASE WHEN o = 0 THEN 0.5 ELSE sin(0.5 * pi() * o) / (pi() * o) END) * (0.42 + 0.5 * cos(0.2 * pi() * o) + 0.08 * cos(0.4 * pi() * o)) AS c FROM generate_series(-5, 5) g(o)),
 k AS (SELECT o, c / sum(c) OVER () - a / sum(a) OVER () AS kw FROM r)
 SELECT s.channel, s.sample, round(sum(b.v * kw), 7) AS v FROM {JOINED} GROUP BY s.channel, s.sample""")
def fir_bandpass(spark, d):
    """Every channel between a tenth and a quarter of its rate."""
    taps = fir.sinc_kernel(1000.0, (100.0, 250.0), "band", 10, window="blackman")
    return fir.filtered(T.samples(spark, d), taps).select("channel", "sample", F.round("v", 7).alias("v"))


@query(f"""WITH {T.SAMPLES}, {NEAR}, k AS (SELECT o, CASE WHEN o % 2 = 0 THEN 0.0 ELSE 2.0 / (pi() * o) * (0.54 + 0.46 * cos(pi() * o / 15)) END AS kw FROM generate_series(-15, 15) g(o)),
 h AS (SELECT s.channel, s.sample, any_value(s.v) AS x, sum(b.v * -kw) AS y FROM {JOINED} GROUP BY s.channel, s.sample)
 SELECT channel, sample, round(sqrt(x * x + y * y), 7) AS v FROM h""")
def fir_envelope(spark, d):
    """Envelope of every channel, its quarter turn by a filter of 31 taps."""
    return fir.hilbert(T.samples(spark, d), "abs", half=15).select("channel", "sample", F.round("v", 7).alias("v"))


@query()
def signal_envelope(spark, d):
    """Envelope of the analytic signal of every channel, a trial each."""
    return S.hilbert(T.samples(spark, d), "abs").select("channel", "sample", F.round("v", 6).alias("v"))


@query(f"WITH {T.SAMPLES}, k AS (SELECT o, exp(-0.5 * pow(o / 5.0::DOUBLE, 2)) AS kw FROM generate_series(-15, 15) g(o)), z AS (SELECT sum(kw) AS z FROM k) SELECT s.channel, s.sample, round(sum(b.v * kw) / any_value(z), 6) AS v FROM smp s CROSS JOIN k CROSS JOIN z JOIN smp b ON b.channel = s.channel AND b.sample = s.sample + o GROUP BY s.channel, s.sample")
def signal_gaussian_rate(spark, d):
    """Samples under a normal kernel."""
    return S.gaussian_rate(T.samples(spark, d), 5.0).select("channel", "sample", F.round("v", 6).alias("v"))


@query()
def multitaper_spectrum(spark, d):
    """Multitaper power of stretches of 128 samples."""
    s = T.samples(spark, d).withColumn("trial", F.expr("(sample - 1) div 128"))
    return S.spectrum(s, 1000.0, 3).select("trial", "channel", F.round("freq", 6).alias("freq"), F.round("power", 6).alias("power"))


@query()
def wavelet_power(spark, d):
    """Power over time at three frequencies in stretches of 256 samples."""
    s = T.samples(spark, d).withColumn("trial", F.expr("(sample - 1) div 256"))
    return S.wavelet_power(s, 1000.0, [30.0, 60.0, 120.0]).select("trial", "channel", "freq", "sample", F.round("power", 6).alias("power"))


@query()
def t_pvalues(spark, d):
    """Two-sided p of each channel's correlation."""
    from ..operators import stats

    out = T.samples(spark, d).groupBy("channel").agg(*stats.correlation_t("v", "w"))
    return out.select("channel", F.round(S.t_pvalue("t", "df"), 9).alias("p"))


@query()
def cluster_isolation(spark, d):
    """Isolation distance and L-ratio of waveform clusters in their first four principal components."""
    e = T.read(spark, d, "embeddings").select(F.col("label").alias("unit"), F.col("vec_id").alias("spike_id"), F.col("embedding").cast("array<double>").alias("x"))
    e = models.components(e, k=4).select("unit", "spike_id", F.col("pc").alias("x"))
    return S.isolation(e).select("unit", F.round("isolation", 6).alias("isolation"), F.round("l_ratio", 6).alias("l_ratio"))
