"""Streams give what the batch gives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from synapark.operators import signal as S
from synapark.streaming import stream as R

SCHEMA = "channel int, sample long, v double, ts timestamp"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """Four files that a stream reads one by one."""
    folder = tmp_path_factory.mktemp("stream")
    x = np.random.default_rng(2).normal(size=(2, 200))
    for k in range(4):
        rows = [(c, i, float(x[c, i])) for c in range(2) for i in range(50 * k, 50 * (k + 1))]
        df = spark.createDataFrame(rows, "channel int, sample long, v double").withColumn("ts", F.timestamp_seconds(F.col("sample")))
        df.coalesce(1).write.mode("append").parquet(str(folder))
    return x, str(folder)


def run(spark, df, tmp_path, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(folder)


def test_online_filter(spark, source, tmp_path):
    x, folder = source
    sos = S.butter(2, 0.2)
    got = run(spark, R.online_filter(stream(spark, folder), sos), tmp_path, "filter_out").orderBy("channel", "sample").toPandas()
    want = [S.run_sections(sos, row, S.steady(sos, row[0]))[0] for row in x]
    assert np.allclose(got["v"].to_numpy(), np.concatenate(want))


def test_blocks(spark, source, tmp_path):
    x, folder = source
    got = run(spark, R.blocks(stream(spark, folder), "10 seconds"), tmp_path, "block_out", "complete").toPandas()
    assert len(got) == 40 and (got["n"] == 10).all()
    batch = R.blocks(spark.read.schema(SCHEMA).parquet(folder), "10 seconds").toPandas()
    key = ["channel", "start"]
    assert np.allclose(got.sort_values(key)["mean"], batch.sort_values(key)["mean"])


def test_overlapping_and_sessions(spark, source, tmp_path):
    _, folder = source
    assert run(spark, R.overlapping(stream(spark, folder), "10 seconds", "5 seconds"), tmp_path, "over_out", "complete").agg(F.sum("n")).first()[0] == 800
    assert run(spark, R.sessions(stream(spark, folder), "3 seconds"), tmp_path, "session_out", "complete").count() == 2


def test_running_average(spark, source, tmp_path):
    x, folder = source
    s = stream(spark, folder).withColumn("offset", F.col("sample") % 5)
    got = {(r["channel"], r["offset"]): r["mean"] for r in run(spark, R.running_average(s), tmp_path, "average_out", "complete").collect()}
    assert all(abs(m - x[c, o::5].mean()) < 1e-9 for (c, o), m in got.items()) and len(got) == 10


def test_standardise_and_threshold(spark, source, tmp_path):
    x, folder = source
    got = run(spark, R.online_standardise(stream(spark, folder)), tmp_path, "standard_out").where("channel = 0 AND sample >= 150").orderBy("sample").toPandas()["v"].to_numpy()
    assert np.allclose(got, (x[0, 150:] - x[0].mean()) / x[0].std(ddof=1))
    assert set(run(spark, R.adaptive_threshold(stream(spark, folder)), tmp_path, "threshold_out").toPandas()["v"]) <= {-1.0, 0.0, 1.0}


def test_decimate(spark, source, tmp_path):
    _, folder = source
    assert run(spark, R.filter_and_decimate(stream(spark, folder), S.butter(2, 0.2), 4), tmp_path, "decimate_out").count() == 100


def test_triggered(spark, source, tmp_path):
    _, folder = source
    triggers = stream(spark, folder).where("channel = 0 AND sample % 50 = 20").select(F.col("sample").alias("trigger"), F.col("ts").alias("at"))
    got = run(spark, R.triggered(stream(spark, folder), triggers, 2, 3), tmp_path, "trigger_out")
    assert got.groupBy("trigger").count().where("count = 10").count() == 4


def test_power_estimate(spark, source, tmp_path):
    """Blocks go on across batches; the largest so far never falls."""
    x, folder = source
    got = run(spark, R.power_estimate(stream(spark, folder), 100.0, 30, (5.0, 20.0)), tmp_path, "power_out").orderBy("channel", "sample").toPandas()
    for c in range(2):
        own = got[got["channel"] == c]
        want = []
        for at in range(0, 180, 30):
            part = x[c, at : at + 30]
            freq, power = S.welch(part - part.mean(), 100.0, 30)
            want.append(power[(freq > 5) & (freq <= 20)].mean())
        assert own["sample"].tolist() == list(range(0, 180, 30)) and np.allclose(own["power"], want) and np.allclose(own["largest"], np.maximum.accumulate(want))


def test_after(spark, source, tmp_path):
    got = run(spark, R.after(stream(spark, source[1]), 150).select("channel", "sample"), tmp_path, "after_out")
    assert got.agg(F.min("sample")).first()[0] == 151 and got.count() == 98
