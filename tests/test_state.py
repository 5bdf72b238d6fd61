"""Keyed state and offsets of their own: a query that starts again goes on where it was."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from synapark.operators import signal as S
from synapark.streaming import state as K


@pytest.fixture()
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    K.use_rocksdb(spark)
    K.register(spark)
    yield spark
    spark.conf.set(key, before)


def append(path, x):
    with open(path, "ab") as f:
        f.write(x.astype("<i2").tobytes())


def run(df, tmp_path):
    q = df.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    return q


def growing(spark, path, **options):
    reader = spark.readStream.format("growing").option("path", str(path)).option("channels", 2)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load()


@pytest.fixture(scope="module")
def recorded():
    return np.random.default_rng(5).integers(-500, 500, (600, 2))


def stages(spark, tmp_path, x, build, cuts=(0, 250, 251, 600), **options):
    """Writes the recording piece by piece, a new query from the same checkpoint after each."""
    path = tmp_path / "data.bin"
    for i, j in zip(cuts, cuts[1:], strict=False):
        append(path, x[i:j])
        if j == 251:
            with open(path, "ab") as f:  # half a frame that the next piece completes
                f.write(x[251:252].astype("<i2").tobytes()[:3])
            run(build(growing(spark, path, **options)), tmp_path)
            with open(path, "rb+") as f:
                f.truncate(251 * 4)
        else:
            run(build(growing(spark, path, **options)), tmp_path)
    return spark.read.parquet(str(tmp_path / "out")).orderBy("channel", "sample").toPandas()


def test_growing_source(rocks, tmp_path, recorded):
    """No sample twice, none lost, from ``minsample`` on, however often the query starts again."""
    got = stages(rocks, tmp_path, recorded, lambda s: s, rangesamples=64, minsample=40)
    assert got["sample"].tolist() == [*range(40, 600)] * 2
    assert np.array_equal(got["v"].to_numpy(), np.r_[recorded[40:, 0], recorded[40:, 1]])


def test_filter_goes_on(rocks, tmp_path, recorded):
    sos = S.butter(3, 0.3)
    got = stages(rocks, tmp_path, recorded, lambda s: K.online_filter(s, sos), rangesamples=100)
    want = [S.run_sections(sos, c, S.steady(sos, c[0]))[0] for c in recorded.T.astype(float)]
    assert np.allclose(got["v"], np.concatenate(want), atol=1e-9)


def test_threshold_goes_on(rocks, tmp_path, recorded):
    got = stages(rocks, tmp_path, recorded, lambda s: K.adaptive_threshold(s, 30, 0.5, ttl=3_600_000))
    want = []
    for c in recorded.T.astype(float):
        for k in range(600):
            last = c[max(0, k - 29) : k + 1]
            want.append((c[k] > last.mean() + 0.5 * last.std()) * 1.0 - (c[k] < last.mean() - 0.5 * last.std()))
    assert np.array_equal(got["v"].to_numpy(), np.array(want))


def test_standardise_goes_on(rocks, tmp_path, recorded):
    got = stages(rocks, tmp_path, recorded + 10_000, lambda s: K.online_standardise(s), cuts=(0, 250, 600))
    want = []
    for c in (recorded + 10_000).T.astype(float):
        for i, j in ((0, 250), (250, 600)):
            want += ((c[i:j] - c[:j].mean()) / c[:j].std(ddof=1)).tolist()
    assert np.allclose(got["v"], want, atol=1e-9)


def test_batches_are_bounded(rocks, tmp_path, recorded):
    append(tmp_path / "data.bin", recorded)
    stream = growing(rocks, tmp_path / "data.bin", maxsamples=200)
    seen = []
    for _ in range(5):
        q = stream.writeStream.foreachBatch(lambda df, _: seen.append((df.agg(F.count("*")).first()[0]))).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        assert q.awaitTermination(180)
    assert sum(seen) == 1200 and max(seen) <= 400
