"""Byte files written here and read back."""

import json
import struct
import zlib

import numpy as np
import pytest

from synapark.sources import binary as B
from synapark.sources import text as T


@pytest.fixture(scope="module")
def sources(spark):
    B.register(spark)
    return spark


def load(spark, name, **options):
    reader = spark.read.format(name)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def test_flat_interleaved(sources, tmp_path):
    data = np.arange(1, 601, dtype="<i2").reshape(200, 3)
    (tmp_path / "a.bin").write_bytes(data[:120].tobytes())
    (tmp_path / "b.bin").write_bytes(data[120:].tobytes() + bytes(60))
    df = load(sources, "flat", path=tmp_path, channels=3, rangebytes=100, stripzeros="true")
    got = np.zeros((200, 3), int)
    for r in df.collect():
        got[r["sample"], r["channel"]] = r["adc"]
    assert (got == data).all() and df.count() == 600 and df.rdd.getNumPartitions() > 5


def test_flat_by_channel(sources, tmp_path):
    for c in range(3):
        (tmp_path / f"amp-{c}.dat").write_bytes(np.full(50, c - 1, "<i2").tobytes())
    rows = load(sources, "flat", path=tmp_path, layout="channel", rangebytes=40).collect()
    assert len(rows) == 150 and all(r["adc"] == r["channel"] - 1 for r in rows) and {r["sample"] for r in rows} == set(range(50))


def test_flat_round_trip(sources, tmp_path):
    df = sources.createDataFrame([(s, c, 10 * s + c) for s in range(100) for c in range(4)], "sample long, channel int, v int")
    B.write_flat(df, str(tmp_path / "out"))
    back = load(sources, "flat", path=tmp_path / "out", channels=4)
    assert sorted((r["sample"], r["channel"], r["adc"]) for r in back.collect()) == sorted((s, c, 10 * s + c) for s in range(100) for c in range(4))


def block(time, words, motion=()):
    parts = [(2, B.HEADER_BYTES, 2 * len(words)), (3, B.HEADER_BYTES + 2 * len(words), 2 * len(motion))]
    size = B.HEADER_BYTES + 2 * len(words) + 2 * len(motion)
    head = bytearray(B.HEADER_BYTES)
    head[:8] = B.BLOCK_ID
    struct.pack_into("<III", head, B.FORMAT_AT, 3, size, time)
    for k, p in enumerate(parts):
        struct.pack_into("<III", head, B.PARTITIONS_AT + k * B.PARTITION_BYTES, *p)
    return bytes(head) + np.array(words, "<u2").tobytes() + np.array(motion, "<u2").tobytes()


def test_blocks(sources, tmp_path):
    motion = [*B.MOTION_MARK, 9, 12, 12, 0, 3, 0, 0, 65535, 2, 3]
    (tmp_path / "NEUR.DF1").write_bytes(b"".join(block(100 + k, range(k, k + 8), motion) for k in range(5)))
    rows = sorted(load(sources, "blocks", path=tmp_path, stream="neural", blocks=2).collect(), key=lambda r: r["block"])
    assert [(r["block"], r["time_ms"], r["words"]) for r in rows] == [(k, 100 + k, list(range(k, k + 8))) for k in range(5)]
    words = np.array(load(sources, "blocks", path=tmp_path, stream="motion").first()["words"])
    assert B.motion(words, "accelerometer").tolist() == [[-1, 2, 3]]
    assert load(sources, "blocks", path=tmp_path, stream="audio").count() == 0


@pytest.mark.parametrize("order", ["C", "F"])
@pytest.mark.parametrize("dtype", ["u1", "u2", "u4", "u8", "i1", "i2", "i4", "i8", "f4", "f8", "?"])
def test_npy(sources, tmp_path, order, dtype):
    data = np.asarray(np.arange(24).reshape(12, 2) % 2 if dtype == "?" else np.arange(24).reshape(12, 2), dtype=dtype, order=order)
    np.save(tmp_path / "x.npy", data)
    rows = sorted(load(sources, "npy", path=tmp_path, rangebytes=20).collect(), key=lambda r: r["row"])
    assert [r["value"] for r in rows] == data.astype(float).tolist()


@pytest.mark.parametrize("many", [True, False])
def test_spike_snapshots(sources, tmp_path, many):
    head = struct.pack("<IH", B.SNAPSHOT_MANY if many else B.SNAPSHOT_ONE, 1) + b"name\0" + b"A-000,A-001\0" + b"x,y\0" + struct.pack("<fII", 1000.0, 1, 2)
    body = b""
    for k in range(6):
        body += (b"A-00" + str(k % 2).encode() if many else b"") + struct.pack("<iB", 100 * k, 128 if k == 5 else 1) + np.array([32768, 32769, 32768 - k], "<u2").tobytes()
    (tmp_path / "spike.dat").write_bytes(head + body)
    rows = sorted(load(sources, "spike_snapshots", path=tmp_path, rangebytes=20, artifacts="false").collect(), key=lambda r: r["t"])
    assert [r["t"] for r in rows] == [0.0, 0.1, 0.2, 0.3, 0.4] and rows[1]["channel"] == ("A-001" if many else "A-000")
    assert np.allclose(rows[4]["wave"], [0, 0.195, -0.78])


def test_diff_chunks(sources, tmp_path):
    data = np.random.default_rng(0).integers(-50, 50, (90, 2)).astype("<i2")
    bounds, offsets, raw = [0, 40, 80, 90], [0], b""
    for a, b in zip(bounds, bounds[1:], strict=False):
        raw += zlib.compress(np.diff(data[a:b], axis=0, prepend=np.zeros((1, 2), "<i2")).T.astype("<i2").tobytes())
        offsets.append(len(raw))
    (tmp_path / "x.cbin").write_bytes(raw)
    (tmp_path / "x.ch").write_text(json.dumps({"chunk_bounds": bounds, "chunk_offsets": offsets, "n_channels": 2, "dtype": "<i2"}))
    df = sources.read.format("diff_chunks").option("path", str(tmp_path / "x.cbin")).option("meta", str(tmp_path / "x.ch")).option("from", "50").option("to", "85").load()
    assert sorted((r["sample"], r["channel"], r["adc"]) for r in df.collect()) == sorted((s, c, int(data[s, c])) for s in range(50, 85) for c in range(2))
    assert df.rdd.getNumPartitions() == 2  # the first chunk isn't read


def test_strings():
    raw = struct.pack("<I", 4) + "ab".encode("utf-16-le") + struct.pack("<I", B.NO_TEXT)
    assert B.q_string(raw, 0) == ("ab", 8) and B.q_string(raw, 8) == (None, 12)


def test_text_files(sources, tmp_path):
    (tmp_path / "params.py").write_text("dat_path = 'a.dat'\nrate = 30000.\nhp = True\n# no\n")
    rows = {r["name"]: r for r in T.key_values(sources, str(tmp_path / "params.py")).collect()}
    assert rows["dat_path"]["text"] == "a.dat" and rows["rate"]["number"] == 30000 and rows["hp"]["flag"] is True
    (tmp_path / "cluster_group.tsv").write_text("cluster_id\tgroup\n0\tnoise\n1\tmua\n2\tgood\n3\tunsorted\n")
    groups = T.cluster_groups(sources, str(tmp_path / "cluster_group.tsv"))
    assert sorted(tuple(r) for r in groups.collect()) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    make = lambda v: sources.createDataFrame([(k, [float(x)]) for k, x in enumerate(v)], "row long, value array<double>")
    spikes = T.phy_spikes(make([30, 60, 90]), make([0, 1, 2]), make([5, 6, 7]), groups, 30.0).collect()
    assert sorted((r["unit"], r["t_s"]) for r in spikes) == [(1, 2.0), (2, 3.0)]
    assert T.channel_map(sources, 40).where("bank = 1").count() == 8


def test_listing(sources, tmp_path):
    for name in ("s1/d1/EVENTLOG.NLE", "s1/d2/EVENT000.DF1", "s2/d1/info.rhd", "s2/d1/amp-A.dat", "s2/d1/amp-B.dat", "s2/d2/notes"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = {(r["subject"], r["session"]): r["format"] for r in T.formats(T.listing(sources, str(tmp_path))).collect()}
    assert got == {("s1", "d1"): "DT2", ("s1", "d2"): "DF1", ("s2", "d1"): "file per channel", ("s2", "d2"): None}


def test_metric_sink(sources, tmp_path):
    T.write_metrics(sources.createDataFrame([(1, 2), (2, 3)], "unit int, n int"), str(tmp_path / "m"))
    assert sources.read.parquet(str(tmp_path / "m/metrics.parquet")).where("n = 3.0").count() == 1
    assert sources.read.csv(str(tmp_path / "m/cluster_n.tsv"), sep="\t", header=True).columns == ["cluster_id", "n"]
