"""Traditional recordings against files that the test writes block by block."""

import struct

import numpy as np
import pytest

from synapark.sources import recording as R

CHANNELS = [("A", [("A-000", "left", 0, 0), ("A-001", "", 1, 0), ("A-002", "off", 2, 0), ("A-AUX1", "", 0, 1), ("A-VDD", "", 0, 2)]), ("B", []), ("Board", [("ADC-0", "", 0, 3), ("DIN-02", "lick", 2, 4), ("DIN-05", "", 5, 4), ("DOUT-01", "", 1, 5)])]


def text(s):
    raw = s.encode("utf-16-le")
    return struct.pack("<I", len(raw)) + raw


def written(version, blocks, seed=0, mode=1, note="a note"):
    """The bytes of a recording and what is in it."""
    rng = np.random.default_rng(seed)
    raw = struct.pack("<Ihhf", 0xC6912702, *version, 20000.0) + struct.pack("<h6fh2f", 1, *[1.0] * 6, 2, 1000.0, 1000.0)
    raw += text(note) + struct.pack("<I", 0xFFFFFFFF) + text("")
    raw += struct.pack("<h", 1) if version >= (1, 1) else b""
    raw += struct.pack("<h", mode) if version >= (1, 3) else b""
    raw += text("n/a") if version >= (2, 0) else b""
    raw += struct.pack("<h", len(CHANNELS))
    for name, own in CHANNELS:
        raw += text(name) + text(name[0]) + struct.pack("<3h", int(bool(own)), len(own), 0)
        for native, custom, order, kind in own:
            raw += text(native) + text(custom) + struct.pack("<10h2f", order, order, kind, int(custom != "off"), 0, 0, 0, 0, 0, 0, 1.0, 2.0)
    n = 128 if version >= (2, 0) else 60
    held = {k: [] for k in ("t", "amplifier", "auxiliary", "supply", "temperature", "adc", "digital_in", "digital_out")}
    for b in range(blocks):
        t = np.arange(b * n, (b + 1) * n) - 30  # before the trigger times are negative
        part = {"t": t.astype("<i4" if version >= (1, 2) else "<u4")}
        for k, shape in (("amplifier", (2, n)), ("auxiliary", (1, n // 4)), ("supply", (1, 1)), ("temperature", (1, 1)), ("adc", (1, n)), ("digital_in", (n,)), ("digital_out", (n,))):
            part[k] = rng.integers(0, 30_000, shape).astype("<i2" if k == "temperature" else "<u2")
        for k in held:
            if k != "temperature" or version >= (1, 1):
                raw += part[k].tobytes()
                held[k].append(part[k])
    return raw, held, n


@pytest.mark.parametrize("version", [(1, 0), (1, 2), (1, 5), (2, 0), (3, 1)])
def test_every_kind(spark, tmp_path, version):
    R.register(spark)
    raw, held, n = written(version, 7, note="long " * 40_000 if version == (2, 0) else "a")
    (tmp_path / "one.rhd").write_bytes(raw + b"cut off")
    (tmp_path / "other.txt").write_bytes(b"no recording")
    mode = 1 if version >= (1, 3) else 0
    board = (lambda x: 152.59e-6 * (x - 32768.0)) if mode else (lambda x: 50.354e-6 * x)
    bit = lambda k: lambda x: (x >> k & 1).astype(float)
    want = {
        "amplifier": {"left": (0, lambda x: 0.195 * (x - 32768.0)), "A-001": (1, lambda x: 0.195 * (x - 32768.0))}, "auxiliary": {"A-AUX1": (0, lambda x: 37.4e-6 * x)},
        "supply": {"A-VDD": (0, lambda x: 74.8e-6 * x)}, "adc": {"ADC-0": (0, board)}, "digital_in": {"lick": (None, bit(2)), "DIN-05": (None, bit(5))},
        "digital_out": {"DOUT-01": (None, bit(1))}, "temperature": {"temperature0": (0, lambda x: x / 100)} if version >= (1, 1) else {},
    }
    for kind, channels in want.items():
        for size in (1, 3 * 1024, 1 << 20):
            got = spark.read.format("recording").option("path", str(tmp_path)).option("kind", kind).option("rangebytes", size).load().toPandas()
            assert set(got["channel"]) == set(channels)
            for name, (k, scale) in channels.items():
                own = got[got["channel"] == name].sort_values("sample")
                values = np.concatenate([b if k is None else b[k] for b in held[kind]]).astype(np.int64)
                times = np.concatenate(held["t"]).astype(np.int64)[:: n * 7 // len(values)]
                order = np.argsort(times, kind="stable")
                assert np.array_equal(own["sample"], times[order]) and np.allclose(own["v"], scale(values)[order])


def test_ends_and_errors(spark, tmp_path):
    R.register(spark)
    raw, _, _ = written((1, 5), 0)
    (tmp_path / "empty.rhd").write_bytes(raw)
    read = lambda: spark.read.format("recording").option("path", str(tmp_path)).load()
    assert read().count() == 0
    (tmp_path / "short.rhd").write_bytes(raw[:-9])
    with pytest.raises(Exception, match="ends inside its header"):
        read().count()
    (tmp_path / "short.rhd").write_bytes(b"\0" * 99)
    with pytest.raises(Exception, match="isn't a recording"):
        read().count()
    with pytest.raises(Exception, match="no kind"):
        read = spark.read.format("recording").option("path", str(tmp_path)).option("kind", "smell").load().count()
