"""Headers, digital lines, multi-rate files, sort results and sinks, written here and read back."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from synapark.sources import binary as B
from synapark.sources import sessions as S
from synapark.sources import sinks as K
from synapark.sources import text as T


@pytest.fixture(scope="module")
def sources(spark):
    for part in (B, S, K):
        part.register(spark)
    return spark


def header_bytes(rate=20000.0, mode=2):
    return struct.pack("<Ihhfh6fh", B.RECORDING_MARK, 1, 5, rate, 1, 0.7, 0.1, 7500.0, 1.0, 0.1, 7600.0, mode) + b"more"


def test_headers_and_time(sources, tmp_path):
    for k, mode in enumerate((0, 1, 2)):
        (tmp_path / f"s{k}").mkdir()
        (tmp_path / f"s{k}/info.rhd").write_bytes(header_bytes(mode=mode))
        (tmp_path / f"s{k}/time.dat").write_bytes(np.arange(-5, 45, dtype="<i4").tobytes())
    rows = {r["folder"][-2:]: r for r in S.headers(sources, str(tmp_path)).collect()}
    assert [rows[f"s{k}"]["notch_hz"] for k in range(3)] == [0, 50, 60]
    r = rows["s1"]
    assert (r["version"], r["rate"], r["aux_rate"], r["dsp_enabled"]) == ("1.5", 20000.0, 5000.0, True) and abs(r["upper"] - 7500) < 1e-3 and abs(r["wanted_upper"] - 7600) < 1e-3
    t = S.time_vector(sources, str(tmp_path / "s0/time.dat"), 20000.0).orderBy("sample").collect()
    assert len(t) == 50 and t[0]["t_s"] == -5 / 20000 and t[49]["t_s"] == 44 / 20000
    (tmp_path / "s0/info.rhd").write_bytes(b"0" * 60)
    with pytest.raises(Exception, match="not a recording header"):
        S.headers(sources, str(tmp_path)).collect()


def test_digital_codes(sources, tmp_path):
    """Sixteen files of pins, a bounce of ten samples, and a code of the upper pins alone."""
    up = np.zeros((400, 16), "<u2")
    up[:3, 0] = 1
    up[50:60:2, 3] = 1  # bouncing before the code stands
    up[60:90, [0, 2]] = 1
    up[200:230, [5, 15]] = 1
    for pin in range(16):
        (tmp_path / f"board-DIGITAL-IN-{pin + 1:02d}.dat").write_bytes(up[:, pin].tobytes())
    got = sorted((r["sample"], r["standard"], r["extra"], r["t_ms"]) for r in S.digital_codes(sources, str(tmp_path), 30000.0, 0.5, 5).collect())
    assert got == [(50, 5, 0, 50 / 30), (200, 0, (1 << 5) | (1 << 15), 200 / 30)]


def test_sync_and_conversion(sources, tmp_path):
    data = np.random.default_rng(0).integers(-900, 900, (300, 5)).astype("<i2")
    (tmp_path / "a.bin").write_bytes(data.tobytes())
    words = S.sync_words(sources, str(tmp_path / "a.bin"), 5).orderBy("sample").collect()
    assert [r["word"] for r in words] == data[:, 4].tolist()
    S.convert(sources, str(tmp_path / "a.bin"), str(tmp_path / "two"), 5, keep=[1, 3])
    two = np.concatenate([np.fromfile(p, "<i2") for p in sorted((tmp_path / "two").iterdir())]).reshape(-1, 2)
    assert (two == data[:, [1, 3]]).all()
    S.referenced(sources, str(tmp_path / "a.bin"), str(tmp_path / "car"), 5, chunk=100)
    car = np.concatenate([np.fromfile(p, "<i2") for p in sorted((tmp_path / "car").iterdir())]).reshape(-1, 5)
    x = np.concatenate([c - np.median(c, 0) for c in np.split(data.astype(float), 3)])
    want = x - np.median(x, 1, keepdims=True)
    assert np.abs(car - want).max() <= 0.5 and len(car) == 300


def edf_bytes():
    field = lambda text, n: str(text).ljust(n).encode()
    labels, samples, low, high = ("fast", "slow"), (4, 2), (-100, 0), (100, 10)
    head = field("0", 8) + field("p", 80) + field("r", 80) + field("01.01.24", 8) + field("00.00.00", 8) + field(256 + 512, 8) + field("", 44) + field(3, 8) + field(1, 8) + field(2, 4)
    for values, width in ((labels, 16), (("", ""), 80), (("uV", "C"), 8), (low, 8), (high, 8), ((-32768, -32768), 8), ((32767, 32767), 8), (("", ""), 80), (samples, 8), (("", ""), 32)):
        head += b"".join(field(v, width) for v in values)
    raw = np.arange(18, dtype="<i2") * 1000
    return head + raw.tobytes(), raw.reshape(3, 6)


def test_multirate_file(sources, tmp_path):
    raw, words = edf_bytes()
    (tmp_path / "x.edf").write_bytes(raw)
    df = sources.read.format("edf").option("path", str(tmp_path)).option("records", "2").load()
    rows = {(r["channel"], r["sample"]): (r["rate"], r["v"]) for r in df.collect()}
    assert len(rows) == 18 and rows[("fast", 5)][0] == 4.0 and rows[("slow", 0)][0] == 2.0
    for k in range(12):
        assert abs(rows[("fast", k)][1] - ((int(words[k // 4, k % 4]) + 32768) / 65535 * 200 - 100)) < 1e-9
    same = {(r["channel"], r["sample"]): r["v"] for r in S.at_highest_rate(df).collect()}
    assert len(same) == 24 and same[("slow", 4)] == same[("slow", 5)] == rows[("slow", 2)][1]


def test_kinds_and_sidecars(sources, tmp_path):
    files = {"a/x_ieeg.bin": b"1234", "a/b/y_ieeg.bin": b"1", "x_channels.tsv": b"name\n", "a/b/b_channels.tsv": b"name\n", "a/n.dat": b"\x93NUMPY..", "a/h": header_bytes(), "a/c.json": b"{}"}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    kinds = {r["path"].split(str(tmp_path))[1][1:]: r["kind"] for r in S.kinds(sources, str(tmp_path)).collect()}
    assert (kinds["a/n.dat"], kinds["a/h"], kinds["a/c.json"]) == ("npy", "rhd", "json")
    found = {r["path"].rsplit("/", 1)[1]: r["sidecar"].split(str(tmp_path))[1][1:] for r in S.sidecars(T.listing(sources, str(tmp_path)), r"_ieeg\.bin$", r"_channels\.tsv$").collect()}
    assert found == {"x_ieeg.bin": "x_channels.tsv", "y_ieeg.bin": "a/b/b_channels.tsv"}


def test_small_tables(sources, tmp_path):
    (tmp_path / "t.tsv").write_text("onset\tkind\n1.5\tgo\nn/a\tn/a\n")
    rows = S.tsv(sources, str(tmp_path / "t.tsv")).collect()
    assert [tuple(r) for r in rows] == [(1.5, "go"), (None, None)]
    (tmp_path / "t.json").write_text('{\n "rate": 5,\n "names": ["a", "b"]\n}')
    assert S.json_table(sources, str(tmp_path / "t.json")).first()["names"] == ["a", "b"]
    table = sources.createDataFrame([("Rate of sampling", "20"), ("Rate of display", "x"), ("Name", "n")], "field string, value string").coalesce(1)
    assert S.setting(table, "Rate", "int").first()["value"] == 20 and S.setting(table, "None").count() == 0 and S.setting(table, "display", "int").first()["value"] is None


def test_recording_meta(sources, tmp_path):
    (tmp_path / "a.meta").write_text("nSavedChans=385\nimSampRate=30000\nimAiRangeMin=-0.6\nimAiRangeMax=0.6\nimroTbl=(0,384)(0 0 0 500 250 1)(1 0 0 500 250 1)\n")
    (tmp_path / "b.meta").write_text("nSavedChans=9\nniSampRate=25000\nniAiRangeMin=-5\nniAiRangeMax=5\nniMNGain=200\n")
    rows = {r["channels"]: r for r in S.recording_meta(sources, str(tmp_path)).collect()}
    assert (rows[385]["bits"], rows[385]["gain"], rows[385]["rate"]) == (10, 500.0, 30000.0) and abs(rows[385]["uv_per_bit"] - 1.2 / 1024 / 500 * 1e6) < 1e-9
    assert (rows[9]["bits"], rows[9]["gain"]) == (16, 200.0)


@pytest.mark.parametrize("dtype", ["<i8", "<u4", "<f4", "<f8", "|b1"])
def test_array_round_trip(sources, tmp_path, dtype):
    values = np.random.default_rng(1).integers(0, 2 if dtype == "|b1" else 1 << 31, 500)
    values[0] = (1 << 62) + 1 if dtype == "<i8" else values[0]
    rows = sources.createDataFrame([(k, int(v)) for k, v in enumerate(values)], "k long, v long").repartition(7)
    K.write_array(rows, "v", ["k"], str(tmp_path / "x.npy"), dtype)
    assert (np.load(tmp_path / "x.npy") == values.astype(dtype)).all()
    back = sources.read.format("npy").option("path", str(tmp_path / "x.npy")).load()
    kind = {"b": "boolean", "i": "bigint", "u": "bigint"}.get(np.dtype(dtype).kind, "double")
    assert dict(back.dtypes)["value"] == f"array<{kind}>"
    assert [r["value"][0] for r in back.orderBy("row").collect()] == np.load(tmp_path / "x.npy").tolist()
    K.write_array(rows.limit(0), "v", ["k"], str(tmp_path / "none.npy"), dtype)
    assert np.load(tmp_path / "none.npy").shape == (0,)


def test_three_dimensional_column_major(sources, tmp_path):
    data = np.asfortranarray(np.arange(120).reshape(10, 4, 3))
    np.save(tmp_path / "t.npy", data)
    rows = sources.read.format("npy").option("path", str(tmp_path)).option("rangebytes", "200").load().orderBy("row").collect()
    assert [r["value"] for r in rows] == data.reshape(10, 12).tolist()


def test_sort_export_and_load(sources, tmp_path):
    """What is exported is read back; noise units and merged templates are handled."""
    rng = np.random.default_rng(2)
    spikes = sources.createDataFrame([(int(t), int(u), int(u) % 2, float(a)) for t, u, a in zip(rng.integers(0, 9000, 80), rng.integers(0, 3, 80), rng.random(80), strict=True)], "t long, unit int, template int, ampl double")
    waves = [(k, c, (np.arange(5) * (c + 1) * (-1) ** k).astype(float).tolist()) for k in range(2) for c in range(3)]
    templates = sources.createDataFrame(waves, "template int, channel int, wave array<double>")
    positions = sources.createDataFrame([(c, 1, 20 * c) for c in range(3)], "channel int, x int, y int")
    K.export_sort(sources, str(tmp_path), spikes, templates, positions, 30000.0, "rec.bin", 3)
    times = np.load(tmp_path / "spike_times.npy")
    assert times.dtype == np.uint64 and (np.diff(times.astype(int)) >= 0).all() and np.load(tmp_path / "templates.npy").shape == (2, 5, 3)
    assert (np.load(tmp_path / "templates.npy")[1] == np.array([w for k, _, w in waves if k == 1]).T).all()
    assert np.load(tmp_path / "channel_positions.npy").tolist() == [[1, 0], [1, 20], [1, 40]]
    assert (tmp_path / "template_bestchannels.tsv").read_text() == "template\tchannel\n0\t2\n1\t2\n"
    params = {r["name"]: r for r in T.key_values(sources, str(tmp_path / "params.py")).collect()}
    assert params["dat_path"]["text"] == "rec.bin" and params["sample_rate"]["number"] == 30000 and params["hp_filtered"]["flag"] is False
    (tmp_path / "cluster_group.tsv").write_text("cluster_id\tgroup\n0\tgood\n1\tnoise\n2\tmua\n")
    back = S.sort_result(sources, str(tmp_path), 30000.0)
    got = back["spikes"].collect()
    want = spikes.where("unit <> 1").collect()
    assert sorted((round(r["t_s"] * 30000), r["unit"], r["template"], r["ampl"]) for r in got) == sorted((r["t"], r["unit"], r["template"], r["ampl"]) for r in want)
    assert {r["unit"]: r["template"] for r in S.unit_templates(back["spikes"]).collect()} == {0: 0, 2: 0}
    matrix = np.array([[2.0, 0, 1], [0, 1, 0], [0, 0, 3]])
    inverse = sources.createDataFrame([(k, row.tolist()) for k, row in enumerate(matrix)], "row long, value array<double>")
    plain = {(r["template"], r["channel"]): r["wave"] for r in S.unwhitened(back["templates"], inverse, 3).collect()}
    block = np.load(tmp_path / "templates.npy")
    assert all(np.allclose(plain[(k, c)], (block[k] @ matrix)[:, c]) for k in range(2) for c in range(3))


def test_results_in_one_time(sources):
    a = sources.createDataFrame([(1, 10.0, 0), (2, 20.0, 1)], "unit int, t_s double, dataset int")
    clocks = sources.createDataFrame([("b", 2.0, 1.0)], "tag string, slope double, offset double")
    got = sorted((r["tag"], r["unit"], r["t_s"]) for r in S.aligned_results({"a": a, "b": a}, clocks).collect())
    assert got == [("a", 1, 10.0), ("a", 2, 20.0), ("b", 1, 21.0), ("b", 2, 41.0)]
    assert [r["unit"] for r in S.of_dataset(a, 1).collect()] == [2]


def test_unit_tables(sources, tmp_path):
    types = sources.createDataFrame([(2, 1), (1, 0), (3, 2), (4, 3)], "unit int, unit_type int")
    K.write_unit_types(types, str(tmp_path))
    assert (tmp_path / "cluster_bc_unitType.tsv").read_text() == "cluster_id\tbc_unitType\n0\tNOISE\n1\tGOOD\n2\tMUA\n3\tNON-SOMA\n"
    properties = sources.createDataFrame([(1, 2.5, [1, 2]), (2, None, [3])], "cluster_id int, rate double, acg array<int>")
    K.write_properties(properties, str(tmp_path / "p"), {"bin": 0.5})
    T.write_metrics(sources.createDataFrame([(1, 2)], "unit int, n int"), str(tmp_path / "p"))
    back = S.saved_metrics(sources, str(tmp_path / "p"))
    assert set(back) == {"metrics", "properties", "parameters", "acg"} and back["parameters"].first()["value"] == 0.5
    assert dict(back["properties"].dtypes) == {"cluster_id": "double", "rate": "double"} and back["acg"].where("cluster_id = 1").first()["acg"] == [1.0, 2.0]
    assert S.saved_metrics(sources, str(tmp_path / "nowhere")) == {}
    K.scaffold(str(tmp_path / "project"), "notes")
    assert all((tmp_path / "project" / f).is_dir() for f in K.FOLDERS) and (tmp_path / "project/readme.txt").read_text() == "notes"


def test_blocks_of_other_sizes(sources, tmp_path):
    from .test_sources import block

    (tmp_path / "a.DF1").write_bytes(block(1, range(8)) + block(2, range(30)) + block(3, range(8)) * 3)
    with pytest.raises(Exception, match="different sizes"):
        sources.read.format("blocks").option("path", str(tmp_path)).option("blocks", "1").load().collect()
    (tmp_path / "a.DF1").write_bytes(b"nothing here")
    with pytest.raises(Exception, match="no block"):
        sources.read.format("blocks").option("path", str(tmp_path)).load().collect()


def test_listing_of_some(sources, tmp_path):
    for name in ("abc/d1/x", "abc/d2/x", "ab/d1/x"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    found = lambda **k: sorted((r["subject"], r["session"]) for r in T.listing(sources, str(tmp_path), **k).collect())
    assert found(least=3) == [("abc", "d1"), ("abc", "d2")] and found(subjects=["ab"]) == [("ab", "d1")] and found(sessions=["d2"]) == [("abc", "d2")]


def test_settings_xml(sources, tmp_path):
    (tmp_path / "settings.xml").write_text('<Settings Version="1.5"><SIGNAL_GROUP Name="Port A"><CHANNEL name="A-000" gain="0.195"/><CHANNEL name="A-001" gain="0.2"/></SIGNAL_GROUP></Settings>')
    rows = T.xml_events(sources, str(tmp_path / "settings.xml"), "SIGNAL_GROUP").select("_Name", F.explode("CHANNEL").alias("c")).select("_Name", "c._name", "c._gain").collect()
    assert [tuple(r) for r in rows] == [("Port A", "A-000", 0.195), ("Port A", "A-001", 0.2)]
