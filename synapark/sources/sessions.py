"""What belongs to a session beside its samples: headers, times, digital lines, sidecars, sort results, settings."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.utils import AnalysisException

from ..operators.trials import digital_events
from . import binary as B
from . import text as X

HEADER = (
    "version string, rate double, aux_rate double, dsp_enabled boolean, dsp_cutoff double, lower double, upper double, "
    "wanted_dsp_cutoff double, wanted_lower double, wanted_upper double, notch_mode int, notch_hz int"
)
#: Notch frequencies by mode.
NOTCH = {1: 50, 2: 60}


def recording_header(raw: bytes) -> tuple:
    """The fields of ``HEADER`` from the first 48 bytes of a recording's header file."""
    mark, major, minor, rate, dsp, *cuts, notch = struct.unpack_from("<Ihhfh6fh", raw)
    if mark != B.RECORDING_MARK:
        raise ValueError("not a recording header")
    return f"{major}.{minor}", rate, rate / 4, dsp != 0, *cuts, notch, NOTCH.get(notch, 0)


def headers(spark: SparkSession, path: str, name: str = "info.rhd") -> DataFrame:
    """A row of header fields for each recording below a path, with its folder; only the first bytes leave the reader."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(path)
    rows = rows.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.substring("content", 1, 64).alias("raw"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(f, *recording_header(bytes(r))) for f, r in zip(batch["folder"], batch["raw"], strict=True)], columns=["folder", *[x.split()[0] for x in HEADER.split(", ")]])

    return rows.mapInPandas(run, "folder string, " + HEADER)


def time_vector(spark: SparkSession, path: str, rate: float) -> DataFrame:
    """Seconds of every sample from a file of 32-bit sample numbers."""
    rows = spark.read.format("flat").option("path", path).option("dtype", "<i4").load()
    return rows.select("file", "sample", (F.col("adc") / rate).alias("t_s"))


def digital_lines(spark: SparkSession, path: str, suffix: str = ".dat") -> DataFrame:
    """Lines (sample, pin, v) from a file a pin, which its name ends with the number of."""
    rows = spark.read.format("flat").option("path", path).option("layout", "channel").option("dtype", "<u2").option("suffix", suffix).load()
    return rows.select("sample", F.regexp_extract("file", r"(\d+)" + suffix.replace(".", r"\.") + "$", 1).cast("int").alias("pin"), F.col("adc").alias("v"))


def digital_codes(spark: SparkSession, path: str, rate: float, skip_ms: float = 0.5, span: int = 2) -> DataFrame:
    """Event codes of a session's digital lines, with their time in ms."""
    found = digital_events(digital_lines(spark, path), max(1, round(skip_ms * rate / 1000)), span)
    return found.withColumn("t_ms", F.col("sample") * 1000.0 / rate)


def sync_words(spark: SparkSession, path: str, channels: int, index: int = -1) -> DataFrame:
    """One channel's words of an interleaved recording, by default the last."""
    rows = spark.read.format("flat").option("path", path).option("channels", channels).load()
    return rows.where(F.col("channel") == (index % channels)).select("file", "sample", F.col("adc").alias("word"))


def convert(spark: SparkSession, source: str, target: str, channels: int, keep: list[int] | None = None) -> None:
    """An interleaved recording, or some of its channels, written anew range by range."""
    rows = spark.read.format("flat").option("path", source).option("channels", channels).load()
    rows = rows.where(F.col("channel").isin(keep)) if keep is not None else rows
    B.write_flat(rows.select("sample", "channel", F.col("adc").alias("v")), target)


def referenced(spark: SparkSession, source: str, target: str, channels: int, chunk: int = 1_000_000) -> None:
    """An interleaved recording without each chunk's channel medians and then each sample's median over channels."""
    rows = spark.read.format("flat").option("path", source).option("channels", channels).load().withColumn("chunk", F.floor(F.col("sample") / chunk))
    middle = rows.groupBy("channel", "chunk").agg(F.percentile("adc", F.lit(0.5)).alias("m"))
    rows = rows.join(middle, ["channel", "chunk"]).select("sample", "channel", (F.col("adc") - F.col("m")).alias("v"))
    common = rows.groupBy("sample").agg(F.percentile("v", F.lit(0.5)).alias("c"))
    B.write_flat(rows.join(common, "sample").select("sample", "channel", F.round(F.col("v") - F.col("c")).cast("int").alias("v")), target)


def setting(table: DataFrame, name: str, kind: str = "string") -> DataFrame:
    """The second column, cast, of the first row whose first column contains a name: one row or none."""
    first, second = table.columns[:2]
    rows = table.withColumn("_at", F.monotonically_increasing_id()).where(F.contains(F.col(first), F.lit(name)))
    return rows.orderBy("_at").limit(1).select(F.col(second).try_cast(kind).alias("value"))


def tsv(spark: SparkSession, path: str) -> DataFrame:
    """A table of tab-separated values, ``n/a`` as null."""
    return spark.read.csv(path, sep="\t", header=True, nullValue="n/a", inferSchema=True)


def json_table(spark: SparkSession, path: str) -> DataFrame:
    """A row for each JSON file, whatever its lines."""
    return spark.read.option("multiLine", True).json(path)


#: First bytes of files.
MAGIC = {
    b"\x93NUMPY": "npy", struct.pack("<I", B.RECORDING_MARK): "rhd", struct.pack("<I", B.SNAPSHOT_MANY): "spike snapshots", struct.pack("<I", B.SNAPSHOT_ONE): "spike snapshots",
    B.BLOCK_ID: "blocks", b"\x1f\x8b": "gzip", b"PK\x03\x04": "zip", b"<?xml": "xml", b"\x89HDF": "hdf5", b"0       ": "edf",
}


def kinds(spark: SparkSession, path: str) -> DataFrame:
    """Every file's kind by its first bytes, else by its extension; contents beyond them aren't read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads = [B.read_bytes(p, 0, min(16, n)) if n else b"" for p, n in zip(batch["path"], batch["length"], strict=True)]
            yield batch.assign(magic=[next((k for m, k in MAGIC.items() if h.startswith(m)), None) for h in heads])

    found = rows.mapInPandas(run, "path string, length long, magic string")
    extension = F.nullif(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)), F.lit(""))
    return found.select("path", "length", F.coalesce("magic", extension).alias("kind"))


def sidecars(listed: DataFrame, data: str, sidecar: str) -> DataFrame:
    """For each file that matches ``data`` the nearest one up its folders that matches ``sidecar``: path, sidecar."""
    folder = lambda c: F.regexp_replace(c, "/[^/]*$", "")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    parts = F.split("folder", "/")
    files = listed.where(name.rlike(data)).select("path", folder("path").alias("folder"))
    above = files.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(F.array_join(F.slice(parts, F.lit(1), k), "/").alias("folder"), k.alias("depth")))).alias("x")).select("path", "x.*")
    side = listed.where(name.rlike(sidecar)).select(F.col("path").alias("sidecar"), folder("path").alias("folder"))
    return above.join(side, "folder").groupBy("path").agg(F.max_by("sidecar", F.struct("depth", "sidecar")).alias("sidecar"))


class EdfReader(DataSourceReader):
    """Records of a multi-rate recording; a task takes a run of records."""

    def __init__(self, options: dict):
        self.path, self.records = options["path"], int(options.get("records", 256))

    @staticmethod
    def layout(path: str) -> dict:
        head = B.read_bytes(path, 0, 256)
        n = int(head[252:256])
        size, count, seconds = int(head[184:192]), int(head[236:244]), float(head[244:252])
        raw, at, field = B.read_bytes(path, 256, 256 * n), 0, {}
        for name, width in (("label", 16), ("kind", 80), ("unit", 8), ("low", 8), ("high", 8), ("digital_low", 8), ("digital_high", 8), ("filter", 80), ("samples", 8)):
            field[name] = [raw[at + k * width : at + (k + 1) * width].decode("latin1").strip() for k in range(n)]
            at += n * width
        return {"at": size, "records": count, "seconds": seconds, **field}

    def partitions(self):
        out = []
        for path, _ in B.files(self.path):
            if path.lower().endswith(".edf"):
                lay = self.layout(path)
                width = 2 * sum(map(int, lay["samples"]))
                out += [B.Range(path, lay["at"] + k * width, min(self.records, lay["records"] - k) * width, k) for k in range(0, lay["records"], self.records)]
        return out or [B.Range("", 0, 0)]

    def read(self, part: B.Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        lay = self.layout(part.path)
        samples = [int(x) for x in lay["samples"]]
        raw = np.frombuffer(B.read_bytes(part.path, part.start, part.size), "<i2").reshape(-1, sum(samples))
        at = 0
        for k, n in enumerate(samples):
            low, high, d0, d1 = (float(lay[c][k]) for c in ("low", "high", "digital_low", "digital_high"))
            value = (raw[:, at : at + n].ravel() - d0) / (d1 - d0) * (high - low) + low
            sample = part.first * n + np.arange(len(value))
            at += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.path] * len(value)), pa.array([lay["label"][k]] * len(value)), pa.array([n / lay["seconds"]] * len(value)), pa.array(sample), pa.array(value)], ["file", "channel", "rate", "sample", "v"]
            )


class EdfSource(DataSource):
    """``edf``: file, channel, its rate, sample number and value in the channel's unit."""

    @classmethod
    def name(cls):
        return "edf"

    def schema(self):
        return "file string, channel string, rate double, sample long, v double"

    def reader(self, schema):
        return EdfReader(self.options)


def at_highest_rate(samples: DataFrame) -> DataFrame:
    """All channels of a file at its highest rate: a slower channel's value holds until its next sample."""
    top = samples.groupBy("file").agg(F.max("rate").alias("top"))
    ratio = F.col("top") / F.col("rate")
    first, last = F.ceil(F.col("sample") * ratio), F.ceil((F.col("sample") + 1) * ratio) - 1
    return samples.join(top, "file").select("file", "channel", F.col("top").alias("rate"), F.explode(F.sequence(first, last)).alias("sample"), "v")


def sort_result(spark: SparkSession, path: str, rate: float) -> dict[str, DataFrame]:
    """A sorter's folder as tables: spikes without noise units, templates (template, wave by channel), feature rows, groups.

    Units are templates where no clusters were written. Numbers stay as the files have them, from 0.
    """
    array = lambda name: spark.read.format("npy").option("path", f"{path}/{name}.npy").load().select("row", "value")
    there = {p.rsplit("/", 1)[-1] for p, _ in B.files(path)}
    groups_at = next((f"{path}/{n}" for n in ("cluster_group.tsv", "cluster_groups.csv") if n in there), None)
    groups = X.cluster_groups(spark, groups_at) if groups_at else spark.createDataFrame([], "unit int, grp int")
    templates = array("spike_templates")
    clusters = array("spike_clusters") if "spike_clusters.npy" in there else templates
    spikes = X.phy_spikes(array("spike_times"), clusters, array("amplitudes"), groups, rate)
    spikes = spikes.join(templates.select(F.col("row").alias("spike_id"), F.element_at("value", 1).cast("int").alias("template")), "spike_id")
    out = {"spikes": spikes, "groups": groups}
    for name in ("templates", "pc_features", "pc_feature_ind", "templates_ind", "channel_positions", "whitening_mat_inv"):
        if f"{name}.npy" in there:
            out[name] = array(name)
    return out


def unwhitened(templates: DataFrame, inverse: DataFrame, channels: int) -> DataFrame:
    """Templates (row, value: samples by channels) times the inverse whitening matrix: template, channel, wave."""
    matrix = inverse.select(F.col("row").cast("int").alias("inner"), F.posexplode("value").alias("channel", "w"))
    cells = templates.select(F.col("row").alias("template"), F.posexplode("value").alias("k", "v")).select("template", F.expr(f"k div {channels}").alias("at"), (F.col("k") % channels).alias("inner"), "v")
    sums = cells.join(F.broadcast(matrix), "inner").groupBy("template", "channel", "at").agg(F.sum(F.col("v") * F.col("w")).alias("v"))  # channels squared rows
    return sums.groupBy("template", "channel").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("wave"))


def unit_templates(spikes: DataFrame) -> DataFrame:
    """The template that most of a unit's spikes have, the lowest of equals: after units were merged or split."""
    counts = spikes.groupBy("unit", "template").agg(F.count("*").alias("n"))
    return counts.groupBy("unit").agg(F.max(F.struct("n", (-F.col("template")).alias("neg"))).alias("x")).select("unit", (-F.col("x.neg")).alias("template"))


def of_dataset(spikes: DataFrame, index: int) -> DataFrame:
    """Spikes of one of several recordings that were sorted together (column ``dataset``)."""
    return spikes.where(F.col("dataset") == index)


def aligned_results(results: dict[str, DataFrame], clocks: DataFrame) -> DataFrame:
    """Spikes of several sort results in one time: clocks (tag, slope, offset) correct every tag that they name."""
    tagged = [df.withColumn("tag", F.lit(tag)) for tag, df in results.items()]
    rows = tagged[0]
    for more in tagged[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    line = F.coalesce(F.col("t_s") * F.col("slope") + F.col("offset"), F.col("t_s"))
    return rows.join(clocks, "tag", "left").withColumn("t_s", line).drop("slope", "offset")


def recording_meta(spark: SparkSession, path: str) -> DataFrame:
    """Derived fields of key=value files of probe recordings: channels, rate, range, bits, gain and microvolts a step.

    Probes save 10-bit values (14-bit ones of later types), other boards 16-bit ones.
    """
    pairs = X.key_values(spark, path).groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("m"))
    get = lambda name: F.try_element_at("m", F.lit(name))
    number = lambda name: get(name).try_cast("double")
    probe = get("imSampRate").isNotNull()
    entry = F.split(F.regexp_extract(F.coalesce(get("imroTbl"), get("~imroTbl")), r"\)\(([^)]*)\)", 1), "[ ,]+")
    later = F.coalesce(get("imDatPrb_type"), F.lit("0")).isin("21", "24", "2003", "2004", "2013", "2014")
    bits = F.when(probe & later, 14).when(probe, 10).otherwise(16)
    low, high = F.coalesce(number("imAiRangeMin"), number("niAiRangeMin")), F.coalesce(number("imAiRangeMax"), number("niAiRangeMax"))
    gain = F.when(probe, F.get(entry, F.lit(3)).try_cast("double")).otherwise(number("niMNGain"))
    out = pairs.select(
        "file", number("nSavedChans").cast("int").alias("channels"), F.coalesce(number("imSampRate"), number("niSampRate")).alias("rate"), low.alias("low"), high.alias("high"), bits.alias("bits"), gain.alias("gain")
    )
    return out.withColumn("uv_per_bit", (F.col("high") - F.col("low")) / F.pow(F.lit(2.0), F.col("bits")) / F.col("gain") * 1e6)


def saved_metrics(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that ``sinks`` wrote for a session's units, as far as they are there."""
    out = {}
    for name in ("metrics", "properties", "parameters", "acg"):
        try:
            out[name] = spark.read.parquet(f"{path}/{name}.parquet")
        except AnalysisException:
            continue
    return out


def register(spark: SparkSession) -> None:
    spark.dataSource.register(EdfSource)
