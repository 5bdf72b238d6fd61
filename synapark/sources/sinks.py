"""Arrays, sort results, unit tables and folders for other programs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from .binary import Written, place

#: Folders of a project.
FOLDERS = ("analysisCode", "data/analysis", "data/preprocessing", "data/raw", "data/spikesorted", "data/trialsorted", "data/behaviour", "manuscript")
#: Names of unit types.
UNIT_TYPES = {0: "NOISE", 1: "GOOD", 2: "MUA", 3: "NON-SOMA"}


def write_text(path: str, text: str) -> None:
    system, inner = place(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner) as out:
        out.write(text.encode())


def scaffold(path: str, readme: str = "") -> None:
    """The folders of a new project; what is there stays."""
    system, inner = place(path)
    for name in FOLDERS:
        system.create_dir(f"{inner}/{name}", recursive=True)
    if readme:
        write_text(f"{path}/readme.txt", readme)


def array_header(dtype: np.dtype, shape: tuple[int, ...]) -> bytes:
    """Header of an array file, padded so that values begin at a multiple of 64 bytes."""
    text = repr({"descr": dtype.str, "fortran_order": False, "shape": shape})
    pad = -(10 + len(text) + 1) % 64
    body = (text + " " * pad + "\n").encode("latin1")
    return b"\x93NUMPY\x01\x00" + len(body).to_bytes(2, "little") + body


class ArrayWriter(DataSourceArrowWriter):
    """Rows' only column as an array file a task; ``rows`` says how many the task will get."""

    def __init__(self, options: dict):
        self.path, self.dtype = options["path"], np.dtype(options["dtype"])
        self.rows, self.tail = int(options["rows"]), tuple(int(x) for x in options.get("tail", "").split("x") if x)

    def write(self, batches: Iterator):
        system, inner = place(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        found = 0
        with system.open_output_stream(inner) as out:
            out.write(array_header(self.dtype, (self.rows, *self.tail)))
            for batch in batches:
                column = batch.column(0)
                values = column.flatten() if self.tail else column
                out.write(np.ascontiguousarray(values.to_numpy(zero_copy_only=False)).astype(self.dtype).tobytes())
                found += batch.num_rows
        if found != self.rows:
            raise ValueError(f"{found} rows came, {self.rows} were counted")
        return Written(inner)

    def commit(self, messages):
        return None

    def abort(self, messages):
        return None


class ArraySink(DataSource):
    """``npy_file``: sink of one column."""

    @classmethod
    def name(cls):
        return "npy_file"

    def schema(self):
        return "value double"

    def writer(self, schema, overwrite):
        return ArrayWriter(self.options)


def write_array(df: DataFrame, value: str, order: list[str], path: str, dtype: str, tail: tuple[int, ...] = ()) -> None:
    """A column, sorted, as one array file; with ``tail`` each row is an array of that shape, flattened.

    Such a file is one stream by nature, so one task writes what the others sorted,
    batch by batch; nothing is held whole.
    """
    rows = df.count()
    ordered = df.select(value, *[c for c in order if c != value]).orderBy(*order).select(value).coalesce(1) if rows else df.select(value).limit(0).coalesce(1)
    ordered.write.format("npy_file").mode("append").option("path", path).option("dtype", dtype).option("rows", rows).option("tail", "x".join(map(str, tail))).save()


def write_table(df: DataFrame, path: str, sep: str = "\t", most: int = 1_000_000) -> None:
    """A small table (a row a unit, ``most`` of them) as one text file of that name, sorted by its first column."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError(f"over {most} rows for one file")
    rows = rows.sort_values(df.columns[0], kind="stable")
    write_text(path, rows.to_csv(sep=sep, index=False, lineterminator="\n"))


def write_unit_types(types: DataFrame, path: str) -> None:
    """Units' types (unit from 1, unit_type) by name and viewer's number (from 0)."""
    named = F.lit(None).cast("string")
    for code, name in UNIT_TYPES.items():
        named = F.when(F.col("unit_type") == code, name).otherwise(named)
    write_table(types.select((F.col("unit") - 1).alias("cluster_id"), named.alias("bc_unitType")), f"{path}/cluster_bc_unitType.tsv")


def write_label(df: DataFrame, unit: str, label: str, path: str) -> None:
    """One measure or label of units for the viewer."""
    write_table(df.select(F.col(unit).alias("cluster_id"), F.col(label).alias(label)), f"{path}/cluster_{label}.tsv")


def write_params(path: str, **values) -> None:
    """Parameters as ``name = value`` lines."""
    write_text(f"{path}/params.py", "".join(f"{k} = {v!r}\n" for k, v in values.items()))


def write_properties(properties: DataFrame, path: str, parameters: dict[str, float], acg: str = "acg", unit: str = "cluster_id") -> None:
    """Units' properties as doubles, their correlograms and the parameters, a table each."""
    numbers = [F.col(c).cast("double").alias(c) for c, t in properties.dtypes if c != acg and not t.startswith("array")]
    properties.select(*numbers).write.mode("overwrite").parquet(f"{path}/properties.parquet")
    if acg in properties.columns:
        properties.select(unit, F.col(acg).cast("array<double>").alias(acg)).write.mode("overwrite").parquet(f"{path}/acg.parquet")
    spark = properties.sparkSession
    spark.createDataFrame([(k, float(v)) for k, v in parameters.items()], "name string, value double").write.mode("overwrite").parquet(f"{path}/parameters.parquet")


def export_sort(spark: SparkSession, path: str, spikes: DataFrame, templates: DataFrame, positions: DataFrame, rate: float, recording: str, channels: int) -> None:
    """A sort result for the viewer: spikes (t in samples, template, unit, ampl; numbers from 0), templates (template, channel, wave), positions (channel, x, y).

    Spikes go by time. A template's amplitude is that of its largest channel, a
    unit's the mean over its spikes of that times their own.
    """
    order = ["t", "unit", "template", "ampl"]
    for name, column, kind in (("spike_times", "t", "<u8"), ("spike_templates", "template", "<u4"), ("spike_clusters", "unit", "<u4"), ("amplitudes", "ampl", "<f8")):
        write_array(spikes, column, order, f"{path}/{name}.npy", kind)
    held = templates.groupBy("template").agg(F.sort_array(F.collect_list(F.struct("channel", "wave"))).alias("c"))
    length = templates.select(F.size("wave").alias("n")).agg(F.max("n")).first()[0] or 0
    width = templates.select("channel").distinct().count()
    flat = held.select("template", F.flatten(F.transform(F.sequence(F.lit(1), F.lit(max(1, length))), lambda s: F.transform("c", lambda x: F.element_at(x["wave"], s)))).cast("array<double>").alias("value"))
    write_array(flat, "value", ["template"], f"{path}/templates.npy", "<f4", (length, width))
    write_array(positions.select("channel"), "channel", ["channel"], f"{path}/channel_map.npy", "<i4")
    write_array(positions.select("channel", F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("xy")), "xy", ["channel"], f"{path}/channel_positions.npy", "<f8", (2,))
    size = F.array_max("wave") - F.array_min("wave")
    best = templates.groupBy("template").agg(F.max(F.struct(size.alias("size"), (-F.col("channel")).alias("neg"))).alias("b")).select("template", F.col("b.size").alias("size"), (-F.col("b.neg")).alias("channel"))
    write_table(best.select("template", "channel"), f"{path}/template_bestchannels.tsv")
    mean = spikes.join(best, "template").groupBy("unit").agg(F.round(F.avg(F.col("size") * F.col("ampl")), 1).alias("Amplitude"))
    write_label(mean, "unit", "Amplitude", path)
    write_params(path, dat_path=recording, n_channels_dat=channels, dtype="int16", offset=0, sample_rate=float(rate), hp_filtered=False)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArraySink)
