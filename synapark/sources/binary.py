"""Recordings in binary formats as Spark data sources (read) and sinks (write).

Every reader splits a file into byte ranges, so that a long recording is read by
many tasks, and opens it through pyarrow's file systems: a local path or any URI
that they know. ``register(spark)`` makes the formats known to ``spark.read.format``.
"""

from __future__ import annotations

import ast
import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Bytes that a task reads, unless the option ``rangebytes`` says otherwise.
RANGE = 64 << 20


def place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def files(path: str) -> list[tuple[str, int]]:
    """Files below a path (or the file itself) with their sizes, by name."""
    system, inner = place(path)
    head = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    info = system.get_file_info(inner)
    found = system.get_file_info(fs.FileSelector(inner, recursive=True)) if info.type == fs.FileType.Directory else [info]
    return sorted((head + f.path, f.size) for f in found if f.type == fs.FileType.File)


def read_bytes(path: str, start: int, size: int | None = None) -> bytes:
    system, inner = place(path)
    with system.open_input_file(inner) as f:
        f.seek(start)
        return f.read() if size is None else f.read(size)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    size: int
    first: int = 0


class FlatReader(DataSourceReader):
    """Samples of one width, channel by channel in a file each or interleaved."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.channels = int(options.get("channels", 1))
        self.dtype = np.dtype(options.get("dtype", "<i2"))
        self.skip = int(options.get("skip", 0))
        self.per_file = options.get("layout", "interleaved") == "channel"
        self.strip = options.get("stripzeros", "false").lower() == "true"
        self.range = int(options.get("rangebytes", RANGE))
        self.suffix = options.get("suffix", "")

    def partitions(self):
        width = self.dtype.itemsize * (1 if self.per_file else self.channels)
        step = max(1, self.range // width) * width
        out, before = [], 0
        held = [(p, s) for p, s in files(self.path) if p.endswith(self.suffix)]
        for k, (path, size) in enumerate(held):
            whole = (size - self.skip) // width * width
            if self.strip and k == len(held) - 1:
                whole = self.without_zeros(path, whole, width)
            for start in range(0, whole, step):
                out.append(Range(path, self.skip + start, min(step, whole - start), k if self.per_file else before + start // width))
            before += whole // width
        return out or [Range("", 0, 0)]

    def without_zeros(self, path: str, whole: int, width: int) -> int:
        """Bytes up to the last frame with a value in the file."""
        while whole > 0:
            size = min(whole, 1 << 20)
            data = np.frombuffer(read_bytes(path, self.skip + whole - size, size), np.uint8)
            if data.any():
                return whole - size + -(-(int(np.flatnonzero(data)[-1]) + 1) // width) * width
            whole -= size
        return 0

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        value = np.frombuffer(read_bytes(part.path, part.start, part.size), self.dtype)
        if self.per_file:
            channel = np.full(len(value), part.first, np.int32)
            sample = (part.start - self.skip) // self.dtype.itemsize + np.arange(len(value))
        else:
            channel = np.tile(np.arange(self.channels, dtype=np.int32), len(value) // self.channels)
            sample = part.first + np.arange(len(value)) // self.channels
        for at in range(0, len(value), 1 << 18):
            cut = slice(at, at + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(value[cut])), pa.array(channel[cut]), pa.array(sample[cut]), pa.array(value[cut].astype(np.int32))], ["file", "channel", "sample", "adc"])


class FlatSource(DataSource):
    """``flat``: options path, channels, dtype, skip, layout (interleaved or channel), stripzeros, suffix."""

    @classmethod
    def name(cls):
        return "flat"

    def schema(self):
        return "file string, channel int, sample long, adc int"

    def reader(self, schema):
        return FlatReader(self.options)

    def writer(self, schema, overwrite):
        return FlatWriter(self.options)


@dataclass
class Written(WriterCommitMessage):
    path: str


class FlatWriter(DataSourceArrowWriter):
    """Values of rows (sample, channel, v) in the order in which they come, one file a task: sort before."""

    def __init__(self, options: dict):
        self.path, self.dtype = options["path"], np.dtype(options.get("dtype", "<i2"))

    def write(self, batches):
        from pyspark import TaskContext

        system, inner = place(self.path)
        system.create_dir(inner, recursive=True)
        target = f"{inner}/part-{TaskContext.get().partitionId():05d}.bin"
        with system.open_output_stream(target) as out:
            for batch in batches:
                out.write(batch.column("v").to_numpy(zero_copy_only=False).astype(self.dtype).tobytes())
        return Written(target)

    def commit(self, messages):
        return None

    def abort(self, messages):
        for m in messages:
            if m:
                place(self.path)[0].delete_file(m.path)


def write_flat(samples: DataFrame, path: str, dtype: str = "<i2") -> None:
    """Samples as interleaved binary: files in the order of samples, channel fastest. Ranges are cut at samples."""
    rows = samples.select("sample", "channel", "v").repartitionByRange("sample").sortWithinPartitions("sample", "channel")
    rows.write.format("flat").mode("append").option("path", path).option("dtype", dtype).save()


#: Fixed values of the block format: identifier, header length, and byte places in it.
BLOCK_ID = bytes.fromhex("1234ABCD567890EF")[::-1]
HEADER_BYTES, FORMAT_AT, SIZE_AT, TIME_AT, PARTITIONS_AT, PARTITION_BYTES, PARTITIONS = 108, 8, 12, 16, 24, 12, 7
#: Kinds of partition.
KINDS = {0: "none", 1: "event", 2: "neural", 3: "motion", 4: "audio", 8: "magnetometer"}
#: Fixed values of the motion sensor's inner blocks: mark, and places of offset and length words.
MOTION_MARK = (13579, 24680)
MOTION_PLACES = {"accelerometer": (2, 6), "gyroscope": (3, 7), "magnetometer": (4, 8)}


def block_starts(raw: bytes) -> list[int]:
    out, at = [], raw.find(BLOCK_ID)
    while at >= 0:
        out.append(at)
        at = raw.find(BLOCK_ID, at + len(BLOCK_ID))
    return out


def block_header(raw: bytes) -> dict:
    word = lambda at: struct.unpack_from("<I", raw, at)[0]
    parts = {}
    for k in range(PARTITIONS):
        at = PARTITIONS_AT + k * PARTITION_BYTES
        if kind := KINDS.get(word(at), "none"):
            if kind != "none":
                parts[kind] = (word(at + 4), word(at + 8))
    return {"format": word(FORMAT_AT), "size": word(SIZE_AT), "time": word(TIME_AT), "parts": parts}


class BlockReader(DataSourceReader):
    """One stream of a block file; a task takes whole blocks and reads nothing of other streams' rows."""

    def __init__(self, options: dict):
        self.path, self.stream = options["path"], options.get("stream", "neural")
        self.blocks = int(options.get("blocks", 64))

    def partitions(self):
        out = []
        for path, size in files(self.path):
            head = read_bytes(path, 0, min(size, 1 << 20))
            starts = block_starts(head)
            if not starts:
                if size:
                    raise ValueError(f"{path} has no block in its first {len(head)} bytes")
                continue
            step = block_header(head[starts[0] : starts[0] + HEADER_BYTES])["size"] or size
            for start in range(starts[0], size, step * self.blocks):
                out.append(Range(path, start, min(step * self.blocks, size - start), (start - starts[0]) // step))
        return out or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        raw = read_bytes(part.path, part.start, part.size) if part.size else b""
        starts = block_starts(raw)
        if raw and (not starts or starts[0] != 0):
            raise ValueError(f"{part.path} has blocks of different sizes: none begins at {part.start}")
        for k, start in enumerate(starts):
            header = block_header(raw[start : start + HEADER_BYTES])
            if self.stream in header["parts"]:
                at, size = header["parts"][self.stream]
                yield part.path, part.first + k, header["time"], np.frombuffer(raw[start + at : start + at + size], "<u2").astype(int).tolist()


class BlockSource(DataSource):
    """``blocks``: a row a block with the words of one stream."""

    @classmethod
    def name(cls):
        return "blocks"

    def schema(self):
        return "file string, block long, time_ms long, words array<int>"

    def reader(self, schema):
        return BlockReader(self.options)


def motion(words: np.ndarray, sensor: str) -> np.ndarray:
    """Signed values of one sensor from a motion stream's words, as rows of x, y, z."""
    offset_at, length_at = MOTION_PLACES[sensor]
    starts = np.flatnonzero((words[:-1] == MOTION_MARK[0]) & (words[1:] == MOTION_MARK[1]))
    parts = [words[s + words[s + offset_at] : s + words[s + offset_at] + words[s + length_at]] for s in starts if s + length_at < len(words)]
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return flat.astype(np.uint16).astype(np.int16).reshape(-1, 3)


class NpyReader(DataSourceReader):
    """Rows of arrays; ranges of rows where they are contiguous in the file."""

    def __init__(self, options: dict):
        self.path, self.range = options["path"], int(options.get("rangebytes", RANGE))

    @staticmethod
    def header(path: str) -> tuple[np.dtype, bool, tuple, int]:
        head = read_bytes(path, 0, 12)
        if head[:6] != b"\x93NUMPY":
            raise ValueError(f"{path} isn't an array file")
        wide = head[6] > 1
        size = struct.unpack("<I", head[8:12])[0] if wide else struct.unpack("<H", head[8:10])[0]
        text = read_bytes(path, 12 if wide else 10, size)
        spec = ast.literal_eval(text.decode("latin1"))
        return np.dtype(spec["descr"]), spec["fortran_order"], spec["shape"], (12 if wide else 10) + size

    def partitions(self):
        out = []
        for path, _ in files(self.path):
            if path.endswith(".npy"):
                dtype, _, shape, at = self.header(path)
                rows = shape[0] if shape else 1
                step = max(1, self.range // max(1, dtype.itemsize * int(np.prod(shape[1:], dtype=np.int64))))
                out += [Range(path, first, min(step, rows - first), at) for first in range(0, rows, step)]
        return out or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        dtype, fortran, shape, at = self.header(part.path)
        wide = int(np.prod(shape[1:], dtype=np.int64))
        if fortran and len(shape) > 1:
            # a column's rows stand together: the range's piece of each, then columns in the order of rows
            pieces = [np.frombuffer(read_bytes(part.path, at + (k * shape[0] + part.start) * dtype.itemsize, part.size * dtype.itemsize), dtype) for k in range(wide)]
            rows = np.stack(pieces, 1).reshape(part.size, *shape[:0:-1]).transpose(0, *range(len(shape) - 1, 0, -1))
        else:
            width = dtype.itemsize * wide
            rows = np.frombuffer(read_bytes(part.path, at + part.start * width, part.size * width), dtype)
        rows = rows.reshape(part.size, wide)
        if dtype.kind == "u" and dtype.itemsize == 8 and len(rows) and rows.max(initial=0) > np.iinfo(np.int64).max:
            raise ValueError(f"{part.path} has numbers beyond 64 bits with a sign")
        kind = {"b": bool, "i": np.int64, "u": np.int64}.get(dtype.kind, float)
        for first in range(0, part.size, step := max(1, (1 << 18) // max(1, wide))):
            some = rows[first : first + step].astype(kind)
            value = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * wide, pa.array(some.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([part.path] * len(some)), pa.array(part.start + first + np.arange(len(some))), value], ["file", "row", "value"])


class NpySource(DataSource):
    """``npy``: file, row number and the row's values: whole numbers as long, flags as boolean, others as double, by the first file's type."""

    @classmethod
    def name(cls):
        return "npy"

    def schema(self):
        first = next((p for p, _ in files(self.options["path"]) if p.endswith(".npy")), None)
        kind = NpyReader.header(first)[0].kind if first else "f"
        return f"file string, row long, value array<{ {'b': 'boolean', 'i': 'long', 'u': 'long'}.get(kind, 'double') }>"

    def reader(self, schema):
        return NpyReader(self.options)


#: Fixed values of spike snapshot files: marks of files with and without channel names, and scale.
SNAPSHOT_MANY, SNAPSHOT_ONE, SNAPSHOT_UV, SNAPSHOT_ZERO, ARTIFACT = 0x18F8474B, 0x18F88C00, 0.195, 32768, 128
RECORDING_MARK, NO_TEXT = 0xC6912702, 0xFFFFFFFF


def q_string(raw: bytes, at: int) -> tuple[str | None, int]:
    """A text of a 32-bit byte length and UTF-16 units, and where it ends."""
    size = struct.unpack_from("<I", raw, at)[0]
    if size == NO_TEXT:
        return None, at + 4
    return raw[at + 4 : at + 4 + size].decode("utf-16-le"), at + 4 + size


def zero_string(raw: bytes, at: int) -> tuple[str, int]:
    end = raw.index(b"\0", at)
    return raw[at:end].decode("latin1"), end + 1


class SnapshotReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range = options["path"], int(options.get("rangebytes", RANGE))
        self.artifacts = options.get("artifacts", "true").lower() == "true"

    @staticmethod
    def layout(path: str) -> dict:
        raw = read_bytes(path, 0, 1 << 16)
        mark = struct.unpack_from("<I", raw)[0]
        if mark not in (SNAPSHOT_MANY, SNAPSHOT_ONE):
            raise ValueError(f"{path} isn't a spike file")
        _, at = zero_string(raw, 6)
        channels, at = zero_string(raw, at)
        _, at = zero_string(raw, at)
        rate, before, after = struct.unpack_from("<fII", raw, at)
        many = mark == SNAPSHOT_MANY
        fields = ([("channel", "S5")] if many else []) + [("time", "<i4"), ("id", "u1")] + ([("wave", "<u2", (before + after,))] if before + after else [])
        return {"at": at + 12, "rate": rate, "record": np.dtype(fields), "only": channels.split(",")[0]}

    def partitions(self):
        out = []
        for path, size in files(self.path):
            record = (lay := self.layout(path))["record"].itemsize
            step = max(1, self.range // record) * record
            out += [Range(path, at, min(step, size - at) // record * record) for at in range(lay["at"], size, step)]
        return out or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        if not part.size:
            return
        lay = self.layout(part.path)
        for r in np.frombuffer(read_bytes(part.path, part.start, part.size), lay["record"]):
            if self.artifacts or r["id"] != ARTIFACT:
                name = r["channel"].decode() if "channel" in r.dtype.names else lay["only"]
                wave = (SNAPSHOT_UV * (r["wave"].astype(float) - SNAPSHOT_ZERO)).tolist() if "wave" in r.dtype.names else None
                yield part.path, name, float(r["time"]) / float(lay["rate"]), int(r["id"]), wave


class SnapshotSource(DataSource):
    """``spike_snapshots``: channel, time, id and waveform in microvolt; option artifacts=false drops marked ones."""

    @classmethod
    def name(cls):
        return "spike_snapshots"

    def schema(self):
        return "file string, channel string, t double, spike_id int, wave array<double>"

    def reader(self, schema):
        return SnapshotReader(self.options)


class ChunkReader(DataSourceReader):
    """Compressed chunks of time differences; the sidecar names their bounds, and only chunks that are asked for are read."""

    def __init__(self, options: dict):
        self.path, self.meta = options["path"], json.loads(read_bytes(options["meta"], 0))
        self.low, self.high = int(options.get("from", 0)), int(options.get("to", 1 << 62))

    def partitions(self):
        bounds, offsets = self.meta["chunk_bounds"], self.meta["chunk_offsets"]
        chosen = [k for k in range(len(bounds) - 1) if bounds[k] < self.high and bounds[k + 1] > self.low]
        return [Range(self.path, offsets[k], offsets[k + 1] - offsets[k], bounds[k]) for k in chosen] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        n = self.meta["n_channels"]
        raw = np.frombuffer(zlib.decompress(read_bytes(part.path, part.start, part.size)), np.dtype(self.meta["dtype"]))
        value = np.cumsum(raw.reshape(n, -1).T, 0, dtype=raw.dtype)
        sample = part.first + np.arange(len(value))
        value, sample = value[(sample >= self.low) & (sample < self.high)], sample[(sample >= self.low) & (sample < self.high)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(sample, n)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(value))), pa.array(value.ravel().astype(np.int32))], ["sample", "channel", "adc"]
        )


class ChunkSource(DataSource):
    """``diff_chunks``: options path, meta, from, to."""

    @classmethod
    def name(cls):
        return "diff_chunks"

    def schema(self):
        return "sample long, channel int, adc int"

    def reader(self, schema):
        return ChunkReader(self.options)


def register(spark: SparkSession) -> None:
    for source in (FlatSource, BlockSource, NpySource, SnapshotSource, ChunkSource):
        spark.dataSource.register(source)
