"""Recordings whose header plans the layout of their data blocks: several kinds of signals of different rates in one file."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from .binary import RANGE, RECORDING_MARK, Range, files, q_string, read_bytes

# Fixed values of the format: kinds of signals by number.
KINDS = ("amplifier", "auxiliary", "supply", "adc", "digital_in", "digital_out")
# Fixed values of the format: samples of a block before version 2 and from it on, and how many of them share an auxiliary one.
SHORT_BLOCK, LONG_BLOCK, SLOWER = 60, 128, 4
# Fixed values of the format: scale and zero of each kind (microvolt for amplifiers, volt, degrees), and of the board's inputs by its mode.
SCALE = {"amplifier": (0.195, 32768), "auxiliary": (37.4e-6, 0), "supply": (74.8e-6, 0), "temperature": (0.01, 0)}
BOARD = {1: (152.59e-6, 32768), 13: (312.5e-6, 32768)}
BOARD_OTHER = (50.354e-6, 0)


@dataclass
class Plan:
    """Where the blocks begin, what one holds, and the channels of each kind."""

    version: tuple[int, int]
    rate: float
    mode: int
    at: int
    channels: dict[str, list[dict]] = field(default_factory=dict)
    temperatures: int = 0

    @property
    def samples(self) -> int:
        return LONG_BLOCK if self.version >= (2, 0) else SHORT_BLOCK

    @property
    def block(self) -> np.dtype:
        n, many = self.samples, {k: len(v) for k, v in self.channels.items()}
        fields = [("t", "<i4" if self.version >= (1, 2) else "<u4", (n,)), ("amplifier", "<u2", (many["amplifier"], n)), ("auxiliary", "<u2", (many["auxiliary"], n // SLOWER)), ("supply", "<u2", (many["supply"], 1))]
        fields += [("temperature", "<i2", (self.temperatures, 1)), ("adc", "<u2", (many["adc"], n))]
        fields += [(k, "<u2", (n,)) for k in ("digital_in", "digital_out") if many[k]]  # all lines in one word
        return np.dtype([f for f in fields if 0 not in f[2]])


def header_plan(path: str) -> Plan:
    """The plan of a file from its header, of which as much is read as it takes."""
    size = 1 << 16
    while True:
        raw = read_bytes(path, 0, size)
        try:
            return _plan(path, raw)
        except (struct.error, UnicodeDecodeError):
            if len(raw) < size:
                raise ValueError(f"{path} ends inside its header") from None
            size *= 4


def _plan(path: str, raw: bytes) -> Plan:
    mark, major, minor, rate = struct.unpack_from("<Ihhf", raw)
    if mark != RECORDING_MARK:
        raise ValueError(f"{path} isn't a recording")
    version, at = (major, minor), 12 + 2 + 24 + 2 + 8
    for _ in range(3):  # notes
        _, at = q_string(raw, at)

    def short() -> int:
        nonlocal at
        at += 2
        return struct.unpack_from("<h", raw, at - 2)[0]

    temperatures = short() if version >= (1, 1) else 0
    mode = short() if version >= (1, 3) else 0
    if version >= (2, 0):
        _, at = q_string(raw, at)  # reference channel
    channels: dict[str, list[dict]] = {k: [] for k in KINDS}
    for _ in range(short()):
        group, at = q_string(raw, at)
        _, at = q_string(raw, at)
        enabled, number, _ = short(), short(), short()
        for _ in range(number if enabled else 0):
            native, at = q_string(raw, at)
            custom, at = q_string(raw, at)
            order, _, kind, on, *_ = struct.unpack_from("<10hff", raw, at)
            at += 28
            if on:
                channels[KINDS[kind]].append({"native": native, "name": custom or native, "order": order, "group": group})
    struct.unpack_from("<0s", raw, at)
    if at > len(raw):
        raise struct.error
    return Plan(version, rate, mode, at, channels, temperatures)


class RecordingReader(DataSourceReader):
    """Ranges of whole blocks; a block that is cut off at the end isn't read."""

    def __init__(self, options: dict):
        self.path, self.range = options["path"], int(options.get("rangebytes", RANGE))
        self.kind, self.suffix = options.get("kind", "amplifier"), options.get("suffix", ".rhd")
        if self.kind not in (*KINDS, "temperature"):
            raise ValueError(f"no kind of signal {self.kind}")

    def partitions(self):
        out = []
        for path, size in files(self.path):
            if path.endswith(self.suffix):
                plan = header_plan(path)
                width = plan.block.itemsize
                blocks, step = max(0, size - plan.at) // width, max(1, self.range // width)
                out += [Range(path, plan.at + k * width, min(step, blocks - k) * width, k) for k in range(0, blocks, step)]
        return out or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.size:
            return
        plan = header_plan(part.path)
        if self.kind not in (plan.block.names or ()):
            return
        step = max(1, (1 << 22) // plan.block.itemsize)
        names = [f"temperature{k}" for k in range(plan.temperatures)] if self.kind == "temperature" else [c["name"] for c in plan.channels[self.kind]]
        for first in range(0, part.size // plan.block.itemsize, step):
            number = min(step, part.size // plan.block.itemsize - first)
            rows = np.frombuffer(read_bytes(part.path, part.start + first * plan.block.itemsize, number * plan.block.itemsize), plan.block)
            raw, t = rows[self.kind], rows["t"].astype(np.int64)
            if self.kind.startswith("digital"):
                raw = np.stack([raw >> c["order"] & 1 for c in plan.channels[self.kind]], 1).astype(float)
            else:
                scale, zero = (BOARD.get(plan.mode, BOARD_OTHER) if self.kind == "adc" else SCALE[self.kind]) if self.kind != "temperature" else SCALE["temperature"]
                raw = scale * (raw.astype(float) - zero)
            at = np.repeat(t[:, None, :: t.shape[1] // raw.shape[2]], raw.shape[1], 1)  # each value bears the first sample that it stands for
            name = np.broadcast_to(np.arange(raw.shape[1], dtype=np.int32)[None, :, None], raw.shape)
            channel = pa.DictionaryArray.from_arrays(pa.array(name.ravel()), pa.array(names)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([part.path] * raw.size), channel, pa.array(at.ravel()), pa.array(raw.ravel())], ["file", "channel", "sample", "v"])


class RecordingSource(DataSource):
    """``recording``: one kind of signal of traditional recordings below a path, scaled. Options path, kind (amplifier, auxiliary, supply, temperature, adc, digital_in, digital_out), suffix, rangebytes."""

    @classmethod
    def name(cls):
        return "recording"

    def schema(self):
        return "file string, channel string, sample long, v double"

    def reader(self, schema):
        return RecordingReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordingSource)
