"""Keyed state of its own kind for online operators, and a growing recording as a stream with its own offsets.

The operators need Spark's RocksDB state store: ``use_rocksdb(spark)`` sets it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.signal import run_sections, steady
from ..sources.binary import files, read_bytes

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def _together(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values("sample", kind="stable")


class _Online(StatefulProcessor):
    """One channel's operator; ``ttl`` milliseconds after its last sample its state goes."""

    def __init__(self, ttl: int | None):
        self.ttl = ttl

    def close(self) -> None:
        pass


class Filter(_Online):
    """A causal filter: the last sample and the delay line are its state."""

    def __init__(self, sos: np.ndarray, ttl: int | None):
        super().__init__(ttl)
        self.sos = sos

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.line = handle.getValueState("line", "last long, line array<double>", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _together(rows)
        line = None
        if self.line.exists():
            last, line = self.line.get()
            found, line = found[found["sample"] > last], np.array(line).reshape(len(self.sos), 2)
        if len(found):
            x = found["v"].to_numpy(float)
            y, line = run_sections(self.sos, x, steady(self.sos, x[0]) if line is None else line)
            self.line.update((int(found["sample"].iloc[-1]), line.ravel().tolist()))
            yield pd.DataFrame({"channel": key[0], "sample": found["sample"].to_numpy(), "v": y})


class Standardise(_Online):
    """Mean and deviation of all samples so far: count, mean and sum of squares about it, which don't cancel."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", "n long, mean double, m2 double", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _together(rows)
        x = found["v"].to_numpy(float)
        n, mean, m2 = self.moments.get() if self.moments.exists() else (0, 0.0, 0.0)
        own, middle = len(x), x.mean()
        m2 += float(((x - middle) ** 2).sum()) + (middle - mean) ** 2 * n * own / (n + own)
        mean += (middle - mean) * own / (n + own)
        self.moments.update((n + own, float(mean), m2))
        sd = np.sqrt(m2 / max(1, n + own - 1))
        yield pd.DataFrame({"channel": key[0], "sample": found["sample"].to_numpy(), "v": (x - mean) / sd if sd else x * 0})


class Threshold(_Online):
    """-1, 0 or 1 against mean +- factor * deviation of the last ``kept`` values, which are list state."""

    def __init__(self, kept: int, factor: float, ttl: int | None):
        super().__init__(ttl)
        self.kept, self.factor = kept, factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", "v double", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        found = _together(rows)
        ring = np.array([v for (v,) in self.ring.get()] if self.ring.exists() else [], float)
        both = np.r_[ring, found["v"].to_numpy(float)]
        middle = both.mean()
        sums, squares = (np.r_[0.0, np.cumsum(v)] for v in (both - middle, (both - middle) ** 2))
        end = len(ring) + 1 + np.arange(len(found))
        start = np.maximum(0, end - self.kept)
        mean = (sums[end] - sums[start]) / (end - start)
        sd = np.sqrt(np.maximum(0.0, (squares[end] - squares[start]) / (end - start) - mean**2))
        x = both[len(ring) :] - middle
        self.ring.put([(float(v),) for v in both[-self.kept :]])
        yield pd.DataFrame({"channel": key[0], "sample": found["sample"].to_numpy(), "v": (x > mean + self.factor * sd).astype(float) - (x < mean - self.factor * sd)})


def _run(stream: DataFrame, processor: _Online) -> DataFrame:
    fields = f"channel {stream.schema['channel'].dataType.simpleString()}, sample long, v double"
    mode = "None" if processor.ttl is None else "ProcessingTime"
    return stream.groupBy("channel").transformWithStateInPandas(statefulProcessor=processor, outputStructType=fields, outputMode="Append", timeMode=mode)


def online_filter(stream: DataFrame, sos: np.ndarray, ttl: int | None = None) -> DataFrame:
    """Each channel's samples (channel, sample, v) through a causal filter; samples at or before the last one filtered are dropped."""
    return _run(stream, Filter(np.asarray(sos), ttl))


def online_standardise(stream: DataFrame, ttl: int | None = None) -> DataFrame:
    """Each sample against mean and deviation of its channel's samples up to its batch."""
    return _run(stream, Standardise(ttl))


def adaptive_threshold(stream: DataFrame, kept: int = 100, factor: float = 0.5, ttl: int | None = None) -> DataFrame:
    """Whether each value lies below, in or above the band of the last ``kept`` ones."""
    return _run(stream, Threshold(kept, factor, ttl))


@dataclass
class Frames(InputPartition):
    path: str
    first: int
    number: int


class GrowingReader(DataSourceStreamReader):
    """Offsets are sample numbers: a batch is what was recorded since the last one, at most ``maxsamples`` of it, in ranges for several tasks."""

    def __init__(self, options: dict):
        self.path, self.channels = options["path"], int(options.get("channels", 1))
        self.dtype = np.dtype(options.get("dtype", "<i2"))
        self.skip, self.first = int(options.get("skip", 0)), int(options.get("minsample", 0))
        self.most, self.range = int(options.get("maxsamples", 1 << 24)), int(options.get("rangesamples", 1 << 20))
        self.seen: int | None = None

    def frames(self) -> int:
        """Whole frames that are there; a frame that is just being written isn't."""
        size = files(self.path)[0][1]
        return max(0, (size - self.skip) // (self.dtype.itemsize * self.channels))

    def initialOffset(self) -> dict:
        return {"sample": self.first}

    def latestOffset(self) -> dict:
        # bounds a batch by what the last one reached
        start = self.first if self.seen is None else self.seen
        return {"sample": max(start, min(self.frames(), start + self.most))}

    def partitions(self, start: dict, end: dict) -> list[Frames]:
        self.seen = end["sample"]
        return [Frames(self.path, at, min(self.range, end["sample"] - at)) for at in range(start["sample"], end["sample"], self.range)]

    def commit(self, end: dict) -> None:
        self.seen = max(self.seen or 0, end["sample"])

    def read(self, part: Frames) -> Iterator[pa.RecordBatch]:
        width = self.dtype.itemsize * self.channels
        value = np.frombuffer(read_bytes(part.path, self.skip + part.first * width, part.number * width), self.dtype)
        channel = np.tile(np.arange(self.channels, dtype=np.int32), part.number)
        sample = part.first + np.repeat(np.arange(part.number), self.channels)
        for at in range(0, len(value), 1 << 18):
            cut = slice(at, at + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(channel[cut]), pa.array(sample[cut]), pa.array(value[cut].astype(float))], ["channel", "sample", "v"])


class GrowingSource(DataSource):
    """``growing``: an interleaved recording that is still being written, as a stream. Options path, channels, dtype, skip, minsample, maxsamples, rangesamples."""

    @classmethod
    def name(cls):
        return "growing"

    def schema(self):
        return "channel int, sample long, v double"

    def streamReader(self, schema):
        return GrowingReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GrowingSource)
