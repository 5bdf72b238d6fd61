"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text that a numpy helper looks at in one go; bounds its temporaries whatever the batch holds.
SLICE_BYTES = 2_000_000


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    The folder is the session's ``spark.checkpoint.dir``. Only where none is set and
    all tasks run on this machine, as in tests, is a temporary one made; on a
    cluster other machines would not see it, so there that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="synapark-checkpoint-"))
    return df.checkpoint()


def sized(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """``df``, written down, in partitions of about ``rows`` rows where it has more of them.

    What comes out of a selective step is small against its partitions; every
    later shuffle then has as many pieces as its rows are worth. No shuffle here.
    """
    held = cut(df)
    return held.coalesce(max(1, -(-held.count() // rows)))


def spread(df: DataFrame, limit: int, size: Column) -> DataFrame:
    """``df``, written down, in partitions of about ``limit`` bytes by the sum of ``size`` where it has more of them."""
    held = cut(df)
    return held.coalesce(max(1, -(-(held.agg(F.sum(size)).first()[0] or 0) // limit)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; an id that is null falls into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(0))


def slices(texts: list, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` characters, or of one longer text."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held > limit and i > start:
            yield start, i
            start, held = i, len(text or "")
    if start < len(texts):
        yield start, len(texts)


def flat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0] .. starts[0]+lengths[0]-1, starts[1] .. and so on, as one array."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts.astype(np.int64), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))
