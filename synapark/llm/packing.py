"""Vector best-fit packing of token runs into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, slices
from .words import WordCoder

#: Side of an attention tile in tokens.
TILE = 128
#: An encoder lives as long as its Python worker, so that words met by one task are known to the next.
_coders: dict[int, WordCoder] = {}


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Token runs of at most ``capacity``: doc_id, piece, start, length, ids_crc32, part.

    A document's run is its ids and ``end_id``; only a longer one is cut. A null
    or empty text is the end id alone. ``part`` is the partition that made the row.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())  # of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text = content.value
        key = zlib.crc32(text.encode())
        coder = _coders.setdefault(key, None) or WordCoder(text)
        _coders[key] = coder
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            names = batch["doc_id"].tolist()
            for i, j in slices(texts, 1_000_000):
                ids, counts = coder.encode(texts[i:j])
                ends = np.cumsum(counts)
                rows = []
                for name, a, b in zip(names[i:j], (ends - counts).tolist(), ends.tolist(), strict=True):
                    own = np.r_[ids[a:b], end_id].astype("<u4")
                    for nth, at in enumerate(range(0, len(own), capacity)):
                        part = own[at : at + capacity]
                        rows.append((name, nth, at, len(part), zlib.crc32(part.tobytes())))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).convert_dtypes()

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return made.mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long").withColumn("part", F.spark_partition_id())


def tiles(length: int) -> int:
    """Attention cost of a run: square tiles of ``TILE`` tokens that a causal kernel visits for it.

    A run stands anywhere in its sequence, so it may touch a tile more than it
    fills; a sequence's triangle of tiles is then made of its runs' triangles.
    """
    side = -(-length // TILE) + 1
    return side * (side + 1) // 2


def best_fit(counts: dict[int, int], capacity: int, documents: int, attention: int, weights: tuple[float, float, float]) -> np.ndarray:
    """Plan for ``counts[length]`` runs of each length: rows of length, first run, number, first bin, offset.

    Lengths go from long to short. A bin has three residual capacities: tokens,
    documents and attention cost (``tiles`` of its runs). Of the bins in
    which a run fits on all three, it takes the one whose residual after it has
    the least weighted norm, each residual in parts of its capacity; a bin is
    opened only when none fits. Bins of one history are held as one interval, so
    the work grows with the different lengths, not with the number of runs.
    """
    state = np.zeros((5, 1024), np.int64)  # residual tokens, documents, attention; first bin, number
    used, bins = 0, 0
    scale = (capacity, documents, attention)
    out: list[tuple[int, int, int, int, int]] = []
    if counts and attention < tiles(max(counts)):
        raise ValueError("a run alone is beyond the attention capacity")
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        need = (length, 1, tiles(length))
        while left:
            if used > state.shape[1] - 3:  # drop full bins, then grow if that freed little
                live = state[:, :used][:, (state[:3, :used] > 0).all(0)]
                used = live.shape[1]
                state = np.concatenate([live, np.zeros((5, max(1024, used)), np.int64)], 1)
            fits = np.flatnonzero(state[0, :used] >= length)
            fits = fits[(state[1, fits] >= 1) & (state[2, fits] >= need[2])]
            if len(fits):
                norm = sum(w * ((state[d, fits] - need[d]) / scale[d]) ** 2 for d, w in enumerate(weights))
                k = int(fits[np.argmin(norm)])
            else:
                each = max(1, min(capacity // length, documents, attention // need[2]))
                number = max(1, left // each)
                k = used
                used, bins = used + 1, bins + number
                state[:, k] = capacity, documents, attention, bins - number, number
            number = int(min(left, state[4, k]))
            out.append((length, rank, number, int(state[3, k]), int(capacity - state[0, k])))
            if rest := state[4, k] - number:  # the others stay as they were
                state[:, used] = state[:, k]
                state[3, used] += number
                state[4, used] = rest
                used += 1
            state[:3, k] -= need
            state[4, k] = number
            left, rank = left - number, rank + number
    return np.array(out, np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    end_id: int = 1,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``documents`` and ``attention`` (``tiles`` of all runs) are the other capacities
    of a sequence. By default they are what a sequence of any mix of runs may take,
    so that they cost no sequence and only weigh in the choice of a bin; tighter
    ones bind. Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Runs of one length take their places by doc_id and piece within a partition,
    and by partition; equal ones in any order.

    Texts are encoded once, in a map; only the small rows of runs are written
    down. The plan is made from how many runs there are of each length: at most
    ``capacity`` figures, whatever the corpus. Each run then takes its place in
    the plan by its rank among the runs of its length, counted per partition and
    offset by the partitions before it, so no length is gathered in one task.
    The plan has a row for each length and state of a bin that it meets, not for each run.

    A null text counts as empty; repeated rows are packed each; no rows give
    none; other columns are ignored.
    """
    documents, attention = documents or capacity, attention or capacity * tiles(1)  # no run costs more a token than the shortest
    rows = cut(pieces(docs, vocabulary, capacity, end_id))
    each = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = cut(each.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    plan = best_fit(counts, capacity, documents, attention, weights)
    inside = Window.partitionBy("part", "length").orderBy("doc_id", "piece")
    ranked = (
        rows.withColumn("nth", F.row_number().over(inside) - 1)
        .join(each.select("length", "part", "before"), ["length", "part"])
        .withColumn("rank", F.col("before") + F.col("nth"))
    )
    sent = docs.sparkSession.sparkContext.broadcast(plan[np.lexsort((plan[:, 1], -plan[:, 0]))])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plan = sent.value
        stride = np.int64(1) << 50
        keys = -plan[:, 0] * stride + plan[:, 1]
        for batch in batches:
            at = np.searchsorted(keys, -batch["length"].to_numpy() * stride + batch["rank"].to_numpy(), side="right") - 1
            batch["sequence_id"] = plan[at, 3] + batch["rank"].to_numpy() - plan[at, 1]
            batch["offset"] = plan[at, 4]
            yield batch.drop(columns="rank")

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*names, "rank").mapInPandas(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
