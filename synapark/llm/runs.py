"""Periodic runs of words, found through multi-scale minimizers."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import flat_ranges, mix64, slices

#: Words of a shortest run.
LEAST = 12
#: Periods below this are found by comparing the words with themselves at each lag.
SHORT = 32
#: Bits of a place in the keys of window minima.
_PLACE = 30

FIELDS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


class Grams:
    """Names of the 2**t words from each place on: equal names mean equal words, and a place whose words occur once has a name of its own."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.levels = [self._named(words.astype(np.int64), np.arange(self.n))]

    def _named(self, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = -1 - np.arange(self.n, dtype=np.int64)
        _, name, count = np.unique(keys, return_inverse=True, return_counts=True)
        twice = count[name] > 1
        out[at[twice]] = name[twice]
        return out

    def level(self, t: int) -> np.ndarray:
        while len(self.levels) <= t:
            last, width = self.levels[-1], 1 << (len(self.levels) - 1)
            at = np.flatnonzero((last[: self.n - width] >= 0) & (last[width:] >= 0)) if self.n > width else np.zeros(0, np.int64)
            self.levels.append(self._named(last[at] << 32 | last[at + width], at))
        return self.levels[t]

    def top(self) -> int:
        """The greatest level at which something occurs twice."""
        t = 0
        while (self.level(t) >= 0).any():
            t += 1
        return t - 1

    def reach(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """Words in common from ``a`` and ``b`` on (``way`` 1), or before them (-1)."""
        got = np.zeros(len(a), np.int64)
        for t in range(self.top(), -1, -1):
            name, width = self.levels[t], 1 << t
            i, j = (a + got, b + got) if way > 0 else (a - got - width, b - got - width)
            fine = (np.minimum(i, j) >= 0) & (np.maximum(i, j) < self.n)
            i, j = np.where(fine, i, 0), np.where(fine, j, 0)
            got += np.where(fine & (name[i] == name[j]) & (name[i] >= 0), width, 0)
        return got


def minima(key: np.ndarray, width: int) -> np.ndarray:
    """The least key of each window of ``width`` places, a power of two."""
    step = 1
    while step < width and len(key) > step:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    return key if step == width else key[:0]


def lagged(words: np.ndarray, lag: int) -> np.ndarray:
    """Runs of period ``lag`` by comparing all words with those ``lag`` later: rows of start, end, period."""
    if len(words) <= lag:
        return np.zeros((0, 3), np.int64)
    edge = np.diff(np.r_[0, (words[:-lag] == words[lag:]).astype(np.int8), 0])
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + lag
    enough = end - start >= max(LEAST, 2 * lag)
    return np.stack([start[enough], end[enough], np.full(enough.sum(), lag)], 1).astype(np.int64)


def smallest(runs: np.ndarray) -> np.ndarray:
    """One row a stretch, with its smallest period, by start and then period.

    A stretch of twice a period at least that has a smaller one too is a run of
    a divisor, with the same ends.
    """
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(1)][: len(runs)]
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def touching(runs: np.ndarray, grams: Grams) -> np.ndarray:
    """Runs of one period and the same words that begin before or where the one before them ends.

    Rows of both runs' ends, the period and a lag that brings their words together.
    """
    runs = runs[np.lexsort((runs[:, 0], runs[:, 2]))]
    first, second = runs[:-1], runs[1:]
    met = (first[:, 2] == second[:, 2]) & (second[:, 0] <= first[:, 1])
    first, second = first[met], second[met]
    period = first[:, 2]
    pair = np.repeat(np.arange(len(first)), period)
    place = flat_ranges(first[:, 1] - 2 * period + 1, period)
    hit = grams.reach(place, second[pair, 0], 1) >= period[pair]
    pair, place = pair[hit], place[hit]
    return np.column_stack([first[pair, :2], second[pair, :2], period[pair], second[pair, 0] - place])


def seeds(grams: Grams, t: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags from 2**t to 2**(t+1) of which every run of such a period has one at least.

    Windows of 2**(t-1) names of 2**(t-1) words lie in a run's first period and
    again a period later, so their minima repeat at that distance. Names that
    have half their length as a period are left out: they can be dense, and all
    lie in ``runs`` of shorter periods. The names left are more than 2**(t-2)
    places apart where they are equal, so a place has few partners. A run whose
    windows are all left out is made of two touching runs of one shorter period.
    """
    width = 1 << (t - 1)
    name = grams.level(t - 1)
    short = runs[runs[:, 2] <= width // 2]
    inside = short[short[:, 1] - short[:, 0] >= width]
    edge = np.zeros(grams.n + 1, np.int64)
    np.add.at(edge, inside[:, 0], 1)
    np.add.at(edge, inside[:, 1] - width + 1, -1)
    dense = np.cumsum(edge)[:-1] > 0
    high = np.uint64(1 << (64 - _PLACE)) - np.uint64(1)
    place = np.arange(grams.n, dtype=np.uint64)
    shut = dense | (name < 0)
    # a name that occurs once has no partner, but its window has to choose it all the same
    drawn = np.where(dense, high, mix64(np.where(name < 0, grams.n - 1 - name, name).astype(np.uint64)) >> np.uint64(_PLACE + 1))
    chosen = minima(drawn << np.uint64(_PLACE) | place, width)
    at = np.unique(chosen & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    at = at[~shut[at]]
    at = at[np.lexsort((at, name[at]))]
    found, lags, left, apart = [], [], np.arange(len(at)), 1
    while len(left):
        left = left[left + apart < len(at)]
        gap = at[left + apart] - at[left]
        left = left[(name[at[left + apart]] == name[at[left]]) & (gap < 2 << t)]
        gap = at[left + apart] - at[left]
        far = gap >= 1 << t
        found.append(at[left[far]])
        lags.append(gap[far])
        apart += 1
    pairs = touching(short, grams)
    if len(pairs):
        low, period, most = pairs[:, 5], pairs[:, 4], np.minimum(pairs[:, 1] - pairs[:, 0], pairs[:, 3] - pairs[:, 2])
        begin = low + np.maximum(0, -(-((1 << t) - low) // period)) * period
        number = np.maximum(0, (np.minimum(most, (2 << t) - 1) - begin) // period + 1)
        pair = np.repeat(np.arange(len(pairs)), number)
        lag = begin[pair] + flat_ranges(np.zeros(len(pairs)), number) * period[pair]
        found.append(np.maximum(pairs[pair, 0], pairs[pair, 2] - lag))
        lags.append(lag)
    return np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0, np.int64), *lags])


def periodic_runs(words: np.ndarray) -> np.ndarray:
    """All runs of a sequence of numbers: rows of start, end and smallest period, by start and then period.

    Work is about n log n log n in the number of words, whatever repeats.
    """
    if len(words) < LEAST:
        return np.zeros((0, 3), np.int64)
    runs = smallest(np.concatenate([lagged(words, lag) for lag in range(1, SHORT)]))
    grams, t = Grams(words), SHORT.bit_length() - 1
    while (grams.level(t - 1) >= 0).any():
        place, lag = seeds(grams, t, runs)
        if len(place):
            start = place - grams.reach(place, place + lag, -1)
            end = place + lag + grams.reach(place, place + lag, 1)
            enough = end - start >= np.maximum(LEAST, 2 * lag)
            runs = smallest(np.concatenate([runs, np.stack([start, end, lag], 1)[enough]]))
        t += 1
    return runs


def repeated(doc_id: int | None, n: int) -> np.ndarray:
    """Which word stands at each place of a document: of every tenth id a stretch is repeated to the end, of others all stay."""
    place = np.arange(n)
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or not n:
        return place
    g = h // 10
    a = g % n
    return np.where(place < a, place, a + (place - a) % (1 + (n - a) // (3 + g % 8)))


def summary(words: list[bytes], runs: np.ndarray) -> tuple:
    """Number of runs, the longest's figures, a digest of all, and one of the words without what repeats."""
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs.tolist())
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    kept = b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()])
    best: tuple = (None, None, None, None)
    if len(runs):
        s, e, q = runs[np.lexsort((runs[:, 2], runs[:, 0], runs[:, 0] - runs[:, 1]))[0]].tolist()
        best = (s, e - s, q, 1000 * (e - s) // q)
    return len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def _found(ids: list, texts: list) -> list[tuple]:
    """Rows of some documents, whose words lie behind one another with a word between that occurs once."""
    known: dict[bytes, int] = {}
    each, codes = [], []
    for k, (doc_id, text) in enumerate(zip(ids, texts, strict=True)):
        words = (text or "").encode("utf-8", "replace").split()
        order = repeated(doc_id, len(words)).tolist()
        words = [words[i] for i in order]
        each.append(words)
        codes.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
        codes.append(np.array([-1 - k], np.int64))
    runs = periodic_runs(np.concatenate(codes))
    sizes = np.array([len(w) + 1 for w in each], np.int64)
    begin = np.cumsum(sizes) - sizes
    cuts = np.searchsorted(runs[:, 0], np.r_[begin, sizes.sum()])
    return [(doc_id, *summary(w, runs[i:j] - np.array([b, b, 0]))) for doc_id, w, b, i, j in zip(ids, each, begin.tolist(), cuts[:-1], cuts[1:], strict=True)]


def runs_of(docs: DataFrame) -> DataFrame:
    """Runs of repeated words in every whole text, and the text with each repetition collapsed.

    Words are runs of characters other than ASCII white space. A run is a stretch
    of words with a smallest period q, of at least 12 words and two periods, that
    cannot be extended. In texts of ids that ``repeated`` names a stretch is
    repeated first. Periods below 32 words are found by comparing at each lag,
    longer ones a scale at a time: minima of windows of names of word runs repeat
    at the period's distance, and each pair of equal minima is extended both ways.
    All runs are found, and the work is nearly linear in the words.

    Returns doc_id, n_runs, start, length, period and exponent_milli of the run of
    the greatest length (ties: smallest start, then period; null without runs),
    runs_sha256 (of all runs' ``start,length,period`` lines) and collapsed_sha256
    (of the words outside runs or in a run's first period, joined by a space).

    One narrow map, no shuffle: rows stay where they are, and an executor's loss
    repeats its partitions. A null or empty text has no words and no runs; the text
    of a null id is taken as it is; repeated rows give a row each; other columns
    are ignored; no rows give none.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FIELDS.split(", ")]
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            texts = batch["text"].tolist()
            for i, j in slices(texts):
                yield pd.DataFrame(_found(ids[i:j], texts[i:j]), columns=names).astype({n: "Int64" for n in names[:6]})

    return docs.select("doc_id", "text").mapInPandas(run, FIELDS)
