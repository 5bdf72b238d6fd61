"""A convolutional text classifier for toxicity, trained in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, slices
from .language import sampled

BUCKETS, EMBED, FILTERS, WIDTHS = 1 << 15, 8, 8, (1, 2, 3)
#: A word's embedding is that of its hash plus those of its first so many bytes, so that
#: inflected forms share what they begin with. Bucket 0 stands for none and stays zero.
BEGINNINGS = (4, 5, 6)
#: ASCII letters in lower case, digits and other scripts' bytes stay; the rest parts words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))
#: Words remembered by a worker before it starts afresh.
MEMORY = 300_000


class Numbers(dict):
    """Numbers of words; ``parts`` has each word's buckets: the word and its longer beginnings."""

    def __init__(self):
        super().__init__()
        self.parts: list[tuple[int, ...]] = []
        self.known = np.zeros((0, 1 + len(BEGINNINGS)), np.int32)

    def buckets(self) -> np.ndarray:
        """``parts`` as an array, extended by the words that are new since the last call."""
        if len(self.known) < len(self.parts):
            self.known = np.concatenate([self.known, np.array(self.parts[len(self.known) :], np.int32)])
        return self.known

    def __missing__(self, word: bytes) -> int:
        self[word] = i = len(self)
        self.parts.append((1 + zlib.crc32(word) % (BUCKETS - 1), *(1 + zlib.crc32(word[:n], n) % (BUCKETS - 1) if len(word) > n else 0 for n in BEGINNINGS)))
        return i


def hashed(texts: list[str], known: Numbers) -> list[np.ndarray]:
    """The numbers of each text's words."""
    out = []
    for text in texts:
        words = text.encode("utf-8", "replace").translate(_TABLE).split()
        out.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
    return out


class Net:
    """Embeddings, filters of several widths, max pooling over the text, a logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embed = rng.normal(0, 0.05, (BUCKETS, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.filters = [rng.normal(0, 0.4, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = np.zeros((len(WIDTHS), FILTERS), np.float32)
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def words(self, parts: np.ndarray) -> np.ndarray:
        return self.embed[parts].sum(1)

    def tables(self, words: np.ndarray) -> list[np.ndarray]:
        """What each word, given its embedding, adds at each place of each width's window."""
        return [np.stack([words @ f[k] for k in range(len(f))]) for f in self.filters]

    def pooled(self, texts: list[np.ndarray], tables: list[np.ndarray], winners: bool = False):
        """Largest activation of each filter over each text, at least 0 (and where it was)."""
        gap = np.zeros(max(WIDTHS) - 1, np.int32)
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = np.concatenate([np.concatenate([t, gap]) for t in texts]) if texts else gap
        ends = np.cumsum(sizes + len(gap))
        firsts = ends - sizes - len(gap)
        result = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        where = np.full(result.shape, -1, np.int64)
        for n, (width, table) in enumerate(zip(WIDTHS, tables, strict=True)):
            full = np.flatnonzero(sizes >= width)
            if not len(full):
                continue
            act = table[0][flat[: len(flat) - width + 1]]
            for k in range(1, width):
                act += table[k][flat[k : len(flat) - width + 1 + k]]
            # windows that run past their text count for nothing
            edges = np.stack([firsts[full], firsts[full] + sizes[full] - width + 1], 1).ravel()
            best = np.maximum.reduceat(np.concatenate([act, act[-1:]]), np.minimum(edges, len(act)), axis=0)[::2]
            block = slice(n * FILTERS, (n + 1) * FILTERS)
            result[full, block] = np.maximum(0, best + self.shift[n])
            if winners:
                for row, (a, b) in zip(full, edges.reshape(-1, 2), strict=True):
                    where[row, block] = a + act[a:b].argmax(0)
        return (result, where, flat) if winners else result

    def logits(self, texts: list[np.ndarray], parts: np.ndarray) -> np.ndarray:
        texts, parts = narrowed(texts, parts)
        return self.pooled(texts, self.tables(self.words(parts))) @ self.out + self.bias[0]

    def fit(self, texts: list[np.ndarray], parts: np.ndarray, labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        weight = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
        held = [self.embed, *self.filters, self.shift, self.out, self.bias]
        first, second = [np.zeros_like(x) for x in held], [np.zeros_like(x) for x in held]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                grads = self.gradients(*narrowed([texts[i] for i in some], parts), labels[some], weight[some])
                step += 1
                for x, g, m, v in zip(held, grads, first, second, strict=True):  # Adam
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def gradients(self, texts: list[np.ndarray], parts: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        words = self.words(parts)
        pooled, where, flat = self.pooled(texts, self.tables(words), winners=True)
        logit = pooled @ self.out + self.bias[0]
        error = ((1 / (1 + np.exp(-logit)) - labels) * weight / len(labels)).astype(np.float32)
        back = np.where(pooled > 0, error[:, None] * self.out, 0)  # only the winning window of a filter learns
        embed = np.zeros_like(self.embed)
        filters = [np.zeros_like(f) for f in self.filters]
        shift = np.zeros_like(self.shift)
        for n, width in enumerate(WIDTHS):
            block = back[:, n * FILTERS : (n + 1) * FILTERS]
            row, col = np.nonzero(block)
            g, place = block[row, col], where[row, n * FILTERS + col]
            np.add.at(shift[n], col, g)
            for k in range(width):
                word = flat[place + k]
                pull = g[:, None] * self.filters[n][k][:, col].T
                for j in range(parts.shape[1]):
                    np.add.at(embed, parts[word, j], pull)
                np.add.at(filters[n][k].T, col, g[:, None] * words[word])
        embed[0] = 0
        return [embed, *filters, shift, (error[:, None] * pooled).sum(0), np.array([error.sum()], np.float32)]


def narrowed(texts: list[np.ndarray], parts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The texts in numbers of the words that they have, and those words' buckets."""
    if not sum(map(len, texts)):
        return texts, parts[:0] if len(parts) else np.zeros((0, 1 + len(BEGINNINGS)), np.int32)
    unique, inverse = np.unique(np.concatenate(texts), return_inverse=True)
    return np.split(inverse, np.cumsum([len(t) for t in texts])[:-1]), parts[unique]


class Tongues:
    """Which language a text's words look like: naive Bayes over the same buckets."""

    def __init__(self, texts: list[np.ndarray], parts: np.ndarray, langs: list[str | None]):
        self.names = sorted({x for x in langs if x is not None}) or ["any"]
        counts = np.full((len(self.names), BUCKETS), 0.1)
        for words, lang in zip(texts, langs, strict=True):
            if lang is not None:
                counts[self.names.index(lang)] += np.bincount(parts[words, 0], minlength=BUCKETS)
        self.logs = np.log(counts / counts.sum(1, keepdims=True)).T.astype(np.float32).copy()

    def of(self, texts: list[np.ndarray], parts: np.ndarray) -> np.ndarray:
        return np.array([self.logs[parts[words, 0]].sum(0).argmax() if len(words) else 0 for words in texts], np.int64)


class Model:
    """The net, and what tells which language a text looks like."""

    def __init__(self, texts: list[np.ndarray], parts: np.ndarray, labels: np.ndarray, langs: list[str | None]):
        self.tongues, self.net = Tongues(texts, parts, langs), Net()
        self.net.fit(texts, parts, labels)


def threshold(values: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """Where to cut rising values with so many rows of each label: the middle of the widest gap that gives the best F1."""
    right, wrong = toxic[::-1].cumsum()[::-1], clean[::-1].cumsum()[::-1]  # at or above each
    f1 = 2 * right / (right + wrong + toxic.sum())
    middle = np.r_[values[0] - 1, (values[1:] + values[:-1]) / 2]
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    wide = np.r_[0, np.diff(values)][best]
    return float(middle[best[wide.argmax()]])


#: Logits are counted in steps of so much, between these ends.
STEP, FARTHEST = 0.01, 40.0
#: Rows of either label that a language needs for a cut of its own.
LEAST = 5


def thresholds(found: pd.DataFrame, tongues: int, share: tuple[float, float]) -> list[float]:
    """The cut of each language from its counts ``tongue, toxic, step, n``; one cut over all where a language has too few rows.

    ``share``: how many labelled rows stand behind one counted row of each label.
    """

    def of(rows: pd.DataFrame) -> float | None:
        if min(rows["n"][rows["toxic"] == k].sum() for k in (0, 1)) < LEAST:
            return None
        at = np.unique(rows["step"])
        counts = [np.bincount(np.searchsorted(at, rows["step"][rows["toxic"] == k]), rows["n"][rows["toxic"] == k] * share[k], len(at)) for k in (0, 1)]
        return threshold(at * STEP, *counts)

    whole = of(found) or 0.0
    own = [of(found[found["tongue"] == k]) for k in range(tongues)]
    return [whole if x is None else x for x in own]


def train(docs: DataFrame, marked: DataFrame, longest: int) -> Model | None:
    """The model from the documents marked for the fit."""
    # about twice ``most`` rows of two numbers
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text", "lang").join(F.broadcast(marked.where("fit").select("doc_id", "toxic")), "doc_id")
    # one text of a document, so that an id of very many rows doesn't fill the sample
    rows = rows.where(F.length("text") <= longest).groupBy("doc_id").agg(F.min(F.struct("text", "lang", "toxic")).alias("x")).select("doc_id", "x.*")
    found = rows.toPandas().sort_values("doc_id", kind="stable")
    if found["toxic"].nunique() < 2:
        return None
    known = Numbers()
    texts = hashed(found["text"].tolist(), known)
    return Model(texts, known.buckets(), found["toxic"].to_numpy(), found["lang"].tolist())


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, most: int = 1600, longest: int = 20_000) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score (0 to 1), predicted.

    Hashed word embeddings, filters one to three words wide and max pooling over
    the whole text, so one passage in a long document counts. The net learns
    from about ``most`` documents of either label, of at most ``longest`` characters
    (the documented bounds of the fit; never more than three quarters of a label; of
    rows that share an id one text),
    whose crc32(doc_id) modulo ``folds`` isn't ``held``. All other labelled
    documents outside that fold calibrate, long ones too: how many of each label
    and language have which logit is counted in steps of ``STEP``, and each language
    gets the logit that counts as 0.5. A text's language is told from its words alone.

    Texts are read in one map and never shuffled; logits are written down, joined
    with the labels and counted. Null and empty texts have no words and get what
    the net's bias alone gives. With labels of one kind only every score is 0.
    Other columns are ignored; repeated rows are each scored; no rows give none.
    """
    marked = labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), folds) != held)).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marked = cut(marked.withColumn("fit", sampled(marked, "toxic", most, F.xxhash64("doc_id"), 0.75)))
    model = train(docs, marked, longest)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, known = sent.value, Numbers()
        for batch in batches:
            texts = [t or "" for t in batch.pop("text")]
            logit, tongue = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int32)
            for i, j in slices(texts, 1_000_000) if model else ():
                if len(known) > MEMORY:
                    known = Numbers()
                words = hashed(texts[i:j], known)
                parts = known.buckets()
                logit[i:j], tongue[i:j] = np.clip(model.net.logits(words, parts), -FARTHEST, FARTHEST), model.tongues.of(words, parts)
            yield batch.assign(logit=logit, tongue=tongue)

    known = docs.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "text")
    known = cut(known.mapInPandas(run, "doc_id long, held_out boolean, logit double, tongue int"))
    if model is None:
        return known.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    counted = known.join(marked.where(~F.col("fit")), "doc_id").groupBy("tongue", "toxic", F.round(F.col("logit") / STEP).cast("int").alias("step")).agg(F.count("*").alias("n"))
    n = {r["toxic"]: (r["whole"], r["rest"]) for r in marked.groupBy("toxic").agg(F.count("*").alias("whole"), F.sum(F.when(F.col("fit"), 0).otherwise(1)).alias("rest")).collect()}  # two rows
    share = tuple(n[k][0] / max(1, n[k][1]) for k in (0, 1))
    cuts = thresholds(counted.toPandas(), len(model.tongues.names), share)  # two rows a language and step at most
    shifted = F.col("logit") - F.element_at(F.array(*[F.lit(c) for c in cuts]), F.col("tongue") + 1)
    scored = 1 / (1 + F.exp(-F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), shifted))))
    return known.select("doc_id", "held_out", scored.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
