"""Hierarchical language identification with linear support vector machines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, slices

#: Families of closely related languages; a language outside them is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa"),
    "semitic": ("ar", "he", "mt", "am"),
}
BUCKETS = 4096
LETTER = regex.compile(r"\p{L}")

#: ASCII letters in lower case; other ASCII becomes a space; bytes of other scripts stay.
_FOLDED = np.full(256, 32, np.uint8)
_FOLDED[97:123] = _FOLDED[65:91] = np.arange(97, 123)
_FOLDED[128:] = np.arange(128, 256)


def family(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of the texts, one after the other, and how many each text has.

    A trigram of which the last two bytes are spaces says nothing and is left out.
    """
    data = [t.encode("utf-8", "replace") for t in texts]
    raw = _FOLDED[np.frombuffer(b"   ".join([b"", *data, b""]), np.uint8)].astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    keep = (code & 0xFFFF) != 0x2020
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int32) % BUCKETS
    sizes = np.array([len(d) + 3 for d in data], np.int64)
    ends = np.r_[0, np.cumsum(keep)]
    cuts = np.minimum(np.r_[0, np.cumsum(sizes)], len(keep))
    cuts[-1] = len(keep)
    return bucket[keep], ends[cuts[1:]] - ends[cuts[:-1]]


def profile(texts: list[str]) -> np.ndarray:
    """A row per text: root frequencies of its buckets, of length one."""
    bucket, counts = grams(texts)
    row = np.repeat(np.arange(len(texts)), counts)
    out = np.bincount(row * BUCKETS + bucket, minlength=len(texts) * BUCKETS).reshape(-1, BUCKETS).astype(np.float32)
    out = np.sqrt(out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Machine:
    """One linear support vector machine a class, each against the rest (squared hinge)."""

    def __init__(self, names: list[str], rows: np.ndarray, labels: np.ndarray, steps: int = 150, penalty: float = 1e-4):
        self.names = names
        width = rows.shape[1]
        self.weights, self.bias = np.zeros((width, len(names)), np.float32), np.zeros(len(names), np.float32)
        if len(names) < 2:
            self.scale = 1.0
            return
        target = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0).astype(np.float32)
        share = np.where(target > 0, 0.5 / np.maximum(1, (target > 0).sum(0)), 0.5 / np.maximum(1, (target < 0).sum(0))).astype(np.float32)
        speed_w, speed_b, rate = np.zeros_like(self.weights), np.zeros_like(self.bias), np.float32(0.8)
        for _ in range(steps):
            slack = np.maximum(0, 1 - target * (rows @ self.weights + self.bias))
            pull = share * target * slack * 2
            speed_w = 0.9 * speed_w + rate * (rows.T @ pull - penalty * self.weights)
            speed_b = 0.9 * speed_b + rate * pull.sum(0) * np.float32(0.1)
            self.weights += speed_w
            self.bias += speed_b
        self.scale = 4.0

    def shares(self, rows: np.ndarray) -> np.ndarray:
        margin = self.scale * (rows @ self.weights + self.bias)
        margin = np.exp(margin - margin.max(1, keepdims=True))
        return margin / margin.sum(1, keepdims=True)


class Pairs:
    """One-versus-one machines: a machine for every pair of a family's languages, which then vote."""

    def __init__(self, names: list[str], rows: np.ndarray, labels: np.ndarray):
        self.names = names
        self.duels = []
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                both = (labels == a) | (labels == b)
                self.duels.append((i, names.index(b), Machine([a, b], rows[both], labels[both])))

    def shares(self, rows: np.ndarray) -> np.ndarray:
        if not self.duels:
            return np.ones((len(rows), 1))
        votes = np.zeros((len(rows), len(self.names)))
        for i, j, machine in self.duels:
            share = machine.shares(rows)
            votes[:, i] += share[:, 0]
            votes[:, j] += share[:, 1]
        return votes / len(self.duels) * len(self.names) / 2


class Hierarchy:
    """A machine for the family, then one-versus-one machines inside each family."""

    def __init__(self, rows: np.ndarray, langs: list[str]):
        of = np.array([family(x) for x in langs])
        langs = np.array(langs)
        self.top = Machine(sorted(set(of)), rows, of)
        self.inner = {f: Pairs(sorted(set(langs[of == f])), rows[of == f], langs[of == f]) for f in self.top.names}

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray]:
        top = self.top.shares(rows)
        best = top.argmax(1)
        names = np.empty(len(rows), object)
        score = top[np.arange(len(rows)), best].astype(float)
        for k, f in enumerate(self.top.names):
            mine = np.flatnonzero(best == k)
            if len(mine):
                shares = self.inner[f].shares(rows[mine])
                names[mine] = np.array(self.inner[f].names, object)[shares.argmax(1)]
                score[mine] *= np.minimum(1.0, shares.max(1))
        return names.tolist(), np.clip(score, 0.0, 1.0)


def sampled(rows: DataFrame, label: str, most: int, mark: Column, share: float = 1.0) -> Column:
    """Whether a row is of about ``most`` of its label, by its mark; of fewer at most that share. ``rows`` has each mark of a label once."""
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}  # as many rows as labels
    limit: Column = F.lit(0.0)
    for name, n in counts.items():
        limit = F.when(F.col(label) == name, min(share, most / n)).otherwise(limit)
    return F.pmod(mark, F.lit(1_000_003)) / 1_000_003.0 < limit


def train(docs: DataFrame, folds: int, held: int, most: int) -> Hierarchy | None:
    """The models from about ``most`` documents of each language outside the held-out fold."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held)).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    # rows that are equal count once, those that share only their id each: the fit's size then keeps to its bound
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "text"))
    drawn = rows.where(sampled(rows.select("lang", "mark").distinct(), "lang", most, F.col("mark"))).groupBy("lang", "mark").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[[bool(LETTER.search(t)) for t in batch["text"]]]
            texts = batch["text"].tolist()
            for i, j in slices(texts, 400_000):
                rows = profile(texts[i:j])
                at = [np.flatnonzero(r).astype(np.int32) for r in rows]
                yield pd.DataFrame({"mark": batch["mark"].iloc[i:j], "doc_id": batch["doc_id"].iloc[i:j], "lang": batch["lang"].iloc[i:j], "at": at, "value": [r[k] for r, k in zip(rows, at, strict=True)]})

    # sparse profiles, at most ``most`` a language (give or take the hash) of BUCKETS values each
    found = drawn.mapInPandas(run, "mark long, doc_id long, lang string, at array<int>, value array<float>").toPandas().sort_values(["doc_id", "mark"], kind="stable")
    if not len(found):
        return None
    dense = np.zeros((len(found), BUCKETS), np.float32)
    for k, (at, value) in enumerate(zip(found["at"], found["value"], strict=True)):
        dense[k, at] = value
    return Hierarchy(dense, found["lang"].tolist())


def identify(docs: DataFrame, folds: int = 4, held: int = 2, most: int = 1000) -> DataFrame:
    """The language of every document, from its whole text alone.

    The first machine tells language families apart; one-versus-one
    linear machines then separate the languages inside the family that won. Features
    are root frequencies of hashed byte trigrams. The machines learn from at
    most about ``most`` documents of each language (the documented bound of the
    fit), whose crc32(doc_id) modulo ``folds`` isn't ``held``.

    Returns doc_id, held_out, lang_pred, score (0 to 1). A text that is null or
    has no letter (category L: numbers, marks and signs are none) is ``und`` with score 0, and so is every text if there was
    nothing to learn from. One map after the fit: no shuffle of texts but those
    drawn. Of equal shares the language first in the alphabet wins. Other columns are
    ignored; repeated rows are each predicted, and count once in the fit; no rows give none.
    """
    model = train(docs, folds, held, most)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights a language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            texts = [t or "" for t in batch.pop("text")]
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            for i, j in slices(texts, 1_000_000):
                at = [k for k in range(i, j) if LETTER.search(texts[k])]
                for a in range(0, len(at) if model else 0, 512):
                    some = at[a : a + 512]
                    found, score = model.predict(profile([texts[k] for k in some]))
                    scores[some] = score
                    for k, name in zip(some, found, strict=True):
                        names[k] = name
            yield batch.assign(lang_pred=names, score=scores)

    return docs.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")
