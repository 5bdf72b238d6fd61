"""Circulant MinHash near-duplicates with exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix64, sized, slices, spread
from .components import components

#: Words of a shingle; links need 100 * intersection >= PERCENT * union.
WORDS, PERCENT = 5, 75
#: Bands of so many coordinates each: a pair at the threshold is missed with a chance of (1 - 0.75^5)^50, about 1e-6.
BANDS, ROWS = 50, 5
#: Bytes of sets that a partition holds about.
SET_BYTES = 16 << 20
#: Size of the permuted universe.
UNIVERSE = 1 << 20


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and every run of BANDS * ROWS neighbours of the second one on a circle.

    Coordinate k of an element is the second permutation, shifted by k, at its
    place under the first: so all coordinates of an element are one such run.
    """
    rng = np.random.default_rng(20240607)
    first, second = rng.permutation(UNIVERSE), rng.permutation(UNIVERSE).astype(np.int32)
    width = BANDS * ROWS
    return first, np.lib.stride_tricks.sliding_window_view(np.r_[second, second[: width - 1]], width)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles (A-Z in lower case).

    Fewer than five words make one shingle of all of them; no word makes none.
    """
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    raw = np.frombuffer(b"\n".join([*data, b""]), np.uint8)
    if not len(raw):
        return [np.zeros(0, np.int64) for _ in texts]
    solid = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = np.flatnonzero(begins)
    at = np.flatnonzero(solid)
    place = at - first[np.cumsum(begins[at]) - 1] if len(at) else at
    mixed = mix64(raw[at].astype(np.uint64) | ((place.astype(np.uint64) + np.uint64(1)) << np.uint64(8)))
    with np.errstate(over="ignore"):
        word = mix64(np.add.reduceat(mixed, np.searchsorted(at, first))) if len(first) else np.zeros(0, np.uint64)
        turned = [mix64(word + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k + 1)) for k in range(WORDS)]
        five = sum(turned[k][k : len(word) - WORDS + 1 + k] for k in range(WORDS)) if len(word) >= WORDS else np.zeros(0, np.uint64)
        ends = np.searchsorted(first, np.cumsum([len(d) + 1 for d in data]))
        out = []
        for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
            if b - a >= WORDS:
                out.append(np.unique(five[a : b - WORDS + 1].view(np.int64)))
            elif b > a:
                whole = sum((turned[k][a + k] for k in range(b - a)), np.uint64(b - a))
                out.append(np.array([mix64(np.array([whole], np.uint64))[0]], np.uint64).view(np.int64))
            else:
                out.append(np.zeros(0, np.int64))
    return out


def bands(found: np.ndarray) -> np.ndarray:
    """Hash of each band of a set's signature."""
    first, runs = permutations()
    place = first[mix64(found.view(np.uint64)) % np.uint64(UNIVERSE)]
    signature = runs[place[:4096]].min(0)
    for i in range(4096, len(place), 4096):
        signature = np.minimum(signature, runs[place[i : i + 4096]].min(0))
    with np.errstate(over="ignore"):
        key = np.arange(1, BANDS + 1, dtype=np.uint64)
        for column in signature.reshape(BANDS, ROWS).T:
            key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + column.astype(np.uint64))
    return key.view(np.int64)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    none = np.zeros(0, np.int64)
    for batch in batches:
        texts = batch["text"].tolist()
        for i, j in slices(texts):
            sets = shingle_sets(texts[i:j])
            with np.errstate(over="ignore"):
                keys = [(int(mix64(s.view(np.uint64)).sum().view(np.int64)), int(mix64(~s.view(np.uint64)).sum().view(np.int64))) if len(s) else (0, 0) for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[i:j].to_numpy(),
                    "mark": batch["mark"].iloc[i:j].to_numpy(),
                    "n": [len(s) for s in sets],
                    "key_a": [k[0] for k in keys],
                    "key_b": [k[1] for k in keys],
                    "bands": [bands(s) if len(s) else none for s in sets],
                }
            )


def _shingles(texts: pd.Series) -> pd.Series:
    out: list[np.ndarray] = []
    held = texts.tolist()
    for i, j in slices(held):
        out += shingle_sets(held[i:j])
    return pd.Series(out, index=texts.index)


def verify(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs ``a, b`` whose full sets overlap enough: a's set goes to where b's is."""
    lead = pairs.join(sets.select(F.col("node").alias("a"), F.col("found").alias("lead")), "a")
    both = lead.join(sets.select(F.col("node").alias("b"), "found"), "b")
    both = both.select("a", "b", F.size("found").alias("x"), F.size("lead").alias("y"), F.size(F.array_intersect("found", "lead")).alias("same"))
    return both.where(F.col("same") * 100 >= (F.col("x") + F.col("y") - F.col("same")) * PERCENT).select("a", "b").distinct()


def prefix_pairs(sets: DataFrame) -> DataFrame:
    """Pairs of different components that may overlap enough, by prefix and positional filtering.

    ``sets`` has node, component, found. With elements ordered from rare to
    common, two sets of n and m elements that overlap by 3/7 (n + m), which is
    what a Jaccard similarity of 3/4 takes, have their first common element so
    early in both that as many can follow. Elements that a set shares with no
    other make up most of those places in edited copies, so pairs below the
    threshold mostly never meet.
    """
    rows = sets.select("node", "component", F.size("found").alias("n"), F.explode("found").alias("x"))
    often = rows.groupBy("x").agg(F.count("*").alias("often"), F.min("component").alias("low"), F.max("component").alias("high"))
    often = often.select("x", "often", (F.col("low") < F.col("high")).alias("mixed"))
    placed = rows.join(often, "x").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("often", "x", "mixed"))).alias("own"))
    # a set of n reaches 3/4 of its size at the least, and 6/7 with a set that is no smaller
    probe = placed.select("node", "component", "n", F.posexplode(F.slice("own", 1, F.col("n") - F.ceil(F.col("n") * 3 / 4).cast("int") + 1)).alias("at", "e")).where("e.mixed")
    index = placed.select("node", "component", "n", F.posexplode(F.slice("own", 1, F.col("n") - F.ceil(F.col("n") * 6 / 7).cast("int") + 1)).alias("at", "e")).where("e.mixed")
    probe = probe.select(F.col("e.x").alias("x"), *[F.col(c).alias(f"{c}_p") for c in ("node", "component", "n", "at")])
    index = index.select(F.col("e.x").alias("x"), *[F.col(c).alias(f"{c}_i") for c in ("node", "component", "n", "at")])
    needed = F.ceil((F.col("n_p") + F.col("n_i")) * 3 / 7)
    found = probe.join(index, "x").where(
        (F.col("component_p") != F.col("component_i"))
        & ((F.col("n_i") < F.col("n_p")) | ((F.col("n_i") == F.col("n_p")) & (F.col("node_i") < F.col("node_p"))))
        & (F.col("n_i") * 100 >= F.col("n_p") * PERCENT)
        & (F.col("n_p") - F.col("at_p") >= needed)
        & (F.col("n_i") - F.col("at_i") >= needed)
    )
    return found.select(F.least("node_p", "node_i").alias("a"), F.greatest("node_p", "node_i").alias("b")).distinct()


def _components(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), n, component_id of every row; see ``near_duplicates``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    rows = cut(docs.mapInPandas(_sketch, "doc_id long, mark long, n long, key_a long, key_b long, bands array<long>"))
    able = rows.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = able.groupBy("n", "key_a", "key_b").agg(F.min(F.struct("doc_id", "mark")).alias("rep"))
    # numbered in the order of their first documents, so that the least number stands for the smallest doc_id
    classes = sized(classes.select("n", "key_a", "key_b", F.col("rep.doc_id").alias("rep"), F.col("rep.mark").alias("mark")).orderBy("rep").withColumn("node", F.monotonically_increasing_id()))
    named = classes.select(F.col("rep").alias("doc_id"), "mark", "node")
    members = able.join(named, ["doc_id", "mark"]).select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.count("*").alias("size")).where("least < most").select("bucket", "size")
    members = sized(members.join(shared, "bucket").distinct(), 200_000)
    popular = sized(members.groupBy("node").agg(F.sum("size").alias("fame")).join(classes.select("node", "n", F.col("rep").alias("doc_id"), "mark"), "node"))
    texts = docs.join(popular.select("doc_id", "mark", "node"), ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])
    sets = spread(texts.select("node", F.pandas_udf(_shingles, "array<long>")("text").alias("found")), SET_BYTES, 8 * F.size("found"))

    # a bucket's most popular member, the first of equals
    ranked = members.join(popular.select("node", "n", "fame"), "node").select("bucket", "node", "n", F.struct("fame", (-F.col("node")).alias("neg"), F.col("n").alias("n_top")).alias("rank"))
    tops = ranked.groupBy("bucket").agg(F.max("rank").alias("top"))
    ranked = sized(ranked.select("bucket", "node", "n").join(tops, "bucket").select("bucket", "node", "n", "top"), 200_000)
    near = f"100 * least(top.n_top, n) >= {PERCENT} * greatest(top.n_top, n)"
    other, pair = (-F.col("top.neg")), [F.least(-F.col("top.neg"), "node").alias("a"), F.greatest(-F.col("top.neg"), "node").alias("b")]

    first = ranked.where(other != F.col("node")).groupBy("node", "n").agg(F.max("top").alias("top")).where(near)
    first = sized(first.select(*pair).distinct())
    links = sized(verify(sets, first))
    known = components(links).withColumnRenamed("node", "of")

    def now(rows: DataFrame) -> DataFrame:
        return rows.join(known, rows["node"] == known["of"], "left").select(*rows.columns, F.coalesce("component", "node").alias("component"))

    def mixed(rows: DataFrame) -> DataFrame:
        many = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
        return rows.join(many, "bucket", "left_semi")

    ranked = sized(mixed(now(ranked)), 200_000)
    lead = ranked.where(other == F.col("node")).select("bucket", F.col("component").alias("of_top"))
    second = ranked.join(lead, "bucket").where("component <> of_top").where(near).select(*pair).distinct()
    links = sized(links.unionByName(verify(sets, second.join(first, ["a", "b"], "left_anti"))))
    known = components(links).withColumnRenamed("node", "of")

    rest = mixed(now(ranked.drop("component").where(other != F.col("node"))))
    rest = rest.select("node", "component").distinct().join(sets, "node")
    third = prefix_pairs(spread(rest, SET_BYTES, 8 * F.size("found")))
    known = components(links.unionByName(verify(sets, sized(third)))).withColumnRenamed("node", "of")

    tops = classes.join(known, classes["node"] == known["of"], "left").select("n", "key_a", "key_b", F.coalesce("component", "node").alias("top"))
    tops = tops.join(classes.select(F.col("node").alias("top"), F.col("rep").alias("component_id")), "top").drop("top")
    linked = able.select("doc_id", "mark", "n", "key_a", "key_b").join(tops, ["n", "key_a", "key_b"])
    alone = rows.where((F.col("n") == 0) | F.col("doc_id").isNull()).withColumn("component_id", F.col("doc_id"))
    return linked.select("doc_id", "mark", "n", "component_id").unionByName(alone.select("doc_id", "mark", "n", "component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Near-duplicate components: doc_id, n_shingles, component_id, kept.

    Documents link when 100 * intersection >= 75 * union of their sets of 5-word
    shingles; component_id is the smallest doc_id reachable over links.

    Documents with one and the same set are a class and linked at once; only the
    class's first document goes on, so copies cost one row each. Band buckets
    then give candidates in three rounds, each of which looks only at pairs that
    lie in different components still: a pair within one would change nothing.

    1. Every document is verified against the most popular of all that it shares
       a bucket with, at most one pair a document. What near copies were made
       from shares most buckets, so this settles most of a large group.
    2. Every document is verified against the most popular one of each bucket.
    3. Documents of buckets in which others stay apart go through an exact prefix
       filter, which names the pairs that can reach the threshold.

    So no link between different texts is lost and no group is expanded into all
    its pairs; sets are read out of the texts once, for documents that share a
    bucket.

    A text that is null, empty or white space has an empty set and links with
    nothing, and so does a row whose doc_id is null; repeated rows are of one
    class, and different texts of one doc_id are apart, each row with its own
    component; no rows give none; other columns are ignored.
    """
    return _components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without the near-duplicates of documents with a smaller doc_id: one document of each group stays.

    Rows go by doc_id and text, so another text of the same doc_id stays where it
    has no near-duplicate itself; of equal texts of one doc_id one row stays, and of
    different near-duplicate texts of one doc_id all that are like none before.
    Rows with a null doc_id or no words stay. Columns stay as they are.
    """
    own = docs.columns
    mark = next(n for n in ("mark", *(f"mark_{k}" for k in range(len(own) + 1))) if n not in {c.lower() for c in own})
    found = _components(docs).withColumnRenamed("mark", mark)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id", mark).distinct()
    left = docs.withColumn(mark, F.xxhash64("text")).join(gone, ["doc_id", mark], "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id", mark).orderBy("doc_id"))
    nth = f"{mark}_nth"
    return left.withColumn(nth, first).where(F.col("doc_id").isNull() | (F.col(nth) == 1)).select(*[F.col(f"`{n}`") for n in own])
