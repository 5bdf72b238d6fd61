"""How far the sources of a language differ in their words, by a cube of tasks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Groups and terms of a block: a task holds two dense blocks of groups by terms.
GROUPS, TERMS = 256, 2048
#: Terms of a task's dictionaries before they are handed on.
HELD = 400_000
#: Letters stay, A-Z in lower case, and so do bytes of other scripts; all else is a space.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences and documents of each term by group, combined over what a task has read."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def rows() -> Iterator[pd.DataFrame]:
        for (lang, source), (n, docs) in held.items():
            names = list(n)
            for i in range(0, len(names), 50_000):
                some = names[i : i + 50_000]
                yield pd.DataFrame({"lang": lang, "source": source, "term": [t.decode() for t in some], "n": [n[t] for t in some], "docs": [docs[t] for t in some]})

    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
            found = Counter(text.encode("utf-8", "replace").translate(_FOLDED).split())
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(n)
            n.update(found)
            docs.update(found.keys())
            size += len(n)
            if size > HELD:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def _cell(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over a block of terms of the distances between the groups of two blocks.

    Rows without ``col`` name the groups, with the figure of a term that they lack.
    """
    first = rows.iloc[0]
    heads = rows[rows["col"] < 0].drop_duplicates("group").sort_values("group")
    width = int(first["width"])
    dense = np.repeat(heads["p"].to_numpy()[:, None], width, 1)
    own = rows[rows["col"] >= 0]
    dense[np.searchsorted(heads["group"].to_numpy(), own["group"].to_numpy()), own["col"].to_numpy()] = own["p"].to_numpy()
    names, block = heads["group"].to_numpy(), heads["block"].to_numpy()
    left, right = np.flatnonzero(block == first["a_block"]), np.flatnonzero(block == first["b_block"])
    out = []
    for k in left.tolist():
        with_ = right[names[right] > names[k]] if first["a_block"] == first["b_block"] else right
        for at in range(0, len(with_), 64):  # bounds the differences held
            some = with_[at : at + 64]
            out.append(pd.DataFrame({"a": names[k], "b": names[some], "value": np.abs(dense[some] - dense[k]).sum(1)}))
    found = pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "value": []})
    return found.assign(lang=first["lang"])[["lang", "a", "b", "value"]].astype({"a": "int64", "b": "int64", "value": "int64"})


def divergence(docs: DataFrame, least: int = 30, smooth: int = 5, top: int = 50, groups: int = GROUPS, terms: int = TERMS) -> DataFrame:
    """Distances between the term shares of all sources of a language, and each source's most outstanding terms.

    Terms are runs of ASCII letters (lower-cased) and characters beyond ASCII; a
    language keeps those of at least ``least`` documents. A group, a language's
    source, gives a kept term p = 1 + floor(10**9 * (count + smooth) / (N + smooth * V)).

    Counts are combined by the tasks that read texts, then by term, so no group
    and no term is gathered. The sums over pairs of groups are a cube: a task owns
    a block of groups, another one and a block of terms, gets the slices of both
    (each slice goes to as many tasks as there are blocks of groups), and holds
    two dense blocks of ``groups`` by ``terms`` whatever the data; partial sums
    are added along the terms. Only rows of present terms move: a block knows its
    groups by one row each, with the p of a term they lack. Whole numbers
    throughout.

    Returns lang, source, part, item, value, rank. ``pair``: every other source of
    the language and the sum of the terms' differences, by descending value, then
    name. ``term``: the ``top`` terms whose p is above the language's, by that
    difference. Null texts, languages and sources are empty ones; a group without
    terms has pairs; repeated rows count each; no rows give none; other columns
    are ignored.
    """
    named = docs.select(*[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in ("lang", "source", "text")])
    counts = named.mapInPandas(_counted, "lang string, source string, term string, n long, docs long")
    counts = cut(counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).drop("docs")
    sizes = whole.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("all"))
    part = F.pmod(F.xxhash64("term"), F.greatest(F.lit(1), F.ceil(F.col("v") / terms)))
    in_block = Window.partitionBy("lang", "term_block").orderBy("term")
    kept = cut(whole.join(sizes, "lang").withColumn("term_block", part).withColumn("col", F.row_number().over(in_block) - 1))
    own = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole", "all", "v", "term_block", "col")
    every = cut(named.select("lang", "source").distinct())  # a row a group, before groups are numbered
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    blocks = kept.groupBy("lang").agg(F.max("v").alias("v"), F.max("all").alias("all"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    every = every.join(totals, ["lang", "source"], "left").join(blocks, "lang", "left").na.fill(0, ["total", "v", "all"]).withColumn("group", number)
    every = cut(every.withColumn("block", F.floor(F.col("group") / groups)))

    def p(count: str, total: str) -> str:
        return f"CASE WHEN v > 0 THEN 1 + (CAST(1000000000 AS DECIMAL(10, 0)) * CAST({count} + {smooth} AS DECIMAL(19, 0))) DIV CAST({total} + {smooth} * v AS DECIMAL(20, 0)) ELSE 0 END"

    shares = cut(own.join(every.select("lang", "source", "total", "group", "block"), ["lang", "source"]).select("*", F.expr(p("n", "total")).alias("p"), F.expr(p("whole", "all")).alias("q")))

    last = every.groupBy("lang").agg(F.max("block").alias("last"))
    width = kept.groupBy("lang", "term_block").agg(F.count("*").cast("int").alias("width"))
    heads = every.join(width, "lang", "left").na.fill(0, ["term_block", "width"])
    columns = ["lang", "term_block", "width", "group", "block", "col", "p"]
    heads = heads.withColumn("p", F.expr(p("0", "total"))).withColumn("col", F.lit(-1)).select(*columns)
    slices = shares.join(width, ["lang", "term_block"]).select(*columns)
    other = F.explode(F.sequence(F.lit(0).cast("long"), "last"))
    dealt = heads.unionByName(slices).join(last, "lang").withColumn("other", other)
    dealt = dealt.select(*columns, F.least("block", "other").alias("a_block"), F.greatest("block", "other").alias("b_block"))
    sums = dealt.groupBy("lang", "a_block", "b_block", "term_block").applyInPandas(_cell, "lang string, a long, b long, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    sums = sums.select("lang", "value", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("lang", "value", "x.*")
    name = every.select("lang", "group", "source")
    pairs = sums.join(name.withColumnRenamed("group", "a"), ["lang", "a"]).join(name.select("lang", F.col("group").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pairs.unionByName(above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
