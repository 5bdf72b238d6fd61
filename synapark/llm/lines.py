"""Line deduplication by pairwise patience alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64

#: Characters of a block that is deleted; holders of a run of lines up to which it is rare.
BLOCK_CHARS, RARE = 50, 8
#: Lines that are looked at in one go; bounds the temporaries.
SLICE_LINES = 500_000
#: Base of the rolling hash of runs, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two sequences: equal ends, then elements unique in both, in longest increasing order, and so on between them."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, p, j, q = todo.pop()
        while i < p and j < q and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < p and j < q and a[p - 1] == b[q - 1]:
            p, q = p - 1, q - 1
            out.append((p, q))
        if i == p or j == q:
            continue
        in_a, in_b = Counter(a[i:p]), Counter(b[j:q])
        place = {x: k for k, x in enumerate(b[j:q], j) if in_b[x] == 1}
        anchors = [(k, place[x]) for k, x in enumerate(a[i:p], i) if in_a[x] == 1 and x in place]
        chain = increasing(anchors)
        if not chain:
            continue
        for (i0, j0), (i1, j1) in zip([(i - 1, j - 1), *chain], [*chain, (p, q)], strict=True):
            if i0 + 1 < i1 and j0 + 1 < j1:
                todo.append((i0 + 1, i1, j0 + 1, j1))
        out += chain
    return sorted(out)


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs in which the second rises; the first rises already."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
        before.append(ends[at - 1] if at else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def chains(ids: list[int]) -> list[list[int]]:
    """Places of a sequence parted into rising chains, each place in the chain whose last id is the greatest below its own."""
    tails: list[int] = []  # of the chains, rising
    ends: list[list[int]] = []
    for k, x in enumerate(ids):
        at = bisect_left(tails, x)
        if at:
            tails[at - 1] = x
            ends[at - 1].append(k)
        else:
            tails.insert(0, x)
            ends.insert(0, [k])
    return ends


def blocks(earlier: np.ndarray, later: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Spans of the later document's lines that are aligned with the earlier one, from the runs that both have.

    ``earlier`` and ``later``: where a shared run of so many lines (``sizes``) begins.
    Patience aligns the two orders of runs; what it leaves, since it stands in
    crossed order or repeatedly, is aligned again, in as many rising chains as it takes.
    """
    earlier, later, sizes = (np.asarray(x, np.int64) for x in (earlier, later, sizes))
    order = np.lexsort((sizes, later))
    _, ids = np.unique(earlier << _PACK | sizes, return_inverse=True)
    ids = ids[order].tolist()
    met = [j for _, j in patience(list(range(max(ids, default=-1) + 1)), ids)]
    left = sorted(set(range(len(ids))) - set(met))
    aligned = [met, *[[left[k] for k in chain] for chain in chains([ids[j] for j in left])]]
    return [(int(later[order[j]]), int(later[order[j]] + sizes[order[j]])) for chain in aligned for j in chain]


def least_runs(codes: list[np.ndarray], chars: np.ndarray, sizes: np.ndarray, least: int = BLOCK_CHARS) -> tuple[np.ndarray, ...]:
    """The shortest run of ``least`` characters from each line on, and up to each: its document, start, end, and a hash for each of the lines' ``codes``.

    Documents of ``sizes`` lines lie behind one another. Every longer block
    consists of such runs, and has the same ones wherever it stands.
    """
    n = len(chars)
    total = np.r_[0, np.cumsum(chars, dtype=np.int64)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    last = np.cumsum(sizes, dtype=np.int64)
    ends = np.searchsorted(total, total[:-1] + least, "left")
    starts = np.searchsorted(total, total[1:] - least, "right") - 1
    fore = np.flatnonzero(ends <= last[row])
    back = np.flatnonzero(starts >= (last - sizes)[row])
    back = back[ends[starts[back]] != back + 1]  # else it is there already
    s, e = np.r_[fore, starts[back]], np.r_[ends[fore], back + 1]
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE, np.uint64)], dtype=np.uint64)
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, BACK, np.uint64)], dtype=np.uint64)
        prefixes = [np.r_[np.uint64(0), np.cumsum(own.view(np.uint64) * up[:-1], dtype=np.uint64)] for own in codes]
        found = [mix64((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64)) for prefix in prefixes]
    return np.r_[row[fore], row[back]], s, e, *found


def _flat(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(column.to_list()), np.array([len(x) for x in column], np.int64)


#: A span of lines is its first one above 31 bits of their number.
_PACK = 31
#: Tasks that a run of very many holders is met in.
SALTS = 64
_HELD = "doc_id long, mark long, salt int, run long, check long, size int, starts array<int>"


def _runs(least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Hashes of every shortest run of a document, once each, with its lines and all places where it begins."""
        for batch in batches:
            total = np.cumsum([len(x) for x in batch["codes"]])
            for _, part in batch.groupby(total // SLICE_LINES, sort=False):
                codes, sizes = _flat(part["codes"])
                row, s, e, found, check = least_runs([codes, _flat(part["checks"])[0]], _flat(part["chars"])[0], sizes, least)
                order = np.lexsort((s, found, row))
                row, s, e, found, check = row[order], s[order], e[order], found[order], check[order]
                fresh = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (found[1:] != found[:-1])][: len(row)])
                begin = np.cumsum(sizes) - sizes
                starts = np.split((s - begin[row]).astype(np.int32), fresh[1:])
                row, found, check, size = row[fresh], found[fresh], check[fresh], (e - s)[fresh]
                doc = part["doc_id"].to_numpy()[row]
                salt = (mix64(doc.astype(np.int64).view(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
                own = {"doc_id": doc, "mark": part["mark"].to_numpy()[row], "salt": salt, "run": found.view(np.int64), "check": check.view(np.int64)}
                yield pd.DataFrame(own | {"size": size.astype(np.int32), "starts": starts[: len(fresh)]})

    return run


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans of the later one of each pair that alignment finds in the earlier one."""
    for batch in batches:
        spans = []
        for a, b, sizes in zip(batch["a"], batch["b"], batch["size"], strict=True):
            found = np.array(blocks(a, b, sizes), np.int64).reshape(-1, 2)
            edge = np.unique(found[:, 0] << _PACK | (found[:, 1] - found[:, 0]))
            spans.append(edge.tolist())
        yield batch[["doc_id", "mark"]].assign(spans=spans)


def _flags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whether each line goes, up to the last that does, from the spans that the pairs of a document found."""
    for batch in batches:
        rows = []
        for spans in batch["spans"]:
            start, size = spans >> _PACK, spans & ((1 << _PACK) - 1)
            edge = np.zeros(int((start + size).max()) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + size, -1)
            gone = np.cumsum(edge)[:-1] > 0
            rows.append((gone, int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())))
        yield pd.concat([batch[["doc_id", "mark"]].reset_index(drop=True), pd.DataFrame(rows, columns=["flags", "n_removed", "n_blocks"])], axis=1)


def dedup_lines(docs: DataFrame, least: int = BLOCK_CHARS, rare: int = RARE) -> DataFrame:
    """Deletes from each document the blocks of lines that any earlier document has.

    A block is a row of lines of at least ``least`` characters together. Whatever
    two documents share is made of shortest such runs, single lines or a few
    short ones, whose hashes bring documents together: through a rare run, of at
    most ``rare`` holders, each holder meets every earlier one; through a common
    run each meets the first, which is the exact way for those: the first holder
    has the whole run, so no other can add to it, and a run that very many share
    still adds one pair a document, never all pairs of the group.

    Pairs are aligned by patience diff over the runs that both have, and aligned
    common blocks go from the later one (larger doc_id; rows that share a doc_id
    come in the order of their text's hash). Runs that patience leaves
    out, since they stand in crossed order or repeatedly, are then aligned among
    themselves until none is left. The first holder keeps its own lines.

    What moves is a row for each run of a document, with its places: a pair has the
    places of the runs it shares and no more, however long its documents are.
    Texts are shuffled once, to take the lines out. Runs meet by one hash and
    are compared by another.

    Returns the columns of ``docs`` with ``text`` shortened, and n_lines,
    n_removed and n_blocks (rows of removed lines), which replace columns of those
    names. A null text stays null with no lines; null ids take no part; equal rows
    are one document and get one result; no rows give none.
    """
    own = [n for n in docs.columns if n.lower() not in ("n_lines", "n_removed", "n_blocks", "mark", "flags")]
    lines = F.split("text", "\n", -1)
    marked = docs.select(*[F.col(f"`{n}`") for n in own], F.xxhash64("text").alias("mark"))
    able = marked.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "mark", "text")
    hashes = [F.transform(lines, lambda x: F.xxhash64(x)).alias("codes"), F.transform(lines, lambda x: F.xxhash64(x, F.lit(1))).alias("checks")]
    coded = able.select("doc_id", "mark", *hashes, F.transform(lines, lambda x: F.length(x)).alias("chars"))
    holder = F.struct("doc_id", "mark", "check", F.element_at("starts", 1).alias("a"))
    runs = coded.mapInPandas(_runs(least), _HELD)
    # combined before it is shuffled; the salts say in which tasks a run's holders are
    shared = runs.groupBy("run").agg(F.min(holder).alias("first"), F.count("*").alias("held"), F.collect_set("salt").alias("salts")).where("held > 1")
    met = runs.join(shared.select("run", "first", "held", F.explode("salts").alias("salt")), ["run", "salt"])
    met = met.where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("mark") != F.col("first.mark")))
    few = met.where(F.col("held").between(3, rare)).groupBy("run").agg(F.collect_set(holder).alias("holders"), F.collect_set(F.struct("doc_id", "mark", "check", "size", "starts")).alias("later"))
    few = few.select(F.explode("later").alias("later"), "holders").select("later.*", F.explode(F.filter("holders", lambda x: F.struct(x["doc_id"], x["mark"]) < F.struct(F.col("later.doc_id"), F.col("later.mark")))).alias("first"))
    columns = ["doc_id", "mark", "check", "size", "starts", "first"]
    pairs = met.select(*columns).unionByName(few.select(*columns)).where(F.col("check") == F.col("first.check"))
    pairs = pairs.select("doc_id", "mark", "size", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark"), F.col("first.a").alias("a"), F.explode("starts").alias("b"))
    # a document's own runs at most
    pairs = pairs.groupBy("doc_id", "mark", "first_id", "first_mark").agg(F.collect_set(F.struct("a", "b", "size")).alias("x")).select("doc_id", "mark", "x.a", "x.b", "x.size")
    found = pairs.mapInPandas(_align, "doc_id long, mark long, spans array<long>").select("doc_id", "mark", F.explode("spans").alias("span"))
    # a document has no more spans than pairs of its lines
    found = found.groupBy("doc_id", "mark").agg(F.collect_set("span").alias("spans"))
    found = found.mapInPandas(_flags, "doc_id long, mark long, flags array<boolean>, n_removed long, n_blocks long")
    joined = marked.join(found, ["doc_id", "mark"], "left")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get("flags", i), F.lit(False))), "\n")
    return joined.select(
        *[F.when(F.col("flags").isNull(), F.col("text")).otherwise(kept).alias("text") if n == "text" else F.col(f"`{n}`") for n in own],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_blocks", F.lit(0).cast("long")).alias("n_blocks"),
    )
