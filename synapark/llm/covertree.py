"""Exact cosine near-duplicates by dual traversal of a cover tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, flat_ranges
from .components import components

#: Points that one task holds of a node at most; points of a node looked at to find its centres.
LEAF, LOOKED_AT = 8192, 2048
#: A node whose next net takes more centres isn't parted by distance; rounds in which a net grows.
CHILDREN, ROUNDS = 64, 6
#: Covering radii of the levels, each half the one before.
RADII = tuple(1.0 / 2**k for k in range(7))
#: Guards the bounds against rounding; what lies so near the threshold is compared itself.
SLACK = 1e-7
#: Pairs of nodes looked at in one go; bounds the temporaries.
PAIRS = 1 << 20

POINT = "cls long, least long, copies long, v array<double>"


def _unit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [np.asarray(v, float) for v in batch["v"]]
        rows = [v / np.abs(v).max() for v in rows]
        yield batch.assign(v=[v / np.sqrt(v @ v) for v in rows])


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 1))


def far(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, all of ``x`` to all of ``y``."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def cover(points: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, list[int]]:
    """A greedy net: the centre within ``radius`` of each point, and the centres, of which the first point is one.

    Centres lie further apart than ``radius``. Ends with points at -1 where ``most`` centres don't do.
    """
    owner = np.full(len(points), -1)
    centers: list[int] = []
    free = np.arange(len(points))
    while len(free) and (most is None or len(centers) < most):
        batch = free[:256]
        gap = far(points[batch], points[batch])
        open_, picked = np.ones(len(batch), bool), []
        for k in range(len(batch)):
            if open_[k]:
                picked.append(batch[k])
                open_ &= gap[k] > radius
        picked = np.array(picked[: None if most is None else most - len(centers)])
        gap = far(points[free], points[picked])
        near = gap.argmin(1)
        hit = gap[np.arange(len(free)), near] <= radius
        owner[free[hit]] = picked[near[hit]]
        owner[picked] = picked
        centers += picked.tolist()
        free = free[owner[free] < 0]
    return owner, centers


def nest(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nested nets of the halving radii: an order of the points, and the node of each at every level.

    Nodes are runs of the order, and a node's first point is its centre at its
    level and at all below.
    """
    order, starts = np.arange(len(points)), np.array([0])
    path = []
    for radius in RADII:
        ends = np.r_[starts[1:], len(points)]
        begun = [starts]
        for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            owner, centers = cover(points[order[s:e]], radius)
            if len(centers) > 1:
                nth = np.zeros(e - s, np.int64)
                nth[centers] = np.arange(len(centers))
                turn = np.lexsort((owner != np.arange(e - s), nth[owner]))
                order[s:e] = order[s:e][turn]
                begun.append(s + np.flatnonzero(np.diff(nth[owner][turn])) + 1)
        starts = np.sort(np.concatenate(begun))
        path.append(np.searchsorted(starts, np.arange(len(points)), side="right") - 1)
    return order, np.stack(path, 1)


def _nest(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("cls", kind="stable")
    order, path = nest(matrix(pdf["v"]))
    return pdf.iloc[order].assign(place=np.arange(len(order)), path=list(path.astype(np.int32)))


class Block:
    """Points in nested order, with the bounds of their nodes level by level."""

    def __init__(self, pdf: pd.DataFrame):
        pdf = pdf.sort_values("place")
        self.points = matrix(pdf["v"])
        self.cls, self.least, self.copies = (pdf[c].to_numpy() for c in ("cls", "least", "copies"))
        self.sum = np.r_[0, np.cumsum(self.copies)]
        self.first, self.end, self.radius = [], [], []
        for column in np.stack(pdf["path"].to_numpy()).T:
            first = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
            own = np.einsum("ij,ij->i", self.points, self.points[np.repeat(first, np.diff(np.r_[first, len(column)]))])
            self.first.append(first)
            self.end.append(np.r_[first[1:], len(column)])
            self.radius.append(np.maximum.reduceat(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * own)), first))
            self.radius[-1][self.end[-1] - first == 1] = 0.0
        #: children of node k of a level are nodes kids[level][k] up to kids[level][k + 1] of the next
        self.kids = [np.searchsorted(self.first[d + 1], np.r_[self.first[d], len(pdf)]) for d in range(len(self.first) - 1)]


def unite(top: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Joins the sets of ``p[k]`` and ``q[k]``; ``top`` names the least place of each place's set."""
    while True:
        a, b = top[p], top[q]
        apart = a != b
        if not apart.any():
            return
        p, q, a, b = p[apart], q[apart], a[apart], b[apart]
        np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
        while (top[top] != top).any():
            top[:] = top[top]


class Links:
    """Counts and connected sets of the points of two blocks (or of one)."""

    def __init__(self, a: Block, b: Block, same: bool, threshold: float):
        self.a, self.b, self.same, self.threshold = a, b, same, threshold
        self.shift = 0 if same else len(a.cls)
        size = len(a.cls) + (0 if same else len(b.cls))
        self.edge, self.own, self.bound = (np.zeros(size + 1, np.int64) for _ in range(3))
        self.top = np.arange(size)

    def whole(self, d: int, x: np.ndarray, y: np.ndarray) -> None:
        """All points of nodes x link with all of nodes y."""
        a, b = self.a, self.b
        x0, x1, y0, y1 = a.first[d][x], a.end[d][x], b.first[d][y], b.end[d][y]
        to_x, to_y = b.sum[y1] - b.sum[y0], a.sum[x1] - a.sum[x0]
        np.add.at(self.edge, x0, to_x)
        np.add.at(self.edge, x1, -to_x)
        itself = (x == y) if self.same else np.zeros(len(x), bool)
        np.add.at(self.own, x0[itself], 1)
        np.add.at(self.own, x1[itself], -1)
        other = ~itself
        np.add.at(self.edge, y0[other] + self.shift, to_y[other])
        np.add.at(self.edge, y1[other] + self.shift, -to_y[other])
        for s, e in ((x0, x1), (y0 + self.shift, y1 + self.shift)):
            # a node's points lie in a row: mark the steps between them
            many = e - s > 1
            np.add.at(self.bound, s[many], 1)
            np.add.at(self.bound, e[many] - 1, -1)
        unite(self.top, x0[other], y0[other] + self.shift)

    def compare(self, d: int, x: np.ndarray, y: np.ndarray) -> None:
        """Compares the points of nodes x with those of nodes y themselves."""
        a, b = self.a, self.b
        m, n = a.end[d][x] - a.first[d][x], b.end[d][y] - b.first[d][y]
        for part in chunks(m * n):
            pair = np.repeat(part, (m * n)[part])
            nth = flat_ranges(np.zeros(len(part), np.int64), (m * n)[part])
            p, q = a.first[d][x[pair]] + nth // n[pair], b.first[d][y[pair]] + nth % n[pair]
            if self.same:
                p, q = p[p < q], q[p < q]
            hit = np.einsum("ij,ij->i", a.points[p], b.points[q]) >= self.threshold
            p, q = p[hit], q[hit]
            np.add.at(self.edge, p, b.copies[q])
            np.add.at(self.edge, p + 1, -b.copies[q])
            np.add.at(self.edge, q + self.shift, a.copies[p])
            np.add.at(self.edge, q + self.shift + 1, -a.copies[p])
            unite(self.top, p, q + self.shift)

    def result(self) -> pd.DataFrame:
        """Rows cls, -1, links; and rows least, least, 0 that join what is linked."""
        step = np.flatnonzero(np.cumsum(self.bound)[:-1] > 0)
        unite(self.top, step, step + 1)
        blocks = (self.a,) if self.same else (self.a, self.b)
        cls, least, copies = (np.concatenate([getattr(x, c) for x in blocks]) for c in ("cls", "least", "copies"))
        n = np.cumsum(self.edge)[:-1] - np.cumsum(self.own)[:-1] * copies
        some, low = n > 0, self.top != np.arange(len(cls))
        return pd.DataFrame({"x": np.r_[cls[some], least[low]], "y": np.r_[np.full(some.sum(), -1), least[self.top[low]]], "n": np.r_[n[some], np.zeros(low.sum(), np.int64)], "count": np.r_[np.ones(some.sum(), bool), np.zeros(low.sum(), bool)]})


def chunks(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Places of sizes in runs of about PAIRS together."""
    if len(sizes):
        yield from np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(np.cumsum(sizes) // PAIRS)) + 1)


def traverse(a: Block, b: Block, same: bool, threshold: float) -> Links:
    """Links between two blocks, or inside one.

    Pairs of nodes go down level by level. A pair whose balls are further apart
    than the threshold is dropped; one whose farthest points are within it links
    as a whole, without its pairs being listed; what is left of the last level,
    or of two single points, is compared.
    """
    links = Links(a, b, same, threshold)
    limit = float(np.sqrt(2.0 - 2.0 * threshold))
    last = len(a.first) - 1
    todo: list[tuple[int, np.ndarray, np.ndarray]] = []

    def judge(d: int, x: np.ndarray, y: np.ndarray, gap: np.ndarray) -> None:
        reach = a.radius[d][x] + b.radius[d][y]
        whole = gap + reach <= limit - SLACK
        links.whole(d, x[whole], y[whole])
        rest = ~whole & (gap - reach <= limit + SLACK)
        x, y, reach = x[rest], y[rest], reach[rest]
        final = (reach == 0) | (d == last)
        links.compare(d, x[final], y[final])
        if not final.all():
            todo.append((d, x[~final], y[~final]))

    def meet(d: int, x0: int, x1: int, y0: int, y1: int, triangle: bool) -> None:
        """All nodes of two ranges, some rows at a time."""
        right, rows = b.points[b.first[d][y0:y1]], max(1, PAIRS // max(1, y1 - y0))
        for at in range(x0, x1, rows):
            to = min(x1, at + rows)
            gap = far(a.points[a.first[d][at:to]], right)
            near = gap - b.radius[d][y0:y1] <= a.radius[d][at:to, None] + (limit + SLACK)
            if triangle:
                near &= np.arange(at, to)[:, None] <= np.arange(y0, y1)
            i, j = np.nonzero(near)
            judge(d, at + i, y0 + j, gap[i, j])

    meet(0, 0, len(a.first[0]), 0, len(b.first[0]), same)
    while todo:
        d, x, y = todo.pop()
        m, n = np.diff(a.kids[d])[x], np.diff(b.kids[d])[y]
        large = m * n > PAIRS // 4
        for i, j in zip(x[large].tolist(), y[large].tolist(), strict=True):
            meet(d + 1, a.kids[d][i], a.kids[d][i + 1], b.kids[d][j], b.kids[d][j + 1], same and i == j)
        x, y, m, n = x[~large], y[~large], m[~large], n[~large]
        for part in chunks(m * n):
            pair = np.repeat(part, (m * n)[part])
            nth = flat_ranges(np.zeros(len(part), np.int64), (m * n)[part])
            i, j = a.kids[d][x[pair]] + nth // n[pair], b.kids[d][y[pair]] + nth % n[pair]
            if same:
                i, j = i[i <= j], j[i <= j]
            dot = np.einsum("ij,ij->i", a.points[a.first[d + 1][i]], b.points[b.first[d + 1][j]])
            judge(d + 1, i, j, np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dot)))
    return links


def _pair(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, right = Block(pdf[pdf["side"] == 0]), pdf[pdf["side"] == 1]
        same = not len(right)
        return traverse(a, a if same else Block(right), same, threshold).result()

    return run


def _choose(radius: float):
    """A net of the points looked at of a node; where it takes too many centres, the first alone, and ``spread``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cls", kind="stable")
        points, node = matrix(pdf["v"]), pdf["node"].iloc[0]
        owner, centers = cover(points, radius, CHILDREN + 1)
        spread = len(centers) > CHILDREN or radius == 0
        centers = centers[:1] if spread else centers
        names = [f"{node}/{pdf['cls'].iloc[k]}" for k in centers]
        return pd.DataFrame({"parent": node, "node": names, "center": list(points[centers]), "spread": spread})

    return run


def _assign(radius: float):
    """Moves a bounded part of a node's points to the nearest centre within the radius, or (spread) to a child by their hash."""

    def run(points: pd.DataFrame, centers: pd.DataFrame) -> pd.DataFrame:
        names = ["node", "parent", "pieces", "far", "cls", "least", "copies", "v"]
        if not len(points) or not len(centers):  # without a centre points wait for the next round
            return points.assign(node=None, far=0.0).astype({"node": object, "v": object})[names]
        centers = centers.sort_values("node", kind="stable")
        child, gap = centers["node"].to_numpy(), far(matrix(points["v"]), matrix(centers["center"]))
        best = gap.argmin(1)
        gap = gap[np.arange(len(gap)), best]
        if centers["spread"].iloc[0]:
            node = [f"{child[0]}#{h}" for h in (points["draw"] % points["pieces"]).tolist()]
        else:
            node = np.where(gap <= radius, child[best], None)
        return points.assign(node=node, far=gap)[names]

    return run


def _grow(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits nodes until none has more than LEAF points: the points by leaf, and all nodes.

    A level's children have its radius: a net of the points looked at takes what
    lies within it, the others go into the next round's net. Nodes that a small
    net can't part (their points are far from each other, or closer than the
    last radius) are dealt by hash among children of one centre; so is what the
    rounds leave. Their radius is measured like any other, so all bounds hold.
    """
    spark = points.sparkSession
    nodes = spark.createDataFrame([], "parent string, node string, center array<double>, radius double")
    done = points.limit(0)
    for radius in (*RADII, 0.0):
        sizes = points.groupBy("node").agg(F.count("*").alias("size"))
        marked = points.join(sizes, "node")
        done = done.unionByName(marked.where(F.col("size") <= LEAF).drop("size"))
        pieces = (F.col("size") * 2 / LEAF).cast("long") + 1
        big = cut(marked.where(F.col("size") > LEAF).withColumn("pieces", pieces).drop("size"))
        if big.isEmpty():
            break
        placed = None
        for turn in range(ROUNDS):
            within = radius if turn < ROUNDS - 1 else 0.0  # what the rounds leave
            many = big.groupBy("node").agg(F.count("*").alias("left"))
            draw = F.pmod(F.xxhash64("cls", F.lit(turn), F.lit(radius)), F.lit(1_000_003)).alias("draw")
            looked = big.join(many, "node").where(draw / 1_000_003.0 * F.col("left") <= LOOKED_AT).select("node", "cls", "v")
            centers = cut(looked.groupBy("node").applyInPandas(_choose(within), "parent string, node string, center array<double>, spread boolean"))
            # parts of a node of bounded size, each with a copy of the node's few centres
            part = F.pmod(F.xxhash64("cls", F.lit(-1)), F.col("pieces")).alias("part")
            parts = big.select(F.col("node").alias("parent"), part, "pieces", F.pmod(F.xxhash64("cls", F.lit(-2)), F.lit(1 << 40)).alias("draw"), "cls", "least", "copies", "v")
            spread = big.groupBy("node").agg(F.first("pieces").alias("pieces")).withColumnRenamed("node", "parent")
            spread = centers.join(spread, "parent").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).drop("pieces")
            fields = "node string, parent string, pieces long, far double, " + POINT
            moved = cut(parts.groupBy("parent", "part").cogroup(spread.groupBy("parent", "part")).applyInPandas(_assign(within), fields))
            kept = moved.where("node IS NOT NULL")
            reach = kept.groupBy("node").agg(F.max("far").alias("radius"), F.first("parent").alias("parent"))
            named = reach.join(centers.select(F.col("node").alias("of"), "center"), F.regexp_replace("node", "#[0-9]+$", "") == F.col("of"))
            nodes = nodes.unionByName(named.select("parent", "node", "center", "radius"))
            placed = kept if placed is None else placed.unionByName(kept)
            big = moved.where("node IS NULL").select(F.col("parent").alias("node"), "pieces", "cls", "least", "copies", "v")
            if big.isEmpty():
                break
        points = placed.select("node", "cls", "least", "copies", "v")
    else:
        done = done.unionByName(points)
    return cut(done), cut(nodes)


def _leaf_pairs(leaves: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The dual traversal across tasks: pairs of leaves whose balls come near enough."""
    limit = float(np.sqrt(2.0 - 2.0 * threshold)) + SLACK
    names = leaves.select("node").distinct()
    itself = names.join(nodes.select("node", "center", "radius"), "node", "left").select(F.col("node").alias("parent"), "node", "center", "radius")
    down = cut(nodes.unionByName(itself))
    pairs = names.select(F.substring_index("node", "/", 1).alias("a")).distinct().select("a", F.col("a").alias("b"))
    depth = names.agg(F.max(F.size(F.split("node", "/")))).first()[0] or 1
    left = down.select(F.col("parent").alias("a"), F.col("node").alias("to_a"), F.col("center").alias("at_a"), F.col("radius").alias("r_a"))
    right = down.select(F.col("parent").alias("b"), F.col("node").alias("to_b"), F.col("center").alias("at_b"), F.col("radius").alias("r_b"))
    dot = F.aggregate(F.zip_with("at_a", "at_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    near = F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * dot)) - F.col("r_a") - F.col("r_b") <= limit, F.lit(True))
    for _ in range(depth - 1):
        pairs = pairs.join(left, "a").join(right, "b").where((F.col("a") != F.col("b")) | (F.col("to_a") <= F.col("to_b"))).where(near)
        pairs = cut(pairs.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct())
    return pairs


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Vectors of a label whose cosine is at least ``threshold``: vec_id, n_links, component_id, kept.

    n_links counts the other vectors linked directly, component_id is the
    smallest vec_id reachable over links, kept says whether it is the own one.

    Vectors of a label that are equal, or differ in length only, are one point
    with a number of copies. Each label's points grow a cover tree whose levels
    have halving radii: across tasks until a node has at most ``LEAF`` points,
    then inside each leaf. Pairs of nodes go down both trees together, pruned by
    their covering radii, which are measured; what remains across tasks are
    pairs of leaves, each a task of bounded size, which count links and return
    one link a point at most to join them. No group is gathered whole, and a
    tight group is counted without its pairs being listed.

    Directions without any order (random ones in many dimensions) have no small
    net: their leaves are parted by a hash and all meet, as in any exact method,
    so work and shuffle grow with the square of their number over ``LEAF``.

    A vector that is null, empty, all zero or has a null or non-finite component
    links with nothing, and so does one whose label or vec_id is null; vectors of
    other lengths are apart. Repeated rows count as copies, and vectors that
    share a vec_id are one place of the links to follow, each with its own
    n_links. No rows give none; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    able = rows.where(sound).where(F.coalesce(finite, F.lit(False)))
    able = able.select("vec_id", F.md5(F.concat(F.col("label"), F.lit("#"), F.size("v"))).alias("node"), F.pmod(F.xxhash64("vec_id"), F.lit(64)).cast("int").alias("salt"), "v")
    able = cut(able.mapInPandas(_unit, "vec_id long, node string, salt int, v array<double>"))
    classes = able.groupBy("node", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.collect_set("salt").alias("salts"))
    classes = cut(classes.withColumn("cls", F.monotonically_increasing_id()))
    points, nodes = _grow(classes.select("node", "cls", "least", "copies", "v"))
    pairs = _leaf_pairs(points, nodes, threshold)
    leaves = points.groupBy("node").applyInPandas(_nest, f"node string, {POINT}, place long, path array<int>")
    pair = F.concat_ws("|", "a", "b").alias("pair")
    sides = pairs.select(pair, F.col("a").alias("node"), F.lit(0).alias("side")).unionByName(pairs.where("a <> b").select(pair, F.col("b").alias("node"), F.lit(1).alias("side")))
    found = cut(sides.join(leaves, "node").groupBy("pair").applyInPandas(_pair(threshold), "x long, y long, n long, count boolean"))
    counts = found.where("count").groupBy(F.col("x").alias("cls")).agg(F.sum("n").alias("n"))
    known = components(found.where("NOT count").select(F.col("x").alias("a"), F.col("y").alias("b")))
    named = classes.join(counts, "cls", "left").join(known.withColumnRenamed("node", "least"), "least", "left")
    named = named.select("node", "v", F.explode("salts").alias("salt"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    # a vector that very many rows have is met in as many tasks as its rows have salts
    linked = able.join(named, ["node", "v", "salt"]).select("vec_id", "n_links", "component_id")
    # rows of one vec_id agree on what it reaches
    alone = rows.where(~sound | ~F.coalesce(finite, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
