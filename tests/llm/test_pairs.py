"""Near-duplicates of vectors and texts, line and substring deduplication, components."""

import random

import numpy as np
import pytest

from synapark.llm import components, covertree, lines, minhash, suffixes

from . import helpers as H


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)] + [(500, 500)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        up[max(p, q)] = min(p, q)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up if x != 500}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def group(seed, n, size, edits):
    """Copies of a text with words changed."""
    rng = random.Random(seed)
    base = H.words(seed, size)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def near_texts():
    texts = group(1, 25, 80, 6) + group(2, 10, 60, 2) + group(3, 12, 100, 12) + [" ".join(H.words(k, 50)) for k in range(100, 120)]
    shared = " ".join(H.words(77, 40))
    texts += [shared + " " + " ".join(H.words(200 + k, 60)) for k in range(15)]
    random.Random(9).shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("texts", [near_texts(), [(i, t) for i, t, *_ in H.awkward()[:15] if i is not None]], ids=["groups", "awkward"])
def test_near_duplicates(spark, texts):
    want = H.near_components(texts)
    rows = minhash.near_duplicates(H.from_texts(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want and len(rows) == len(texts)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_awkward(spark):
    rows = minhash.near_duplicates(H.docs(spark)).collect()
    assert len(rows) == len(H.awkward())
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert got[5] == got[4] == 4 and got[8] == got[7] == got[6] == 6 and got[17] == 16 and got[1] == 1 and got[3] == 3 and got[None] is None
    assert minhash.near_duplicates(H.docs(spark).limit(0)).count() == 0


def test_keep_first(spark):
    """The text of a doc_id that is no near-duplicate stays; of repeated rows one does."""
    x, y = (" ".join(H.words(k, 40)) for k in (1, 2))
    texts = [(1, x), (2, x), (2, y), (2, y), (3, y + " more"), (4, None), (5, " "), (None, x), (None, x)]
    got = sorted(((r["doc_id"], r["text"]) for r in minhash.keep_first(H.from_texts(spark, texts)).collect()), key=str)
    assert got == sorted([(1, x), (2, y), (4, None), (5, " "), (None, x), (None, x)], key=str)
    out = minhash.keep_first(H.docs(spark))
    assert out.columns == H.docs(spark).columns and sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(i) for i in (1, 2, 3, 4, 6, 9, 10, 11, 12, 13, 14, None, 15, 16))
    assert minhash.keep_first(H.docs(spark).limit(0)).count() == 0


def test_near_duplicates_of_repeated_rows(spark):
    """Rows of one doc_id and text count once in every round."""
    texts = near_texts()
    rows = minhash.near_duplicates(H.from_texts(spark, texts + texts[::3])).collect()
    want = H.near_components(texts)
    assert len(rows) == len(texts) + len(texts[::3]) and all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in rows)


def test_prefix_pairs(spark):
    """The prefix filter names every pair at the threshold."""
    texts = near_texts()
    sets = {i: s for i, s in zip([i for i, _ in texts], minhash.shingle_sets([t for _, t in texts]), strict=True)}
    df = spark.createDataFrame([(i, i, s.tolist()) for i, s in sets.items()], "node long, component long, found array<long>")
    got = {(r["a"], r["b"]) for r in minhash.prefix_pairs(df).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert want <= got


def test_prefix_pairs_of_one_stock(spark):
    """Texts of all sizes assembled from one stock of lines: every shingle is common."""
    rng = random.Random(14)
    stock = [" ".join(H.words(900 + k, 7)) for k in range(9)]
    texts = [" ".join(rng.sample(stock, rng.randint(1, 9))) for _ in range(60)]
    texts += [" ".join(stock[:n]) for n in range(3, 10)] + [" ".join([*stock, *H.words(5, n)]) for n in (1, 4, 9, 17, 18, 19, 20, 21, 22, 23)]
    sets = dict(enumerate(minhash.shingle_sets(texts)))
    df = spark.createDataFrame([(i, i, s.tolist()) for i, s in sets.items()], "node long, component long, found array<long>")
    got = {(r["a"], r["b"]) for r in minhash.prefix_pairs(df).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert want <= got and len(want) > 10
    rows = minhash.near_duplicates(H.from_texts(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == H.near_components(list(enumerate(texts)))


@pytest.mark.parametrize("leaf", [1024, 16])
def test_vectors(spark, leaf, monkeypatch):
    monkeypatch.setattr(covertree, "LEAF", leaf)
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            center = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):
                rows.append((i, (center + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.12])).tolist(), label))
                i += 1
    tight = rng.normal(size=16)
    for _ in range(60):
        rows.append((i, (tight + rng.normal(size=16) * 0.001).tolist(), 1))
        i += 1
    for v in (None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [1.0] * 8, [2.0] * 8):
        rows.append((i, v, 1))
        i += 1
    want = H.vector_links(rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumnRenamed("label", "label").repartition(3)
    got = covertree.near_vectors(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == want and len(got) == len(rows)
    assert covertree.near_vectors(df.limit(0)).count() == 0


def test_vectors_that_distances_do_not_part(spark, monkeypatch):
    """More multiples of one vector, and more vectors that differ by rounding, than a leaf holds."""
    monkeypatch.setattr(covertree, "LEAF", 16)
    rng = np.random.default_rng(6)
    base, other = rng.normal(size=8).astype(np.float32).astype(float), rng.normal(size=8)
    rows = [(k, (base * (k + 1)).tolist(), 0) for k in range(60)]
    rows += [(100 + k, (other * (1 + rng.integers(-9, 10, 8) * 2.0**-50)).tolist(), 1) for k in range(60)]
    rows += [(200 + k, rng.normal(size=8).tolist(), k % 2) for k in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = covertree.near_vectors(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == H.vector_links(rows) and len(got) == len(rows)


def test_cover_tree_invariants():
    """Nested halving nets: children lie within their level's radius of their centre, which is their parent's or apart from it."""
    rng = np.random.default_rng(3)
    points = np.concatenate([c + rng.normal(size=(60, 8)) * s for c, s in zip(rng.normal(size=(5, 8)), (0.0, 0.01, 0.05, 0.2, 0.5), strict=True)])
    points /= np.linalg.norm(points, axis=1)[:, None]
    order, path = covertree.nest(points)
    points = points[order]
    assert sorted(order) == list(range(300))
    for level, radius in enumerate(covertree.RADII):
        heads = [int(np.flatnonzero(path[:, level] == k)[0]) for k in range(path[-1, level] + 1)]
        gap = np.linalg.norm(points - points[np.array(heads)[path[:, level]]], axis=1)
        assert gap.max() <= radius + 1e-7
        if level:
            assert {int(np.flatnonzero(path[:, level - 1] == k)[0]) for k in range(path[-1, level - 1] + 1)} <= set(heads)
            for k in range(path[-1, level - 1] + 1):
                own = [h for h in heads if path[h, level - 1] == k]
                apart = covertree.far(points[own], points[own]) + 9 * np.eye(len(own))
                assert apart.min() > radius - 1e-7


@pytest.mark.parametrize("children", [64, 2])
def test_vectors_in_many_leaves(spark, children, monkeypatch):
    """Nodes parted by nets over rounds, and nodes dealt by hash, with pairs of leaves between them."""
    monkeypatch.setattr(covertree, "LEAF", 40)
    monkeypatch.setattr(covertree, "LOOKED_AT", 30)
    monkeypatch.setattr(covertree, "CHILDREN", children)
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(9, 6))
    rows = [(k, (centers[k % 9] + rng.normal(size=6) * rng.choice([0.02, 0.1, 0.4])).tolist(), k % 2) for k in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = covertree.near_vectors(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == H.vector_links(rows) and len(got) == len(rows)


def test_vectors_that_share_an_id(spark):
    """Each vector has its own links; what either reaches, their id reaches."""
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(7, a, 0), (7, b, 0), (3, [1.0, 0.001, 0.0], 0), (5, [0.0, 1.0, 0.001], 0), (6, [0.0, 1.0, -0.001], 0), (9, [0.0, 0.0, 1.0], 0)]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in covertree.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    assert got == [(3, 1, 3), (5, 2, 3), (6, 2, 3), (7, 1, 3), (7, 2, 3), (9, 0, 9)]


def test_vectors_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0, "x"), (1, [1.0, 0.0], 0, "x"), (2, [0.0, 1.0], 0, "y"), (None, [1.0, 0.0], 0, "z")], "vec_id long, embedding array<float>, label int, node string")
    got = sorted((r["vec_id"] or -1, r["n_links"]) for r in covertree.near_vectors(df).collect())
    assert got == [(-1, 0), (1, 1), (1, 1), (2, 0)]


@pytest.mark.parametrize("crowd", [50_000, 2])
def test_substrings(spark, crowd):
    rng = random.Random(2)
    passage = " ".join(H.words(5, 60))
    texts = [(k, " ".join(H.words(300 + k, rng.randint(5, 80)))) for k in range(12)]
    texts += [(20 + k, texts[k][1] + " " + passage[: rng.randint(90, 300)] + "é" * rng.randint(0, 3) + passage) for k in range(8)]
    texts += [(40, "ab" * 400), (41, "ab" * 130), (42, texts[3][1]), (43, None), (44, ""), (45, "é中😀" * 60), (46, "中😀é" * 60), (47, passage)]
    want = H.repeated_bytes(texts)
    rows = suffixes.dedup_substrings(H.from_texts(spark, texts), crowd).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want and len(rows) == len(texts)


def test_substrings_of_a_crowded_anchor(spark, monkeypatch):
    """A passage in very many surroundings, some of them shared, over several Arrow batches."""
    rng = random.Random(4)
    passage = "".join(H.words(3, 30))[:105]
    near = ["".join(H.words(50 + k, 14)) for k in range(4)]
    texts = [(k, rng.choice(near)[-rng.randint(1, 60) :] + passage[: rng.randint(60, 105)] + rng.choice(near)[: rng.randint(1, 60)] + f"{k}") for k in range(160)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        want = H.repeated_bytes(texts)
        rows = suffixes.dedup_substrings(H.from_texts(spark, texts), 5).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == want


def test_substrings_awkward(spark):
    rows = suffixes.dedup_substrings(H.docs(spark)).collect()
    assert len(rows) == len(H.awkward()) and rows[0].asDict().keys() >= {"Bucket", "shard", "kept", "n_spans"}
    got = {r["doc_id"]: r for r in rows}
    assert got[7]["n_removed"] == got[7]["n_bytes"] and got[6]["n_removed"] == 0 and got[1]["text"] is None and got[None]["n_removed"] == 0
    assert suffixes.dedup_substrings(H.docs(spark).limit(0)).count() == 0


def test_merge_orders_like_a_sort():
    rng = np.random.default_rng(1)
    shards = [np.frombuffer(bytes(rng.integers(97, 99, n).tolist()) + b"\xff", np.uint8) for n in (400, 333, 7)]
    mix, place, group = suffixes.merge(shards)
    ring = [bytes(np.resize(s, len(s) + suffixes.LENGTH)) for s in shards]
    keys = [ring[m][p : p + suffixes.LENGTH] for m, p in zip(mix.tolist(), place.tolist(), strict=True)]
    assert keys == sorted(keys)
    assert [a == b for a, b in zip(keys, keys[1:], strict=False)] == (group[1:] == group[:-1]).tolist()


def brute_all_lines(texts):
    """Each document laid in step beside every earlier one, at every offset: equal rows of lines with enough characters go."""
    out, earlier = {}, []
    for i, t in sorted(texts):
        own = t.split("\n")
        gone = set()
        for other in earlier:
            for offset in range(-len(own), len(other)):
                row = []
                for j in range(len(own) + 1):
                    if j < len(own) and 0 <= j + offset < len(other) and own[j] == other[j + offset]:
                        row.append(j)
                    else:
                        if sum(len(own[k]) for k in row) >= lines.BLOCK_CHARS:
                            gone |= set(row)
                        row = []
        earlier.append(own)
        out[i] = ("\n".join(x for k, x in enumerate(own) if k not in gone), len(gone))
    return out


def test_lines_of_every_earlier_document(spark):
    """Crossed and repeated lines, blocks whose lines have several first holders, blocks of short lines."""
    rng = random.Random(12)
    long = ["".join(H.words(700 + k, 12)) + "x" * 30 for k in range(6)]
    mid = [f"{k} " + "m" * 26 for k in range(6)]
    short = [f"short {k}" for k in range(9)]
    texts = [(0, "\n".join([long[0], long[1]])), (1, "\n".join([long[1], "between", long[0]])), (2, "\n".join([long[1], long[1], long[0], "end"]))]
    texts += [(3, mid[0]), (4, mid[1]), (5, "\n".join(["x", *mid[:2], "y"])), (6, "\n".join(["z", *mid[:2], "w"])), (7, "\n".join(["a", *short, "b"])), (8, "\n".join(["c", *short, "d"]))]
    pool = [*long, *mid, *short, "", ""]
    texts += [(9 + k, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 16)))) for k in range(40)]
    want = brute_all_lines(texts)
    assert want[1] == ("between", 2) and want[6] == ("z\nw", 2) and want[8] == ("c\nd", 9)
    rows = lines.dedup_lines(H.from_texts(spark, texts)).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in rows} == want
    assert all((r["n_blocks"] > 0) == (r["n_removed"] > 0) for r in rows)
    assert len(lines.dedup_lines(H.docs(spark)).collect()) == len(H.awkward())
    assert lines.dedup_lines(H.docs(spark).limit(0)).count() == 0


def test_lines_of_mixed_documents(spark):
    rng = random.Random(8)
    stock = [" ".join(H.words(600 + k, 9)) for k in range(30)] + ["", "short"]
    texts = [(i, "\n".join(rng.choice(stock) if rng.random() < 0.4 else " ".join(H.words(1000 + 31 * i + k, 8)) for k in range(rng.randint(1, 14)))) for i in range(60)]
    texts += [(60 + k, texts[k][1]) for k in range(5)]
    for rare in (8, 2):  # 2: the first holders alone give the same
        rows = lines.dedup_lines(H.from_texts(spark, texts), rare=rare).collect()
        assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in rows} == brute_all_lines(texts)


def test_lines_that_a_third_of_all_have(spark):
    """A block that very many documents share, among other lines."""
    rng = random.Random(3)
    texts = [(i, "\n".join([f"own {i}", *(["a line that is common", "and one more like it, common too"] if i % 3 == 0 else []), " ".join(H.words(i, rng.randint(1, 15)))])) for i in range(240)]
    rows = lines.dedup_lines(H.from_texts(spark, texts)).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in rows} == brute_all_lines(texts)
    assert sum(r["n_removed"] for r in rows) == 158 and {r["n_blocks"] for r in rows} == {0, 1}


def test_lines_awkward(spark):
    rows = lines.dedup_lines(H.docs(spark)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(H.awkward()) and got[1]["text"] is None and got[7]["text"] == "" and got[6]["n_removed"] == 0
    assert got[10]["n_removed"] == 8 and got[9]["n_removed"] == 0
    assert lines.dedup_lines(H.docs(spark).limit(0)).count() == 0


def test_alignment_decides(spark, monkeypatch):
    """What alignment doesn't find stays, though documents share it."""
    texts = [(k, "\n".join(" ".join(H.words(j, 12)) for j in (1, 2, 3 + k))) for k in range(4)]
    assert [r["n_removed"] for r in lines.dedup_lines(H.from_texts(spark, texts)).orderBy("doc_id").collect()] == [0, 2, 2, 2]
    held = spark.createDataFrame([(1, 0, [0, 1], [0, 1], [1, 1])], "doc_id long, mark long, a array<int>, b array<int>, size array<int>").toPandas()
    assert [len(x) for x in next(lines._align(iter([held])))["spans"]] == [2]
    monkeypatch.setattr(lines, "blocks", lambda *_: [])
    assert [len(x) for x in next(lines._align(iter([held])))["spans"]] == [0]


@pytest.mark.parametrize("seed", range(3))
def test_blocks(seed):
    """Crossed, repeated and in step: each shared run is aligned once, and chains rise."""
    rng = np.random.default_rng(seed)
    earlier, sizes = rng.integers(0, 30, 60), np.ones(60, np.int64)
    later = rng.permutation(60)
    assert sorted(lines.blocks(earlier, later, sizes)) == [(k, k + 1) for k in range(60)]
    ids = rng.integers(0, 25, 80).tolist()
    parts = lines.chains(ids)
    assert sorted(k for c in parts for k in c) == list(range(80)) and all(ids[a] < ids[b] and a < b for c in parts for a, b in zip(c, c[1:], strict=False))
    assert len(lines.chains(list(range(50)))) == 1 and len(lines.chains(list(range(50))[::-1])) == 50
    n = 100_000  # crossed throughout, in far less than the square
    assert len(lines.blocks(np.arange(n)[::-1], np.arange(n), np.ones(n, np.int64))) == n


def test_patience():
    assert lines.patience([1, 2, 3, 4], [1, 9, 3, 4]) == [(0, 0), (2, 2), (3, 3)]
    assert lines.patience([5, 5, 7, 5], [8, 7, 8]) == [(2, 1)]
    assert lines.patience([], [1]) == [] and lines.patience([1], [2]) == []
