"""Small tables with every awkward case, and brute-force versions."""

import hashlib
import random
import re
from collections import defaultdict

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, shard int, size string, part double, mark string, kept string, n_removed int, Bucket string"


def words(seed, n, alphabet="abcdefgh"):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 7))) for _ in range(n)]


def awkward():
    """Nulls, blanks, ties, repeated rows, copies, near copies, a long text, clashing columns."""
    base = words(1, 120)
    near = list(base)
    near[60] = "changed"
    lines = "\n".join(" ".join(words(k, 12)) for k in range(20, 28))
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "two words"), (5, "two words"), (6, " ".join(base)), (7, " ".join(base)), (8, " ".join(near)), (9, lines),
        (10, lines + "\n" + " ".join(words(50, 40))), (11, " ".join(words(60, 90))), (12, "Ünïcode ßtraße ñandú 中文 😀 " * 30), (13, "a" * 3000), (14, " ".join(words(70, 8000))), (None, " ".join(words(80, 60))),
        (4, "two words"), (15, "x\n\n\n" + "repeat this very same line here please\n" * 9), (16, "the quick brown fox"), (17, "THE quick\tbrown fox"),
    ]
    return [(i, t, None if i == 6 else ("en", "de", "fr")[(i or 0) % 3], None, None if t is None else len(t), 7, "x", 1.5, "m", "k", 3, "b") for i, t in texts]


def docs(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, COLUMNS).repartition(3)


def from_texts(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def near_components(texts):
    """doc_id -> (shingles, smallest id reachable)."""
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), top(i)) for i in ids}


def repeated_bytes(texts, length=100):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    seen, out = set(), {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        data = (t or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = [True] * length
            else:
                seen.add(s)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone, strict=True) if not g)).hexdigest())
    return out


def vector_links(rows, least=0.98):
    """vec_id -> (links, smallest id reachable)."""
    import numpy as np

    sound = {}
    for i, v, label in rows:
        if v is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = (label, np.array(v, float) / np.linalg.norm(np.array(v, float)))
    links, up = defaultdict(int), {i: i for i, _, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sound)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sound[a][0] == sound[b][0] and len(sound[a][1]) == len(sound[b][1]) and sound[a][1] @ sound[b][1] >= least:
                links[a] += 1
                links[b] += 1
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: (links[i], top(i)) for i, _, _ in rows}
