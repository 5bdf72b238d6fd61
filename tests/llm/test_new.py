"""Periodic runs, personal data and divergence of sources against direct versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from synapark.llm import divergence, personal, runs

from . import helpers as H

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """Every run by comparing each word with that one period later, period by period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > start and i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def nested(rng, kinds, size):
    """A sequence of pieces repeated within pieces."""

    def piece(depth):
        if not depth or rng.random() < 0.3:
            return [rng.randrange(kinds) for _ in range(rng.randint(1, 9))]
        return piece(depth - 1) * rng.randint(1, 9) if rng.random() < 0.6 else piece(depth - 1) + piece(depth - 1)

    out = []
    while len(out) < size:
        out += piece(5)
    return out[:size]


@pytest.mark.parametrize("kinds", [1, 2, 3, 50])
def test_periodic_runs(kinds):
    rng = random.Random(kinds)
    for size in (13, 40, 150, 400, 900, 900, 900):
        w = nested(rng, kinds, size)
        assert [tuple(r) for r in runs.periodic_runs(np.array(w)).tolist()] == plain_runs(w)


@pytest.mark.parametrize("period", [1, 2, 3, 5, 7])
def test_touching_runs(period):
    """Runs whose periods are themselves periodic: their windows have no minima of their own."""
    rng = random.Random(period)
    for size in (70, 133, 190):
        u = [rng.randrange(4) for _ in range(period)] * 60
        for w in (u[:size] * 5, u[:size] + u[:size][::-1] + [9] + u[:size], (u[:size] + [9]) * 4):
            assert [tuple(r) for r in runs.periodic_runs(np.array(w)).tolist()] == plain_runs(w)


def test_fibonacci_and_long():
    a, b = [0], [0, 1]
    while len(b) < 1200:
        a, b = b, b + a
    assert [tuple(r) for r in runs.periodic_runs(np.array(b)).tolist()] == plain_runs(b)
    assert runs.periodic_runs(np.zeros(200_000, np.int64)).tolist() == [[0, 200_000, 1]]
    long = np.r_[np.arange(70_000), np.arange(70_000), np.arange(5)]
    assert runs.periodic_runs(long).tolist() == [[0, 140_005, 70_000]]
    assert len(runs.periodic_runs(np.zeros(11, np.int64))) == len(runs.periodic_runs(np.zeros(0, np.int64))) == 0


def plain_row(i, text):
    w = WORD.findall(text or "")
    n = len(w)
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    found = plain_runs(w)
    gone = {k for s, e, q in found for k in range(s + q, e)}
    best = min(found, key=lambda r: (r[0] - r[1], r[0], r[2])) if found else None
    longest = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    return (len(found), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest())


def test_runs_of(spark):
    rng = random.Random(8)
    rows = [(i, t) for i, t, *_ in H.awkward()] + [(1000 + k, " ".join(H.words(k, 300 + 7 * k))) for k in range(120)]
    rows += [(2000 + k, " \t".join(f"w{x}" for x in nested(rng, 3, 200))) for k in range(40)] + [(2000, "again again")]
    want = sorted(((i, *plain_row(i, t)) for i, t in rows), key=str)
    got = runs.runs_of(H.from_texts(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert sum(w[1] > 0 for w in want) > 40 and max(w[4] or 0 for w in want) > 32
    assert runs.runs_of(H.docs(spark)).count() == len(H.awkward()) and runs.runs_of(H.docs(spark).limit(0)).count() == 0


PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_base(text):
    """The four forms as they are worded, by the plain expressions."""
    out = []
    for k, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            fine = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans():
    rng = random.Random(3)
    alphabet = ["a", "Z", "9", "4", "0", ".", "@", "-", "+", " ", "(", ")", "%", "_", "\n", "é", "😀", "4539578763621486", "+1 (555) 010-9999", "a.b@c.de", "10.2.255.4", "256", "."]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert personal.base_spans(text) == plain_base(text), text
    for text in ("9" * 300_000, "a" * 300_000 + "@", "1." * 100_000, "+" + "1 " * 100_000, "@" * 100_000, "a@" * 100_000, "f" * 300_000):
        assert len(personal.examined(text)[0]) <= 100_000  # in linear time


def private_corpus():
    rng = random.Random(4)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 2)) + "a7"
    prose = lambda n: " ".join(H.words(rng.randrange(10**6), n))
    texts = [f"{prose(20)} password={hexes(18)} {prose(20)}" for _ in range(12)]
    texts += [f"{prose(20)} password=Hunter{k}secret {prose(20)}" for k in range(3)]
    texts += [f"{prose(10)} write to mail: user{k}@site{k % 3}.example.com today {prose(10)}" for k in range(12)]
    texts += [f"{prose(10)} write to mail: user{k}[at]site today or mail: joe{k}77.example today" for k in range(2)]
    texts += [f"{prose(10)} version 2024.{k}b and item A{k}1234 {prose(10)}" for k in range(10)] + [prose(60) for _ in range(20)]
    texts += [f"elsewhere Hunter1secret again {prose(5)}", None, "", "+1 (555) 010-9999 and 4539578763621486 or 10.0.0.1"]
    return list(enumerate(texts))


def test_personal(spark):
    texts = private_corpus()
    rows = {r["doc_id"]: r for r in personal.personal(H.from_texts(spark, texts)).collect()}
    for i, text in texts:
        base = plain_base(text)
        written = [f"{PLAIN[k][0]}:{s}:{e}" for s, k, e in base]
        r = rows[i]
        assert [r[f"n_{name}"] for name, _ in PLAIN] == [sum(k == n for _, k, _ in base) for n in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(filter(None, r["spans"].split(",")))
    found = {i: [(x.split(":")[0], texts[i][1][int(x.split(":")[1]) : int(x.split(":")[2])]) for x in rows[i]["spans"].split(",") if x] for i, _ in texts}
    assert all(len(found[k]) == 1 and found[k][0][0] == "secret" for k in range(12))
    assert [found[12 + k] for k in range(3)] == [[("secret", f"Hunter{k}secret")] for k in range(3)]
    assert found[27][-1] == ("email", "joe077.example") and found[59] == [("secret", "Hunter1secret")]
    assert all(not found[k] for k in range(29, 59)) and [k for k, _ in found[62]] == ["phone", "card", "ip"]


def plain_bootstrap(edges, support, precision, accept, rounds):
    items, patterns, known = defaultdict(set), defaultdict(set), {}
    for p, i, k in edges:
        items[i].add(p)
        patterns[p].add(i)
        if k >= 0:
            known[i] = min(k, known.get(i, 9))
    seeds = set(known)
    for _ in range(rounds):
        good = {}
        for p, held in patterns.items():
            by = Counter(known[i] for i in held if i in known)
            if by:
                most, weight = max(by.values()), sum(by.values()) + (len(held) - sum(by.values())) / 2
                if most >= support and most >= precision * weight:
                    good[p] = (min(k for k, n in by.items() if n == most), 1 - most / (weight + 1))
        fresh = {}
        for i, held in items.items():
            if i not in known:
                err = defaultdict(lambda: 1.0)
                for p in held & good.keys():
                    err[good[p][0]] *= good[p][1]
                if err and min((e, k) for k, e in err.items())[0] <= 1 - accept:
                    fresh[i] = min((e, k) for k, e in err.items())[1]
        if not fresh:
            break
        known |= fresh
    return {i: k for i, k in known.items() if i not in seeds}


def test_bootstrap(spark):
    rng = random.Random(6)
    edges = {}
    for item in range(400):
        kind = rng.choice([0, 0, 1, 2, 4])
        for _ in range(rng.randint(1, 4)):
            edges[(kind * 10 + rng.randrange(10) if rng.random() < 0.95 else rng.randrange(50), item)] = kind if item % 3 and (kind < 4 or item % 2) else -1
    rows = [(p, i, k) for (p, i), k in edges.items()]
    got = {r["item"]: r["kind"] for r in personal.bootstrap(spark.createDataFrame(rows, "pattern long, item long, kind int"), 3, 0.6, 0.7, 4).collect()}
    assert got == plain_bootstrap(rows, 3, 0.6, 0.7, 4) and len(got) > 30


def test_personal_awkward(spark):
    rows = personal.personal(H.docs(spark)).collect()
    assert len(rows) == len(H.awkward()) and all(r["spans"] == "" and r["n_email"] == 0 for r in rows)
    twice = H.from_texts(spark, [(1, "a@b.cd"), (1, "a@b.cd"), (1, "x"), (None, "c@d.ef x12345y")])
    assert sorted(r["spans"] for r in personal.personal(twice).collect()) == ["", "email:0:6", "email:0:6", "email:0:6"]
    assert personal.personal(H.docs(spark).limit(0)).count() == 0


def plain_divergence(rows, least, top):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in ((t or "", la or "", s or "") for t, la, s in rows):
        groups.add((lang, source))
        count[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = sorted(s for la, s in groups if la == lang)
        total = Counter()
        for s in own:
            total.update(count[lang, s])

        def p(c, kept=kept):
            n = sum(c[t] for t in kept)
            return [1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept]

        shares, q = {s: p(count[lang, s]) for s in own}, p(total)
        for s in own:
            pairs = sorted((-sum(abs(a - b) for a, b in zip(shares[s], shares[x], strict=True)), x.encode()) for x in own if x != s)
            above = sorted((b - a, t.encode()) for t, a, b in zip(kept, shares[s], q, strict=True) if count[lang, s][t] and a > b)
            for part, found in (("pair", pairs), ("term", above[:top])):
                out |= {(lang, s, part, x.decode(), -v, k) for k, (v, x) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("blocks", [(256, 2048), (2, 7)])
def test_divergence(spark, blocks):
    rng = random.Random(2)
    rows = [(" ".join(H.words(rng.randrange(40), 30, "abÉß") + ["Common"] * rng.randrange(3)), rng.choice(["en", "de", None]), f"s{min(rng.randrange(9), rng.randrange(9))}") for _ in range(300)]
    rows += [(None, "en", "empty"), ("", "xx", "a"), (None, "xx", None), ("...", "yy", "b"), rows[0], rows[0]]
    df = spark.createDataFrame([(i, t, la, s, "clash", 1) for i, (t, la, s) in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n int").repartition(3)
    got = divergence.divergence(df, least=10, top=5, groups=blocks[0], terms=blocks[1]).collect()
    assert {tuple(r) for r in got} == plain_divergence(rows, 10, 5) and len(got) == len({tuple(r) for r in got})


def test_divergence_awkward(spark):
    assert {tuple(r) for r in divergence.divergence(H.docs(spark), least=2).collect()} == plain_divergence([(t, la, s) for _, t, la, s, *_ in H.awkward()], 2, 50)
    assert divergence.divergence(H.docs(spark).limit(0)).count() == 0
