"""Personal data: fixed forms, and identifiers found through contexts bootstrapped from them."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Kinds in the order of the result; those after ``BASE`` come from seeds and contexts alone.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Possessive forms, from the first of a row of digits: what follows a row is no digit, so none is left out and each text is read once.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Seeds of secrets: access keys and digests.
SECRET = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|(?=[a-f]*+[0-9])(?=[0-9]*+[a-f])[0-9a-f]{16,256}+)(?![A-Za-z0-9])")
#: What may be an identifier: a word with a digit, of six characters at least.
WORD = re.compile(r"(?<![A-Za-z0-9._@+/-])[A-Za-z._@+/-]*+[0-9][A-Za-z0-9._@+/-]*+")
LEAST = 6
#: Words and marks of a context, and the characters beside an identifier that they are taken from.
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_")
NEAR = 64
DIGIT = re.compile("[0-9]")
#: Tasks that the contexts or places of one item are dealt to.
SALTS = 32


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: all that may precede an @ reaches from it to the left, up to the last address."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
        last = found.end() if found else at + 1
        at = text.find("@", last)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """start, kind, end of every address, number and card, by start and kind."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p) < 4 and int(p) < 256 for p in (x.lstrip("0") or "0" for x in m[0].split(".")))]
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() < 40:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out)


def _free(spans: list[tuple[int, int, int]]):
    """Whether a place meets none of the spans."""
    starts, reach = [s for s, _, _ in spans], []
    for _, _, e in spans:
        reach.append(max(e, reach[-1] if reach else 0))

    def free(start: int, end: int) -> bool:
        k = bisect_right(starts, end - 1)
        return not k or reach[k - 1] <= start

    return free


def _number(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def contexts(text: str, start: int, end: int) -> list[int]:
    """Numbers of the lexical patterns round a place: two and three words or marks before it, and one to each side."""
    left = ["0" if t[0] in "0123456789" else t.lower() for t in TOKEN.findall(text, max(0, start - NEAR), start)][-3:]
    right = ["0" if t[0] in "0123456789" else t.lower() for t in TOKEN.findall(text, end, end + NEAR)][:1]
    out = [_number("2", *left[-2:])] if len(left) > 1 else []
    out += [_number("3", *left)] if len(left) > 2 else []
    return out + ([_number("1", left[-1], right[0])] if left and right else [])


def examined(text: str) -> tuple[list[tuple[int, int, int]], list[tuple]]:
    """The spans of a text, seeds of secrets included, and what else may be an identifier, each with its contexts."""
    spans = base_spans(text)
    if not spans and not DIGIT.search(text):
        return spans, []
    free = _free(spans)
    spans = sorted(spans + [(m.start(), BASE, m.end()) for m in SECRET.finditer(text) if free(m.start(), m.end())])
    free = _free(spans)
    found = [(s, e, k, _number(text[s:e]), contexts(text, s, e)) for s, k, e in spans]
    for m in WORD.finditer(text):
        start = m.end() - len(m[0].lstrip("._@+/-"))
        end = start + len(text[start : m.end()].rstrip("._@+/-"))
        if end - start >= LEAST and free(start, end):
            found.append((start, end, -1, _number(text[start:end]), contexts(text, start, end)))
    return spans, found


_SCAN = "doc_id long, mark long, spans array<struct<start:int,kind:int,end:int>>, found array<struct<start:int,end:int,kind:int,item:long,contexts:array<long>>>"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        both = [examined(t or "") for t in batch.pop("text")]
        yield batch.assign(
            spans=[[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans, _ in both],
            found=[[{"start": s, "end": e, "kind": k, "item": i, "contexts": c} for s, e, k, i, c in found] for _, found in both],
        )


def _salted(rows: DataFrame) -> DataFrame:
    """Each row once for every salt."""
    return rows.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))


def _salt(*names: str) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int").alias("salt")


def bootstrap(edges: DataFrame, support: int, precision: float, accept: float, rounds: int) -> DataFrame:
    """item, kind of what the contexts of known items make known, round by round.

    ``edges`` has pattern, item, kind (-1: not known), each pattern and item once. A
    round scores every pattern by the items it has: its kind is that of most known
    ones, its precision their share, where other kinds count whole and unknown
    items half. Patterns of enough known items and precision vote; an unknown item
    becomes known when the chance that all its patterns of a kind err,
    1 - known / (weight of all + 1) each, is at most 1 - ``accept``.
    """
    edges = edges.select("*", _salt("pattern"), _salt("item").alias("item_salt"))
    seeds = edges.where("kind >= 0").groupBy("item").agg(F.min("kind").alias("kind"))
    known = cut(seeds)
    for _ in range(rounds):
        marked = edges.drop("kind").join(_salted(known), ["item", "salt"], "left")
        counts = [F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"of_{k}") for k in range(len(KINDS))]
        scored = marked.groupBy("pattern").agg(F.count("*").alias("all"), *counts)
        most = F.greatest(*[f"of_{k}" for k in range(len(KINDS))])
        which = F.array_position(F.array(*[f"of_{k}" for k in range(len(KINDS))]), most).cast("int") - 1
        seen = sum((F.col(f"of_{k}") for k in range(len(KINDS))), F.lit(0))
        weight = seen + (F.col("all") - seen) / 2
        good = scored.where((most >= support) & (most >= precision * weight)).select("pattern", which.alias("vote"), (1 - most / (weight + 1)).alias("err"))
        votes = marked.where("kind IS NULL").select("pattern", "item", F.col("item_salt").alias("salt")).join(_salted(good), ["pattern", "salt"])
        votes = votes.groupBy("item", "vote").agg(F.exp(F.sum(F.log("err"))).alias("err"))
        votes = votes.groupBy("item").agg(F.min(F.struct("err", "vote")).alias("best")).where(F.col("best.err") <= 1 - accept)
        fresh = cut(votes.select("item", F.col("best.vote").alias("kind")))
        if fresh.isEmpty():
            break
        known = cut(known.unionByName(fresh))
    return known.join(seeds.select("item"), "item", "left_anti")


def personal(docs: DataFrame, support: int = 5, precision: float = 0.8, accept: float = 0.8, rounds: int = 5) -> DataFrame:
    """Personal data and secrets of every whole text.

    Addresses, card and phone numbers of fixed forms are found first, and access
    keys and digests as seeds of secrets. The words and marks round all these are
    lexical patterns; their graph with the words that bear a digit is scored round
    by round (``bootstrap``), and items that patterns of high confidence agree on
    are added, wherever they stand. Spans of the fixed forms stay as they are, and
    an added one overlaps none.

    Texts are read once, in a map that keeps spans and hashes; patterns and
    items are joined and counted in salted shuffles of distinct pairs, so neither a
    frequent context nor a frequent item meets in one task, and only whether a
    round found something comes to the driver.

    Returns doc_id, n_email, n_ip, n_card, n_phone (of the fixed forms),
    base_sha256 (of their ``kind:start:end``), spans (all, by start, then kind;
    code points, end exclusive). A null text is empty; repeated rows get a row
    each; ids may be null; no rows give none; other columns are ignored.
    """
    scanned = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), "text").mapInPandas(_scan, _SCAN)
    scanned = cut(scanned.withColumn("base", F.filter("spans", lambda x: x["kind"] < BASE)))
    found = scanned.where(F.size("found") > 0).select("doc_id", "mark", F.explode("found").alias("x")).select("doc_id", "mark", "x.*")
    edges = found.select("item", "kind", F.explode("contexts").alias("pattern")).groupBy("pattern", "item").agg(F.max("kind").alias("kind"))
    new = bootstrap(cut(edges), support, precision, accept, rounds)
    id_ = F.coalesce("doc_id", F.lit(0)).alias("id")
    places = found.where("kind < 0").select(id_, "mark", "start", "end", "item", _salt("mark"))
    more = places.join(_salted(new), ["item", "salt"]).groupBy("id", "mark").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))
    open_ = F.exists("found", lambda x: x["kind"] < 0)
    joined = scanned.where(open_).select("*", id_).join(more, ["id", "mark"], "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    both = joined.withColumn("spans", F.array_sort(F.concat("spans", F.coalesce("more", none)))).select("doc_id", "base", "spans")
    every = scanned.where(~open_).select("doc_id", "base", "spans").unionByName(both)
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return every.select("doc_id", *[number(k) for k in range(BASE)], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
