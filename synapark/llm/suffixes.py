"""Repeated substrings by merging Burrows-Wheeler transforms of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, mix64, slices

#: Bytes of a repeated string, of the pieces whose hashes are compared, and pieces in a string.
LENGTH, PIECE = 100, 20
WINDOW = LENGTH - PIECE + 1
#: An anchor with more than so many different contexts is parted by the bytes beside it before its contexts are merged.
CROWD = 50_000
#: Bytes of a shard, and of contexts merged in one go (more only for one anchor's).
SHARD, MERGED = 1 << 14, 60_000
#: Bytes of a letter of the transforms.
LETTER = 8
END = 0xFF  # no byte of UTF-8

_MARKS = 1 << 20  # places carry 20 bits of their text's hash above 40 bits of offset
_OFFSET = 40
_LOW = (1 << _OFFSET) - 1
#: Spans are an offset above 23 bits of length; longer ones are written as several.
_PACK = 23
_SIZE = (1 << _PACK) - 1


def packs(raw: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from each place on, as one little-endian integer."""
    return np.ndarray((len(raw) - size + 1,), f"<u{size}", raw.data, strides=(1,)).astype(np.uint64)


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over the ``width`` values from each place on."""
    done, out = 1, x
    while done * 2 <= width:
        out = op(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of texts: text number, offset, hash, and first and last string that has it.

    The anchor of a string of LENGTH bytes is its first piece of least hash, so
    equal strings have equal anchors at equal places (winnowing). The strings of
    an anchor follow one another.
    """
    none = np.zeros(0, np.int64)
    sizes = np.array([len(d) for d in data], np.int64)
    if sizes.max(initial=0) < LENGTH:
        return none, none, none, none, none
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(data) + bytes(8), np.uint8)
    eight, four = packs(raw, 8), packs(raw, 4)
    n = int(sizes.sum()) - PIECE + 1
    with np.errstate(over="ignore"):
        h = mix64(mix64(eight[:n] * np.uint64(0x9E3779B97F4A7C15) + eight[8 : n + 8]) + four[16 : n + 16] * np.uint64(0xC2B2AE3D27D4EB4F))
    least = sliding(h, WINDOW, np.minimum)
    inside = np.zeros(len(least) + 1, np.int64)
    full = sizes >= LENGTH
    np.add.at(inside, starts[full], 1)
    np.add.at(inside, starts[full] + sizes[full] - LENGTH + 1, -1)
    string = np.flatnonzero(np.cumsum(inside[:-1]))
    least = least[string]
    # the piece of least hash, looked for among those that are least in any string
    picked = np.zeros(len(h), bool)
    wide = np.zeros(len(h) + WINDOW - 1, np.uint64)
    wide[string + WINDOW - 1] = least
    picked[h == sliding(wide, WINDOW, np.maximum)[: len(h)]] = True
    at = np.flatnonzero(picked)
    nth = np.searchsorted(at, string) if len(at) < 64 else (np.cumsum(picked) - picked)[string]
    open_ = np.arange(len(string))
    while len(open_):
        open_ = open_[h[at[nth[open_]]] != least[open_]]
        nth[open_] += 1
    edge = np.r_[True, (nth[1:] != nth[:-1]) | (string[1:] != string[:-1] + 1)]
    first = string[edge]
    last = string[np.r_[np.flatnonzero(edge)[1:] - 1, len(string) - 1]]
    place = at[nth[edge]]
    text = np.searchsorted(starts, first, side="right") - 1
    return text, place - starts[text], h[place].view(np.int64), first - starts[text], last - starts[text]


def _texts(batch: pd.DataFrame) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch["text"].tolist()
    for i, j in slices(texts, 400_000):
        yield i, j, [t.encode("utf-8", "replace") for t in texts[i:j]]


def _repeated(frame: pd.DataFrame) -> np.ndarray:
    """Rows, sorted by piece, context and place, whose context the row before has too."""
    piece, context = frame["piece"].to_numpy(), frame["context"].to_numpy()
    return np.r_[False, (piece[1:] == piece[:-1]) & (context[1:] == context[:-1])][: len(frame)]


ORDER = ["piece", "context", "doc_id", "place"]
#: ``reach``: width of the anchor, bytes before it and bytes from it on of its context; ``context`` null marks a span to remove.
ANCHORS = "piece long, context long, doc_id long, place long, reach long"
_REACH, _WIDTH = 20, 40
_PART = (1 << _REACH) - 1


def _combined(rows: pd.DataFrame) -> pd.DataFrame:
    """Anchors sorted, of equal ones the first; the others become spans to remove."""
    rows = rows.sort_values(ORDER, kind="stable")
    again = _repeated(rows)
    if again.any():
        rows["context"] = rows["context"].astype("Int64").mask(again)
        rows.loc[again, "piece"] = rows.loc[again, "doc_id"]  # spans go anywhere
    return rows


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Anchors with hashes of their contexts; of equal ones in a batch the first, the others as spans to remove."""
    for batch in batches:
        parts = []
        for i, j, data in _texts(batch):
            text, offset, piece, first, last = anchors(data)
            doc, mark = batch["doc_id"].to_numpy()[i:j], batch["mark"].to_numpy()[i:j]
            ends = last + LENGTH
            digest = xxhash.xxh3_64_intdigest
            found = (digest(data[t][a:b], p & 0xFF) for t, a, b, p in zip(text.tolist(), first.tolist(), ends.tolist(), (offset - first).tolist(), strict=True))
            context = np.fromiter(found, np.uint64, len(text)).view(np.int64)
            parts.append(pd.DataFrame({"piece": piece, "context": context, "doc_id": doc[text], "place": (mark[text] << _OFFSET) | offset, "reach": (PIECE << _WIDTH) | ((offset - first) << _REACH) | (ends - offset)}))
        if parts:
            yield _combined(pd.concat(parts, ignore_index=True))


#: What is found about a document: spans to remove, and contexts that have to be compared (``piece``) or parted first (``reach``); offsets and lengths are packed.
FOUND = "doc_id long, mark long, span long, piece long, reach long"


def _meet(crowd: int):
    """Over anchors sorted by ``ORDER``: spans to remove, and the contexts of anchors that have several.

    Holds one anchor's rows until it has more than ``crowd`` different contexts;
    what comes of it then goes on at once, to be parted.
    """

    def settle(rows: pd.DataFrame, before: tuple | None, crowded: bool) -> pd.DataFrame:
        context = rows["context"]
        span = context.isna().to_numpy()
        again = _repeated(rows.assign(context=context.fillna(0).astype("int64"))) & ~span
        if before is not None and len(rows) and not span[0]:
            again[0] = (rows["piece"].iloc[0], context.iloc[0]) == before
        alone = ~span & ~again
        piece = rows["piece"].to_numpy()
        _, which, many = np.unique(piece[alone], return_inverse=True, return_counts=True)
        asked = np.zeros(len(rows), bool)
        asked[np.flatnonzero(alone)[(many[which] > 1) | crowded]] = True
        keep = span | again | asked
        place, reach = rows["place"].to_numpy(), rows["reach"].to_numpy()
        start, after = (reach >> _REACH) & _PART, reach & _PART
        out = pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "mark": place >> _OFFSET, "span": ((place & _LOW) - start) << _PACK | (start + after)})
        out["piece"] = pd.array(np.where(asked, piece, 0), dtype="Int64")
        out.loc[~asked, "piece"] = pd.NA
        out["reach"] = pd.array(np.where(asked & crowded, reach, 0), dtype="Int64")
        out.loc[~(asked & crowded), "reach"] = pd.NA
        return out[keep]

    def contexts(rows: pd.DataFrame) -> int:
        return int((~_repeated(rows.assign(context=rows["context"].fillna(0).astype("int64"))) & rows["context"].notna().to_numpy()).sum())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        crowded, before = None, None  # the anchor that is being passed on, and its last context
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            piece = rows["piece"].to_numpy()
            head = int(np.searchsorted(piece, crowded, side="right")) if crowded is not None else 0
            if head:
                yield settle(rows.iloc[:head], before, True)
                last = rows.iloc[head - 1]
                before = (last["piece"], last["context"]) if not pd.isna(last["context"]) else before
                rows, piece = rows.iloc[head:], piece[head:]
            if not len(rows):
                held = None
                continue
            crowded, before = None, None
            tail = int(np.searchsorted(piece, piece[-1]))
            if tail:
                yield settle(rows.iloc[:tail], None, False)
            held = rows.iloc[tail:]
            if contexts(held) > crowd:
                yield settle(held, None, True)
                last = held.iloc[-1]
                crowded, before, held = piece[-1], (last["piece"], last["context"]), None
        if held is not None:
            yield settle(held, None, False)

    return run


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of each context that is asked for."""
    for batch in batches:
        rows = []
        for doc, mark, text, asked in zip(batch["doc_id"], batch["mark"], batch["text"], batch["asked"], strict=True):
            if asked is None or not len(asked):
                continue
            data, high = text.encode("utf-8", "replace"), int(mark) << _OFFSET
            for s in asked:
                start, size = s["span"] >> _PACK, s["span"] & _SIZE
                rows.append((s["piece"], data[start : start + size], doc, high | start))
        if rows:
            yield pd.DataFrame(rows, columns=["piece", "own", "doc_id", "place"])


def letters(shards: list[np.ndarray]) -> list[np.ndarray]:
    """For each place of each shard, a circular byte string, the number of the letter that begins there.

    A letter is LETTER bytes, so a transform has the letters of all phases. Numbers
    stand in the order of their letters.
    """
    codes = []
    for shard in shards:
        ring = np.r_[shard, np.resize(shard, LETTER)]
        code = np.zeros(len(shard), np.uint64)
        for k in range(LETTER):
            code = (code << np.uint64(8)) | ring[k : k + len(shard)].astype(np.uint64)
        codes.append(code)
    unique, number = np.unique(np.concatenate(codes), return_inverse=True)
    number = number.astype(np.uint16 if len(unique) <= 1 << 16 else np.int32)
    return np.split(number, np.cumsum([len(s) for s in shards])[:-1])


def suffix_order(number: np.ndarray, depth: int) -> np.ndarray:
    """Places of a circular string in the order of ``depth`` letters from each on."""
    order = np.arange(len(number))
    for k in reversed(range(depth)):
        order = order[np.argsort(np.roll(number, -k * LETTER)[order], kind="stable")]
    return order


def merge(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, place and class of every suffix of the shards, in merged order.

    Each shard is a circular byte string with its transform: the letters before
    its sorted suffixes. The interleave says which shard the next suffix of the
    merged order is from. At first it is sorted by nothing; each round writes
    every shard number behind the letter that precedes its suffix, in a stable
    order, and so sorts by one letter more. Suffixes of a class have as long a
    common prefix as rounds went by; where a class is split, it ends. The last
    round takes the part of a letter that makes up LENGTH, after which classes
    are the intervals of repeated strings. The suffixes of all shards are never
    sorted together and no text is looked at, only the transforms.
    """
    whole, part = divmod(LENGTH, LETTER)
    number = letters(shards)
    orders = [suffix_order(x, whole + 1) for x in number]
    # letters before each suffix; and, for the last round, the shorter ones
    before = [np.concatenate([np.roll(x, LETTER)[o] for x, o in zip(number, orders, strict=True)])] * whole
    if part:
        bytes_ = [sum(np.roll(s, part - k).astype(np.uint64) << np.uint64(8 * (part - 1 - k)) for k in range(part)) for s in shards]
        short = np.unique(np.concatenate(bytes_), return_inverse=True)[1]
        short = np.split(short.astype(np.uint16 if short.max(initial=0) < 1 << 16 else np.int32), np.cumsum([len(s) for s in shards])[:-1])
        before.append(np.concatenate([x[o] for x, o in zip(short, orders, strict=True)]))
    kind = np.uint8 if len(shards) < 256 else np.uint16
    mix = np.repeat(np.arange(len(shards)), [len(s) for s in shards]).astype(kind)
    group = np.zeros(len(mix), np.int32)
    for letter in before:
        held = np.empty_like(letter)
        held[np.argsort(mix, kind="stable")] = letter
        turn = np.argsort(held, kind="stable")
        mix, group, held = mix[turn], group[turn], held[turn]
        group = np.r_[0, np.cumsum((held[1:] != held[:-1]) | (group[1:] != group[:-1]))].astype(np.int32)
    # a shard's suffixes come in the order that ends with the shorter letter, which its own order has to follow
    place = np.empty(len(mix), np.int64)
    final = []
    for k, o in enumerate(orders):
        final.append((o - part)[np.argsort(short[k][o], kind="stable")] % len(o) if part else o)
    place[np.argsort(mix, kind="stable")] = np.concatenate(final)
    return mix, place, group


def repeats(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, offset and class of every string of LENGTH bytes that the contexts have more than once."""
    shards, held, size = [], [[]], 0
    for k, own in enumerate(contexts):
        if size + len(own) > SHARD and held[-1]:
            held.append([])
            size = 0
        held[-1].append(k)
        size += len(own) + 1
    for members in held:
        shards.append(np.frombuffer(b"".join(contexts[k] + bytes([END]) for k in members), np.uint8))
    mix, place, group = merge(shards)
    sizes = [np.array([len(contexts[k]) + 1 for k in members], np.int64) for members in held]
    first = [np.cumsum(s) - s for s in sizes]
    context, offset = np.empty(len(mix), np.int64), np.empty(len(mix), np.int64)
    for s, members in enumerate(held):
        mine = np.flatnonzero(mix == s)
        nth = np.searchsorted(first[s], place[mine], side="right") - 1
        context[mine], offset[mine] = np.array(members)[nth], place[mine] - first[s][nth]
    length = np.array([len(c) for c in contexts], np.int64)
    whole = offset <= length[context] - LENGTH
    context, offset, group = context[whole], offset[whole], group[whole]
    many = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    return context[many], offset[many], group[many]


def spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """The union of spans, document by document, packed."""
    out: list[tuple[int, int, int]] = []
    if len(doc):
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        fresh = np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] > end[:-1])]  # all are equally long, so ends rise too
        head = np.flatnonzero(fresh)
        last = np.r_[head[1:] - 1, len(doc) - 1]
        for d, s, e in zip(doc[head].tolist(), start[head].tolist(), end[last].tolist(), strict=True):
            for k in range(s, e, _SIZE):
                out.append((d, k >> _OFFSET, (k & _LOW) << _PACK | min(_SIZE, e - k)))
    return pd.DataFrame(out, columns=["doc_id", "mark", "span"]).astype("int64")


def settle(rows: pd.DataFrame) -> pd.DataFrame:
    """Spans to remove among contexts of some anchors, each anchor complete."""
    context, offset, group = repeats(rows["own"].tolist())
    doc, place = rows["doc_id"].to_numpy(np.int64)[context], rows["place"].to_numpy(np.int64)[context] + offset
    order = np.lexsort((place, doc, group))
    doc, place, group = doc[order], place[order], group[order]
    later = np.r_[False, group[1:] == group[:-1]] if len(group) else np.zeros(0, bool)
    return spans(doc[later], place[later], place[later] + LENGTH)


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over contexts sorted by anchor: settles whole anchors, about MERGED bytes at a time."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(batch)
        if batch["piece"].iloc[-1] == held[0]["piece"].iloc[0]:
            continue
        rows = pd.concat(held, ignore_index=True)
        piece = rows["piece"].to_numpy()
        heads = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
        size = np.r_[0, np.cumsum(rows["own"].str.len().to_numpy())]
        at, last = 0, int(heads[-1])  # the last anchor may go on
        while at < last:
            fits = heads[(heads > at) & (size[heads] <= size[at] + MERGED)]
            to = int(fits[-1]) if len(fits) else int(heads[heads > at][0])
            yield settle(rows.iloc[at:to])
            at = to
        held = [rows.iloc[last:]]
    if held:
        yield settle(pd.concat(held, ignore_index=True))


def _parted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Contexts of crowded anchors under wider ones: the anchor with the bytes behind it, for strings that have those, else with the bytes before it.

    A string of LENGTH bytes has at least half of what its anchor lacks on one side,
    so equal strings stay together; an anchor of LENGTH bytes has one string.
    """
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        rows = []
        for doc, mark, text, asked in zip(batch["doc_id"], batch["mark"], batch["text"], batch["crowds"], strict=True):
            if asked is None or not len(asked):
                continue
            data, high = text.encode("utf-8", "replace"), int(mark) << _OFFSET
            for s in asked:
                start, size, reach = s["span"] >> _PACK, s["span"] & _SIZE, s["reach"]
                width, end = reach >> _WIDTH, start + size
                at = start + ((reach >> _REACH) & _PART)
                wide = (width + LENGTH + 1) // 2
                turn = at - (LENGTH - wide)  # strings from here on have the bytes behind
                sides = ((max(start, turn), end, at, wide), (start, min(end, turn - 1 + LENGTH), turn - 1, width + LENGTH + 1 - wide))
                for side, (low, top, place, span) in enumerate(sides):
                    if top - low >= LENGTH:
                        own = digest(data[place : place + span], seed=2 * width + side)
                        rows.append((own, digest(data[low:top], seed=(place - low) & 0xFF), doc, high | place, (span << _WIDTH) | ((place - low) << _REACH) | (top - place)))
        if rows:
            found = pd.DataFrame(rows, columns=["piece", "context", "doc_id", "place", "reach"])
            for c in ("piece", "context"):
                found[c] = found[c].to_numpy(np.uint64).view(np.int64)
            yield _combined(found)


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, texts = [], []
        for text, found in zip(batch["text"], batch["found"], strict=True):
            data = (text or "").encode("utf-8", "replace")
            out, at, runs = [], 0, 0
            top = -1
            for s, e in sorted((x >> _PACK, (x >> _PACK) + (x & _SIZE)) for x in (found.tolist() if found is not None else ())):
                if s > top:
                    runs += 1
                    out.append(data[at:s])
                at = top = max(top, e)
            out.append(data[at:])
            kept = b"".join(out)
            gone = len(data) - len(kept)
            rows.append((len(data), gone, runs, hashlib.sha256(kept).hexdigest()))
            texts.append(None if text is None else kept.decode("utf-8", "ignore"))
        stats = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        yield pd.concat([batch.drop(columns="found").assign(text=texts).reset_index(drop=True), stats], axis=1)


def dedup_substrings(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Removes each byte of a LENGTH-byte string that also starts earlier.

    Texts are UTF-8 bytes; earlier is a smaller doc_id or, in one document, a
    smaller offset (rows that share a doc_id come in the order of their text's
    hash). Strings never cross documents and are judged on the input.

    First winnowing: a string's anchor is its piece of least hash, so equal strings
    meet under equal anchors, and anchors that occur once go. The strings of an
    anchor make up its context. Equal contexts, told by two hashes of 128 bits
    together, are one: all but the first are repeats as a whole, and the first
    stands for them in what follows. Where an anchor has several contexts, their
    bytes are fetched and cut into shards of bounded size, whose Burrows-Wheeler
    transforms are merged by interleave refinement (``merge``); its intervals of
    LENGTH equal bytes are the repeated strings. An anchor of over ``crowd``
    contexts isn't gathered: it is parted by the bytes beside it, round by round,
    until its contexts are few enough to merge, or of one string.

    Returns the columns of ``docs`` with the text shortened (a character of
    which bytes are cut off goes), and n_bytes, n_removed, n_spans, kept_sha256
    of the remaining bytes (which replace columns of those names). A null text
    stays null and counts as empty; null ids take no part; equal rows are one
    document; no rows give none.
    """
    if crowd < 1:
        raise ValueError("an anchor of the whole length has one context")
    taken = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "mark", "found")
    own = [n for n in docs.columns if n.lower() not in taken]
    keyed = docs.select(*[F.col(f"`{n}`") for n in own], (F.xxhash64("text") % _MARKS + _MARKS).bitwiseAND(_MARKS - 1).alias("mark"))
    able = keyed.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)).select(F.col("doc_id").cast("long").alias("doc_id"), "mark", "text")
    anchors = able.mapInPandas(_places, ANCHORS)
    found = None
    while True:
        met = anchors.repartition("piece").sortWithinPartitions(*ORDER).mapInPandas(_meet(crowd), FOUND)
        asked = F.struct("span", "piece")
        # a document has at most as many anchors as bytes
        met = cut(
            met.groupBy("doc_id", "mark").agg(
                F.collect_list(F.when(F.col("piece").isNull(), F.col("span"))).alias("known"),
                F.collect_list(F.when(F.col("piece").isNotNull() & F.col("reach").isNull(), asked)).alias("asked"),
                F.collect_list(F.when(F.col("reach").isNotNull(), F.struct("span", "reach"))).alias("crowds"),
            )
        )
        again = met.select("doc_id", "mark", F.explode("known").alias("span"))
        quiet = met.select("doc_id", "mark", "asked").where(F.size("asked") > 0)
        # an outer join like the last one below, so that Spark shuffles the texts once for both
        contexts = keyed.join(quiet, ["doc_id", "mark"], "left").mapInPandas(_contexts, "piece long, own binary, doc_id long, place long")
        settled = contexts.repartition("piece").sortWithinPartitions("piece").mapInPandas(_settle, "doc_id long, mark long, span long").unionByName(again)
        found = settled if found is None else found.unionByName(settled)
        few = met.select("doc_id", "mark", "crowds").where(F.size("crowds") > 0)
        if few.isEmpty():
            break
        anchors = cut(keyed.select("doc_id", "mark", "text").join(few, ["doc_id", "mark"]).mapInPandas(_parted, ANCHORS))
    found = found.groupBy("doc_id", "mark").agg(F.collect_list("span").alias("found"))
    joined = keyed.join(found, ["doc_id", "mark"], "left")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("mark", "found"))
    out = joined.drop("mark").mapInPandas(_remove, fields + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(*[F.col(f"`{n}`") for n in own], "n_bytes", "n_removed", "n_spans", "kept_sha256")
