"""Byte-pair encoding by batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from .common import flat_ranges, slices

#: Fixed by the byte-level vocabulary format: how text splits before merges ...
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ... and the printable ranges whose bytes stand for themselves.
PRINTABLE = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
#: The same pattern spelt out for texts below U+0250, which the plain regex engine runs faster.
LETTER, DIGIT, WHITE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
LATIN = re.compile("[\0-ɏ]*")
SPLIT_LATIN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{WHITE}{LETTER}{DIGIT}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: Distinct words an encoder remembers before it starts afresh.
MEMORY = 400_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte value in the vocabulary file."""
    plain = {b for lo, hi in PRINTABLE for b in range(lo, hi + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Words(dict):
    """Numbers of words; a new word gets the next one and is noted as fresh."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = i = len(self)
        self.fresh.append(word)
        return i


class Coder:
    """Encoder and decoder of a byte-level vocabulary file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in enumerate(symbols)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max(*vocab.values(), *self.specials.values())
        pieces = [b""] * self.size
        for token, i in vocab.items():
            pieces[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.specials.items():
            pieces[i] = token.encode()
        self.piece_lengths = np.array([len(p) for p in pieces], np.int64)
        self.piece_starts = np.cumsum(self.piece_lengths) - self.piece_lengths
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        end = spec["model"].get("end_of_word_suffix") or ""
        self.first = np.array([vocab[c] for c in symbols], np.int64)
        self.final = np.array([vocab[c + end] for c in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.split = regex.compile(SPLIT)
        self.special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")") if self.specials else None
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        self.ids = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, in one array, and how many each word has.

        Each round looks up every adjacent pair of the words still at work and
        merges, in each of them, all occurrences of its lowest-ranked pair.
        """
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        symbols[last] = self.final[np.frombuffer(b"".join(words), np.uint8)[last]]
        rank = self.rank(symbols, last, np.arange(len(symbols)))
        none = len(self.keys)
        done_symbols, done_owner = [], []
        while len(symbols):
            heads = np.flatnonzero(np.r_[True, last[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(symbols)]))
            over = least == none
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
            at = np.flatnonzero((rank == least) & ~over)
            # in a run of overlapping occurrences every other one merges, from the left
            place = np.arange(len(at))
            nth = place - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, place, 0)) if len(at) else place
            at = at[nth % 2 == 0]
            symbols[at] = self.made[least[at]]
            last[at] = last[at + 1]
            stays = ~over
            stays[at + 1] = False
            moved = np.cumsum(stays) - 1
            symbols, owner, last, rank = symbols[stays], owner[stays], last[stays], rank[stays]
            at = moved[at]  # only pairs with a new symbol have another rank
            before = at[at > 0] - 1
            at = np.concatenate([at, before])
            rank[at] = self.rank(symbols, last, at)
        if not done_symbols:
            return np.zeros(0, np.int64), lengths
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def rank(self, symbols: np.ndarray, last: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at ``at``: a binary search over the sorted pair keys."""
        out = np.full(len(at), len(self.keys), np.int64)
        inner = np.flatnonzero(~last[at])
        key = symbols[at[inner]] * self.size + symbols[at[inner] + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[found] == key
        out[inner[hit]] = self.ranks[found[hit]]
        return out

    def learn(self) -> None:
        fresh, self.words.fresh = self.words.fresh, []
        ids, counts = self.merge([w.encode() for w in fresh])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
        self.lengths = np.concatenate([self.lengths, counts])
        self.ids = np.concatenate([self.ids, ids])

    def cut(self, text: str) -> list[str]:
        return (SPLIT_LATIN if LATIN.fullmatch(text) else self.split).findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        if len(self.words) > MEMORY:
            self.forget()
        parts: list[list[str]] = []
        marks: list[tuple[int, int, int]] = []  # text, word before which it stands, id
        for i, text in enumerate(texts):
            words: list[str] = []
            if self.special and any(s in text for s in self.specials):
                for piece in self.special.split(text):
                    if piece in self.specials:
                        marks.append((i, len(words), self.specials[piece]))
                        words.append(" ")  # its id is put in below
                    else:
                        words += self.cut(piece)
            else:
                words = self.cut(text)
            parts.append(words)
        flat = [w for words in parts for w in words]
        which = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        if self.words.fresh:
            self.learn()
        lengths = self.lengths[which]
        ids = self.ids[flat_ranges(self.starts[which], lengths)]
        counts = np.array([len(p) for p in parts], np.int64)
        firsts = np.cumsum(counts) - counts
        ends = np.r_[0, np.cumsum(lengths)]
        for i, at, special in marks:  # the placeholder, one space, is a single id
            ids[ends[firsts[i] + at]] = special
        return ids, ends[firsts + counts] - ends[firsts]

    def decode(self, ids: np.ndarray) -> str:
        return self.piece_bytes[flat_ranges(self.piece_starts[ids], self.piece_lengths[ids])].tobytes().decode("utf-8", "replace")


def encode(docs: DataFrame, vocabulary: str, ids: bool = False) -> DataFrame:
    """Token ids of every text under a byte-level vocabulary file, and their decoding.

    ``vocabulary`` is the file's path on the driver; its content, of fixed size,
    travels with the tasks. Returns doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256 (of the decoded
    text) and, with ``ids``, the ids and the decoded text themselves. A special
    token's string in a text becomes its id, as the reference library has it.

    One map without a shuffle. A null text counts as empty: no ids. Rows of the
    input are rows of the output, however often repeated; other columns are
    ignored; no rows give none.
    """
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_text())
    more = ", ids array<int>, decoded string" if ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Coder(content.value)
        for batch in batches:
            texts = [t or "" for t in batch["text"]]
            for i, j in slices(texts):
                all_ids, counts = coder.encode(texts[i:j])
                each = np.split(all_ids, np.cumsum(counts)[:-1])
                back = [coder.decode(x) for x in each]
                out = {
                    "doc_id": batch["doc_id"].iloc[i:j].to_numpy(),
                    "n_tokens": counts,
                    "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each],
                    "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in back],
                }
                if ids:
                    out |= {"ids": [x.astype(np.int32) for x in each], "decoded": back}
                yield pd.DataFrame(out)

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + more)
