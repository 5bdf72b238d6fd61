"""Ids of a lower-casing word vocabulary, found by hashing whole words in numpy."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

from .bpe import Coder
from .common import flat_ranges, mix64

#: Classes of code points: white space, letter, number, anything else.
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Fixed by the vocabulary: endings that are tokens of their own after an apostrophe.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
#: Texts of these characters alone; their classes are the same in every edition of Unicode tables.
PLAIN = re.compile("[\0-\u052f]*")
#: Bytes of the arrays of remembered words, beyond which they are forgotten.
MEMORY = 32_000_000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(i) for i in range(0xD800)) + "".join(chr(i) for i in range(0xE000, 0x110000))
    code = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    for pattern, kind in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, every):
            out[code[m.start() : m.end()]] = kind
    return out


class WordCoder:
    """Ids of texts under a word-level byte-pair vocabulary (lower case, white space dropped).

    A word is looked up by a 64-bit hash of its code points and their places,
    computed for all words of a slice at once; only words not met before go
    through the merge rounds. Texts with characters past the Cyrillic blocks go
    to the tokenizers library itself, whose Unicode tables decide on their words.
    """

    def __init__(self, content: str):
        self.coder = Coder(content)
        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = self.coder.specials
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.index = np.zeros(0, np.int64)  # of each hash's word in the three below
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def held(self) -> int:
        return sum(x.nbytes for x in (self.hashes, self.index, self.starts, self.lengths, self.ids))

    @staticmethod
    def normal(text: str) -> str:
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each text has."""
        pieces, owner, marks = [], [], []
        others: dict[int, list[int]] = {}
        for i, text in enumerate(texts):
            if not PLAIN.fullmatch(text):
                others[i] = self.library.encode(text, add_special_tokens=False).ids
                text = ""
            if self.special and any(s in text for s in self.specials):
                for piece in self.special.split(text):
                    if piece in self.specials:
                        marks.append((len(pieces), self.specials[piece]))
                        piece = "a"  # one id, put in below
                    pieces.append(self.normal(piece))
                    owner.append(i)
            else:
                pieces.append(self.normal(text))
                owner.append(i)
        ids, counts = self._plain(pieces)
        firsts = np.cumsum(counts) - counts
        for at, special in marks:
            ids[firsts[at]] = special
        sizes = np.bincount(np.array(owner, np.int64), weights=counts, minlength=len(texts)).astype(np.int64)
        if others:
            each = np.split(ids, np.cumsum(sizes)[:-1])
            for i, own in others.items():
                each[i] = np.array(own, np.int32)
            return np.concatenate(each), np.array([len(x) for x in each], np.int64)
        return ids, sizes

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        joined = "\n".join(texts) + "\n"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes()[code]
        begins = kind != SPACE
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        self._endings(joined, code, kind, begins)
        first = np.flatnonzero(begins)
        if not len(first):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        solid = np.flatnonzero(kind != SPACE)
        which = np.cumsum(begins[solid]) - 1
        place = solid - first[which]
        lengths = np.bincount(which)
        mixed = mix64(code[solid].astype(np.uint64) | (place.astype(np.uint64) << np.uint64(21)))
        with np.errstate(over="ignore"):
            hashes = np.add.reduceat(mixed, np.searchsorted(solid, first))
        unique, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.held() > MEMORY:
            self.forget()
        at = np.minimum(np.searchsorted(self.hashes, unique), max(0, len(self.hashes) - 1))
        fresh = np.flatnonzero(self.hashes[at] != unique) if len(self.hashes) else np.arange(len(unique))
        if len(fresh):
            spans = [(int(first[k]), int(first[k] + lengths[k])) for k in sample[fresh]]
            ids, counts = self.coder.merge([joined[a:b].encode("utf-8", "replace") for a, b in spans])
            number = len(self.starts) + np.arange(len(fresh))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.lengths = np.concatenate([self.lengths, counts])
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            to = np.searchsorted(self.hashes, unique[fresh])
            self.hashes = np.insert(self.hashes, to, unique[fresh])
            self.index = np.insert(self.index, to, number)
            at = np.searchsorted(self.hashes, unique)
        word = self.index[at][inverse]
        n_ids = self.lengths[word]
        ends = np.r_[0, np.cumsum(n_ids)]
        cut = np.searchsorted(first, np.r_[0, np.cumsum(sizes)])
        return self.ids[flat_ranges(self.starts[word], n_ids)], ends[cut[1:]] - ends[cut[:-1]]

    @staticmethod
    def _endings(joined: str, code: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> None:
        """Make an apostrophe that begins a token one token with a listed ending."""
        at = np.flatnonzero((code == ord("'")) & begins)
        for p in at.tolist():
            for size in (1, 2):
                if joined[p + 1 : p + 1 + size] in ENDINGS and len(joined[p + 1 : p + 1 + size]) == size:
                    begins[p + 1 : p + 1 + size] = False
                    begins[p + 1 + size] = kind[p + 1 + size] != SPACE
                    break
