"""Quality rules from compression bands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHITE, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"

#: Limits of compressed over raw codes by length: texts of at least the first
#: figure's codes (see ``coded``) must lie between the other two. Short texts carry the frame
#: and have little to refer back to, so both limits fall as length grows. The
#: lower ones stand about 0.02 below the least ratio of documents labelled good.
BANDS = (
    (0, 0.10, 1.35), (256, 0.47, 0.85), (512, 0.455, 0.78), (1024, 0.445, 0.70), (2048, 0.425, 0.64),
    (4096, 0.405, 0.60), (8192, 0.395, 0.56), (16384, 0.382, 0.54), (32768, 0.37, 0.52),
)
#: The same for each chunk; a last chunk of under a quarter isn't judged.
CHUNK_BYTES, CHUNK_LOW, CHUNK_HIGH, CHUNK_SHARE = 2048, 0.08, 0.80, 0.34

FIELDS = "n_bytes long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, chunks_out double, kept boolean"


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    with np.errstate(over="ignore"):
        windows = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def dup_lines(data: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in data.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip(WHITE):
            seen.add(line)
    return found


#: Characters that have a byte of their own in texts of over 256 different ones, and those of two bytes.
PLAIN, WIDE = 248, 1792
#: From so many different characters on the upper limits rise, up to ``OPEN`` at twice as many: compression can't tell prose of a large alphabet from noise.
KINDS, OPEN = 128, 1.25


def coded(text: str, data: bytes) -> tuple[bytes, int]:
    """A byte for each character, so that a script's bytes a character don't count, and how many different characters there are (0: few).

    ASCII text is its own code. Of more than 256 different characters the most
    frequent keep one byte and the others take two or four.
    """
    if len(data) == len(text):
        return data, 0
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    count = np.bincount(points)
    kinds = np.flatnonzero(count)
    if len(kinds) <= 256:
        return (np.cumsum(count > 0) - 1).astype(np.uint8)[points].tobytes(), len(kinds)
    order = kinds[np.argsort(-count[kinds], kind="stable")]
    plain, rank = np.sort(order[:PLAIN]), np.arange(len(order) - PLAIN)
    code, width = np.zeros((len(count), 4), np.uint8), np.ones(len(count), np.int64)
    code[plain, 0] = np.arange(len(plain))
    wide = order[PLAIN:]
    far = rank >= WIDE
    width[wide] = np.where(far, 4, 2)
    code[wide] = np.stack([np.where(far, 255, PLAIN + rank // 256), np.where(far, rank >> 16, rank % 256), rank >> 8 & 255, rank & 255], 1)
    return code[points][np.arange(4) < width[points][:, None]].tobytes(), len(kinds)


def judge(text: str | None, packer: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()
    white = len(data) - len(data.translate(None, WHITE))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeats = repeat_words(words)
    base = len(words) < 50 or 100 * repeats > 50 * len(words)
    ratio, out = 1.0, 0.0
    codes, kinds = coded(text, data)
    open_ = min(1.0, max(0.0, kinds / KINDS - 1))
    if data:
        ratio = len(packer.compress(codes)) / len(codes)
        chunks = [codes[i : i + CHUNK_BYTES] for i in range(0, len(codes), CHUNK_BYTES)]
        if len(chunks) > 1:
            chunks = [c for c in chunks if len(c) >= CHUNK_BYTES // 4]
            each = [len(packer.compress(c)) / len(c) for c in chunks]
            out = sum(not CHUNK_LOW <= x <= CHUNK_HIGH + open_ * (OPEN - CHUNK_HIGH) for x in each) / len(each)
    low, high = next((lo, hi) for least, lo, hi in reversed(BANDS) if len(codes) >= least)
    kept = not base and low <= ratio <= high + open_ * max(0.0, OPEN - high) and out <= CHUNK_SHARE
    return len(data), len(words), len(text) - white, symbols, dup_lines(data), repeats, base, ratio, out, kept


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=3)
    names = [x.split()[0] for x in FIELDS.split(", ")]
    for batch in batches:
        found = pd.DataFrame([judge(t, packer) for t in batch.pop("text")], columns=names)
        yield pd.concat([batch.reset_index(drop=True), found], axis=1)


def quality(docs: DataFrame) -> DataFrame:
    """Word statistics, zstandard ratios and a verdict for every document.

    Words are runs of characters other than ASCII white space. ``base_failed``:
    under 50 words, or more than half of them in repeated 3-word windows.
    ``kept``: not base_failed, the ratio of the whole text inside the limits for
    its length (``BANDS``), and at most ``CHUNK_SHARE`` of the fixed chunks
    outside theirs: below is repetitive, above incompressible. Ratios are taken
    over one code a character, which makes them alike for alphabets of one, two
    or three bytes. Of texts of over 256 different characters the most frequent 248
    have such a code and the rest a wider one. From 128 different characters on the
    upper limits rise with their number, until none is left at 256.

    One narrow map: rows stay where they were read and no group is gathered.
    Null and empty texts count nothing and aren't kept; a row of the input gives
    a row of the output; other columns are ignored; no rows give none.
    """
    return docs.select("doc_id", "text").mapInPandas(_score, "doc_id long, " + FIELDS)


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns."""
    names = docs.columns
    flagged = docs.mapInPandas(_filter, docs.schema)
    return flagged.select(*[F.col(f"`{n}`") for n in names])


def _filter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield batch[np.fromiter((judge(t, packer)[-1] for t in batch["text"]), bool, len(batch))]
