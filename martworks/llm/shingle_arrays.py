"""Word shingles of Arrow text batches, in numpy.

Words are runs of bytes other than the six blanks (no byte of a longer UTF-8 sequence is one). A word's hash is a
polynomial of its bytes modulo 2^64, mixed; a shingle's hash combines those of five words in a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import SHINGLE

#: Texts are worked on in pieces of about so many bytes (a longer text alone).
PIECE_BYTES = 1 << 21

_BYTE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed one-to-one image of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about PIECE_BYTES of a text column each."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE_BYTES)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(sizes)]):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, null as empty, and where each text starts (one more: the end)."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return all_bytes[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    # Places of the words among the bytes inside words.
    rank = np.cumsum(inside) - 1
    at = rank[starts]
    lengths = np.diff(np.append(at, rank[-1] + 1))
    place = np.arange(rank[-1] + 1) - np.repeat(at, lengths)
    powers = np.cumprod(np.full(int(lengths.max()) + 1, _BASE, np.uint64))
    hashes = mix64(np.add.reduceat(_BYTE[data[inside]] * powers[place], at) + lengths.astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of five words, text after text, and their number per text. A text of one to four words
    has one window, of them all; a text without words none."""
    words, counts = word_hashes(texts)
    windows = np.where(counts >= SHINGLE, counts - SHINGLE + 1, (counts > 0).astype(np.int64))
    total = int(windows.sum())
    owner = np.repeat(np.arange(len(counts)), windows)
    inner = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    start = (np.cumsum(counts) - counts)[owner] + inner
    length = np.minimum(counts, SHINGLE)[owner]
    out = length.astype(np.uint64)
    for k in range(SHINGLE):
        there = k < length
        value = words[np.where(there, start + k, 0)] if len(words) else np.zeros(total, np.uint64)
        out = np.where(there, mix64(out * _STEP + value), out)
    return out, windows


def weighted(hashes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text its different shingles: the text, the hash and how often it occurs."""
    owner = np.repeat(np.arange(len(windows)), windows)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(fresh)
    return owner[first], hashes[first], np.diff(np.append(first, len(hashes)))


def occurrences(hashes: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Each shingle hash made different for its first, second, ... occurrence in the text, so that the similarity of
    the resulting sets is that of the counted shingles; text after text, sorted inside."""
    owner, different, counts = weighted(hashes, windows)
    number = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return mix64(np.repeat(different, counts) + number.astype(np.uint64) * _STEP)
