"""Word hashes of Arrow text columns, computed half a megabyte at a time with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
PIECE = 512 << 10  # bytes of text that are turned into numpy arrays at once; a longer document goes alone
BLANKS = b" \t\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, dtype=bool)
_WORD[list(BLANKS)] = False
_place_keys = np.zeros(0, dtype=U)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values; different seeds give independent-looking results."""
    with np.errstate(over="ignore"):
        x = x + U((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def _keys_of_places(n: int) -> np.ndarray:
    """A fixed random odd factor for each byte position in a word."""
    global _place_keys
    if len(_place_keys) < n:
        _place_keys = mix(np.arange(max(n, 256), dtype=U), 7) | U(1)
    return _place_keys


@dataclass
class Words:
    """The words of some consecutive documents: hash, document (from `first`), place in the bytes."""

    first: int
    docs: int
    hashes: np.ndarray
    doc: np.ndarray
    bounds: np.ndarray  # words of document i: bounds[i] to bounds[i + 1]
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray  # the lower-cased bytes of all documents
    offsets: np.ndarray


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, one after the other, and where each row starts. NULL is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most that many bytes together, or of one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, min(b, n)
        a = b


def words(column: pa.Array, of: np.ndarray = _WORD) -> Iterator[Words]:
    """Words `[^\\x20\\x09-\\x0D]+` of every row, A-Z lower-cased, in pieces of whole rows. `of` tells other bytes
    that words are made of."""
    data, offsets = raw(column)
    for a, b in pieces(offsets):
        yield _words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a, of)


def _words_of(data: np.ndarray, offsets: np.ndarray, first: int, of: np.ndarray) -> Words:
    data = _LOWER[data]
    docs = len(offsets) - 1
    inside = of[data]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    tails = heads[heads > 0] - 1
    closes[tails] = inside[tails]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    length = end - start
    if len(start):
        before = np.zeros(len(start), dtype=np.int64)
        np.cumsum(length[:-1], out=before[1:])
        place = np.arange(int(length.sum())) - np.repeat(before, length)
        values = data[inside].astype(U) + U(1)
        with np.errstate(over="ignore"):
            values *= _keys_of_places(int(length.max()))[place]
            hashes = mix(np.add.reduceat(values, before) + length.astype(U) * U(0xD6E8FEB86659FD93))
    else:
        hashes = np.zeros(0, dtype=U)
    bounds = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(docs), np.diff(bounds))
    return Words(first, docs, hashes, doc, bounds, start, end, data, offsets)


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of runs of `size` words for each document, and their bounds.

    A document with fewer words has its whole sequence as one run; one without words has none.
    """
    count = np.diff(w.bounds)
    runs = np.maximum(count - size + 1, 0)
    short = np.flatnonzero((count > 0) & (runs == 0))
    runs[short] = 1
    bounds = np.concatenate([[0], np.cumsum(runs)])
    out = np.zeros(int(bounds[-1]), dtype=U)
    full = np.repeat(count >= size, runs)
    at = np.arange(len(out)) - np.repeat(bounds[:-1] - w.bounds[:-1], runs)
    with np.errstate(over="ignore"):
        acc = np.zeros(int(full.sum()), dtype=U)
        for i in range(size):
            acc = acc * U(0x9FB21C651E98DF25) + w.hashes[at[full] + i]
        out[full] = mix(acc, size)
        for i in short:
            acc = U(len(w.hashes[w.bounds[i] : w.bounds[i + 1]]))
            for h in w.hashes[w.bounds[i] : w.bounds[i + 1]]:
                acc = acc * U(0x9FB21C651E98DF25) + h
            out[bounds[i]] = mix(np.array([acc]), 31)[0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out[a:b].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][runs > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[bounds]
