"""Word and shingle hashes of whole batches of texts, with array operations.

A word is a maximal run of bytes that belong to words, A-Z taken as a-z. Its hash is a polynomial in
its bytes modulo 2^64, taken from running sums over some of them at a time, and mixed.
A text of any length is taken whole; beside its bytes, that takes about as much again for each of a dozen
arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text hashed at once; a longer text is a chunk of its own
CHUNK = (1 << 19) - 1
BASE = 0x9E3779B97F4A7C15 | 1
STEP = np.uint64(0xD1342543DE82EF95)
_U = np.uint64
#: bytes whose running sums are taken at once
PIECE = 1 << 17


def by_space() -> np.ndarray:
    """Which bytes belong to words: all but space and the control characters 9 to 13."""
    keep = np.ones(256, bool)
    keep[[0x20, *range(9, 14)]] = False
    return keep


def by_letter() -> np.ndarray:
    """Digits, ASCII letters and everything beyond ASCII."""
    keep = np.zeros(256, bool)
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        keep[first : last + 1] = True
    return keep


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: BASE^i and BASE^-i modulo 2^64 for a piece
UP, DOWN = (
    np.cumprod(np.concatenate([np.ones(1, "<u8"), np.full(PIECE, base, "<u8")]), dtype="<u8")
    for base in (BASE, pow(BASE, -1, 1 << 64))
)


def piece_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Polynomials of the words from start to stop in at most PIECE bytes."""
    sums = np.zeros(len(data) + 1, "<u8")
    np.cumsum((data.astype("<u8") + _U(1)) * UP[: len(data)], out=sums[1:])
    return (sums[stop] - sums[start]) * DOWN[start]


def word_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The same of any number of bytes."""
    found = np.empty(len(start), "<u8")
    k = 0
    while k < len(start):
        first = int(start[k])
        last = int(np.searchsorted(stop, first + PIECE, side="right"))
        if last > k:
            found[k:last] = piece_hashes(data[first : stop[last - 1]], start[k:last] - first, stop[k:last] - first)
        else:  # one word beyond a piece
            last, total = k + 1, 0
            for at in range(first, int(stop[k]), PIECE):
                part = data[at : min(at + PIECE, int(stop[k]))]
                own = piece_hashes(part, np.zeros(1, "<i8"), np.array([len(part)]))
                total += int(own[0]) * pow(BASE, at - first, 1 << 64)
            found[k] = total % (1 << 64)
        k = last
    return found


class Words:
    """The words of some texts: ``hash``, ``start`` and ``stop`` (bytes in ``data``) and ``doc`` of
    each; ``first`` has for each text its first word, and the number of words last."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, keep: np.ndarray):
        self.data = LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = keep[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # no word goes on into the next text
        before, here = inside[:-1], inside[1:]
        self.start = np.flatnonzero((here & (~before | edge))[: len(data)])
        self.stop = np.flatnonzero(before & (~here | edge))
        found = word_hashes(self.data, self.start, self.stop)
        self.hash = mix(found + (self.stop - self.start).astype("<u8"))
        self.first = np.searchsorted(self.start, offsets).astype("<i8")
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def text(self, at: int) -> bytes:
        return self.data[self.start[at] : self.stop[at]].tobytes()

    def shingles(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, position of the first word) of all runs of so many words within a text."""
        n = len(self.hash) - words + 1
        if n <= 0:
            return np.zeros(0, "<u8"), np.zeros(0, "<i8")
        at = np.flatnonzero(self.doc[:n] == self.doc[words - 1 :])
        return sequence_hash((self.hash[at + k] for k in range(words)), words, len(at)), at


def sequence_hash(words: Iterable[np.ndarray], length: int, n: int) -> np.ndarray:
    """Hash of n word sequences, from the hashes of their first, second, ... words."""
    total = np.full(n, length, "<u8")
    for w in words:
        total *= STEP
        total += w
    return mix(total)


def run_hash(words: list[np.ndarray]) -> np.ndarray:
    return sequence_hash(words, len(words), len(words[0]))


def chunks(texts: pa.Array, keep: np.ndarray) -> Iterator[tuple[int, Words]]:
    """(row of the first text, words) of the column's texts, some at a time. Null: no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    if not len(texts):
        return
    kind = "<i8" if pa.types.is_large_string(texts.type) else "<i4"
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, kind)[texts.offset : texts.offset + len(texts) + 1].astype("<i8")
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        stop = min(stop, len(texts))
        yield row, Words(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], keep)
        row = stop
