"""Words and n-grams of Arrow text columns as whole-array NumPy work."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
# The bytes \x20 and \x09-\x0D part words.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
# Parts words at all that is no ASCII letter and no part of a longer character.
NO_LETTERS = np.ones(256, bool)
NO_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), modulo 2 ** 64."""
    out = np.ones(count, np.uint64)
    done, step = 1, base & _MASK
    while done < count:
        more = min(done, count - done)
        out[done : done + more] = out[:more] * np.uint64(step)
        done += more
        step = step * step & _MASK
    return out


_UP = _powers(_BASE, 1)
_DOWN = _powers(_BASE, 1)


def _tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < count:
        size = max(count, SLICE_BYTES + 1)
        _UP, _DOWN = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _UP, _DOWN


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Texts:
    """The bytes of some texts, one after another; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def piece(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def texts_of(column: pa.Array) -> Texts:
    """A null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw else np.empty(0, np.uint8)
    return Texts(data, bounds - bounds[0])


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text; a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, done + most, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


@dataclass
class Words:
    """Words in text order: first byte, byte after the last, number of the text, hash."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    sums: np.ndarray

    def prefixes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words have at least ``length`` bytes, and a hash of those words' first bytes."""
        long = self.end - self.start >= length
        start = self.start[long]
        hashes = (self.sums[start + length] - self.sums[start]) * _DOWN[start]
        return long, mixed_bits(hashes + np.uint64(length << 32))

    def per_text(self, texts: int) -> np.ndarray:
        """bounds: the words of text i are bounds[i] to bounds[i + 1]."""
        return np.searchsorted(self.text, np.arange(texts + 1))


def words_of(texts: Texts, parting: np.ndarray = BLANKS, fold: np.ndarray | None = None) -> Words:
    """Equal words have equal hashes wherever they stand."""
    data = texts.data
    inside = ~parting[data]
    starts_here = np.zeros(len(data) + 1, bool)
    starts_here[texts.bounds] = True
    fresh = starts_here[:-1].copy()
    fresh[1:] |= ~inside[:-1]
    last = starts_here[1:].copy()
    last[-1:] = True
    last[:-1] |= ~inside[1:]
    start = np.flatnonzero(inside & fresh)
    end = np.flatnonzero(inside & last) + 1
    number = np.searchsorted(texts.bounds, start, "right") - 1
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    seen = data if fold is None else fold[data]
    np.cumsum((seen.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = (sums[end] - sums[start]) * down[start]
    return Words(start, end, number, mixed_bits(hashes + (end - start).astype(np.uint64)), sums)


def word_runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of ``length`` words; runs over a text's end are the caller's to leave out."""
    count = max(len(hashes) - length + 1, 0)
    out = np.zeros(count, np.uint64)
    for j in range(length):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + count]
    return mixed_bits(out)


def inner_runs(text: np.ndarray, length: int) -> np.ndarray:
    """Which of the word runs stay within one text."""
    count = max(len(text) - length + 1, 0)
    return text[:count] == text[length - 1 :][:count]


def distinct_per_text(text: np.ndarray, feature: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's features once; ``text`` must be in order.

    Every feature's last place in a text is noted in a table, and a place that is the noted one
    is kept: no sorting, and the table is never cleared.
    """
    noted = np.zeros(1 << bits, np.int32)
    feature = feature.astype(np.int64)
    kept = np.empty(len(text), bool)
    cuts = [0, *(np.flatnonzero(text[1:] != text[:-1]) + 1).tolist(), len(text)]
    places = np.arange(max(map(int.__sub__, cuts[1:], cuts), default=0), dtype=np.int32)
    for a, b in zip(cuts, cuts[1:]):
        here = feature[a:b]
        noted[here] = places[: b - a]
        kept[a:b] = noted[here] == places[: b - a]
    return text[kept], feature[kept]
