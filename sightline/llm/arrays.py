"""Word and n-gram hashing over Arrow string columns, vectorised with numpy.

Every function works on the raw UTF-8 bytes of a column, so nothing is decoded
and no Python object is made per word.  Hashes are 64 bits wide and depend only
on the bytes of a word (and on ``seed``), never on the process.

Null texts count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_BYTE_MULT = 0x9E6C63D0876A9A35  # odd multipliers of the polynomial hashes
_WORD_MULT = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1

#: bytes of text handled at once; bounds the temporary arrays
SLICE_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (every input bit reaches every output bit)."""
    h = h.astype(_U, copy=True)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> _U(shift)
        h *= _U(mult)
    h ^= h >> _U(31)
    return h


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: [\x20\x09-\x0D]
SPACE = separators(b" \t\n\x0b\x0c\r")
#: [\x00-\x2F\x3A-\x60\x7B-\x7F] once A-Z are lower-cased: all but 0-9, A-Z, a-z and bytes from 0x80
NOT_ALNUM = separators(bytes(b for b in range(128) if not chr(b).isalnum()))

_FOLD = np.arange(256)
_FOLD[65:91] += 32
_TABLES: dict[tuple[int, bool], np.ndarray] = {}
_POWERS = np.ones(64, _U)


def _byte_table(seed: int, fold: bool) -> np.ndarray:
    if (seed, fold) not in _TABLES:
        table = mix(np.arange(256, dtype=_U) + _U(1 + 1000 * (seed + 1)))
        _TABLES[seed, fold] = table[_FOLD] if fold else table
    return _TABLES[seed, fold]


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n or _POWERS[1] == 1:
        p = np.full(max(n, 2 * len(_POWERS)), _U(_BYTE_MULT))
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


@dataclass
class Words:
    """Words of a run of texts. ``first[d]:first[d + 1]`` are the words of text ``d``."""

    buf: np.ndarray
    offsets: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and the offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, one row at least; every row is in one of them."""
    _, offsets = utf8(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(stop, rows)
        row = min(stop, rows)


def words(column: pa.Array, sep: np.ndarray = SPACE, fold: bool = False, seed: int = 0, kinds: np.ndarray | None = None) -> Words:
    """Words: longest runs of bytes outside ``sep`` within one text; ``fold`` hashes A-Z as a-z.

    With ``kinds`` (a number for each byte), words also end between bytes of kinds 1 and 2.
    """
    buf, offsets = utf8(column)
    inside = ~sep[buf]
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(buf))]
    before[cut], after[cut - 1] = False, False
    if kinds is not None:
        kind = kinds[buf]
        cut = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)) + 1
        before[cut], after[cut - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes, size, letters = np.empty(len(starts), _U), ends - starts, buf[inside]
    at = np.cumsum(size) - size
    table, word = _byte_table(seed, fold), 0
    while word < len(starts):  # words of SLICE_BYTES at once, one at least, so a very long text takes no more memory
        stop = max(word + 1, int(np.searchsorted(at, at[word] + SLICE_BYTES)))
        own, first = size[word:stop], at[word]
        place = np.arange(int(own.sum())) - np.repeat(at[word:stop] - first, own)
        sums = np.add.reduceat(table[letters[first : first + len(place)]] * _powers(int(own.max()))[place], at[word:stop] - first)
        hashes[word:stop] = mix(sums + own.astype(_U))
        word = stop
    return Words(buf, offsets, hashes, starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash of the ``n`` values from each place on (whatever text they are in).

    The polynomial of a run is put together from those of its parts,
    H(ab) = H(a) * M^|b| + H(b), so a window of 50 takes 7 vector operations.
    """
    if len(hashes) < n:
        return np.empty(0, _U)
    block, size, done, length = hashes, 1, None, 0
    while True:
        if n & size:
            if done is None:
                done, length = block, size
            else:
                keep = len(hashes) - length - size + 1
                done = done[:keep] * _U(pow(_WORD_MULT, size, 1 << 64)) + block[length : length + keep]
                length += size
        if length == n:
            return mix(done)
        keep = len(hashes) - 2 * size + 1
        block = block[:keep] * _U(pow(_WORD_MULT, size, 1 << 64)) + block[size : size + keep]
        size *= 2


def window_starts(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Marks the first ``total - n + 1`` word places whose window of ``n`` lies in one text."""
    counts = np.diff(first)
    left = np.repeat(first[1:], counts) - np.arange(total)
    return left[: max(0, total - n + 1)] >= n


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Marks the words that windows of ``n`` from the marked ``starts`` cover."""
    edge = np.zeros(total + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def numbers(blob: bytes, kind) -> np.ndarray:
    return np.frombuffer(blob, kind)
