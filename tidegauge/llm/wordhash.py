"""Words of whole texts and 64-bit hashes of word sequences, with numpy on Arrow buffers.

Texts are read as UTF-8 bytes.  A byte table says which bytes belong to words; ASCII
capitals are lower-cased.  All functions work on one slice of rows at a time, so that a
task needs memory for a few megabytes of text, or for its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 * 2**20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_GOLD = _U(0x9E3779B97F4A7C15)
_M1 = _U(0xBF58476D1CE4E5B9)
_M2 = _U(0x94D049BB133111EB)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words [^\x20\x09-\x0D]+
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def constants(count: int, seed: int) -> np.ndarray:
    """``count`` fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(count, dtype=np.uint64) + _U(seed * 1_000_003 + 1)) * _GOLD) | _U(1)


def _powers(count: int) -> np.ndarray:
    out = np.full(max(count, 1), _U(_BASE), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if len(column) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(buffers[2], np.uint8), offsets.astype(np.int64)


def slices(offsets: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``size`` bytes together, or one longer row."""
    rows, at = len(offsets) - 1, 0
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end
        at = end


class Words:
    """The words of consecutive rows: hashes, byte spans and the row of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        base = int(offsets[0])
        data = data[base : int(offsets[-1])]
        offsets = offsets - base
        self.rows = len(offsets) - 1
        self.data = data
        n = len(data)
        if n == 0:
            self.hashes = np.zeros(0, np.uint64)
            self.starts = self.ends = self.row = np.zeros(0, np.int64)
            self.bounds = np.zeros(self.rows + 1, np.int64)
            return
        flag = table[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.concatenate(([False], flag[:-1])) & ~edge[:-1]
        after = np.concatenate((flag[1:], [False])) & ~edge[1:]
        self.starts = np.flatnonzero(flag & ~before)
        self.ends = np.flatnonzero(flag & ~after) + 1
        self.row = np.searchsorted(offsets[1:], self.starts, side="right")
        #: bounds[i]:bounds[i + 1] are the words of row i
        self.bounds = np.searchsorted(self.starts, offsets, side="left")
        lengths = self.ends - self.starts
        if len(lengths) == 0:
            self.hashes = np.zeros(0, np.uint64)
            return
        letters = LOWER[data[flag]].astype(np.uint64)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(letters)) - np.repeat(first, lengths)
        letters += _U(1)
        letters *= _powers(int(lengths.max()))[place]
        self.hashes = mix(np.add.reduceat(letters, first) + lengths.astype(np.uint64) * _GOLD)

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``length`` words from each word on, and whether all are of its row."""
        total = len(self.hashes)
        out, whole = np.zeros(total, np.uint64), np.zeros(total, dtype=bool)
        count = total - length + 1
        if count <= 0:
            return out, whole
        for j, factor in enumerate(constants(length, length)):
            out[:count] += self.hashes[j : j + count] * factor
        whole[:count] = self.row[:count] == self.row[length - 1 :]
        return mix(out), whole

    def text(self, first: int, count: int) -> bytes:
        """``count`` words from word ``first`` on, lower-cased, with one space between."""
        return b" ".join(
            LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes() for i in range(first, first + count)
        )


def shingle_sets(words: Words, length: int) -> list[np.ndarray]:
    """Per row, the sorted distinct hashes of its ``length``-word shingles.

    A row with fewer words has its whole sequence as its only shingle; a row without
    words has none.
    """
    hashes, whole = words.runs(length)
    at, out, short = words.bounds, [], {}
    for i in range(words.rows):
        a, b = int(at[i]), int(at[i + 1])
        if b - a >= length:
            out.append(np.unique(hashes[a : b - length + 1]))
        elif b > a:
            n = b - a
            if n not in short:
                short[n] = words.runs(n)[0]
            out.append(short[n][a : a + 1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out
