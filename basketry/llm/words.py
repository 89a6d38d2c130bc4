"""Word positions and hashes of whole texts, worked out on Arrow buffers a slice at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A slice holds whole documents of about this many bytes; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20
# Odd constants of the hashes.
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
# Byte ranges up to this length are hashed together, 8 bytes of each at a time.
LONG_RANGE = 64
LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
SPACES = b" \t\n\v\f\r"
SEPARATOR = np.isin(np.arange(256), list(SPACES))


class Slice(NamedTuple):
    """Rows ``first`` up to ``last`` of a batch: their UTF-8 bytes and where each row starts."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Words of a slice in reading order: row within the slice, byte range, hash."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray | None


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """A string column cut into slices of whole rows; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case; other letters stay."""
    upper = (data >= 65) & (data <= 90)
    return data + (upper * np.uint8(32))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every maximal run of True that does not cross a row's edge."""
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none
    fresh = np.ones(len(inside) + 1, bool)
    fresh[1:-1] = ~inside[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(inside & fresh[:-1])
    closing = np.ones(len(inside), bool)
    closing[:-1] = ~inside[1:]
    edges = offsets[1:-1]
    closing[edges[edges > 0] - 1] = True
    ends = np.flatnonzero(inside & closing) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(BASE)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(STEP)
    return h ^ (h >> np.uint64(32))


class Hasher:
    """64-bit hashes of byte ranges, by blocks of 8 bytes that are each mixed in; long ranges go to XXH3.

    No sum of powers: such sums modulo 2 ** 64 give many pairs of regular words one hash.
    """

    def __init__(self, seed: int = 1):
        import xxhash

        self.seed, self.long = seed, xxhash.xxh3_64_intdigest

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        found = mixed(size.astype(np.uint64) * np.uint64(STEP) + np.uint64(self.seed))
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        # The 8 bytes from every place on, as one number.
        blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        left, at = np.flatnonzero((size > 0) & (size <= LONG_RANGE)), 0
        while len(left):
            rest = size[left] - at
            found[left] = mixed(found[left] ^ (blocks[start[left] + at] & LOW_BYTES[np.minimum(rest, 8)]))
            left, at = left[rest > 8], at + 8
        raw = memoryview(padded)
        for i in np.flatnonzero(size > LONG_RANGE).tolist():
            found[i] = self.long(raw[start[i] : end[i]], self.seed)
        return found


def space_words(piece: Slice, hasher: Hasher | None = None, lower: bool = True) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice, hashed after lower-casing A-Z when asked for."""
    row, start, end = runs(~SEPARATOR[piece.data], piece.offsets)
    found = hasher.ranges(lowered(piece.data) if lower else piece.data, start, end) if hasher else None
    return Words(row, start, end, found)


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, index of the first word and hash of every run of n words within one row."""
    last = len(words.row) - n + 1
    if last <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(last, np.uint64)
    for k in range(n):
        total = total * np.uint64(BASE) + words.hash[k : k + last]
    at = np.flatnonzero(words.row[:last] == words.row[n - 1 :])
    return words.row[at], at, mixed(total[at])


def trim() -> None:
    """Gives memory that this process holds free back to the system; otherwise workers keep what their largest task took."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:  # the GNU library has it
        give_back(0)


def released(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task, before and after which its Python worker, which Spark uses again, gives free memory back."""

    def run(batches: Iterator) -> Iterator:
        trim()
        try:
            yield from task(batches)
        finally:
            trim()

    return run


def per_row(row: np.ndarray, rows: int) -> np.ndarray:
    """How many entries each row has."""
    return np.bincount(row, minlength=rows)[:rows] if len(row) else np.zeros(rows, np.int64)


def unused(columns: list[str], name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(columns, schema.types, strict=True)],
        schema=schema,
    )
