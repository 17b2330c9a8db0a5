"""Words, hashes and counts over the bytes of many texts at once, as numpy arrays."""

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18  # arrays of eight bytes for each byte of a chunk stay in the processor's cache
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BYTE_VALUES = np.random.RandomState(20).randint(1, 2**62, 256).astype(np.uint64)
_powers: dict[str, np.ndarray] = {}

# White space of the contracts: blank and \x09-\x0D.  Everything else belongs to a word.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
# Digits, letters and every byte of a character beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls empty) and the offsets of its values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, row after the last, bytes, offsets from 0."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of True within one text."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edges = offsets[:-1][np.diff(offsets) > 0]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[edges] = False
    after[offsets[1:][np.diff(offsets) > 0] - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def text_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The text each byte position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-byte array within each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all bits of its input."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which :func:`range_hash` reads the hash of any byte range."""
    up, _ = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=total[1:])
    return total


def range_hash(total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes begin .. end-1, the same wherever those bytes stand."""
    _, down = _power_tables(len(total))
    return mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(np.uint64))


def hash_bytes(words: list[bytes]) -> np.ndarray:
    """:func:`range_hash` of whole byte strings."""
    offsets = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    total = prefix_hash(np.frombuffer(b"".join(words), np.uint8))
    return range_hash(total, offsets[:-1], offsets[1:])


def found_in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted array, -1 where it is missing."""
    if not len(sorted_values):
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return np.where(sorted_values[at] == values, at, -1)


def _give_back() -> None:
    """Return freed memory to the system: a worker outlives its task and would keep it."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidy(run: Callable) -> Callable:
    """A function over the Arrow batches of a partition that leaves its worker small."""

    @functools.wraps(run)
    def tidied(batches):
        yield from run(batches)
        _give_back()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """As :func:`tidy`, for a function over the frame of a group."""

    @functools.wraps(run)
    def tidied(rows):
        out = run(rows)
        _give_back()
        return out

    return tidied


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
