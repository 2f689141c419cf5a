"""Words of many texts at once: numpy over UTF-8 bytes, for use inside tasks.

A batch of texts becomes one byte buffer with a separator after each text, so that no word crosses
two of them. A word's hash is a polynomial over its bytes modulo 2**64, mixed at the end; a
span's hash comes from prefix sums, so any number of spans costs one pass over the bytes.
"""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEPARATOR = b"\n"
BLOCK_BYTES = 1 << 20
KEPT_POWERS = 5 << 16  # of a block of 256 KB with a separator after each text
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def give_back() -> None:
    """Return this process's free memory to the system: it stays for other tasks, beside another that works."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def class_table(pattern: bytes) -> np.ndarray:
    """For each byte, whether the character class `pattern` has it."""
    return np.array([bool(re.fullmatch(pattern, bytes([b]))) for b in range(256)])


#: The two word classes of the contracts, on lower-cased bytes.
ALPHANUMERIC = class_table(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]")
NOT_BLANK = class_table(rb"[^\x20\x09-\x0D]")


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def powers(name: str, base: int, n: int) -> np.ndarray:
    """1, base, base**2 ... modulo 2**64. A process keeps those of small blocks, others are made anew."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, KEPT_POWERS), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= KEPT_POWERS:
            _powers[name] = have
    return have


class SpanHashes:
    """Hashes of any spans of one buffer."""

    def __init__(self, values: np.ndarray):
        """`values`: one 64-bit value for each position."""
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers("up", _BASE, n + 1)[:n], out=self.sums[1:])
        self.down = powers("down", _INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spans = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(spans + (ends - starts).astype(np.uint64))


@dataclass
class Block:
    """Texts of one slice of a batch as one buffer; text i is buffer[begins[i]:stops[i]]."""

    first: int  # the row in the batch of text 0
    buffer: np.ndarray
    begins: np.ndarray
    stops: np.ndarray

    def hashes(self) -> SpanHashes:
        return SpanHashes(_BYTE_VALUES[self.buffer])

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the number of words before it."""
        inside = np.zeros(len(self.buffer) + 2, dtype=np.int8)
        inside[1:-1] = table[self.buffer]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        bounds = np.append(np.searchsorted(starts, self.begins), len(starts))
        return starts, ends, bounds


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def blocks(texts: list[bytes | None], lower: bool = True, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Consecutive texts, about `size` bytes at a time; a longer text is a block of its own.

    A missing text counts as empty. With `lower`, A-Z are lower-cased.
    """
    at = 0
    while at < len(texts):
        taken: list[bytes] = []
        length = 0
        first = at
        while at < len(texts) and (not taken or length + len(texts[at] or b"") <= size):
            taken.append(texts[at] or b"")
            length += len(taken[-1])
            at += 1
        joined = SEPARATOR.join(taken) + SEPARATOR
        if lower:
            joined = joined.lower()  # of bytes: only A-Z
        lengths = np.array([len(x) for x in taken], dtype=np.int64)
        stops = np.cumsum(lengths + 1) - 1
        yield Block(first, np.frombuffer(joined, dtype=np.uint8), stops - lengths, stops)


def batch(schema: pa.Schema, **columns: Iterable) -> pa.RecordBatch:
    """A record batch of the schema from columns by name."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An array of lists: list i is values[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
