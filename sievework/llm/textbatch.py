"""Vectorised views of Arrow text batches.

The helpers turn a column of strings into flat byte arrays and find words, word hashes and
n-grams with numpy, so that operators which score or count words cost a few nanoseconds a byte.
Work is done on slices of a bounded number of bytes (``slices``), so a batch of long texts never
needs more than a fixed multiple of one slice or of its longest text.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

#: Multiplier of the polynomial hash and its inverse modulo 2**64.
PRIME = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Odd multipliers that make hashes depend on the place in an n-gram.
MIX = np.array(
    [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)
SLICE_BYTES = 1 << 20

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of words that only white space ends.
NONWHITE = ~_WHITE
#: Bytes of words that any ASCII punctuation ends; bytes of other scripts count as letters.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Bytes that begin a code point.
LEADS = np.array([(b & 0xC0) != 0x80 for b in range(256)])


class _Powers:
    """Powers of PRIME and INVERSE, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) <= n:
            with np.errstate(over="ignore"):
                self.up = np.concatenate([self.up, self.up * (self.up[-1] * PRIME)])
                self.down = np.concatenate([self.down, self.down * (self.down[-1] * INVERSE)])
        return self.up, self.down


_POWERS = _Powers()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the place where each begins (one more at the end). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n, buffers = len(column), column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = SLICE_BYTES):
    """(first text, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


class Words:
    """Words of a slice: start, end, text number and a 64-bit hash of each word's bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = NONWHITE) -> None:
        inside = letters[data]
        before, after = np.empty_like(inside), np.empty_like(inside)
        if len(data):
            before[0] = after[-1] = False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            before[edges] = False
            after[edges - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.texts = np.searchsorted(offsets, self.starts, side="right") - 1
        up, down = _POWERS.upto(len(data) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
            self.hashes = mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self._sums, self._down = sums, down

    def __len__(self) -> int:
        return len(self.starts)

    def windows(self, *places: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of the words at these places from each word on, within one text."""
        last = places[-1]
        if len(self) <= last:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        n = len(self) - last
        same = np.flatnonzero(self.texts[:n] == self.texts[last:])
        with np.errstate(over="ignore"):
            value = np.zeros(len(same), np.uint64)
            for k, place in enumerate(places):
                value += self.hashes[same + place] * MIX[k % len(MIX)]
        return same, mixed(value + np.uint64(last))

    def stems(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, hash of the first ``size`` bytes) of the words that are longer."""
        longer = np.flatnonzero(self.ends - self.starts > size)
        starts = self.starts[longer]
        with np.errstate(over="ignore"):
            return longer, mixed((self._sums[starts + size] - self._sums[starts]) * self._down[starts] + np.uint64(size))


def mixed(value: np.ndarray) -> np.ndarray:
    """Values whose every bit depends on all bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        value = value ^ (value >> np.uint64(29))
        value = value * np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(32))


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def give_back() -> None:
    """Hands freed memory back to the system. Arrow's pool and glibc keep it otherwise, in a driver for as long as it runs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries haven't one
    if trim is not None:
        trim(0)


def per_text(values: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by text number."""
    return np.bincount(texts, weights=values, minlength=n) if len(values) else np.zeros(n)


_KINDS = {"bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "binary": T.BinaryType()}


def struct(fields: str) -> T.StructType:
    """A struct of plain fields, ``name: type, ...``, for UDFs that are made before there is a session."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split(": ") for x in fields.split(", "))])
