"""Helpers the corpus operators share: word splitting and hashing in tasks, batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII letters for a lower-casing that leaves all other characters alone.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space that ends a word.
SPACES = " \t\n\x0b\x0c\r"
#: UTF-8 bytes that one step of a vectorised pass takes at once (a longer text is one step).
STEP_BYTES = 1_000_000


def doc_crc32(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit("")))


def ascii_lower(c: Column | str) -> Column:
    return F.translate(F.col(c) if isinstance(c, str) else c, UPPER, LOWER)


def unused(names: Iterable[str], like: str) -> str:
    """A column name that is none of ``names`` in any case."""
    taken, name = {n.lower() for n in names}, f"_{like}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def release_memory() -> None:
    """Hand back what this worker has freed; Spark keeps idle workers, whose memory counts on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over batches, each cut into steps of bounded bytes.

    ``fn(batch)`` takes a RecordBatch whose ``text`` column (the last one, string)
    is null-free and yields RecordBatches.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                yield from fn(part)
        release_memory()

    return df.mapInArrow(run, schema)


def steps(batch: pa.RecordBatch, column: int = -1, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` holding at most ``limit`` bytes of its variable-length column
    (one row at least)."""
    if not batch.num_rows:
        return
    off = offsets(batch.column(column if column >= 0 else batch.num_columns + column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def offsets(arr: pa.Array) -> np.ndarray:
    """Start and end offsets of a string or binary array's values."""
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], dtype=kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values' bytes in one uint8 array, and the offsets of each value in it."""
    off = offsets(arr)
    data = np.frombuffer(arr.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


#: Mixing constants of splitmix64, a public 64-bit finaliser.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _table(seed: int, n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = _table(11, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out)  # wraps modulo 2**64


def lower_ascii_bytes(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of words per text; ``is_word`` (256 booleans) says which
    bytes make words, and words never cross texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    w = is_word[data]
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = w.copy()
    start[1:] &= ~w[:-1] | first[1:n]
    end = w.copy()
    end[:-1] &= ~w[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.diff(np.searchsorted(s, off))


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[s:e]`` for sorted, disjoint spans."""
    if not len(s):
        return np.zeros(0, np.uint64)
    length = e - s
    cell = np.arange(int(length.sum()), dtype=np.int64)
    base = np.cumsum(length) - length
    inside = cell - np.repeat(base, length)
    terms = _BYTE[data[np.repeat(s, length) + inside]] * _powers(int(length.max()))[inside]
    return mix64(np.add.reduceat(terms, base) + length.astype(np.uint64))


#: Bytes of words ``[^\x20\x09-\x0D]+`` and of words of digits, letters and non-ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True
