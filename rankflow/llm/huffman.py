"""Canonical length-limited Huffman codes and their bit streams, in numpy.

Codes are MSB first.  A stream is cut by checkpoints: the bit offset of every
``STRIDE``-th symbol.  All stretches between checkpoints are decoded side by side, one
table look-up a step for each, so decoding is vectorised though a stream is serial.
"""

from __future__ import annotations

import numpy as np

STRIDE = 128
#: Longest code allowed (more only where that many symbols need it).
LIMIT = 18


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each symbol (0 where its count is 0): the optimum under the limit, by
    the package-merge rule.  One used symbol alone has length 1."""
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts > 0)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(n))))
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used]
    row, leaf_rows = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        row = both[order]
        leaf_rows.append(order < n)
    length, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(leaf_rows):
        chosen = int(is_leaf[:take].sum())
        length[:chosen] += 1
        take = 2 * (take - chosen)
    out[used] = length
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol: by length, then by symbol, counting up."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        top = int(lengths.max())
        step = np.uint64(1) << (np.uint64(top) - lengths[order].astype(np.uint64))
        start = np.cumsum(step) - step  # each code as an interval of the unit range, in 2**-top
        codes[order] = (start >> (np.uint64(top) - lengths[order].astype(np.uint64))).astype(np.uint32)
    return codes


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits looked at, and the symbol and code length for each of their values."""
    top = max(1, int(lengths.max(initial=0)))
    symbol, length = np.zeros(1 << top, np.uint32), np.ones(1 << top, np.uint8)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    span = np.int64(1) << (top - lengths[order].astype(np.int64))
    total = int(span.sum())
    symbol[:total], length[:total] = np.repeat(order, span), np.repeat(lengths[order], span)
    return top, symbol, length


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray, int]:
    """The bit stream (32-bit big-endian words), the checkpoints and the number of bits."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    bits = int(end[-1]) if len(ids) else 0
    start = end - size
    word, shift = start >> 5, (start & 31).astype(np.uint64)
    placed = codes[ids].astype(np.uint64) << (np.uint64(64) - size.astype(np.uint64) - shift)
    n = (bits + 31) // 32 + 1
    # codes don't overlap, so sums are unions; each fits 32 bits and is exact as a float
    out = np.bincount(word, (placed >> np.uint64(32)).astype(np.float64), n + 1)[:n + 1]
    out += np.bincount(word + 1, (placed & np.uint64(0xFFFFFFFF)).astype(np.float64), n + 1)[:n + 1]
    return out[:n].astype(np.uint32).astype(">u4").tobytes(), start[::STRIDE], bits


def decode(stream: bytes, checkpoints: np.ndarray, n: int, table: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """The ``n`` symbols of a stream."""
    if not n:
        return np.zeros(0, np.uint32)
    top, symbol, length = table
    words = np.concatenate([np.frombuffer(stream, ">u4").astype(np.uint64), np.zeros(2, np.uint64)])
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    at = np.asarray(checkpoints, np.int64).copy()
    out = np.zeros((len(at), STRIDE), np.uint32)
    mask, down = np.uint64((1 << top) - 1), np.uint64(64 - top)
    last = len(pairs) - 1
    for k in range(min(STRIDE, n)):
        live = len(at) if k < n - (len(at) - 1) * STRIDE else len(at) - 1  # the last stretch may be short
        pos = at[:live]
        key = (pairs[np.minimum(pos >> 5, last)] >> (down - (pos & 31).astype(np.uint64))) & mask
        out[:live, k] = symbol[key]
        at[:live] = pos + length[key]
    return out.reshape(-1)[:n]
