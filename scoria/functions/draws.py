"""``report.poisson_weight`` for arrays: the Poisson draws of many keys and replicates at once.

The key of a draw is ``prefix | replicate | class``.  Its md5 is computed on arrays of (keys x replicates),
the words that only a key or only a replicate has are kept once; keys of any length are read block by block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

__all__ = ["md5_pairs", "poisson_pairs", "strings"]

_K = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_TURN = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_START = [np.full((1, 1), x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def _block(state, words):
    """md5's compression of one block; all are arrays that broadcast to (keys, replicates)."""
    a, b, c, d = state
    for i in range(64):
        if i < 16:
            f, at = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, at = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, at = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, at = c ^ (b | ~d), 7 * i % 16
        f = f + a + (words[at] + np.uint32(_K[i]))
        turn = _TURN[i // 16][i % 4]
        left = f << np.uint32(turn)
        f >>= np.uint32(32 - turn)
        left |= f
        left += b
        a, d, c, b = d, c, b, left
    return [x + y for x, y in zip(state, (a, b, c, d))]


def _words(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view("<u4").astype(np.uint32)


def md5_pairs(prefixes: np.ndarray, suffixes: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The first and the next 8 hex digits of md5(prefix + suffix) as numbers, for every prefix (rows of equally many
    bytes) and every suffix."""
    keys, length = prefixes.shape
    whole = length // 64
    state = _START
    for k in range(whole):
        w = _words(prefixes[:, 64 * k:64 * k + 64])
        state = _block(state, [w[:, i:i + 1] for i in range(16)])
    rest = length - 64 * whole
    out = np.empty((2, keys, len(suffixes)), np.uint32)
    blocks = np.array([(rest + len(s) + 8) // 64 + 1 for s in suffixes])
    for n in np.unique(blocks):
        own = np.nonzero(blocks == n)[0]
        tail = np.zeros((len(own), 64 * n), np.uint8)
        for row, j in zip(tail, own):
            s = suffixes[j] + b"\x80"
            row[rest:rest + len(s)] = np.frombuffer(s, np.uint8)
            row[-8:] = np.frombuffer((8 * (length + len(s) - 1)).to_bytes(8, "little"), np.uint8)
        head = np.zeros((keys, 64 * n), np.uint8)
        head[:, :rest] = prefixes[:, 64 * whole:]
        head, tail = _words(head), _words(tail)
        words = [tail[None, :, i] if 4 * i >= rest else head[:, i, None] | tail[None, :, i] if tail[:, i].any() else head[:, i, None]
                 for i in range(16 * n)]
        now = state
        for k in range(n):
            now = _block(now, words[16 * k:16 * k + 16])
        for x, v in zip(out, now):
            x[:, own] = v.byteswap()
    return out[0], out[1]


def strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A string column's bytes, and where each string begins and how long it is."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets[:-1], np.diff(offsets)


def poisson_pairs(data: np.ndarray, begin: np.ndarray, length: np.ndarray, count: np.ndarray, suffixes: Sequence[bytes],
                  ladders: Sequence[Sequence[float]]) -> np.ndarray:
    """Poisson(``count``) draws, keys x suffixes; a key is ``length`` bytes of ``data`` from ``begin``."""
    out = np.zeros((len(count), len(suffixes)))
    for size in np.unique(length[count > 0]):
        rows = np.nonzero((count > 0) & (length == size))[0]
        x, y = md5_pairs(data[begin[rows, None] + np.arange(size)], suffixes)
        small = count[rows] < len(ladders)
        for mean in np.unique(count[rows][small]):
            here = slice(None) if (count[rows] == mean).all() else count[rows] == mean
            u, w = x[here], np.zeros(x[here].shape, np.uint8)
            for step in ladders[mean]:
                at = math.ceil(step * 2 ** 32)  # exact: a step of the ladder is at most x / 2 ** 32
                if at >= 2 ** 32:
                    break
                w += u >= np.uint32(at)
            out[rows[here]] = w
        if not small.all():
            mean = count[rows][~small].astype(float)[:, None]
            u, v = x[~small] / 2.0 ** 32, y[~small] / 2.0 ** 32
            z = np.sqrt(-2 * np.log(1 - u)) * np.cos(2 * math.pi * v)
            out[rows[~small]] = np.maximum(0.0, np.floor(mean + np.sqrt(mean) * z + (z * z - 1) / 6 + 0.5))
    return out
