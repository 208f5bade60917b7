"""The published FarmHash ``Fingerprint64`` as a vectorised column function.

Spark has no such function. Strings are grouped by the length class the hash
distinguishes and each class is computed with 64-bit numpy arithmetic.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# The multipliers the fingerprint is defined with.
K0 = np.uint64(0xC3A5C85C97CB3127)
K1 = np.uint64(0xB492B66FBE98F273)
K2 = np.uint64(0x9AE16A3B2F90404F)


def _rotate(x, bits):
    return (x >> np.uint64(bits)) | (x << np.uint64(64 - bits))


def _fold(x):
    return x ^ (x >> np.uint64(47))


def _mix(u, v, mul):
    a = _fold((u ^ v) * mul)
    return _fold((v ^ a) * mul) * mul


def _word(block: np.ndarray, start: int, size: int = 8) -> np.ndarray:
    """Little-endian integer read from the same position of every row."""
    part = np.ascontiguousarray(block[:, start:start + size])
    return part.view(np.dtype(f"<u{size}")).reshape(-1).astype(np.uint64)


def _up_to_16(block, n):
    if n == 0:
        return np.full(block.shape[0], K2, dtype=np.uint64)
    if n < 4:
        first, middle, last = (block[:, i].astype(np.uint64) for i in (0, n >> 1, n - 1))
        y = first + (middle << np.uint64(8))
        z = np.uint64(n) + (last << np.uint64(2))
        return _fold((y * K2) ^ (z * K0)) * K2
    mul = K2 + np.uint64(2 * n)
    if n < 8:
        return _mix(np.uint64(n) + (_word(block, 0, 4) << np.uint64(3)), _word(block, n - 4, 4), mul)
    a, b = _word(block, 0) + K2, _word(block, n - 8)
    return _mix(_rotate(b, 37) * mul + a, (_rotate(a, 25) + b) * mul, mul)


def _up_to_32(block, n):
    mul = K2 + np.uint64(2 * n)
    a, b = _word(block, 0) * K1, _word(block, 8)
    c, d = _word(block, n - 8) * mul, _word(block, n - 16) * K2
    return _mix(_rotate(a + b, 43) + _rotate(c, 30) + d, a + _rotate(b + K2, 18) + c, mul)


def _up_to_64(block, n):
    mul = K2 + np.uint64(2 * n)
    a, b = _word(block, 0) * K2, _word(block, 8)
    c, d = _word(block, n - 8) * mul, _word(block, n - 16) * K2
    y = _rotate(a + b, 43) + _rotate(c, 30) + d
    z = _mix(y, a + _rotate(b + K2, 18) + c, mul)
    e, f = _word(block, 16) * mul, _word(block, 24)
    g, h = (y + _word(block, n - 32)) * mul, (z + _word(block, n - 24)) * mul
    return _mix(_rotate(e + f, 43) + _rotate(g, 30) + h, e + _rotate(f + a, 18) + g, mul)


def _weak_pair(block, start, a, b):
    w, x, y, z = (_word(block, start + 8 * i) for i in range(4))
    a = a + w
    b = _rotate(b + a + z, 21)
    c = a
    a = a + x + y
    return a + z, b + _rotate(a, 44) + c


def _longer(block, n):
    seed = np.uint64(81)
    x = np.full(block.shape[0], seed, dtype=np.uint64)
    y = np.full(block.shape[0], seed * K1 + np.uint64(113), dtype=np.uint64)
    z = _fold(y * K2 + np.uint64(113)) * K2
    v = (np.zeros_like(x), np.zeros_like(x))
    w = (np.zeros_like(x), np.zeros_like(x))
    x = x * K2 + _word(block, 0)
    whole = ((n - 1) // 64) * 64
    tail = n - 64
    for s in range(0, whole, 64):
        x = _rotate(x + y + v[0] + _word(block, s + 8), 37) * K1
        y = _rotate(y + v[1] + _word(block, s + 48), 42) * K1
        x = x ^ w[1]
        y = y + v[0] + _word(block, s + 40)
        z = _rotate(z + w[0], 33) * K1
        v = _weak_pair(block, s, v[1] * K1, x + w[0])
        w = _weak_pair(block, s + 32, z + w[1], y + _word(block, s + 16))
        z, x = x, z
    mul = K1 + ((z & np.uint64(0xFF)) << np.uint64(1))
    w = (w[0] + np.uint64((n - 1) & 63), w[1])
    v = (v[0] + w[0], v[1])
    w = (w[0] + v[0], w[1])
    x = _rotate(x + y + v[0] + _word(block, tail + 8), 37) * mul
    y = _rotate(y + v[1] + _word(block, tail + 48), 42) * mul
    x = x ^ (w[1] * np.uint64(9))
    y = y + v[0] * np.uint64(9) + _word(block, tail + 40)
    z = _rotate(z + w[0], 33) * mul
    v = _weak_pair(block, tail, v[1] * mul, x + w[0])
    w = _weak_pair(block, tail + 32, z + w[1], y + _word(block, tail + 16))
    z, x = x, z
    return _mix(_mix(v[0], w[0], mul) + _fold(y) * K0 + z, _mix(v[1], w[1], mul) + x, mul)


def fingerprints(values: list[bytes]) -> np.ndarray:
    """Signed 64-bit fingerprints of a batch of byte strings."""
    out = np.zeros(len(values), dtype=np.uint64)
    by_length: dict[int, list[int]] = {}
    for i, value in enumerate(values):
        by_length.setdefault(len(value), []).append(i)
    with np.errstate(over="ignore"):
        for n, rows in by_length.items():
            block = np.frombuffer(b"".join(values[i] for i in rows), dtype=np.uint8)
            block = block.reshape(len(rows), n)
            rule = (_up_to_16 if n <= 16 else _up_to_32 if n <= 32
                    else _up_to_64 if n <= 64 else _longer)
            out[rows] = rule(block, n)
    return out.view(np.int64)


@F.pandas_udf(LongType())
def farm_fingerprint(text: pd.Series) -> pd.Series:
    present = text.notna()
    out = pd.Series(pd.NA, index=text.index, dtype="Int64")
    out[present] = fingerprints([v.encode() for v in text[present]])
    return out
