"""XXH64 of many byte windows of one buffer, vectorised with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of the XXH64 specification.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)

LONG = 2048  # windows from this length on are hashed one by one by the xxhash library


def _rot(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc, lane):
    return _rot(acc + lane * P2, 31) * P1


def hash_windows(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of data[starts[i]:ends[i]] for every i."""
    with np.errstate(over="ignore"):
        return _hash(data, starts, ends, seed)


def _hash(data: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    n = len(starts)
    out = np.empty(n, np.uint64)
    if n == 0:
        return out
    lens = np.minimum(ends - starts, LONG).astype(np.int16)
    padded = data + b"\0" * 8
    v8 = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    v4 = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    v1 = np.frombuffer(padded, np.uint8)
    s = np.uint64(seed)
    order = np.argsort(lens, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(lens))))
    for size in np.flatnonzero(np.diff(bounds)).tolist():  # windows of one length at a time
        rows = order[bounds[size] : bounds[size + 1]]
        if size == LONG:
            view = memoryview(data)
            out[rows] = [xxhash.xxh64_intdigest(view[starts[i] : ends[i]], seed) for i in rows.tolist()]
            continue
        pos = starts[rows]
        if size >= 32:
            acc = [np.full(len(rows), x, np.uint64) for x in (s + P1 + P2, s + P2, s, s - P1)]
            for at in range(0, size - 31, 32):
                acc = [_round(a, v8[pos + (at + 8 * j)]) for j, a in enumerate(acc)]
            h = _rot(acc[0], 1) + _rot(acc[1], 7) + _rot(acc[2], 12) + _rot(acc[3], 18)
            for a in acc:
                h = (h ^ _round(np.uint64(0), a)) * P1 + P4
            h = h + np.uint64(size)
        else:
            h = s + P5 + np.uint64(size)
        at = size // 32 * 32
        for at in range(at, size - 7, 8):
            h = _rot(h ^ _round(np.uint64(0), v8[pos + at]), 27) * P1 + P4
        at = size // 8 * 8
        if size & 4:
            h = _rot(h ^ (v4[pos + at].astype(np.uint64) * P1), 23) * P2 + P3
            at += 4
        for at in range(at, size):
            h = _rot(h ^ (v1[pos + at].astype(np.uint64) * P5), 11) * P1
        h = h ^ (h >> np.uint64(33))
        h = h * P2
        h = h ^ (h >> np.uint64(29))
        h = h * P3
        out[rows] = h ^ (h >> np.uint64(32))
    return out
