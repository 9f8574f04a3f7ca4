"""Vectorised building blocks (numpy) of the operators: hashes, text as code points, packed blocks."""

from __future__ import annotations

import zlib

import numpy as np

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = np.array(x, dtype=np.uint64)
    s = np.uint64(33)
    x ^= x >> s
    x *= _M1
    x ^= x >> s
    x *= _M2
    x ^= x >> s
    return x


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        m = max(n, 1 << 16)
        p = np.full(m, np.uint64(base), dtype=np.uint64)
        p[0] = 1
        _POW[base] = have = np.multiply.accumulate(p)
    return have[:n]


def codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Rolling:
    """Hashes of all substrings of one array of codes; equal substrings hash alike wherever they stand."""

    def __init__(self, c: np.ndarray):
        n = len(c)
        self.h = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((c.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=self.h[1:])
        self.inv = _powers(_BASE_INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.h[end] - self.h[start]) * self.inv[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        return mix((self.h[k:] - self.h[:-k]) * self.inv[: len(self.h) - k])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` consecutive values, by doubling."""
    m, s = v, 1
    while s * 2 <= w:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    return np.minimum(m[: len(m) - (w - s)], m[w - s :]) if w > s else m


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays in one block: name, type, length and bytes each. Ascending integers are kept as compressed differences."""
    out = []
    for name, a in arrays.items():
        body, how = np.ascontiguousarray(a), b"r"
        if a.dtype == np.int64 and len(a) > 8:
            body, how = np.diff(a, prepend=np.int64(0)), b"d"
        raw = body.tobytes() if how == b"r" else zlib.compress(body.tobytes(), 1)
        head = f"{name},{a.dtype.str},{len(raw)}".encode()
        out += [len(head).to_bytes(2, "little"), how, head, raw]
    return b"".join(out)


def unpack(block: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    while at < len(block):
        n = int.from_bytes(block[at : at + 2], "little")
        how = block[at + 2 : at + 3]
        name, kind, size = block[at + 3 : at + 3 + n].decode().split(",")
        at += 3 + n
        raw = block[at : at + int(size)]
        at += int(size)
        out[name] = np.cumsum(np.frombuffer(zlib.decompress(raw), dtype=kind)) if how == b"d" else np.frombuffer(raw, dtype=kind)
    return out


def unpack_all(blocks) -> dict[str, np.ndarray]:
    """The arrays of several blocks, one after the other."""
    parts = [unpack(b) for b in blocks]
    return {k: np.concatenate([p[k] for p in parts]) for k in (parts[0] if parts else ())}
