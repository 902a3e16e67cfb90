"""Small numpy helpers that run inside tasks: code points, n-gram and word hashes.

Every hash here is a fixed function of the characters (no per-process seed), so
a task that is run again after a lost executor gives the same rows.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
_LETTER: np.ndarray | None = None
MUL = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """Boolean per code point: is it a letter?  Built once per worker."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of ``texts`` in one array, and the n+1 offsets of the texts."""
    off = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), off


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: spreads every input bit over the output."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive values (length n-width+1), by doubling."""
    n = len(values)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        first = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        first ^= first >> np.uint64(32)
        power = {1: first}
        factor, size = MUL, 1
        mult = {1: factor}
        while size * 2 <= width:
            prev = power[size]
            power[size * 2] = prev[: len(prev) - size] * mult[size] + prev[size:]
            mult[size * 2] = mult[size] * mult[size]
            size *= 2
        out, done = power[size][: n - size + 1], size
        for part in sorted((p for p in power if p < size), reverse=True):
            if done + part <= width:
                nxt = power[part]
                m = n - done - part + 1
                out = out[:m] * mult[part] + nxt[done : done + m]
                done += part
    return out


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles.

    A text with fewer words than ``width`` has one shingle of all its words; a
    text without words has none.
    """
    ws = words(text)
    if not ws:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), dtype=np.uint64, count=len(ws))
    return np.unique(mix(rolling(h, min(width, len(ws)))))
