"""Front-coded sorted runs and a loser tree that knows common prefixes.

A sorted run of byte strings is stored front-coded: each string as the length
of the prefix that it shares with the string before and the rest.  Merging k
such runs, every player of the tree keeps the length of its common prefix with
the last string put out.  Two players with different lengths are ordered by
these numbers alone; only with equal lengths are bytes read, and only those
after the known prefix.  The merge therefore gives the common prefix of
neighbours in the merged order at no further cost.
"""

from __future__ import annotations

from typing import Iterable, Iterator

import numpy as np


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes are known to be equal."""
    m = min(len(a), len(b))
    x = int.from_bytes(a[known:m], "big") ^ int.from_bytes(b[known:m], "big")
    return m - (x.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(prefix lengths, rest lengths, rests) of a sorted list."""
    shared = np.zeros(len(strings), dtype=np.uint32)
    for i in range(1, len(strings)):
        shared[i] = common_prefix(strings[i - 1], strings[i])
    rests = [s[k:] for s, k in zip(strings, shared.tolist())]
    return shared, np.array([len(r) for r in rests], dtype=np.uint32), b"".join(rests)


def front_decode(shared: np.ndarray, rest: np.ndarray, blob: bytes) -> Iterator[tuple[bytes, int]]:
    """(string, common prefix with the one before)."""
    at, last = 0, b""
    for k, n in zip(shared.tolist(), rest.tolist()):
        last = last[:k] + blob[at : at + n]
        at += n
        yield last, k


def merge_runs(runs: list[Iterable[tuple[bytes, int, object]]]) -> Iterator[tuple[bytes, int, object]]:
    """Merge sorted runs of (string, common prefix with the one before in its run, payload).

    Yields (string, common prefix with the string before in the merged order,
    payload); equal strings come in the order of their runs.
    """
    feeds = [iter(r) for r in runs]
    size = 1
    while size < max(1, len(feeds)):
        size *= 2
    text: list[bytes | None] = [None] * size
    load: list[object] = [None] * size
    known = [-1] * size  # common prefix with the last string put out; -1: the run is over

    def advance(p: int, first: bool = False) -> None:
        item = next(feeds[p], None) if p < len(feeds) else None
        if item is None:
            text[p], known[p] = None, -1
        else:
            text[p], known[p], load[p] = item[0], 0 if first else item[1], item[2]

    def beats(a: int, b: int) -> bool:
        """Does a come before b?  The loser's known prefix becomes that with the winner."""
        ka, kb = known[a], known[b]
        if ka != kb:
            return ka > kb
        if ka < 0:
            return True
        sa, sb = text[a], text[b]
        x = common_prefix(sa, sb, ka)
        if x == len(sa):
            first = a < b if x == len(sb) else True
        else:
            first = x < len(sb) and sa[x] < sb[x]
        known[b if first else a] = x
        return first

    for p in range(size):
        advance(p, first=True)
    loser = [0] * size

    def build(node: int) -> int:
        if node >= size:
            return node - size
        a, b = build(2 * node), build(2 * node + 1)
        a_first = beats(a, b)
        loser[node] = b if a_first else a
        return a if a_first else b

    win = build(1)
    while known[win] >= 0:
        yield text[win], known[win], load[win]
        advance(win)
        node = (win + size) >> 1
        while node:
            rival = loser[node]
            if not beats(win, rival):
                loser[node], win = win, rival
            node >>= 1
