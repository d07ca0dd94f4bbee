"""Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

A collection of byte strings is a set of cycles: each string and its end mark.
A shard's transform lists, for all rotations in sorted order, the symbols before
them. To merge shards, all rotations start in one group in shard order. Each
step takes the rotations in their present order to the rotations that start some
symbols before, which is a stable distribution by those symbols, read from the
transforms alone: the order by d symbols becomes the order by d + q symbols.
Group borders move along, so after the last step neighbours without a border
between them share a prefix of the full depth; no suffix is sorted anew.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """Sorted rotations of some strings: ``start`` of each rotation in sorted order, ``before[q]`` codes and ``back[q]`` ranks q symbols earlier."""

    def __init__(self, flat: np.ndarray, offs: np.ndarray, depth: int):
        """``flat``: symbols (bytes + 1; each string ends with 0); ``offs``: string borders."""
        n = len(flat)
        self.size = n
        nxt = np.arange(1, n + 1, dtype=np.int64)
        nxt[offs[1:] - 1] = offs[:-1]
        # rank by 7 symbols, 9 bits each, then by doubling
        key, at = np.zeros(n, np.int64), np.arange(n)
        for _ in range(7):
            key = key << 9 | flat[at]
            at = nxt[at]
        rank, known, jump = self._ranks(key), 7, at
        while known < depth and rank.max(initial=0) < n - 1:
            rank = self._ranks(rank * n + rank[jump])
            jump = jump[jump]
            known *= 2
        order = np.argsort(rank)
        self.start = order
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        before = np.empty(n, np.int64)
        before[nxt] = np.arange(n)
        self.last = flat[before[order]]  # the transform
        self.back = place[before[order]]  # the rank of the rotation that starts with it

    @staticmethod
    def _ranks(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        k = key[order]
        out = np.empty(len(key), np.int64)
        out[order] = np.cumsum(np.r_[False, k[1:] != k[:-1]])
        return out


def _dense(code: np.ndarray, bound: int) -> tuple[np.ndarray, int]:
    """Codes without gaps, in the same order, and their number."""
    seen = np.zeros(bound, bool)
    seen[code] = True
    number = np.cumsum(seen)
    return number[code] - 1, int(number[-1])


def _steps(last: np.ndarray, back: np.ndarray, depth: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The most symbols a step can take (a divisor of the depth) while their strings have at most 65,536 codes; the codes and ranks for it."""
    single, _ = _dense(last, 257)
    code, many = single, int(single.max(initial=0)) + 1
    best = (1, code.astype(np.uint16), back)
    at = back
    for q in range(2, 6):
        # the string of q symbols before a rotation: those further back come first
        code, many = _dense(single[at] * many + code, (int(single.max(initial=0)) + 1) * many)
        at = back[at]
        if many > 65_536:
            break
        if depth % q == 0:
            best = (q, code.astype(np.uint16), at)
    return best


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, group) of the rotations that share their first ``depth`` symbols with another, in sorted order.

    The index counts through the shards' sorted rotations. Rotations that are alone
    in their group are left behind on the way, as those before them are alone as well.
    """
    sizes = np.array([s.size for s in shards], np.int64)
    base = np.cumsum(sizes) - sizes
    last = np.concatenate([s.last for s in shards])
    back = np.concatenate([s.back + b for s, b in zip(shards, base.tolist(), strict=True)])
    q, code, back = _steps(last, back, depth)
    index = np.arange(len(last))
    group = np.zeros(len(last), np.int64)
    for _ in range(depth // q):
        symbols = code[index]
        order = np.argsort(symbols, kind="stable")
        symbols, group = symbols[order], group[order]
        index = back[index[order]]
        border = np.r_[True, (symbols[1:] != symbols[:-1]) | (group[1:] != group[:-1])]
        group = np.cumsum(border)
        alone = border & np.r_[border[1:], True]
        if alone.any():
            index, group = index[~alone], group[~alone]
        if not len(index):
            break
    return index, group


def repeated(strings: list[bytes], depth: int, shard_bytes: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, group) of every substring of ``depth`` bytes that occurs more than once in the strings."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.zeros(int(lengths.sum()) + len(strings), np.int64)
    offs = np.concatenate([[0], np.cumsum(lengths + 1)])
    inside = np.ones(len(flat), bool)
    inside[offs[1:] - 1] = False
    flat[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    shards, starts, lo = [], [], 0
    while lo < len(strings):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + shard_bytes, "right")) - 1)
        s = Shard(flat[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], depth)
        shards.append(s)
        starts.append(s.start + offs[lo])
        lo = hi
    if not shards:
        return (np.empty(0, np.int64),) * 3
    index, group = merge(shards, depth)
    at = np.concatenate(starts)[index]
    string = np.searchsorted(offs, at, "right") - 1
    offset = at - offs[string]
    whole = offset + depth <= lengths[string]
    return string[whole], offset[whole], group[whole]
