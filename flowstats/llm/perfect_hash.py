"""Minimal perfect hashes over sets of 64-bit key hashes: cascades of bit arrays without collisions.

Level by level, every key left picks a bit; keys alone on their bit keep it, the others go on to the next level. A
key's number is the rank of its bit over all levels, so n keys are numbered 0 to n - 1 without gaps.
"""

from __future__ import annotations

import numpy as np

from flowstats.llm.common import mix

#: Bits per key left at a level.
ROOM = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(hashes ^ (_ODD * np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """`number(hashes)` of the hashes it was built from; any number, or -1, for others: verify against stored keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            ones = np.cumsum(np.unpackbits(bits).reshape(-1, 8).sum(axis=1, dtype=np.int64))
            self.ranks.append(before + np.r_[0, ones[:-1]])
            before += int(ones[-1])
        self.size = before

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        """For distinct hashes."""
        left, levels = np.asarray(hashes, np.uint64), []
        while len(left):
            size = -(-len(left) * ROOM // 8) * 8
            at = _place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone))
            left = left[~alone[at]]
        return cls(levels)

    def number(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        open_, left = np.arange(len(hashes)), np.asarray(hashes, np.uint64)
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = _place(left, level, len(bits) * 8)
            byte = bits[at >> 3]
            shift = (at & 7).astype(np.uint8)
            hit = (byte >> (7 - shift)) & 1 == 1
            head = (byte.astype(np.uint16) >> (8 - shift).astype(np.uint16)).astype(np.uint8)
            out[open_[hit]] = (ranks[at >> 3] + _BITS[head])[hit]
            open_, left = open_[~hit], left[~hit]
        return out


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)
