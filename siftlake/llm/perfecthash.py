"""Minimal perfect hash over distinct 64-bit keys, built level by level.

On each level the keys left over mark positions of a bit array twice their number; a position marked
by exactly one key is that key's, and the others go on to the next level. The rank of a key's bit
among all bits is its index, 0 to n-1. Finding a key takes a few bit tests and one rank, whatever n is.
"""

from dataclasses import dataclass

import numpy as np

from .textblocks import mix

GAMMA = 2.0
RANK_BITS = 512


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(0xA24BAED4963EE407 * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    """32 bits that tell a stored key from a foreign one, independent of the positions."""
    return (mix(keys.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class PerfectHash:
    sizes: np.ndarray
    bits: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        left = keys.view(np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys repeat")
        sizes, levels = [], []
        while len(left):
            size = -(-max(int(GAMMA * len(left)), 1) // RANK_BITS) * RANK_BITS
            position = _position(left, len(sizes), size)
            counts = np.bincount(position, minlength=size)
            sizes.append(size)
            levels.append(counts == 1)
            left = left[counts[position] != 1]
        marked = np.concatenate(levels) if levels else np.zeros(0, dtype=bool)
        per_block = marked.reshape(-1, RANK_BITS).sum(axis=1)
        ranks = np.concatenate(([0], np.cumsum(per_block)))[:-1]
        return cls(np.array(sizes, np.int64), np.packbits(marked), ranks.astype(np.uint32))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; -1 for a key that no level holds. A foreign key may get any index."""
        keys = keys.view(np.uint64)
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        base = 0
        for level, size in enumerate(self.sizes):
            at = base + _position(keys[open_], level, int(size))
            hit = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            out[open_[hit]] = self._rank(at[hit])
            open_ = open_[~hit]
            if not len(open_):
                break
            base += int(size)
        return out

    def _rank(self, at: np.ndarray) -> np.ndarray:
        """Number of set bits before each position: its block's stored rank and the bits inside the block."""
        if not len(at):
            return at
        block = at // RANK_BITS
        used, slot = np.unique(block, return_inverse=True)
        rows = np.unpackbits(self.bits.reshape(-1, RANK_BITS // 8)[used], axis=1)
        before = np.cumsum(rows, axis=1, dtype=np.int64) - rows
        return self.ranks[block].astype(np.int64) + before[slot, at % RANK_BITS]
