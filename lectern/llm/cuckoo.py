"""A cuckoo filter over 64-bit hashes, many at a time, that also deletes."""

from __future__ import annotations

import numpy as np

SLOTS = 4
MOST_LOAD = 0.8
MOST_KICKS = 500


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; each key has two buckets, either found from the other.

    Every key that was inserted is found until it is deleted; others are found by chance, about once in
    8,000. Insert a key once, and delete only what was inserted.
    """

    def __init__(self, keys: int, table: bytes | None = None):
        if table is None:
            buckets = 1 << max(4, int(keys / (SLOTS * MOST_LOAD))).bit_length()
            self.table = np.zeros((buckets, SLOTS), np.uint16)
        else:
            self.table = np.frombuffer(table, np.uint16).reshape(-1, SLOTS).copy()
        self.used = int(np.count_nonzero(self.table))
        self._random = np.random.default_rng(len(self.table))

    def __bytes__(self) -> bytes:
        return self.table.tobytes()

    def room(self) -> int:
        return int(self.table.size * MOST_LOAD) - self.used

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (hashes & np.uint64(len(self.table) - 1)).astype(np.int64)

    def _other(self, prints: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        mixed = (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return buckets ^ (mixed & np.uint64(len(self.table) - 1)).astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, buckets = self._places(hashes)
        first = (self.table[buckets] == prints[:, None]).any(1)
        return first | (self.table[self._other(prints, buckets)] == prints[:, None]).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if some found no place: then build a larger filter anew."""
        prints, buckets = self._places(hashes)
        if len(prints) > self.room():
            return False
        self.used += len(prints)
        for kicks in range(MOST_KICKS):
            if not len(prints):
                return True
            prints, buckets = self._settle(prints, buckets)
            buckets = self._other(prints, buckets)
            if kicks and len(prints):
                prints, buckets = self._settle(prints, buckets)
                prints, buckets = self._kick(prints, buckets)
        return not len(prints)

    def _settle(self, prints: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fill free slots; returns what found none."""
        order = np.argsort(buckets, kind="stable")
        prints, buckets = prints[order], buckets[order]
        rank = np.arange(len(buckets)) - np.searchsorted(buckets, buckets)
        taken = self.table[buckets] != 0
        placed = rank < SLOTS - taken.sum(1)
        slot = np.argsort(taken, axis=1, kind="stable")[placed, rank[placed]]
        self.table[buckets[placed], slot] = prints[placed]
        return prints[~placed], buckets[~placed]

    def _kick(self, prints: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In each full bucket, one print takes a slot, and what was there goes on to its other bucket."""
        at, first = np.unique(buckets, return_index=True)
        slot = self._random.integers(0, SLOTS, len(at))
        out = self.table[at, slot].copy()
        self.table[at, slot] = prints[first]
        prints = prints.copy()
        prints[first] = out
        moved = buckets.copy()
        moved[first] = self._other(out, at)
        return prints, moved

    def delete(self, hashes: np.ndarray) -> None:
        """Remove one copy for each hash, from either bucket."""
        prints, buckets = self._places(hashes)
        for side in range(2):
            while len(prints):
                pair = buckets * (1 << 16) + prints
                _, first = np.unique(pair, return_index=True)
                there = self.table[buckets[first]] == prints[first][:, None]
                found = there.any(1)
                gone = first[found]
                # Prints of one bucket that differ have slots that differ.
                self.table[buckets[gone], there[found].argmax(1)] = 0
                self.used -= len(gone)
                if not len(gone):
                    break
                keep = np.ones(len(prints), bool)
                keep[gone] = False
                prints, buckets = prints[keep], buckets[keep]
            if side == 0:
                buckets = self._other(prints, buckets)
