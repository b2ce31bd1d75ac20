"""A cuckoo filter that grows: insertions, deletions and look-ups of many keys at once."""

from __future__ import annotations

import numpy as np

SLOTS = 4
#: Rounds of moving fingerprints before a table counts as full.
ROUNDS = 200


class CuckooFilter:
    """Tables of 16-bit fingerprints, four to a bucket; a full table gets another beside it.

    Keys are rows of two unsigned 64-bit integers that are already well mixed (a digest). A key
    that was inserted as often as deleted is absent but for false positives, about
    8 / 65,536 for each table.
    """

    def __init__(self, buckets: int = 1 << 10, data: bytes = b""):
        self.buckets = buckets
        size = buckets * SLOTS * 2
        self.tables = [np.frombuffer(data[i:i + size], np.uint16).reshape(buckets, SLOTS).copy()
                       for i in range(0, len(data), size)]

    def to_bytes(self) -> bytes:
        return b"".join(t.tobytes() for t in self.tables)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        prints = (keys[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        return prints, (keys[:, 1] % np.uint64(self.buckets)).astype(np.int64)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        mixed = (prints.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995)) >> np.uint64(20)
        return bucket ^ (mixed % np.uint64(self.buckets)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, bucket = self._places(keys)
        other = self._other(prints, bucket)
        found = np.zeros(len(keys), bool)
        for table in self.tables:
            found |= (table[bucket] == prints[:, None]).any(1) | (table[other] == prints[:, None]).any(1)
        return found

    def insert(self, keys: np.ndarray) -> None:
        prints, bucket = self._places(keys)
        if len(keys) and not self.tables:
            self.tables.append(np.zeros((self.buckets, SLOTS), np.uint16))
        while len(prints):
            prints, bucket = self._fill(self.tables[-1], prints, bucket)
            if len(prints):
                self.tables.append(np.zeros((self.buckets, SLOTS), np.uint16))

    def _fill(self, table: np.ndarray, prints: np.ndarray, bucket: np.ndarray):
        """Put what fits into one table; what is left over, with a bucket it may go to."""
        prints, bucket = self._free_slots(table, prints, bucket)
        prints, bucket = self._free_slots(table, prints, self._other(prints, bucket))
        moves = np.random.default_rng(len(prints))
        for _ in range(ROUNDS):
            if not len(prints):
                break
            # One fingerprint a bucket takes the place of another, which goes to its other bucket.
            _, first = np.unique(bucket, return_index=True)
            slot = moves.integers(0, SLOTS, len(first))
            home = bucket[first]
            out = table[home, slot]
            table[home, slot] = prints[first]
            prints[first], bucket[first] = out, self._other(out, home)
            prints, bucket = self._free_slots(table, prints, bucket)
        return prints, bucket

    @staticmethod
    def _free_slots(table: np.ndarray, prints: np.ndarray, bucket: np.ndarray):
        order = np.argsort(bucket, kind="stable")
        prints, bucket = prints[order], bucket[order]
        n = len(prints)
        new = np.concatenate([[True], bucket[1:] != bucket[:-1]])[:n]
        nth = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.arange(0)
        free = table[bucket] == 0
        rank = np.cumsum(free, axis=1) - 1
        takes = free & (rank == nth[:, None])
        fits = takes.any(1)
        table[bucket[fits], takes[fits].argmax(1)] = prints[fits]
        return prints[~fits], bucket[~fits]

    def delete(self, keys: np.ndarray) -> None:
        """Take out one fingerprint for each key; keys that were never inserted must not be given."""
        prints, bucket = self._places(keys)
        places = np.stack([bucket, self._other(prints, bucket)])
        for table in self.tables:
            for side in (0, 1):
                while len(prints):
                    hit = table[places[side]] == prints[:, None]
                    slot = places[side] * SLOTS + hit.argmax(1)
                    rows = np.flatnonzero(hit.any(1))
                    # Of keys that found the same slot one has it, the others look again.
                    rows = rows[np.unique(slot[rows], return_index=True)[1]]
                    if not len(rows):
                        break
                    table.reshape(-1)[slot[rows]] = 0
                    left = np.ones(len(prints), bool)
                    left[rows] = False
                    prints, places = prints[left], places[:, left]
