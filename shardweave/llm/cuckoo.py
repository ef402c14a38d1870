"""A cuckoo filter over 128-bit keys, whose operations take whole NumPy arrays."""

from __future__ import annotations

import numpy as np

from shardweave.llm.words import mix

# Buckets of a filter and fingerprints of 16 bits in each: 1 MB. Rounds of moving before an entry is put aside.
BUCKETS, SLOTS, ROUNDS = 1 << 17, 4, 400


class Cuckoo:
    """One fingerprint per key, in one of the two buckets that the key may use.

    Each round of an insertion handles at most one entry per bucket, so that a round is a few array operations.
    Entries that still have no place after ``ROUNDS`` lie beside the table, where they are searched too: no key
    is ever lost, whatever the load. Fingerprints may be removed again, as often as they were added.
    """

    def __init__(self, data: bytes | None = None):
        cells = BUCKETS * SLOTS
        kept = np.zeros(cells, np.uint16) if data is None else np.frombuffer(data, np.uint16)
        self.table = kept[:cells].reshape(BUCKETS, SLOTS).copy()
        self.aside = kept[cells:].copy().view(np.uint64)

    def tobytes(self) -> bytes:
        return self.table.tobytes() + self.aside.tobytes()

    def __len__(self) -> int:
        return int(np.count_nonzero(self.table)) + len(self.aside)

    @staticmethod
    def places(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, fingerprint) of keys given as two 64-bit numbers each; fingerprint 0 means a free slot."""
        mark = (second & np.uint64(0xFFFF)).astype(np.uint16)
        return (first & np.uint64(BUCKETS - 1)).astype(np.int64), np.where(mark == 0, np.uint16(1), mark)

    @staticmethod
    def other(bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)

    @classmethod
    def names(cls, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """One number for a fingerprint and its two buckets."""
        return (np.minimum(bucket, cls.other(bucket, mark)) << 16 | mark).astype(np.uint64)

    def has(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        bucket, mark = self.places(first, second)
        found = (self.table[bucket] == mark[:, None]).any(1) | (self.table[self.other(bucket, mark)] == mark[:, None]).any(1)
        return found | np.isin(self.names(bucket, mark), self.aside) if len(self.aside) else found

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        bucket, mark = self.places(first, second)
        moved = np.zeros(len(bucket), bool)
        rng = np.random.default_rng(len(bucket))
        for _ in range(ROUNDS):
            if not len(bucket):
                return
            _, turn = np.unique(bucket, return_index=True)
            here = bucket[turn]
            free = self.table[here] == 0
            fits, slot = free.any(1), free.argmax(1)
            self.table[here[fits], slot[fits]] = mark[turn[fits]]
            full = turn[~fits]
            # Go to the other bucket at first, and only there push out a fingerprint, which goes to its own other one.
            push = full[moved[full]]
            slot = rng.integers(0, SLOTS, len(push))
            out = self.table[bucket[push], slot]
            self.table[bucket[push], slot] = mark[push]
            mark[push] = out
            bucket[full] = self.other(bucket[full], mark[full])
            moved[full] = True
            left = np.ones(len(bucket), bool)
            left[turn[fits]] = False
            bucket, mark, moved = bucket[left], mark[left], moved[left]
        self.aside = np.concatenate([self.aside, self.names(bucket, mark)])

    def remove(self, first: np.ndarray, second: np.ndarray) -> None:
        """Take away one fingerprint for each of the keys, all of which must have been added."""
        bucket, mark = self.places(first, second)
        while len(bucket):
            # Entries of another name never share a slot, so one of each name may go at once.
            names, turn = np.unique(self.names(bucket, mark), return_index=True)
            gone = np.zeros(len(turn), bool)
            for place in (bucket[turn], self.other(bucket[turn], mark[turn])):
                same = self.table[place] == mark[turn][:, None]
                hit = same.any(1) & ~gone
                self.table[place[hit], same.argmax(1)[hit]] = 0
                gone |= hit
            if len(self.aside) and not gone.all():
                _, at = np.unique(self.aside, return_index=True)
                at = at[np.isin(self.aside[at], names[~gone])]
                self.aside = np.delete(self.aside, at)
            left = np.ones(len(bucket), bool)
            left[turn] = False
            bucket, mark = bucket[left], mark[left]
