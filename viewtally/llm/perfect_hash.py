"""A minimal perfect hash over 64-bit numbers, built and asked with numpy.

A cascade of bit arrays: on each level the numbers that are alone on their bit
are settled there, the others go on to the next level. The slot of a number is
the count of settled bits before its own, so there are as many slots as numbers.
"""

from __future__ import annotations

import numpy as np

from viewtally.llm.textarrays import mix

_SALT = np.uint64(0xD1342543DE82EF95)


class PerfectHash:
    """``slots(numbers)`` sends the n numbers it was built over to 0..n-1, others anywhere."""

    def __init__(self, numbers: np.ndarray, spread: float = 2.0):
        if len(np.unique(numbers)) < len(numbers):
            raise ValueError("numbers repeat")
        self.levels: list[np.ndarray] = []  # the slot of each bit, -1 if nobody is settled there
        settled, rest = 0, numbers
        while len(rest):
            bits = max(1, int(spread * len(rest)))
            at = self._at(rest, len(self.levels), bits)
            alone = np.bincount(at, minlength=bits) == 1
            slots = np.full(bits, -1, np.int64)
            slots[alone] = settled + np.arange(alone.sum())
            self.levels.append(slots)
            settled += int(alone.sum())
            rest = rest[~alone[at]]

    @staticmethod
    def _at(numbers: np.ndarray, level: int, bits: int) -> np.ndarray:
        salt = np.uint64((level + 1) * int(_SALT) % (1 << 64))
        return (mix(numbers ^ salt) % np.uint64(bits)).astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers), np.int64)
        open_ = np.arange(len(numbers))
        for level, slots in enumerate(self.levels):
            got = slots[self._at(numbers[open_], level, len(slots))]
            out[open_] = np.maximum(got, 0)
            open_ = open_[got < 0]
        return out
