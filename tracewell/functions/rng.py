"""A seeded counter-based generator as column expressions: any draw of a sequence without the ones before it.

The only state is a counter that grows by a fixed step, so draw k mixes ``seed + (k + 1) * STEP``
modulo 2^32. Products of 32-bit numbers are taken in halves of 16 bits, so that no product leaves
the 64 bits of a long.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: The step of the counter, and the offset and factor of the string hash.
STEP, HASH_OFFSET, HASH_FACTOR = 0x6D2B79F5, 0x811C9DC5, 0x01000193
MASK = 0xFFFFFFFF


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(MASK))


def _times(a: Column, b: Column) -> Column:
    """Low 32 bits of a product of two unsigned 32-bit numbers held as longs."""
    return _low(a * b.bitwiseAND(F.lit(0xFFFF)) + F.shiftleft((a * F.shiftright(b, 16)).bitwiseAND(F.lit(0xFFFF)), 16))


def draw(seed: Column, k: Column) -> Column:
    """Draw number k (from 0) of the sequence of a seed: a double in [0, 1)."""
    one, sixty_one = F.lit(1), F.lit(61)
    a = _low(_low(seed.cast("long")) + _times(_low(k.cast("long") + 1), F.lit(STEP).cast("long")))
    t = _times(a.bitwiseXOR(F.shiftright(a, 15)), a.bitwiseOR(one))
    t = _low(t + _times(t.bitwiseXOR(F.shiftright(t, 7)), t.bitwiseOR(sixty_one))).bitwiseXOR(t)
    return _low(t.bitwiseXOR(F.shiftright(t, 14))) / F.lit(4294967296.0)


def seed_from(text: Column) -> Column:
    """32-bit hash of an ASCII text, as a long."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    start = F.lit(HASH_OFFSET).cast("long")
    return F.aggregate(codes, start, lambda h, c: _times(h.bitwiseXOR(c), F.lit(HASH_FACTOR).cast("long")))


def draws(seed: int | np.ndarray, n: int) -> np.ndarray:
    """The first n draws of a sequence at once, for tasks that shuffle arrays and for tests. Of several seeds: a row each."""
    a = (np.asarray(seed & MASK, np.uint64)[..., None] + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(STEP)).astype(np.uint32)
    t = (a ^ a >> np.uint32(15)) * (a | np.uint32(1))
    t = (t + (t ^ t >> np.uint32(7)) * (t | np.uint32(61))) ^ t
    return (t ^ t >> np.uint32(14)) / 4294967296
