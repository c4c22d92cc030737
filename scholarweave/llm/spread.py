"""Joins and filters that hold when one key has a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

SALTS = 64
#: Bits of a filter: at least one bitmap of Spark's, at most 16 MB.
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 27
BITS_PER_KEY = 32


def join_unique(rows: DataFrame, unique: DataFrame, keys: Sequence[str], salt: Column, salts: int = SALTS) -> DataFrame:
    """Inner join of ``rows`` to ``unique``, which has one row for each of the ``keys``.

    Rows of one key are dealt out by ``salt``, a hash of what tells them apart. A row of
    ``unique`` is sent to the salts that its key has, which partial aggregation finds, so
    a key with few rows is not multiplied and a hot one is split into ``salts`` parts.
    """
    salted = rows.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    wanted = salted.select(*keys, "_salt").distinct()
    return salted.join(wanted.join(unique, list(keys)), [*keys, "_salt"]).drop("_salt")


class KeyFilter:
    """A bitmap of hashed keys: says of each key whether it may have been put in.

    It never denies a key that was put in. One that was not is taken for one that was with
    a probability of at most 1 in ``BITS_PER_KEY``, and of more once the bitmap has its
    largest size, so what passes has to be compared exactly afterwards. The size is bound
    by ``MOST_BITS`` whatever the number of keys.
    """

    def __init__(self, keys: DataFrame, hashed: str) -> None:
        """``keys`` is a stored table; ``hashed`` is its column of 64-bit hashes."""
        number = keys.count()
        self.bits = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(BITS_PER_KEY * number + 1))))
        slot = F.pmod(F.col(hashed), F.lit(self.bits))
        pages = (
            keys.groupBy(F.shiftright(slot, 15).cast("int").alias("page"))
            .agg(F.bitmap_construct_agg(F.pmod(slot, F.lit(1 << 15))).alias("bits"))
            .collect()
        )
        bitmap = np.zeros((self.bits >> 15, 1 << 12), np.uint8)
        for page in pages:
            bitmap[page.page] = np.frombuffer(page.bits, np.uint8)
        self.bitmap = bitmap.ravel()

    def may_have(self, hashed: np.ndarray) -> np.ndarray:
        slot = hashed.astype(np.int64) & (self.bits - 1)
        return (self.bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
