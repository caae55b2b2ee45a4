"""A keyed permutation of 0..n-1: Feistel rounds, walking cycles until the value is in range."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 6


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Permutation:
    """Bijection on 0..n-1 fixed by (n, key).

    The Feistel network permutes the smallest even power of two at or above n. A value
    that lands outside is sent through again; following its cycle it must come back in
    range, as it started there. The range is less than 4 n, so few rounds are needed.
    """

    def __init__(self, n: int, key: str):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = np.frombuffer(hashlib.blake2b(key.encode(), digest_size=8 * ROUNDS).digest(), "<u8").tolist()

    def _once(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        bits, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> bits, x & mask
        for key in reversed(self.keys) if backwards else self.keys:
            if backwards:
                left, right = right ^ (_mixed(left ^ np.uint64(key)) & mask), left
            else:
                left, right = right, left ^ (_mixed(right ^ np.uint64(key)) & mask)
        return (left << bits) | right

    def _walk(self, values: np.ndarray, backwards: bool) -> np.ndarray:
        x = np.asarray(values).astype(np.uint64)
        if len(x) and int(x.max()) >= self.n:
            raise ValueError("value outside the permutation's range")
        out = self._once(x, backwards)
        while len(far := np.flatnonzero(out >= np.uint64(self.n))):
            out[far] = self._once(out[far], backwards)
        return out.astype(np.int64)

    def forward(self, values: np.ndarray) -> np.ndarray:
        return self._walk(values, False)

    def backward(self, values: np.ndarray) -> np.ndarray:
        return self._walk(values, True)

    def of(self, number: Column) -> Column:
        @F.pandas_udf("long")
        def permuted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(self.forward(batch.to_numpy()))

        return permuted(number)
