"""Union of many small results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """Stack DataFrames of one schema, pairing them so that planning stays shallow."""
    layer = list(parts)
    while len(layer) > 1:
        pairs = [layer[i:i + 2] for i in range(0, len(layer), 2)]
        layer = [pair[0].unionAll(pair[1]) if len(pair) == 2 else pair[0] for pair in pairs]
    return layer[0]
