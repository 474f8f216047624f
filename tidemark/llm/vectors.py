"""Integer vectors in blocks: what the operators that compress and cluster embeddings share.

A block is one row with many vectors: their ids and labels as arrays, their integers as bytes, little-endian, in `width` bytes each. Numbers
stay exact: blocks whose sums of squares could leave 64 bits are computed with Python's integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest magnitude whose squared differences, summed over a vector, surely fit into 64 bits.
SAFE = 1 << 24
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def integer_vectors(vectors: DataFrame, scale: int, vector_col: str) -> Column:
    """floor(scale * x) of each component as longs, null if the vector, a component is null or a component isn't finite.

    Integers beyond 64 bits become the largest or smallest that fit.
    """
    v = F.col(vector_col).cast("array<double>")
    whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    fits = lambda c: F.when(F.abs(c) < 2.0**63, F.floor(c).cast("long")).otherwise(F.when(c > 0, F.lit(LONG_MAX)).otherwise(F.lit(LONG_MIN)))
    return F.when(whole, F.transform(v, lambda c: fits(c * scale)))


def saturated(x: Column) -> Column:
    """A decimal as a long; beyond 64 bits the largest or smallest."""
    return F.when(x > F.lit(LONG_MAX).cast("decimal(38,0)"), F.lit(LONG_MAX)).when(x < F.lit(LONG_MIN).cast("decimal(38,0)"), F.lit(LONG_MIN)).otherwise(x.cast("long"))


def matrix(column, width: int):
    """The lists of longs of an Arrow column as rows of an array, filled up with zeros."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def packed(x) -> tuple[bytes, int]:
    """The bytes of an array of longs, in the least of 2, 4 and 8 bytes a number that holds them all, and that width."""
    import numpy as np

    most = max(int(x.max()), -int(x.min()) - 1) if x.size else 0
    width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return np.ascontiguousarray(x, f"<i{width}").tobytes(), width


def unpacked(data: bytes, width: int, columns: int):
    import numpy as np

    return np.frombuffer(data, f"<i{width}").astype(np.int64).reshape(-1, columns)


def exact(*arrays):
    """The arrays as they are if squares of differences of their numbers are safe in 64 bits, else with Python's integers."""
    if all(not a.size or max(int(a.max()), -int(a.min())) < SAFE for a in arrays):
        return arrays
    return tuple(a.astype(object) for a in arrays)


def squares(x, c):
    """Squared Euclidean distances of the rows of x to c, exact."""
    d = x - c
    return (d * d).sum(1)


def floors(sums: list[int], count: int) -> list[int]:
    """Componentwise floor(sum / count) of Python integers."""
    return [s // count for s in sums]
