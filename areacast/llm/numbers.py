"""Number columns inside Arrow tasks, and exact sums over them."""

from __future__ import annotations

import sys
from collections.abc import Iterable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXACT = "decimal(38,0)"
LONG_MAX = (1 << 63) - 1


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column of equally long lists without nulls as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def whole(vector: Column, scale: int, limit: int) -> Column:
    """Each entry as the whole number floor(scale * c); null unless all entries are given, finite and within the limit."""
    entries = vector.cast("array<double>")

    def fits(c: Column) -> Column:
        # False for NaN, which is larger than any number here, and for null.
        return F.coalesce(F.abs(c * scale) <= float(limit), F.lit(False))

    longs = F.transform(entries, lambda c: F.floor(c * scale).cast("bigint"))
    return F.when(F.forall(entries, fits), longs)


def decimals(values: Iterable[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def long_or_none(value: int) -> int | None:
    """The number where a long can hold it."""
    return value if -LONG_MAX - 1 <= value <= LONG_MAX else None


def column_sums(rows: np.ndarray) -> list[int]:
    """Exact sums of the columns of a matrix of longs, whatever their size."""
    high = (rows >> 32).sum(axis=0)
    low = (rows & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(l) for h, l in zip(high, low)]


def summed(partials: DataFrame, keys: list[str], value: str = "total") -> dict:
    """The sums of the tasks' partial sums by key, on the driver: one number per key.

    The keys are places of a model (centroids x dimensions, dimensions x dimensions), not of the data.
    """
    rows = partials.groupBy(*keys).agg(F.sum(value).alias("_sum")).collect()
    return {tuple(r[k] for k in keys): r["_sum"] for r in rows}
