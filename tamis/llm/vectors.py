"""Whole-number vectors for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def all_finite(vector: str) -> Column:
    """Whether a vector is there and all of its components are numbers; false for null."""
    double = F.transform(vector, lambda x: x.cast("double"))
    number = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(number, F.lit(False))


def whole_numbers(vector: str, factor: int, limit: int) -> Column:
    """``floor(factor * x)`` of every component as an int array. A result of ``limit`` or more in
    size is an error: sums and products of such numbers would not fit 64 bits."""
    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * F.lit(float(factor)))
        small = (x.cast("double") * F.lit(float(factor))).between(F.lit(-float(limit)), F.lit(float(limit)))
        error = F.raise_error(F.lit(f"component beyond {limit} / {factor}")).cast("int")
        return F.when(small, scaled.cast("int")).otherwise(error)

    return F.transform(vector, whole)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column, each of ``width`` numbers, as a matrix of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
