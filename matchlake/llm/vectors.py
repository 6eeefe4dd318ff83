"""Vectors of a table as arrays of integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Whether an array is there and none of its entries is null, NaN or infinite."""
    bad = F.exists(F.col(column), lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.col(column).isNotNull() & ~bad


def scaled(column: str, scale: int, shift: int = 0) -> Column:
    """floor(scale * entry) + shift of each entry, as long."""
    return F.transform(column, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(shift).cast("long"))


def matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column of equally long arrays without nulls as rows of a matrix."""
    values = batch.column(column).flatten().to_numpy()
    return values.reshape(batch.num_rows, -1)
