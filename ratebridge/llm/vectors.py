"""Embedding columns: which vectors count, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integer_components(vector: Column, scale: float, shift: int, most: float) -> Column:
    """floor(scale * x) + shift of each component, as longs; scaled components are held within ``most`` of zero."""
    held = lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), x.cast("double") * F.lit(float(scale))))
    return F.transform(vector, lambda x: F.floor(held(x)) + F.lit(shift).cast("long"))


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
