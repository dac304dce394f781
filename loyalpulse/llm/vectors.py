"""Vectors of a table as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for vectors that are neither null, empty nor zero and all finite."""
    return F.expr(
        f"""size({vector}) > 0
            AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))
            AND exists({vector}, x -> x <> 0)"""
    )


def matrix(column: pa.Array) -> np.ndarray:
    """One row per vector; all must have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest part is scaled to 1 first, so squares stay finite."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)
