"""Vectors of a table of embeddings as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(rows: DataFrame, *columns: str) -> DataFrame:
    """vec_id, ``columns`` (cast to long) and the embedding in doubles of the
    rows whose vector is there and has only finite entries."""
    kept = rows.where(F.forall("embedding", lambda x: F.abs(x) < float("inf")))  # null and NaN fail, too
    named = [F.col(c).cast("long").alias(c) for c in ("vec_id", *columns)]
    return kept.select(*named, F.col("embedding").cast("array<double>").alias("embedding"))


def width_of(rows: DataFrame) -> int:
    """Entries of the longest vector; 0 without vectors."""
    return rows.agg(F.max(F.size("embedding"))).first()[0] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """One row per vector; entries that a shorter vector lacks are 0."""
    starts = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(starts)
    at = starts[:-1, None] + np.arange(width)
    if len(sizes) and sizes.min() == width:
        return values[at]
    out = np.zeros((len(sizes), width))
    has = np.arange(width) < sizes[:, None]
    out[has] = values[at[has]]
    return out
