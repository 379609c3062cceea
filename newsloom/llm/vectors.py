"""Vectors as rows: which ones take part, and how they reach numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (array<double>) of the vectors that take part: not null, not
    zero, all components finite, an id, and the number of components that most vectors have
    (the smallest such number on a tie)."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    kept = (
        rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .where(finite & F.exists("embedding", lambda x: x != 0))
    )
    sizes = kept.groupBy(F.size("embedding").alias("n")).count()
    usual = sizes.orderBy(F.desc("count"), "n").first()
    return kept.where(F.size("embedding") == (usual["n"] if usual else 0))


def matrix(column: pa.ChunkedArray | pa.Array, dimensions: int) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(-1, dimensions)
