"""Which vectors take part in comparisons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not all zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def common_width(rows: DataFrame, vector: str) -> int:
    """The most common number of components (the smaller one of equals); 0 for no rows."""
    sizes = rows.groupBy(F.size(vector).alias("width")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), "width").first()
    return first[0] if first else 0


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column whose rows all have ``width`` numbers, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
