"""Rows of vectors as the vector operators read them."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Whether a vector is neither null, empty nor zero and all its components are finite."""
    v = F.col(column)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def rows(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and v of every row, v of floats or doubles as it came."""
    kind = dict(df.dtypes)[vector]
    v = F.col(vector) if kind == "array<float>" else F.col(vector).cast("array<double>")
    return df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one length as a float64 matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(array):
        return np.zeros((0, 0))
    return array.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(array), -1)
