"""Vectors as integers: what the vector operators share.

A vector is kept where it is not null and all its components are finite numbers. A component c
becomes the integer ``floor(256 * c)``. Vectors shorter than the longest kept one count as
ending in zeros. An integer that no long holds ends the job with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
ROWS_EACH = 4096


def _quantised(component: Column) -> Column:
    scaled = component.cast("double") * SCALE
    # 2 ** 63 is a double, the largest long is not.
    fits = (scaled >= F.lit(-(2.0**63))) & (scaled < F.lit(2.0**63))
    return F.when(fits, F.floor(scaled)).otherwise(F.raise_error(F.lit("a component is too large for a long")).cast("long"))


def kept_vectors(embeddings: DataFrame, vector_column: str, *columns: Column) -> DataFrame:
    """``columns`` and ``x``, the integers of each kept vector, as it lies."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(math.inf)))
    return embeddings.where(vector.isNotNull() & finite).select(*columns, F.transform(vector, _quantised).alias("x"))


def longest(vectors: DataFrame) -> int | None:
    """The greatest number of components; none where there is no vector."""
    return vectors.agg(F.max(F.size("x"))).first()[0]


def padded(vectors: DataFrame, dimension: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dimension) - F.size("x"))
    return vectors.withColumn("x", F.concat("x", zeros))


def matrices(vectors: pa.Array, dimension: int) -> Iterator[np.ndarray]:
    """The rows of a list array as matrices of long, a few thousand rows at a time."""
    for start in range(0, len(vectors), ROWS_EACH):
        part = vectors.slice(start, ROWS_EACH)
        yield part.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(part), dimension)


def largest(values: np.ndarray) -> int:
    """The greatest absolute value, as a number without bound."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0
