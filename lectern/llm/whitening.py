"""Embedding whitening: unit variance along the leading principal components.

Vectors become integers x (see ``vectors``). The components are fitted on the distinct vectors, each once: a
shuffle of vectors that merges copies in each task first. Sums per dimension and products of
vectors, centred at the whole part of the mean, are exact integers, added up per task and then over all; so
the covariance does not depend on how rows are split. It has the size of the dimension squared and goes to
the driver, where FEAST contour integration (``feast``) extracts the components. The rows are then projected
where they lie.

Defined cases: rows without a kept vector give no row. Shorter vectors count as ending in zeros. Repeated rows are
rows of their own, but one vector of the fit. Components are numbered up to the smaller of
``components`` and the dimension; along one without variance, ``whitened`` is null and ``explained`` is 0, and
where no component has any, ``explained`` and ``identity_error`` are null too. An empty table, or one of empty vectors
only, gives no rows. Null identifiers stay null. Other columns are not looked at, whatever their names; vectors of any
length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import written
from lectern.llm.feast import leading_eigenpairs
from lectern.llm.vectors import kept_vectors, largest, longest, matrices, padded

COMPONENTS = 4
# Integers up to here are exact as doubles.
EXACT = 1 << 53


class Whitening(NamedTuple):
    """What the fit learns: n distinct vectors, their sums, and eigenpairs of their covariance."""

    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    vectors: np.ndarray


def _column_sums(fit: DataFrame, dimension: int) -> tuple[int, list[int]]:
    places = fit.select(F.posexplode("x").alias("place", "value")).groupBy("place")
    found = {row.place: row for row in places.agg(F.sum("value").alias("total"), F.count("*").alias("n")).collect()}
    return (found[0].n if found else 0), [found[place].total for place in range(dimension)] if found else []


def _products(centre: np.ndarray, dimension: int):
    """Per task: sums of the products of each two centred components, for the upper triangle."""
    upper = np.triu_indices(dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dimension, dimension), object)
        for batch in batches:
            for rows in matrices(batch.column("x"), dimension):
                rows = rows - centre
                most = largest(rows)
                # A matrix product of doubles is exact while its sums are exact integers.
                if most * most * len(rows) < EXACT:
                    real = rows.astype(float)
                    total += (real.T @ real).astype(np.int64)
                else:
                    exact = rows.astype(object)
                    total += exact.T @ exact
        columns = [upper[0].astype(np.int32), upper[1].astype(np.int32), total[upper].tolist()]
        kinds = [pa.int32(), pa.int32(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["i", "j", "product"])

    return run


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance with divisor n, each entry the double next to the exact fraction."""
    dimension = len(sums)
    centre = np.array([total // n for total in sums], np.int64)
    left_over = np.array([total - n * int(c) for total, c in zip(sums, centre, strict=True)], object)
    products = fit.mapInArrow(_products(centre, dimension), "i int, j int, product long").groupBy("i", "j")
    # As many rows as the upper triangle has entries.
    found = products.agg(F.sum("product").alias("product")).toArrow()
    i, j, product = (found.column(k).to_numpy() for k in range(3))
    matrix = np.zeros((dimension, dimension), object)
    matrix[i, j] = matrix[j, i] = product.astype(object)
    exact = n * matrix - np.outer(left_over, left_over)
    return np.array([[value / (n * n) for value in row] for row in exact.tolist()], float)


def fit_whitening(vectors: DataFrame, dimension: int, components: int = COMPONENTS) -> tuple[Whitening, DataFrame]:
    """Learn from the distinct ``x``; also returns them."""
    fit = written(vectors.select("x").distinct(), "whitening-fit")
    n, sums = _column_sums(fit, dimension)
    matrix = covariance(fit, n, sums)
    return Whitening(n, sums, float(np.trace(matrix)), *leading_eigenpairs(matrix, components)), fit


def _projection(model: Whitening, components: int):
    """deviation: the sum of ``(n x - S) ** 2``, exact. whitened: one value per component, null without variance."""
    dimension = len(model.sums)
    sums = np.array(model.sums, object)
    centre = np.array([total // model.n for total in model.sums], np.int64)
    rest = np.array([(total - model.n * int(c)) / model.n for total, c in zip(model.sums, centre, strict=True)])
    scaled = model.vectors / np.sqrt(model.eigenvalues)
    absent = [None] * (components - len(model.eigenvalues))
    kind = T.StructType(
        [T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    )

    @F.arrow_udf(kind)
    def run(vectors: pa.Array) -> pa.Array:
        deviations, whitened = [], []
        for rows in matrices(vectors, dimension):
            whitened.extend([*values, *absent] for values in ((rows - centre - rest) @ scaled).tolist())
            most = largest(rows) * max(max(abs(s) for s in model.sums), largest(rows)) * dimension
            exact = most >= 1 << 62
            numbers = rows.astype(object) if exact else rows
            squares = (numbers * numbers).sum(1).tolist()
            mixed = (numbers @ (sums if exact else sums.astype(np.int64))).tolist()
            own = int((sums * sums).sum())
            n = model.n
            deviations.extend(Decimal(n * n * a - 2 * n * b + own) for a, b in zip(squares, mixed, strict=True))
        return pa.StructArray.from_arrays(
            [pa.array(deviations, pa.decimal128(38, 0)), pa.array(whitened, pa.list_(pa.float64()))],
            names=["deviation", "whitened"],
        )

    return run


def _identity_error(fit: DataFrame, project, kept: int) -> float | None:
    """The covariance of the whitened distinct vectors, less the identity: its largest entry."""
    if not kept:
        return None
    values = fit.select(project("x").alias("row")).select(*[F.col("row.whitened")[k].alias(f"w{k}") for k in range(kept)])
    entries = [
        F.abs(F.covar_pop(f"w{i}", f"w{j}") - F.lit(1.0 if i == j else 0.0)) for i in range(kept) for j in range(i, kept)
    ]
    return values.agg(F.array_max(F.array(*entries))).first()[0]


RESULT = "id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(
    embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``, a row per kept vector and component."""
    kept = kept_vectors(embeddings, vector_column, F.col(id_column).alias("id"))
    dimension = longest(kept) or 0
    if not dimension:
        schema = RESULT.format(kind=kept.schema["id"].dataType.simpleString())
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors = padded(kept, dimension)
    components = min(components, dimension)
    model, fit = fit_whitening(vectors, dimension, components)
    project = _projection(model, components)
    error = _identity_error(fit, project, len(model.eigenvalues))
    shares = [float(e) / model.trace for e in model.eigenvalues] if model.trace else [None] * components
    shares += [0.0] * (components - len(shares))
    row = vectors.select("id", project("x").alias("row")).select(
        "id", "row.deviation", F.posexplode("row.whitened").alias("place", "whitened")
    )
    return row.select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(share).cast("double") for share in shares])[F.col("place")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
