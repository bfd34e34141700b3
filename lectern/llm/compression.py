"""Vector code compression by codebooks per part, in integers throughout.

Vectors become integers and are cut into equal consecutive parts. Each part position has a
codebook; a part's code is the index of the nearest entry by squared Euclidean distance. The search
takes the integer Walsh-Hadamard transform of parts and entries, padded with zeros to a power of
two P. Squared differences of transforms sum to P times the squared distance, exactly. They are added
up in sequency order; an entry is out as soon as its sum exceeds the whole distance of the entry
that led after the first coefficient. Sums only grow, so no nearest entry is ever out.

A round assigns all parts in parallel and keeps sums and counts per entry in each task, so that a
task sends one row per entry and place, whatever its rows. The driver holds the codebooks only: their
size follows from parts, entries and dimension.

Defined cases: rows without a kept vector (see ``vectors``) give no row. Vectors shorter than the longest, or
than a multiple of the number of parts, count as ending in zeros. A null identifier is larger than
any other. Rows that repeat an identifier are rows of their own, ordered by their vectors among the first
ones. With fewer rows than entries, codebooks are shorter. Equal distances go to the lower
index. Null labels are one label. Distances too large for 64 bits are added up as numbers without bound;
an error that no long holds ends the job. An empty table gives no rows. Other columns are not looked at,
whatever their names; vectors of any length are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.llm.common import written
from lectern.llm.vectors import kept_vectors, largest, longest, matrices, padded
from lectern.operators.skew import join_per_key

PARTS = 16
ENTRIES = 64
ROUNDS = 2

# Labels up to this number are broadcast with their sums; more are joined, hot ones salted.
BROADCAST_LABELS = 100_000


class Compressed(NamedTuple):
    """``codes``: id, label, code (array of indexes), error. ``codebooks``: by part, entry and place."""

    codes: DataFrame
    codebooks: np.ndarray


@cache
def sequency_order(size: int) -> np.ndarray:
    """The rows of the Hadamard matrix of ``size``, by their number of sign changes."""
    rows = np.arange(size)
    signs = np.array([[bin(r & c).count("1") & 1 for c in rows] for r in rows]).reshape(size, size)
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def walsh_hadamard(values: np.ndarray) -> np.ndarray:
    """Transform the rows, padded with zeros to a power of two, into sequency order."""
    count, width = values.shape
    size = 1 << max(width - 1, 0).bit_length()
    out = np.zeros((count, size), values.dtype)
    out[:, :width] = values
    step = 1
    while step < size:
        pairs = out.reshape(count, -1, 2, step)
        left, right = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = left + right, left - right
        step *= 2
    return out[:, sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and squared distance to it, for each row of ``parts``."""
    width = parts.shape[1]
    size = 1 << max(width - 1, 0).bit_length()
    reach = largest(parts) + largest(entries)
    if size * width * reach * reach >= 1 << 62:
        parts, entries = parts.astype(object), entries.astype(object)
    left, right = walsh_hadamard(parts), walsh_hadamard(entries)
    sums = (left[:, :1] - right[None, :, 0]) ** 2
    leader = np.argmin(sums, axis=1)
    whole = ((left - right[leader]) ** 2).sum(1)
    # What is still in: rows ascending, and entries ascending within a row.
    row, entry = np.nonzero(sums <= whole[:, None])
    total = sums[row, entry]
    for place in range(1, size):
        total = total + (left[row, place] - right[entry, place]) ** 2
        within = total <= whole[row]
        row, entry, total = row[within], entry[within], total[within]
    first = np.searchsorted(row, np.arange(len(parts)))
    least = np.minimum.reduceat(total, first) if len(parts) else total
    # The leader is never out, so every row has an entry; of equal ones the lowest comes first.
    best = np.flatnonzero(total == least[row])
    best = best[np.searchsorted(row[best], np.arange(len(parts)))]
    return entry[best], least // size


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    return vectors.reshape(len(vectors), parts, -1)


def _sums(codebooks: np.ndarray):
    """Per task: rows (part, entry, place, total, members) of the entries that parts went to."""
    parts, entries, width = codebooks.shape
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.int64()), ("members", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width), object)
        members = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for vectors in matrices(batch.column("x"), parts * width):
                cut = _cut(vectors, parts)
                kind = object if largest(vectors) * len(vectors) >= 1 << 62 else np.int64
                for part in range(parts):
                    index, _ = nearest(cut[:, part], codebooks[part])
                    members[part] += np.bincount(index, minlength=entries)
                    added = np.zeros((entries, width), kind)
                    np.add.at(added, index, cut[:, part])
                    totals[part] += added
        part, entry = np.nonzero(members)
        used = totals[part, entry]
        columns = [
            np.repeat(part, width),
            np.repeat(entry, width),
            np.tile(np.arange(width), len(part)),
            used.ravel().tolist(),
            np.repeat(members[part, entry], width),
        ]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run, "part int, entry int, place int, total long, members long"


def _next_codebooks(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """Each entry becomes the mean of its parts, rounded down; an unused one stays."""
    run, kind = _sums(codebooks)
    sums = vectors.select("x").mapInArrow(run, kind).groupBy("part", "entry", "place")
    # Fewer rows than the codebooks have components.
    found = sums.agg(F.sum("total").alias("total"), F.sum("members").alias("members")).toArrow()
    part, entry, place, total, members = (found.column(i).to_numpy() for i in range(5))
    out = codebooks.copy()
    out[part, entry, place] = total // members
    return out


def _encoder(codebooks: np.ndarray):
    parts, _, width = codebooks.shape
    kind = T.StructType([T.StructField("code", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])

    @F.arrow_udf(kind)
    def run(vectors: pa.Array) -> pa.Array:
        codes, errors = [np.zeros(0, np.int32)], []
        for rows in matrices(vectors, parts * width):
            cut = _cut(rows, parts)
            found = [nearest(cut[:, part], codebooks[part]) for part in range(parts)]
            codes.append(np.stack([index for index, _ in found], 1).astype(np.int32).ravel())
            errors.extend(np.sum([distance.astype(object) for _, distance in found], axis=0).tolist())
        flat = pa.array(np.concatenate(codes))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * parts, pa.int32()), flat)
        return pa.StructArray.from_arrays([lists, pa.array(errors, pa.int64())], names=["code", "error"])

    return run


def compress(
    embeddings: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Compressed:
    """Codes of all kept vectors, and the codebooks after ``rounds`` rounds."""
    kept = kept_vectors(embeddings, vector_column, F.col(id_column).alias("id"), F.col(label_column).alias("label"))
    width = -(-(longest(kept) or 0) // parts)
    vectors = padded(kept, parts * width)
    # At most ``entries`` rows.
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([row.x for row in first], np.int64).reshape(len(first), parts, width)
    codebooks = start.transpose(1, 0, 2).copy()
    for _ in range(rounds if first else 0):
        codebooks = _next_codebooks(vectors, codebooks)
    coded = vectors.select("id", "label", _encoder(codebooks)("x").alias("coded"))
    return Compressed(coded.select("id", "label", "coded.*"), codebooks)


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components in order, in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame, broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Add ``label_error``, the sum of ``error`` over the rows of the same label."""
    codes = written(codes.withColumn("_label", F.struct("label")), "codes")
    sums = written(codes.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows")), "label-errors")
    if sums.limit(broadcast_labels + 1).count() <= broadcast_labels:
        return codes.join(F.broadcast(sums.drop("_rows")), "_label").drop("_label")
    return join_per_key(codes, sums, "_label", "_rows", "id").drop("_label", "_rows")
