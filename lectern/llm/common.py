"""What the operators of this folder share."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.skew import ROWS_PER_SALT, join_per_key
from lectern.sources.scratch import scratch_path
from lectern.sources.tables import scan_table

BATCH_BYTES = 8 * 1024 * 1024

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_EACH = 1_000

# The columns that Unicode calls ASCII white space, in words as well as in line breaks.
WHITE = b"\t\n\x0b\x0c\r "


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/documents.parquet")


def embeddings_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/embeddings.parquet")


def bound_batches(spark: SparkSession) -> None:
    """From now on the session sends at most TEXTS_EACH rows a batch to Python, as rows hold whole texts.

    A batch lies in the JVM's and the worker's memory several times over; Spark's 10,000 rows of text
    come to some 30 MB each time. Fewer rows, if the session asks for them, stay.
    """
    if int(spark.conf.get(BATCH_ROWS)) > TEXTS_EACH:
        spark.conf.set(BATCH_ROWS, str(TEXTS_EACH))


def written(frame: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    Unlike a checkpoint, a written table tells Spark its size, so that a small one is
    broadcast by Spark's own check. What a lost executor held is read again from the table.
    """
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def join_counted(
    rows: DataFrame, per_key: DataFrame, key: str, weight: str, spread: str, rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Inner join to a written table with one row per key and, in ``weight``, the number of its rows.

    One aggregate of that table tells whether any key is heavy. If so, the heavy ones are salted by a
    hash of ``spread``; if not, the plain join has nothing to split. The rows are the same.
    """
    heaviest = per_key.agg(F.max(weight)).first()[0] or 0
    if heaviest <= rows_per_salt:
        return rows.join(per_key, key)
    return join_per_key(rows, per_key, key, weight, spread, rows_per_salt)


def whole_row() -> Column:
    """All columns as one struct, so that working columns cannot clash with them."""
    return F.struct("*").alias("row")


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode()


def hex_digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def batches(rows: Iterable[tuple], schema: pa.Schema, size_of=None) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most 10,000 rows or about BATCH_BYTES."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += size_of(row) if size_of else 64
        if weight >= BATCH_BYTES or len(held) >= 10_000:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
