"""Exact duplicates: every text goes, whole, into the radix trie of its length and content hash.

Texts are equal when identical after each run of ASCII white space becomes one space. Each
task first merges its own copies in a trie, so that a text of which there are millions of
copies is shuffled once per task. The survivors meet by length and SHA-256 in a partition whose
trie compares the full byte strings; its terminal nodes hold the smallest identifier. Were there
two texts of one length and SHA-256, they would show as two owners of one digest.

Defined cases: a null text counts as empty. A null identifier is larger than any other; a
group of null identifiers only has a null ``keep_id``. Rows that repeat an identifier and its
text are one document. Very long texts are compared whole. An empty table gives no rows. Other columns are not
looked at, whatever their names; survivors keep theirs.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.llm.common import WHITE, batches, bound_batches, join_counted, text_bytes, whole_row, written
from lectern.llm.radix_trie import Owner, RadixTrie

TRIE_BYTES = 96 * 1024 * 1024


def normalise(text: bytes) -> bytes:
    """Every run of ASCII white space becomes one space."""
    words = text.split()
    if not words:
        return b" " if text else b""
    head = b" " if text[0] in WHITE else b""
    tail = b" " if text[-1] in WHITE else b""
    return head + b" ".join(words) + tail


KEY = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("digest", T.BinaryType())])


def _content_key(texts: pa.Array) -> pa.Array:
    """Length and SHA-256 of the normalised text."""
    contents = [normalise(text_bytes(text)) for text in texts.to_pylist()]
    return pa.StructArray.from_arrays(
        [
            pa.array([len(content) for content in contents], pa.int64()),
            pa.array([hashlib.sha256(content).digest() for content in contents], pa.binary()),
        ],
        names=["n_bytes", "digest"],
    )


# Not marked deterministic, or the optimizer would compute it once more for the join's null check.
content_key = F.arrow_udf(_content_key, KEY).asNondeterministic()


def text_owners(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_rows: bool = False,
    trie_bytes: int = TRIE_BYTES,
) -> DataFrame:
    """``(n_bytes, digest, keep_id, group_size)``, one row per distinct text.

    With ``keep_rows``, also ``row``: the owner's whole row as a struct.
    """
    # With rows, the text travels once, within its row, and is normalised again where it arrives.
    held = documents.select(
        F.col(id_column).cast("long").alias("id"),
        whole_row() if keep_rows else F.col(text_column).alias("text"),
    )
    partial = T.StructType(
        [
            T.StructField("n_bytes", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("id", T.LongType()),
            T.StructField("copies", T.LongType()),
            held.schema["row"] if keep_rows else T.StructField("content", T.BinaryType()),
        ]
    )
    final = T.StructType([field for field in partial if field.name != "content"])

    def content_of(row: dict) -> bytes:
        return normalise(text_bytes(row[text_column]))

    merged = held.mapInArrow(_merge_in_task(to_arrow_schema(partial), trie_bytes, content_of), partial)
    owners = merged.repartition("n_bytes", "digest").mapInArrow(
        _merge_partition(to_arrow_schema(final), trie_bytes, content_of), final
    )
    return owners.withColumnsRenamed({"id": "keep_id", "copies": "group_size"})


def _merge_in_task(schema: pa.Schema, budget: int, content_of: Callable[[dict], bytes]):
    """The task's distinct texts; a full trie is handed on and begun anew."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie(2**62)
        for entry in _entries(parts):
            row = entry.get("row")
            content = content_of(row) if row is not None else normalise(text_bytes(entry["text"]))
            trie.insert(content, Owner(entry["id"], 1, hashlib.sha256(content).digest(), _packed(row)))
            if trie.held > budget:
                yield from batches(_rows(trie, schema), schema, _weight)
                trie = RadixTrie(2**62)
        yield from batches(_rows(trie, schema), schema, _weight)

    return run


def _merge_partition(schema: pa.Schema, budget: int, content_of: Callable[[dict], bytes]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = RadixTrie(budget)
        for entry in _entries(parts):
            row = entry.get("row")
            content = content_of(row) if row is not None else entry["content"]
            trie.insert(content, Owner(entry["id"], entry["copies"], entry["digest"], _packed(row)))
        yield from batches(_rows(trie, schema), schema, _weight)

    return run


def _packed(row: dict | None) -> bytes | None:
    """A row as bytes: of known size, and with its text in UTF-8, shorter than as objects."""
    return None if row is None else pickle.dumps(row, pickle.HIGHEST_PROTOCOL)


def _entries(parts: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[dict]:
    """Rows as dictionaries, a few at a time, so that a batch is not held twice."""
    for part in parts:
        for start in range(0, part.num_rows, step):
            yield from part.slice(start, step).to_pylist()


def _rows(trie: RadixTrie, schema: pa.Schema) -> Iterator[tuple]:
    for content, owner in trie.owners():
        row = [len(content), owner.digest, owner.identifier, owner.copies]
        if "content" in schema.names:
            row.append(content)
        if "row" in schema.names:
            row.append(pickle.loads(owner.row))
        yield tuple(row)


def _weight(row: tuple) -> int:
    return 64 + 2 * row[0]


def exact_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per document.

    Documents meet their owners by length and digest, in narrow rows. The owners' group sizes tell
    which digests many documents share; those are salted by the documents' identifiers.
    """
    documents = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    owners = text_owners(documents, "doc_id", "text").select(
        F.struct("n_bytes", "digest").alias("key"), "keep_id", "group_size"
    )
    keyed = documents.select("doc_id", content_key("text").alias("key"))
    return join_counted(keyed, written(owners, "owners"), "key", "group_size", "doc_id").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("key.digest")).alias("text_sha256"),
    )


def without_exact_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents' own rows and columns, of equal texts the one with the smallest identifier."""
    bound_batches(documents.sparkSession)
    return text_owners(documents, id_column, text_column, keep_rows=True).select("row.*")
