"""Line dedup that can be undone: sharded cuckoo filters before exact reference counts.

A line's key is the line without white space at its ends, A-Z in lower case; only keys of ten code
points or more count. An index holds three tables: references, a row per document and key, in the
order of the documents; exact counts, a row per key with the number of its references and the smallest
and greatest document; and per shard of the key space a cuckoo filter of the keys in the counts. Documents can be
inserted and deleted at any time, at the cost of the narrow tables; texts of other documents are not read.

Insertion sums the new references per key in each task, so that a line of a third of all documents is a few
rows, and sends them to their key's shard. There the filter tells new keys, which are added at once, from those to look up in
the exact counts; what the filter finds by chance is not there and is added, too. Deletion counts the
references of the keys concerned anew; a key without any leaves the counts and its filter. A key is a BLAKE2b hash of 128
bits. Filters grow when they fill up, from the exact counts; shards are dealt anew when they hold many keys.

Of a key in two documents or more, the smallest document keeps its lines, and the others lose theirs.
References meet the counts in a join that salts the keys with many.

Defined cases: a null or empty text is one empty line. Rows that share an identifier are one document. A null
identifier is larger than any other. A document that is inserted again counts again, until its identifier is deleted,
which takes all its rows. A text of which no line stays becomes empty. An empty table gives no rows. Very long texts
are split whole, one at a time. Columns beside identifier and text, whatever their names, stay in ``row``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import WHITE, batches, text_bytes, whole_row, written
from lectern.llm.cuckoo import CuckooFilter
from lectern.operators.skew import join_per_key

MIN_POINTS = 10

# Keys a shard is made for. Shards are dealt anew beyond four times that.
SHARD_KEYS = 1 << 18
SHARDS_PER_TASK = 4
# References summed together before they leave a task.
SUMMED = 1 << 19

FILTER, COUNTED, SEEN, RECOUNTED = range(4)
NO_LOW, NO_HIGH = np.iinfo(np.int64).max, np.iinfo(np.int64).min

STATE = "shard int, kind int, filter binary, key binary, refs long, low long, high long, nulls long"
STATE_ARROW = pa.schema(
    [("shard", pa.int32()), ("kind", pa.int32()), ("filter", pa.binary()), ("key", pa.binary())]
    + [(name, pa.int64()) for name in ("refs", "low", "high", "nulls")]
)


class LineIndex(NamedTuple):
    """``references``: id, tie, key. ``state``: a row per shard with its filter, and a row per key with its counts."""

    references: DataFrame
    state: DataFrame
    shards: int

    def counts(self) -> DataFrame:
        """``(key, refs, low, high, nulls)``: references, smallest and greatest identifier, references without one."""
        return self.state.where(F.col("kind") == COUNTED).select("key", "refs", "low", "high", "nulls")

    def filters(self) -> DataFrame:
        return self.state.where(F.col("kind") == FILTER).select("shard", "filter")


def line_keys(text: str | None) -> list[bytes | None]:
    """Per line the hash of its key; none for short keys."""
    keys: list[bytes | None] = []
    for line in text_bytes(text).split(b"\n"):
        key = line.strip(WHITE).lower()
        # Each code point has one byte that does not go on with another.
        points = len(key) if key.isascii() else sum(byte & 0xC0 != 0x80 for byte in key)
        keys.append(hashlib.blake2b(key, digest_size=16).digest() if points >= MIN_POINTS else None)
    return keys


def _tied(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows of one identifier and text are alike; ``tie`` tells others of the same identifier apart."""
    text = F.col(text_column)
    return documents.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"), whole_row())


REFERENCES = "id long, tie long, key binary"
REFERENCES_ARROW = pa.schema([("id", pa.int64()), ("tie", pa.int64()), ("key", pa.binary())])


def _references(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for part in parts:
            columns = [part.column(name) for name in ("id", "tie", "text")]
            for number, tie, text in zip(*columns, strict=True):
                for key in dict.fromkeys(line_keys(text.as_py())):
                    if key is not None:
                        yield number.as_py(), tie.as_py(), key

    return batches(rows(), REFERENCES_ARROW)


def _key_array(column: pa.Array) -> np.ndarray:
    """16-byte strings; all are of full length, so that zeros at the end cannot make two equal."""
    fixed = column.cast(pa.binary(16))
    return np.frombuffer(fixed.buffers()[1], "S16", len(fixed), fixed.offset * 16) if len(fixed) else np.zeros(0, "S16")


def _bytes_of(keys: np.ndarray) -> pa.Array:
    data = pa.py_buffer(np.ascontiguousarray(keys).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keys), [None, data]).cast(pa.binary())


def _halves(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view("<u8").reshape(-1, 2)


def _shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (_halves(keys)[:, 1] % np.uint64(shards)).astype(np.int32)


def _hashes(keys: np.ndarray) -> np.ndarray:
    return _halves(keys)[:, 0].copy()


def _summed(keys: np.ndarray, numbers: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """One row per key: refs and nulls added, the least low, the greatest high."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    refs, low, high, nulls = (column[order] for column in numbers)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    if not len(first):
        return keys, numbers
    return keys[first], [
        np.add.reduceat(refs, first),
        np.minimum.reduceat(low, first),
        np.maximum.reduceat(high, first),
        np.add.reduceat(nulls, first),
    ]


def _state_batch(shards: np.ndarray, kind: int, keys: np.ndarray, numbers: list[np.ndarray]) -> pa.RecordBatch:
    columns = [
        pa.array(shards, pa.int32()),
        pa.array(np.full(len(keys), kind), pa.int32()),
        pa.nulls(len(keys), pa.binary()),
        _bytes_of(keys),
        *[pa.array(column, pa.int64()) for column in numbers],
    ]
    return pa.record_batch(columns, schema=STATE_ARROW)


def _sightings(shards: int, summed: int):
    """References summed per key, a task's worth at a time, with their shard."""

    def out(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, ids, absent = (np.concatenate(column) for column in zip(*held, strict=True))
        low, high = np.where(absent, NO_LOW, ids), np.where(absent, NO_HIGH, ids)
        keys, numbers = _summed(keys, [np.ones(len(keys), np.int64), low, high, absent.astype(np.int64)])
        for start in range(0, len(keys), 10_000):
            part = slice(start, start + 10_000)
            yield _state_batch(_shards_of(keys[part], shards), SEEN, keys[part], [n[part] for n in numbers])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in parts:
            if not part.num_rows:
                continue
            ids = part.column("id")
            held.append((_key_array(part.column("key")), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
            size += part.num_rows
            if size >= summed:
                yield from out(held)
                held, size = [], 0
        if held:
            yield from out(held)

    return run


class _Counts:
    """Exact counts by key: rows in order of arrival, found through a few sorted runs."""

    def __init__(self):
        self.keys = np.zeros(0, "S16")
        self.numbers = [np.zeros(0, np.int64) for _ in range(4)]
        self._size = 0
        self._runs: list[tuple[np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return self._size

    def all_keys(self) -> np.ndarray:
        return self.keys[: self._size]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, or -1."""
        rows = np.full(len(keys), -1)
        for known, places in self._runs:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            rows[hit] = places[at[hit]]
        return rows

    def add(self, keys: np.ndarray, numbers: list[np.ndarray]) -> None:
        """Keys in order, none of them known."""
        if not len(keys):
            return
        end = self._size + len(keys)
        if end > len(self.keys):
            self.keys = np.resize(self.keys, 2 * end) if self._size else np.zeros(2 * end, "S16")
            self.numbers = [np.concatenate([n[: self._size], np.zeros(2 * end - self._size, np.int64)]) for n in self.numbers]
        self.keys[self._size : end] = keys
        for column, new in zip(self.numbers, numbers, strict=True):
            column[self._size : end] = new
        self._runs.append((keys, np.arange(self._size, end)))
        self._size = end
        # Each run is at least twice as long as the next, so there are few.
        while len(self._runs) > 1 and len(self._runs[-2][0]) < 2 * len(self._runs[-1][0]):
            (left, left_rows), (right, right_rows) = self._runs[-2:]
            merged, rows = np.concatenate([left, right]), np.concatenate([left_rows, right_rows])
            order = np.argsort(merged, kind="stable")
            self._runs[-2:] = [(merged[order], rows[order])]


class _Shard:
    """One shard while its rows pass: filter, then counts, then what was seen or recounted."""

    def __init__(self, number: int):
        self.number = number
        self.filter: CuckooFilter | None = None
        self.counts = _Counts()
        self.looked_up = 0

    def load(self, keys: np.ndarray, numbers: list[np.ndarray]) -> None:
        self.counts.add(*_summed(keys, numbers))

    def _ready(self) -> CuckooFilter:
        if self.filter is None:
            self._rebuild()
        return self.filter

    def _rebuild(self) -> None:
        size = max(len(self.counts), 256)
        while True:
            self.filter = CuckooFilter(2 * size)
            live = self.counts.numbers[0][: len(self.counts)] > 0
            if self.filter.insert(_hashes(self.counts.all_keys()[live])):
                return
            size *= 2

    def see(self, keys: np.ndarray, numbers: list[np.ndarray]) -> None:
        keys, numbers = _summed(keys, numbers)
        maybe = self._ready().contains(_hashes(keys))
        rows = np.full(len(keys), -1)
        rows[maybe] = self.counts.find(keys[maybe])
        self.looked_up += int(maybe.sum())
        known, at = rows >= 0, rows[rows >= 0]
        refs, low, high, nulls = self.counts.numbers
        refs[at] += numbers[0][known]
        low[at] = np.minimum(low[at], numbers[1][known])
        high[at] = np.maximum(high[at], numbers[2][known])
        nulls[at] += numbers[3][known]
        new = ~known
        self.counts.add(keys[new], [column[new] for column in numbers])
        if not self.filter.insert(_hashes(keys[new])):
            self._rebuild()

    def recount(self, keys: np.ndarray, numbers: list[np.ndarray]) -> None:
        """Set the counts of known keys; without references, they go."""
        rows = self.counts.find(keys)
        known = rows >= 0
        for column, new in zip(self.counts.numbers, numbers, strict=True):
            column[rows[known]] = new[known]
        self._ready().delete(_hashes(keys[known & (numbers[0] == 0)]))

    def rows(self) -> Iterator[pa.RecordBatch]:
        table = bytes(self._ready())
        first = [[self.number], [FILTER], [table], [None], [None], [None], [None], [None]]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(first, STATE_ARROW, strict=True)], schema=STATE_ARROW)
        live = np.flatnonzero(self.counts.numbers[0][: len(self.counts)] > 0)
        for start in range(0, len(live), 10_000):
            part = live[start : start + 10_000]
            numbers = [column[part] for column in self.counts.numbers]
            yield _state_batch(np.full(len(part), self.number), COUNTED, self.counts.keys[part], numbers)


def _merge_shards(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard and kind; the new state of each shard follows its last row."""
    shard: _Shard | None = None
    for part in parts:
        if not part.num_rows:
            continue
        numbers = part.column("shard").to_numpy()
        kinds = part.column("kind").to_numpy()
        edges = np.flatnonzero(np.r_[True, (numbers[1:] != numbers[:-1]) | (kinds[1:] != kinds[:-1]), True])
        for start, end in zip(edges, edges[1:], strict=False):
            if shard is None or shard.number != numbers[start]:
                if shard is not None:
                    yield from shard.rows()
                shard = _Shard(int(numbers[start]))
            piece = part.slice(start, end - start)
            if kinds[start] == FILTER:
                shard.filter = CuckooFilter(0, piece.column("filter")[0].as_py())
                continue
            step = {COUNTED: shard.load, SEEN: shard.see, RECOUNTED: shard.recount}[int(kinds[start])]
            step(_key_array(piece.column("key")), [piece.column(n).to_numpy() for n in ("refs", "low", "high", "nulls")])
    if shard is not None:
        yield from shard.rows()


def _merged(rows: DataFrame, shards: int) -> DataFrame:
    return written(
        rows.repartition(max(1, shards // SHARDS_PER_TASK), "shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(_merge_shards, STATE),
        "line-state",
    )


def _shards_for(references: DataFrame, keys_each: int) -> int:
    partitions = int(references.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return SHARDS_PER_TASK * max(partitions, -(-references.count() // (SHARDS_PER_TASK * keys_each)))


def _with_shards(rows: DataFrame, shards: int) -> DataFrame:
    """Rows of keys in the state's columns, with their shard among ``shards`` put in."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            numbers = pa.array(_shards_of(_key_array(part.column("key")), shards), pa.int32())
            yield part.set_column(0, STATE_ARROW.field(0), numbers)

    return rows.mapInArrow(run, STATE)


def insert(
    index: LineIndex | None,
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keys_each: int = SHARD_KEYS,
    summed: int = SUMMED,
) -> LineIndex:
    """The index with the lines of ``documents`` counted in; a new one where there is none."""
    new = _tied(documents, id_column, text_column).select("id", "tie", "text").mapInArrow(_references, REFERENCES)
    new = written(new, "line-references")
    references = index.references.unionByName(new) if index else new
    shards, state = _shards_for(references, keys_each), None
    if index:
        dealt_anew = shards > 4 * index.shards
        shards = shards if dealt_anew else index.shards
        # Without filter rows, the filters are built anew from the counts.
        state = _with_shards(index.state.where(F.col("kind") == COUNTED), shards) if dealt_anew else index.state
    seen = new.mapInArrow(_sightings(shards, summed), STATE)
    return LineIndex(references, _merged(state.unionByName(seen) if state else seen, shards), shards)


def _counted(references: DataFrame) -> DataFrame:
    return references.groupBy("key").agg(
        F.count("*").alias("refs"),
        F.coalesce(F.min("id"), F.lit(int(NO_LOW))).alias("low"),
        F.coalesce(F.max("id"), F.lit(int(NO_HIGH))).alias("high"),
        F.count_if(F.col("id").isNull()).alias("nulls"),
    )


def delete(index: LineIndex, documents: DataFrame, id_column: str = "doc_id") -> LineIndex:
    """The index without the documents of these identifiers; their texts are not needed."""
    gone = written(documents.select(F.col(id_column).cast("long").alias("id")).distinct(), "line-deletions")
    same = index.references["id"].eqNullSafe(gone["id"])
    remaining = index.references.join(gone, same, "left_anti")
    touched = written(index.references.join(gone, same, "left_semi").select("key").distinct(), "line-touched")
    # Summed before they meet, so that a line of a third of all documents is a few rows.
    counted = _counted(remaining).join(touched, "key", "left_semi")
    none = {"refs": 0, "low": int(NO_LOW), "high": int(NO_HIGH), "nulls": 0}
    recounted = touched.join(counted, "key", "left").na.fill(none)
    blank = [F.lit(0).alias("shard"), F.lit(RECOUNTED).alias("kind"), F.lit(None).cast("binary").alias("filter")]
    dealt = _with_shards(recounted.select(*blank, "key", *none), index.shards)
    return LineIndex(remaining, _merged(index.state.unionByName(dealt), index.shards), index.shards)


def shared_lines(index: LineIndex) -> DataFrame:
    """``(key, refs, owner)`` of the keys in two documents or more; the owner is the smallest."""
    several = (F.col("low") < F.col("high")) | ((F.col("nulls") > 0) & (F.col("refs") > F.col("nulls")))
    return index.counts().where(several).select("key", "refs", F.col("low").alias("owner"))


def lost_lines(index: LineIndex) -> DataFrame:
    """``(id, tie, key)``: the keys whose lines a document loses."""
    shared = written(shared_lines(index), "shared-lines")
    met = join_per_key(index.references, shared, "key", "refs", "tie")
    return met.where(~F.col("id").eqNullSafe(F.col("owner"))).select("id", "tie", "key")


KEPT = T.StructType(
    [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())]
)


@F.arrow_udf(KEPT)
def _kept_lines(texts: pa.Array, lost: pa.Array) -> pa.Array:
    columns: list[list] = [[], [], []]
    for text, keys in zip(texts, lost, strict=True):
        text, gone = text.as_py(), set(keys.as_py() or ())
        lines = (text or "").split("\n")
        stay = lines
        if gone:
            stay = [line for line, key in zip(lines, line_keys(text), strict=True) if key not in gone]
        for column, value in zip(columns, (len(lines), len(lines) - len(stay), "\n".join(stay)), strict=True):
            column.append(value)
    arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)]
    return pa.StructArray.from_arrays(arrays, names=KEPT.names)


def kept_documents(
    index: LineIndex, documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(row, n_lines, n_dropped, kept)``: each inserted document's row, and its text without the lost lines."""
    lost = lost_lines(index).groupBy("id", "tie").agg(F.collect_set("key").alias("lost"))
    lost = lost.withColumnsRenamed({"id": "lost_id", "tie": "lost_tie"})
    tied = _tied(documents, id_column, text_column)
    same = F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("tie") == F.col("lost_tie"))
    text = F.col(f"row.`{text_column}`")
    return (
        tied.drop("text")
        .join(lost, same, "left")
        .select("row", _kept_lines(text, "lost").alias("found"))
        .select("row", "found.*")
    )


def without_repeated_lines(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Line dedup of one table: all documents inserted into a new index, and what they keep."""
    return kept_documents(insert(None, documents, id_column, text_column), documents, id_column, text_column)
