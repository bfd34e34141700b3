"""Best-fit packing by minimum bin slack.

Documents become pieces of at most ``capacity`` tokens, so there are at most ``capacity``
different lengths, whatever the size of the corpus. The plan is made from the counts per length
alone: the longest length left opens a bin, and a subset-sum dynamic program over the lengths
left, with a bitset of reachable sums, finds the fullest feasible rest. That combination is
used as often as the counts allow, and then removed. Each piece finds its place from its rank
among the pieces of its length, which a range sort gives; no piece passes the driver.

Defined cases: a null or empty text is one piece, its end token. Repeated rows are packed each.
Pieces are ranked by length, identifier and place; a null identifier comes first. Very long texts
are encoded whole, and cut. Other columns are not looked at, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import bound_batches, written
from lectern.llm.tokens import VOCABULARY, encode
from lectern.operators.numbering import numbered

CAPACITY = 1024
END_ID = 2


class Run(NamedTuple):
    """``used`` pieces of ``length`` in each of some like bins, from ``offset`` on."""

    length: int
    pieces: int
    used: int
    first_bin: int
    offset: int


def fullest(lengths: dict[int, int], room: int) -> dict[int, int]:
    """The combination with the greatest sum of at most ``room``: length -> how many.

    Counts are split in binary, so that a length costs a few shifts of the bitset.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in lengths if x <= room), reverse=True):
        left, size = min(lengths[length], room // length), 1
        while left:
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= reach << (length * size) & mask
            left -= size
            size *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, size, before in reversed(steps):
        if not before >> at & 1:
            at -= length * size
            chosen[length] = chosen.get(length, 0) + size
    return chosen


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs that use up ``counts`` (length -> pieces), each length's runs in order."""
    left = {length: count for length, count in counts.items() if count}
    runs, bins = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fullest({x: n for x, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[length] // number for length, number in used.items())
        offset = 0
        for length in sorted(used, reverse=True):
            runs.append(Run(length, times * used[length], used[length], bins, offset))
            offset += length * used[length]
            left[length] -= times * used[length]
            if not left[length]:
                del left[length]
        bins += times
    return runs


def pieces_of(path: str, capacity: int, end_id: int, keep_ids: bool):
    fields = [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []),
    ]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: len(fields)]

    def cut(text: str | None) -> list[tuple]:
        """All pieces are full but the first, which takes what is left over."""
        ids = np.array([*encode(text, path), end_id], "<u4")
        edges = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        out = []
        for piece, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
            part = ids[start:end]
            row = (piece, start, len(part), zlib.crc32(part.tobytes()))
            out.append((*row, part.view("<i4")) if keep_ids else row)
        return out

    @F.arrow_udf(T.ArrayType(T.StructType(fields)))
    def run(texts: pa.Array) -> pa.Array:
        cuts = [cut(text) for text in texts.to_pylist()]
        flat = [row for rows in cuts for row in rows]
        columns = list(zip(*flat, strict=True)) or [[] for _ in fields]
        structs = pa.StructArray.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[f.name for f in fields]
        )
        offsets = np.cumsum([0, *map(len, cuts)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)

    return run


def document_pieces(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``, one row per piece."""
    cut = pieces_of(path, capacity, end_id, keep_ids)(F.col(text_column))
    return documents.select(F.col(id_column).alias("doc_id"), F.inline(cut))


def _place(runs: list[Run]):
    """Sequence and offset of a piece, from its rank over all pieces in order of length."""
    ordered = sorted(runs, key=lambda run: run.length)
    first = np.cumsum([0, *[run.pieces for run in ordered]])[:-1]
    length, _, used, first_bin, offset = np.array(ordered, np.int64).reshape(-1, 5).T

    @F.arrow_udf(T.StructType([T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]))
    def run(ranks: pa.Array) -> pa.Array:
        rank = ranks.to_numpy(zero_copy_only=False)
        at = np.searchsorted(first, rank, side="right") - 1
        within = rank - first[at]
        bins = first_bin[at] + within // used[at]
        starts = offset[at] + within % used[at] * length[at]
        return pa.StructArray.from_arrays([pa.array(bins), pa.array(starts)], names=["sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``piece`` and ``length``."""
    pieces = written(pieces, "pieces")
    # At most ``capacity`` rows, whatever the size of the corpus.
    counts = {row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranked = numbered(pieces, ["length", "doc_id", "piece"], "_rank")
    placed = ranked.withColumn("_place", _place(plan_bins(counts, capacity))("_rank"))
    return placed.select(*pieces.columns, "_place.*")


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    bound_batches(documents.sparkSession)
    return pack(document_pieces(documents, capacity=capacity, **options), capacity)
