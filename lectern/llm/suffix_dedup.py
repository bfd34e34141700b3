"""Repeated byte strings, found by a distributed merge sort of suffixes that knows common prefixes.

A byte goes if a string of ``match`` bytes covers it that also starts earlier: in a document
with a smaller identifier, or in the same one further on the left.

Anchors. Of the ``gram``-byte strings within a window of ``match`` bytes, the leftmost one with
the least hash is the window's anchor. That depends on the window's bytes alone, so equal windows
have equal anchors at equal offsets, and a few hundredths of all suffixes stand for all windows.
An anchor whose gram occurs once in the corpus belongs to no repeated window and is dropped.

Exchange. The suffixes at the other anchors, cut at ``match`` bytes, with the bytes before them
that their windows reach, go to a partition by the hash of their gram, as sorted front-coded
runs. There the runs are merged by a loser tree that never compares a known prefix again; the
common prefixes of neighbours come with the merge. For each offset, windows are equal where the
common prefix on the right and that of the reversed bytes on the left both reach far enough. All
but the earliest of them are repeated.

Hot strings. Within a task, anchors with the same surroundings are merged before any exchange,
so a passage that a third of all documents share is sent once per task. A gram that occurs more
than ``hot_anchors`` times is not sent as a group: its anchors are spread into their windows, each
of which goes by the hash of all its bytes. The list of such grams is broadcast; it holds at most
one 8-byte hash for every ``hot_anchors`` anchors.

Defined cases: a null text counts as empty; texts shorter than ``match`` lose nothing. A null
identifier comes after all others. Rows that share an identifier are ordered by a hash of their
text; rows that repeat both are one document and are judged alike. Very long texts are compared whole. Other
columns are not looked at, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import written
from lectern.llm.loser_tree import Run, front_code, merge_runs

MATCH_BYTES = 100
HOT_ANCHORS = 1_000_000
BLOCK_BYTES = 1 << 20

# A task takes the texts of one group at a time, about this many bytes; sorting them takes up to nine times that.
GROUP_BYTES = 32 * 1024 * 1024
LAST = (1 << 63) - 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Shape(NamedTuple):
    """``match``: bytes of a window; ``gram``: bytes of an anchor; ``reach``: its greatest offset."""

    match: int
    gram: int
    reach: int


def shape_of(match: int) -> Shape:
    """Half a window for the gram, or more where the offsets would not fit a 64-bit mask."""
    gram = max(match // 2, match - 63, 1)
    return Shape(match, gram, match - gram)


# Arrays in one compressed value ------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one or several lengths; wide ones as differences, which compress well."""
    parts = [struct.pack("<B", len(columns))]
    for column in columns:
        stepped = column.dtype.itemsize >= 4 and column.dtype != np.uint64
        flat = np.diff(column, prepend=column.dtype.type(0)) if stepped else column
        parts += [struct.pack("<3sq", column.dtype.str[1:].encode(), len(column)), flat.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, columns = 1, []
    for _ in range(raw[0]):
        kind, count = struct.unpack_from("<3sq", raw, at)
        at += struct.calcsize("<3sq")
        dtype = np.dtype("<" + kind.rstrip(b"\0").decode())
        column = np.frombuffer(raw, dtype, count, at)
        at += count * dtype.itemsize
        stepped = dtype.itemsize >= 4 and dtype != np.uint64
        columns.append(np.cumsum(column, dtype=dtype) if stepped else column)
    return columns


def _joined(blobs: list[bytes], width: int) -> list[np.ndarray]:
    """The columns of several values, laid end to end."""
    sets = [unpack(blob) for blob in blobs]
    return [np.concatenate([s[i] for s in sets]) for i in range(width)]


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with the places where it stands, in order."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(keys[part[0]]), part


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + sizes, sizes)


# Anchors -----------------------------------------------------------------------------------


@cache
def _letters() -> np.ndarray:
    return np.random.default_rng(100).integers(1, 1 << 63, 256, np.uint64)


@lru_cache(2)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = (np.full(count, base, np.uint64) for base in (_BASE, inverse))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on: a rolling polynomial, then mixed."""
    size = 1 << max(1, (len(data) - 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_letters()[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(32)
    return hashes


def row_hashes(rows: np.ndarray, gram: int) -> np.ndarray:
    """``gram_hashes`` of the first ``gram`` bytes of each row of a matrix."""
    up, _ = _powers(1 << max(1, (gram - 1).bit_length()))
    hashes = np.zeros(len(rows), np.uint64)
    for place in range(gram):
        hashes += _letters()[rows[:, place]] * up[place]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """How far the leftmost least of ``width`` values lies from the place they begin at."""
    least, away, span = values, np.zeros(len(values), np.uint8), 1
    while span < width:
        step = min(span, width - span)
        count = len(least) - step
        right = least[step:] < least[:count]
        away = np.where(right, away[step:] + np.uint8(step), away[:count])
        least = np.minimum(least[:count], least[step:])
        span += step
    return away


class Anchors(NamedTuple):
    """Per anchor: its text's place in the list, its place in the text, least and greatest offset, hash."""

    text: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    hash: np.ndarray


def anchors_of(texts: list[bytes], shape: Shape) -> Anchors:
    """All anchors of whole texts; a long text is worked off in overlapping segments."""
    found: list[Anchors] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        for base in range(0, len(text) - shape.match + 1, BLOCK_BYTES):
            segment = text[base : base + BLOCK_BYTES + shape.match - 1]
            held.append((number, base, segment))
            size += len(segment)
            if size >= BLOCK_BYTES:
                found.append(_block_anchors(held, shape))
                held, size = [], 0
    if held or not found:
        found.append(_block_anchors(held, shape))
    return Anchors(*map(np.concatenate, zip(*found, strict=True)))


def _block_anchors(segments: list[tuple[int, int, bytes]], shape: Shape) -> Anchors:
    if not segments:
        return Anchors(*(np.empty(0, kind) for kind in (np.int64, np.int64, np.uint8, np.uint8, np.uint64)))
    data = np.frombuffer(b"".join(segment for *_, segment in segments), np.uint8)
    sizes = np.array([len(segment) for *_, segment in segments], np.int64)
    starts = np.cumsum(sizes) - sizes
    hashes = gram_hashes(data, shape.gram)
    away = _leftmost_least(hashes, shape.reach + 1)
    windows = sizes - shape.match + 1
    own = np.repeat(np.arange(len(segments)), windows)
    window = _ranges(starts, windows)
    at = window + away[window]
    first = np.r_[True, (at[1:] != at[:-1]) | (own[1:] != own[:-1])]
    last = np.r_[first[1:], True]
    own, at = own[first], at[first]
    numbers = np.array([number for number, *_ in segments], np.int64)
    bases = np.array([base for _, base, _ in segments], np.int64)
    return Anchors(
        numbers[own],
        at - starts[own] + bases[own],
        (at - window[last]).astype(np.uint8),
        (at - window[first]).astype(np.uint8),
        hashes[at],
    )


# Step 1: anchors whose gram occurs more than once -------------------------------------------


def _send_anchors(shape: Shape, partitions: int):
    """Anchors with a gram that is single in the batch go to the gram's partition, to be counted.

    Of the other grams one entry goes there; their anchors are candidates already.
    """
    schema = pa.schema([("p", pa.int32()), ("kind", pa.string()), ("q", pa.int32()), ("blob", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            doc, tie, q = (part.column(n).to_numpy(zero_copy_only=False) for n in ("doc", "tie", "q"))
            own = anchors_of(part.column("data").to_pylist(), shape)
            grams, places, counts = np.unique(own.hash, return_inverse=True, return_counts=True)
            single = counts[places] == 1
            known, known_counts = grams[counts > 1], counts[counts > 1]
            target = (own.hash % np.uint64(partitions)).astype(np.int32)
            doc, tie, q = doc[own.text], tie[own.text], q[own.text].astype(np.int32)
            at = own.at.astype(np.uint32)
            known_by = dict(_by((known % np.uint64(partitions)).astype(np.int32)))
            single_by = {p: rows for p, rows in _by(np.where(single, target, -1)) if p >= 0}
            rows = []
            none = np.empty(0, np.int64)
            for p in {*known_by, *single_by}:
                s, k = single_by.get(p, none), known_by.get(p, none)
                entries = (own.hash[s], doc[s], tie[s], q[s], at[s], own.low[s], own.high[s])
                rows.append((p, "grams", -1, pack(*entries, known[k], known_counts[k])))
            repeated = np.flatnonzero(~single)
            for to, places in _by(q[repeated]):
                s = repeated[places]
                blob = pack(doc[s], tie[s], at[s], own.low[s], own.high[s], target[s])
                rows.append((to % partitions, "candidates", to, blob))
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


FOUND = "kind string, q int, blob binary"


def _count_grams(hot_anchors: int):
    schema = pa.schema([("kind", pa.string()), ("q", pa.int32()), ("blob", pa.binary())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        p = key[0].as_py()
        blobs, out = [], []
        for kind, q, blob in zip(*(rows.column(n).to_pylist() for n in ("kind", "q", "blob")), strict=True):
            if kind == "grams":
                blobs.append(blob)
            else:
                out.append((kind, q, blob))
        if blobs:
            grams, doc, tie, q, at, low, high, known, known_counts = _joined(blobs, 9)
            every, places = np.unique(np.concatenate([grams, known]), return_inverse=True)
            counts = np.bincount(places, np.r_[np.ones(len(grams)), known_counts], len(every))
            again = np.flatnonzero(counts[places[: len(grams)]] > 1)
            for to, part in _by(q[again]):
                s = again[part]
                where = np.full(len(s), p, np.int32)
                out.append(("candidates", to, pack(doc[s], tie[s], at[s], low[s], high[s], where)))
            hot = every[counts > hot_anchors]
            if len(hot):
                out.append(("hot", -1, pack(hot)))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


# Step 2: suffixes with what stands before them, as sorted runs --------------------------------


class Suffixes(NamedTuple):
    """``right``: the bytes from the anchor on; ``left``: those before it, nearest first."""

    doc: np.ndarray
    tie: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    p: np.ndarray
    right: np.ndarray
    left: np.ndarray


def _cut_suffixes(texts: dict[tuple[int, int], bytes], blobs: list[bytes], shape: Shape) -> Suffixes:
    columns = _joined(blobs, 6)
    doc, tie, at, low, high, p = (c[np.lexsort((columns[3], columns[2], columns[1], columns[0]))] for c in columns)
    new = np.r_[True, (np.diff(doc) != 0) | (np.diff(tie) != 0)]
    # Rows that repeat identifier and text give the same anchors again.
    fresh = new | np.r_[True, (np.diff(at.astype(np.int64)) != 0) | (np.diff(low.astype(np.int16)) != 0)]
    doc, tie, at, low, high, p, new = (c[fresh] for c in (doc, tie, at, low, high, p, new))
    rights, lefts = [], []
    for places in np.split(np.arange(len(doc)), np.flatnonzero(new)[1:]):
        text = texts[int(doc[places[0]]), int(tie[places[0]])]
        data = np.frombuffer(b"\0" * shape.reach + text + b"\0" * shape.match, np.uint8)
        begin = at[places].astype(np.int64)
        rights.append(np.lib.stride_tricks.sliding_window_view(data, shape.match)[begin + shape.reach])
        lefts.append(np.lib.stride_tricks.sliding_window_view(data, shape.reach)[begin][:, ::-1])
    right, left = np.concatenate(rights), np.concatenate(lefts)
    # What no window of the anchor reaches does not tell suffixes apart.
    left = np.where(np.arange(shape.reach) < high[:, None], left, 0).astype(np.uint8)
    right = np.where(np.arange(shape.match) < (shape.match - low.astype(np.int64))[:, None], right, 0).astype(np.uint8)
    return Suffixes(doc, tie, at, low, high, p, right, left)


def _spread_hot(own: Suffixes, hot: np.ndarray, shape: Shape, partitions: int) -> Suffixes:
    """Anchors of hot grams become their windows, each an anchor at offset 0 of its own."""
    if not len(hot):
        return own
    is_hot = np.isin(row_hashes(own.right, shape.gram), hot)
    cold = Suffixes(*(column[~is_hot] for column in own))
    rows = np.flatnonzero(is_hot)
    low, high = own.low[rows].astype(np.int64), own.high[rows].astype(np.int64)
    source = np.repeat(rows, high - low + 1)
    offset = _ranges(low, high - low + 1)
    around = np.concatenate([own.left[source][:, ::-1], own.right[source]], axis=1)
    right = np.take_along_axis(around, (shape.reach - offset)[:, None] + np.arange(shape.match), axis=1)
    zero = np.zeros(len(source), np.uint8)
    target = (row_hashes(right, shape.match) % np.uint64(partitions)).astype(np.int32)
    at = (own.at[source].astype(np.int64) - offset).astype(np.uint32)
    left = np.zeros((len(source), shape.reach), np.uint8)
    warm = Suffixes(own.doc[source], own.tie[source], at, zero, zero, target, right, left)
    both = Suffixes(*(np.concatenate(pair) for pair in zip(cold, warm, strict=True)))
    order = np.lexsort((both.low, both.at, both.tie, both.doc))
    return Suffixes(*(column[order] for column in both))


def _masks(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A bit for each offset from low to high."""
    one = np.uint64(1)
    upto = np.where(high >= 63, np.uint64((1 << 64) - 1), (one << (high + 1).clip(max=63).astype(np.uint64)) - one)
    return upto & ~((one << low.astype(np.uint64)) - one)


def _send_runs(shape: Shape, partitions: int, hot: np.ndarray):
    schema = pa.schema([("p", pa.int32()), ("kind", pa.string()), ("q", pa.int32()), ("blob", pa.binary())])

    def run(documents: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if candidates.num_rows and documents.num_rows:
            q = documents.column("q")[0].as_py()
            keys = zip(documents.column("doc").to_pylist(), documents.column("tie").to_pylist(), strict=True)
            texts = dict(zip(keys, documents.column("data").to_pylist(), strict=True))
            own = _cut_suffixes(texts, candidates.column("blob").to_pylist(), shape)
            own = _spread_hot(own, hot, shape, partitions)
            # Equal surroundings: the first of them stands for all, as rows are in order.
            whole = np.concatenate([own.right, own.left, own.low[:, None] + 1, own.high[:, None] + 1], axis=1)
            _, first = np.unique(np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel(), return_index=True)
            later = np.ones(len(own.doc), bool)
            later[first] = False
            if later.any():
                masks = _masks(own.low[later], own.high[later])
                out.append((q % partitions, "repeated", q, pack(own.doc[later], own.tie[later], own.at[later], masks)))
            for p, places in _by(own.p[first]):
                rows = first[places]
                coded = front_code(own.right[rows])
                left = own.left[rows][np.arange(shape.reach) < own.high[rows][:, None]]
                blob = pack(
                    coded.shared.astype(np.uint8),
                    np.frombuffer(coded.tails, np.uint8),
                    left,
                    *(column[rows] for column in (own.doc, own.tie, own.at, own.low, own.high)),
                )
                out.append((p, "run", q, blob))
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


# Step 3: merge the runs, and tell which windows start earlier elsewhere ------------------------


def _merge(shape: Shape):
    schema = pa.schema([("q", pa.int32()), ("blob", pa.binary())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        out, runs, owners, sets = [], [], [], []
        order = pc.sort_indices(rows, [("kind", "ascending"), ("q", "ascending")])
        for kind, q, blob in zip(*(rows.column(n).take(order).to_pylist() for n in ("kind", "q", "blob")), strict=True):
            if kind == "repeated":
                out.append((q, blob))
                continue
            shared, tails, left, *entries = unpack(blob)
            runs.append(Run(shared.astype(np.int64), tails.tobytes()))
            owners.append(np.full(len(shared), q, np.int32))
            high = entries[4]
            full = np.zeros((len(shared), shape.reach), np.uint8)
            full[np.arange(shape.reach) < high[:, None]] = left
            sets.append((*entries, full))
        if runs:
            order, shared = merge_runs(runs, shape.match)
            q = np.concatenate(owners)[order]
            doc, tie, at, low, high, left = (np.concatenate([s[i] for s in sets])[order] for i in range(6))
            masks = repeated_windows(shared, left, low, high, np.lexsort((low, at, tie, doc)), shape)
            again = np.flatnonzero(masks)
            for to, part in _by(q[again]):
                s = again[part]
                out.append((to, pack(doc[s], tie[s], at[s], masks[s])))
        columns = list(zip(*out, strict=True)) or [[], []]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def repeated_windows(
    shared: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, earliest: np.ndarray, shape: Shape
) -> np.ndarray:
    """Per suffix, in sorted order, a bit for each offset whose window starts earlier elsewhere.

    ``shared``: bytes in common with the suffix before; ``earliest``: places by identifier and start.
    """
    masks = np.zeros(len(shared), np.uint64)
    group = np.cumsum(shared < shape.gram)
    crowded = np.bincount(group)[group] > 1
    rows = np.flatnonzero(crowded)
    if not len(rows):
        return masks
    shared, left, low, high = shared[rows], left[rows], low[rows], high[rows]
    place = np.full(len(masks), -1)
    place[rows] = np.arange(len(rows))
    earliest = place[earliest[crowded[earliest]]]
    by_left, left_shared = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    if shape.reach:
        by_left = np.argsort(np.ascontiguousarray(left).view(f"S{shape.reach}").ravel(), kind="stable")
        left_shared = front_code(left[by_left]).shared
    found = np.zeros(len(rows), np.uint64)
    left_class = np.zeros(len(rows), np.int64)
    for offset in range(shape.reach + 1):
        chosen = earliest[((low <= offset) & (offset <= high))[earliest]]
        if len(chosen) < 2:
            continue
        right_class = np.cumsum(shared < shape.match - offset)
        left_class[by_left] = np.cumsum(left_shared < offset)
        window = right_class[chosen] * (len(rows) + 1) + left_class[chosen]
        _, first = np.unique(window, return_index=True)
        later = np.ones(len(chosen), bool)
        later[first] = False
        found[chosen[later]] |= np.uint64(1 << offset)
    masks[rows] = found
    return masks


# Step 4: what is left of each text ------------------------------------------------------------


def covered_bytes(size: int, at: np.ndarray, masks: np.ndarray, shape: Shape) -> np.ndarray:
    """Whether each byte lies in a repeated window."""
    bits = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, offset = np.nonzero(bits)
    starts = np.zeros(size, np.int32)
    starts[at[row].astype(np.int64) - offset] = 1
    begun = np.cumsum(starts)
    covered = begun > 0
    covered[shape.match :] = begun[shape.match :] > begun[: -shape.match]
    return covered


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _finish(shape: Shape, keep_bytes: bool):
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_bytes
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(documents: pa.Table, removals: pa.Table) -> pa.Table:
        slices: dict[tuple[int, int], slice] = {}
        if removals.num_rows:
            columns = _joined(removals.column("blob").to_pylist(), 4)
            order = np.lexsort((columns[1], columns[0]))
            doc, tie, at, masks = (column[order] for column in columns)
            cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(tie) != 0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(doc)], strict=True):
                slices[int(doc[begin]), int(tie[begin])] = slice(begin, end)
        out = []
        for identifier, *key, data in zip(
            *(documents.column(n).to_pylist() for n in ("doc_id", "doc", "tie", "data")), strict=True
        ):
            kept, removed, spans = data, 0, 0
            if own := slices.get(tuple(key)):
                covered = covered_bytes(len(data), at[own], masks[own], shape)
                kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                removed = len(data) - len(kept)
                spans = int(covered[0]) + int(np.count_nonzero(covered[1:] & ~covered[:-1]))
            row = (identifier, len(data), removed, spans, hashlib.sha256(kept).hexdigest())
            out.append((*row, kept) if keep_bytes else row)
        columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def remove_repeats(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    match: int = MATCH_BYTES,
    hot_anchors: int = HOT_ANCHORS,
    keep_bytes: bool = False,
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])``, one row per document.

    Texts are dealt out by document once; cutting the suffixes and the last step share that exchange.
    """
    spark = documents.sparkSession
    shape = shape_of(match)
    identifier = F.col(id_column).cast("long")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    counted = documents.agg(
        F.count("*").alias("n"), F.count_distinct(identifier).alias("ids"), F.sum(F.octet_length(text)).alias("bytes")
    ).first()
    unique = counted.n == counted.ids
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(counted.bytes or 0) // GROUP_BYTES))
    tie = F.lit(0).cast("long") if unique else F.xxhash64(text)
    named = documents.select(
        identifier.alias("doc_id"),
        F.coalesce(identifier, F.lit(LAST)).alias("doc"),
        tie.alias("tie"),
        # With the tie, so that rows without an identifier, or with the same one, are not one group.
        F.pmod(F.xxhash64(identifier, tie), F.lit(partitions)).cast("int").alias("q"),
        text.cast("binary").alias("data"),
    )
    found = written(
        named.mapInArrow(_send_anchors(shape, partitions), "p int, kind string, q int, blob binary")
        .groupBy("p")
        .applyInArrow(_count_grams(hot_anchors), FOUND),
        "anchors",
    )
    hot = np.concatenate(
        [np.empty(0, np.uint64), *(unpack(row.blob)[0] for row in found.where("kind = 'hot'").collect())]
    )
    candidates = found.where("kind = 'candidates'").select("q", "blob")
    dealt = named.groupBy("q")
    repeated = (
        dealt.cogroup(candidates.groupBy("q"))
        .applyInArrow(_send_runs(shape, partitions, hot), "p int, kind string, q int, blob binary")
        .groupBy("p")
        .applyInArrow(_merge(shape), "q int, blob binary")
    )
    result = RESULT + (", kept binary" if keep_bytes else "")
    return dealt.cogroup(repeated.groupBy("q")).applyInArrow(_finish(shape, keep_bytes), result)
