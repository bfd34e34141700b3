"""SimHash near duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits. Two fingerprints that differ in three bits or fewer have a
fingerprint between them, one bit from the one and two bits from the other. Each distinct
fingerprint therefore emits the ball of half the radius around it: itself, its 64 variants of
one bit, and the variants of two bits. Of the latter it suffices to flip pairs within one half
of the word, 992 of 2,016: of any three bits, two lie in the same half, and those two are the
pair. A variant that one fingerprint reached with at most one flip, and others with at most two,
links them all to the first; so each variant yields a star, never all pairs, and every link of
the star is a true one.

Variants are shuffled by coset: ``syndrome(variant)`` is linear over the bits, so the variants
of a fingerprint that belong to a coset follow from the fingerprint itself. A task gets the
fingerprints with variants in its coset, 8 bytes each, makes those variants and joins them. This
moves 2 KB a fingerprint in place of the 17 KB of the variants with their origins.

Defined cases: a null or blank text has fingerprint zero and is linked like any other. Repeated
rows and copies collapse to one fingerprint before the balls are made. A component of which no
row has an identifier has a null ``component_id``. All shingles of very long texts count. Other columns
are not looked at, whatever their names; survivors keep theirs. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import join_counted, text_bytes, whole_row, written

SHINGLE_WORDS = 3
MAX_BITS = 3
BITS = 64
SHINGLE_BLOCK = 65_536

# Cosets: 2 ** 8 at least; more when a coset's fingerprints would pass this number.
COSET_BITS = 8
COSET_FINGERPRINTS = 1 << 23
VARIANT_BLOCK = 1 << 20


def fingerprint(text: bytes, words_each: int = SHINGLE_WORDS) -> int:
    """A bit is 1 where more than half of the shingles' hashes have it, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(words_each, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    counts = np.zeros(BITS, np.int64)
    hashed = xxhash.xxh64_intdigest
    for block in range(0, len(starts), SHINGLE_BLOCK):
        pairs = zip(
            starts[block : block + SHINGLE_BLOCK].tolist(),
            ends[block : block + SHINGLE_BLOCK].tolist(),
            strict=True,
        )
        hashes = np.array([hashed(joined[a:b], 42) for a, b in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(counts * 2 > len(starts)).tolist())


def fingerprint_of(text: str | Column, words_each: int = SHINGLE_WORDS) -> Column:
    """The fingerprint as a signed long."""

    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        prints = [fingerprint(text_bytes(text), words_each) for text in texts.to_pylist()]
        return pa.array(np.array(prints, np.uint64).view(np.int64))

    return run(text)


@cache
def _syndromes(bits: int) -> np.ndarray:
    """A syndrome per bit of the fingerprint: spread by a fixed generator, none of them zero."""
    rng = np.random.default_rng(64)
    return rng.permutation(np.arange(1, 1 << bits, dtype=np.uint32))[:BITS]


@cache
def _byte_syndromes(bits: int) -> np.ndarray:
    """``[byte place, byte value]`` -> syndrome."""
    table = np.zeros((8, 256), np.uint32)
    for place in range(8):
        for bit in range(8):
            having = (np.arange(256) >> bit) & 1 == 1
            table[place, having] ^= _syndromes(bits)[8 * place + bit]
    return table


def syndrome(prints: np.ndarray, bits: int) -> np.ndarray:
    parts = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
    table = _byte_syndromes(bits)
    out = np.zeros(len(prints), np.uint32)
    for place in range(8):
        out ^= table[place, parts[:, place]]
    return out


@cache
def _flips(bits: int, max_bits: int) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Flip masks by syndrome: of the near ball (every fingerprint is met there), and beyond it."""
    near_radius, far_radius = max_bits // 2, max_bits - max_bits // 2
    single = _syndromes(bits)
    halves = [range(BITS // 2), range(BITS // 2, BITS)] if max_bits == 3 else [range(BITS)]

    def by_syndrome(groups: list[tuple[int, ...]]) -> dict[int, np.ndarray]:
        found: dict[int, list[int]] = {}
        for group in groups:
            value = 0
            for bit in group:
                value ^= int(single[bit])
            found.setdefault(value, []).append(sum(1 << bit for bit in group))
        return {value: np.array(masks, np.uint64) for value, masks in found.items()}

    near = [g for size in range(near_radius + 1) for g in combinations(range(BITS), size)]
    far = [
        g
        for size in range(near_radius + 1, far_radius + 1)
        for half in halves
        for g in combinations(half, size)
    ]
    return by_syndrome(near), by_syndrome(far)


def _emit(bits: int, max_bits: int):
    """For each coset, the fingerprints that have variants in it, 8 bytes each."""
    near, far = _flips(bits, max_bits)
    reached = np.array(sorted({*near, *far}), np.uint32)
    schema = pa.schema([("coset", pa.int32()), ("prints", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints = part.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            own = syndrome(prints, bits)
            order = np.argsort(own, kind="stable")
            prints, own = prints[order], own[order]
            by_own = np.split(prints, np.flatnonzero(np.diff(own)) + 1)
            values = own[np.r_[0, np.flatnonzero(np.diff(own)) + 1]] if len(own) else own
            cosets: dict[int, list[bytes]] = {}
            for value, group in zip(values, by_own, strict=True):
                raw = group.tobytes()
                for coset in (reached ^ value).tolist():
                    cosets.setdefault(coset, []).append(raw)
            yield pa.record_batch(
                [
                    pa.array(list(cosets), pa.int32()),
                    pa.array([b"".join(raw) for raw in cosets.values()], pa.binary()),
                ],
                schema=schema,
            )

    return run


def _meet(bits: int, max_bits: int):
    """Make a coset's variants, link those that meet, and return a forest of the links."""
    schema = pa.schema([("child", pa.int64()), ("parent", pa.int64())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        near, far = _flips(bits, max_bits)
        raw = b"".join(rows.column("prints").to_pylist())
        prints = np.unique(np.frombuffer(raw, np.uint64))
        apart = syndrome(prints, bits) ^ np.uint32(key[0].as_py())
        order = np.argsort(apart, kind="stable")
        prints, apart = prints[order], apart[order]
        edges = np.flatnonzero(np.diff(apart)) + 1
        groups = dict(zip(apart[np.r_[0, edges]].tolist(), np.split(prints, edges), strict=True))

        variants, origins = _ball(groups, near)
        order = np.lexsort((origins, variants))
        variants, origins = variants[order], origins[order]
        first = np.r_[True, variants[1:] != variants[:-1]][: len(variants)]
        centres = origins[first]
        star = centres[np.cumsum(first) - 1]
        links = [(origins[~first], star[~first])]
        meeting = variants[first]
        for value, group in groups.items() if len(meeting) else ():
            for masks in _blocks(far.get(value), len(group)):
                reached = (group[None, :] ^ masks[:, None]).ravel()
                at = np.searchsorted(meeting, reached)
                at[at == len(meeting)] = 0
                hit = np.flatnonzero(meeting[at] == reached)
                links.append((group[hit % len(group)], centres[at[hit]]))
        child, parent = _forest(
            np.concatenate([a for a, _ in links]), np.concatenate([b for _, b in links])
        )
        return pa.table([child.view(np.int64), parent.view(np.int64)], schema=schema)

    return run


def _ball(groups: dict[int, np.ndarray], flips: dict[int, np.ndarray]):
    variants, origins = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for value, group in groups.items():
        for mask in flips.get(value, ()):
            variants.append(group ^ mask)
            origins.append(group)
    return np.concatenate(variants), np.concatenate(origins)


def _blocks(masks: np.ndarray | None, group: int) -> Iterator[np.ndarray]:
    if masks is not None:
        step = max(1, VARIANT_BLOCK // group)
        for start in range(0, len(masks), step):
            yield masks[start : start + step]


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not its component's smallest, with that smallest node."""
    nodes, places = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = places[: len(left)], places[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            jumped = root[root]
            if np.array_equal(jumped, root):
                break
            root = jumped
        if np.array_equal(root, before):
            break
    lower = root != np.arange(len(nodes))
    return nodes[lower], nodes[root[lower]]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(child, parent)``: links between distinct ``fingerprint`` values that keep every component."""
    if not 0 <= max_bits <= 3:
        raise ValueError("balls are made for at most three differing bits")
    distinct = written(prints.select("fingerprint").distinct(), "fingerprints")
    crowd = max(1, distinct.count() / COSET_FINGERPRINTS)
    bits = COSET_BITS + math.ceil(math.log2(crowd))
    return (
        distinct.mapInArrow(_emit(bits, max_bits), "coset int, prints binary")
        .groupBy("coset")
        .applyInArrow(_meet(bits, max_bits), "child long, parent long")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``(child, parent)`` links; the root is the smallest node.

    Large-star and small-star steps in turn: each node's larger neighbours, then its smaller
    ones, are hung below the smallest. Every step is written, so that a lost executor costs one
    step. Ends when the links no longer change.
    """
    edges = written(_downward(edges, "child", "parent"), "links")
    state = _state(edges)
    while True:
        edges = written(_star(_star(edges, large=True), large=False), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots.unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )


def _downward(edges: DataFrame, left: str, right: str) -> DataFrame:
    return (
        edges.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("high"), F.least(left, right).alias("low"))
        .distinct()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang a node's neighbours below the smallest of them and itself."""
    if large:
        reach = edges.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
            edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
        )
    else:
        reach = edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    smallest = reach.groupBy("node").agg(F.min("other").alias("least"))
    smallest = smallest.withColumn("least", F.least("least", "node"))
    hung = reach.join(smallest, "node")
    if large:
        hung = hung.where(F.col("other") > F.col("node")).select("other", "least")
    else:
        hung = hung.select("other", "least").unionByName(
            smallest.select(F.col("node").alias("other"), "least")
        )
    return _downward(hung, "other", "least")


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("high", "low")
    row = edges.agg(F.count("*"), F.bit_xor(mixed), F.sum(mixed.bitwiseAND(0xFFFFFFFF))).first()
    return tuple(row)


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_each: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``(doc_id, content, fingerprint, component_id)``, one row per document.

    ``content`` is a hash of the text, which tells rows apart that share an identifier.
    """
    prints = written(
        documents.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.xxhash64(text_column).alias("content"),
            fingerprint_of(F.col(text_column), words_each).alias("fingerprint"),
        ),
        "prints",
    )
    roots = components(links(prints, max_bits))
    rooted = (
        prints.groupBy("fingerprint")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
        .join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("root", F.coalesce("root", "fingerprint"))
    )
    rooted = written(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("members"))
    named = join_counted(rooted, written(smallest, "smallest"), "root", "members", "fingerprint")
    named = written(named.select("fingerprint", "component_id", "rows"), "named")
    # A fingerprint or a component may hold a third of all rows, so both joins salt such keys.
    return join_counted(prints, named, "fingerprint", "rows", "doc_id").select(
        "doc_id", "content", "fingerprint", "component_id"
    )


def without_near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The documents' own rows and columns; of each component the smallest identifier stays.

    Where a whole component has no identifier, its rows cannot be told apart, and all stay.
    """
    found = near_duplicates(documents, id_column, text_column, **options)
    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    dropped = dropped.select("doc_id", "content").distinct()
    keyed = documents.select(
        whole_row(),
        F.col(id_column).cast("long").alias("_id"),
        F.xxhash64(text_column).alias("_content"),
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_content") == F.col("content"))
    return keyed.join(dropped, same, "left_anti").select("row.*")
