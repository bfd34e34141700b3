import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm.compression import codebooks_digest, compress, nearest, sequency_order, walsh_hadamard, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_codes(rows, parts=16, entries=64, rounds=2):
    """Plain loops over Python integers; rows of (vec_id, vector, label)."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    vectors = [[math.floor(256 * c) for c in v] + [0] * (parts * width - len(v)) for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, vectors[k]))

    def cut(vector, part):
        return vector[part * width : (part + 1) * width]

    books = [[cut(vectors[k], part) for k in order[:entries]] for part in range(parts)]

    def assign(vector, part):
        distances = [sum((a - b) ** 2 for a, b in zip(cut(vector, part), e, strict=True)) for e in books[part]]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        groups = defaultdict(list)
        for vector in vectors:
            for part in range(parts):
                groups[part, assign(vector, part)[0]].append(cut(vector, part))
        for (part, entry), members in groups.items():
            books[part][entry] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    coded = [[assign(vector, part) for part in range(parts)] for vector in vectors]
    errors = [sum(d for _, d in found) for found in coded]
    by_label = defaultdict(int)
    for (_, _, label), error in zip(kept, errors, strict=True):
        by_label[label] += error
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    out = [
        (i, "".join(f"{index:02x}" for index, _ in found), error, by_label[label])
        for (i, _, label), found, error in zip(kept, coded, errors, strict=True)
    ]
    return out, digest


def run(frame, **options):
    codes, books = compress(frame, **options)
    rows = with_label_error(codes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [(r.id, "".join(f"{c:02x}" for c in r.code), r.error, r.label_error) for r in rows]
    return sorted(got, key=key), codebooks_digest(books)


def check(spark, rows, **options):
    got, digest = run(spark.createDataFrame(rows, SCHEMA), **options)
    want, brute_digest = brute_codes(rows, **options)
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))
    assert digest == brute_digest
    return got


def test_sequency_order():
    signs = walsh_hadamard(np.eye(16, dtype=np.int64)).T
    assert [int((a[1:] != a[:-1]).sum()) for a in signs] == list(range(16))
    assert (signs @ signs.T == 16 * np.eye(16)).all()
    assert sequency_order(1).tolist() == [0]


@settings(deadline=None, max_examples=60)
@given(st.integers(1, 7), st.integers(1, 20), st.sampled_from([3, 300, 1 << 40]), st.integers(0, 1 << 30))
def test_nearest_equals_all_distances(width, entries, reach, seed):
    random = np.random.default_rng(seed)
    parts = random.integers(-reach, reach, (30, width))
    book = random.integers(-reach, reach, (entries, width))
    index, distance = nearest(parts, book)
    for part, i, d in zip(parts.tolist(), index, distance, strict=True):
        all_distances = [sum((a - b) ** 2 for a, b in zip(part, e, strict=True)) for e in book.tolist()]
        assert (i, d) == (all_distances.index(min(all_distances)), min(all_distances))


def test_table_against_plain_loops(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in frame.collect()]
    got, digest = run(frame)
    want, brute_digest = brute_codes(rows)
    assert got == sorted(want) and digest == brute_digest and len(got) == 500


def test_dropped_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, [k / 7 - j / 3 for j in range(32)], k % 3 or None) for k in range(90)]
    odd = [
        (100, None, 1), (101, [nan] * 32, 1), (102, [inf] + [0.0] * 31, 1), (103, [None] + [0.0] * 31, 1),
        (None, [0.5] * 32, None), (None, [0.25] * 32, 2), (5, good[5][1], 2), (5, good[5][1], 2), (104, [], 1), (105, [1.0] * 20, 9),
    ]
    got = check(spark, odd + good[::-1])
    assert len(got) == 96 and not {100, 101, 102, 103} & {row[0] for row in got}


def test_few_rows_and_ties(spark):
    check(spark, [(2, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1), (3, [-1.0, 2.0, 9.0], None)], parts=2, entries=64)
    check(spark, [(k, [0.0] * 16, 0) for k in range(100)])
    check(spark, [(k, [float(k % 2)], 0) for k in range(10)], parts=1, entries=3, rounds=3)


def test_large_components_stay_exact(spark):
    rows = [(k, [(-1) ** k * 2.0**18 + k, 0.0], 1) for k in range(10)]
    check(spark, rows, parts=1, entries=2)


def test_too_large_components_end_the_job(spark):
    with pytest.raises(Exception, match="too large for a long"):
        compress(spark.createDataFrame([(1, [1e30], 1)], SCHEMA), parts=1)


def test_many_labels_are_joined_instead(spark):
    rows = [(k, [k / 3, -k / 5], k % 7 or None) for k in range(200)]
    codes, _ = compress(spark.createDataFrame(rows, SCHEMA), parts=2, entries=4)
    same = [sorted(with_label_error(codes, limit).collect(), key=lambda r: r.id) for limit in (100, 0)]
    assert same[0] == same[1] and len(same[0]) == 200


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    codes, books = compress(empty)
    assert with_label_error(codes).collect() == [] and books.size == 0
    clashing = spark.createDataFrame([(1, [1.0, 2.0], 3)], SCHEMA)
    for name in ("id", "x", "code", "error", "label_error", "coded", "_label", "_salt"):
        clashing = clashing.withColumn(name, F.lit("z"))
    assert run(clashing, parts=2)[0] == [(1, "0000", 0, 0)]
