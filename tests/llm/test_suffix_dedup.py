import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import suffix_dedup
from lectern.llm.loser_tree import front_code, merge_runs
from lectern.llm.suffix_dedup import anchors_of, covered_bytes, pack, remove_repeats, shape_of, unpack


def brute(rows, match):
    """First start of every string of ``match`` bytes, over documents in order."""
    keyed = {}
    for identifier, text in rows:
        keyed[(identifier is None, identifier or 0, text or "")] = (text or "").encode()
    seen, covered = set(), {}
    for key in sorted(keyed, key=lambda k: k[:2]):
        data = keyed[key]
        gone = [False] * len(data)
        for start in range(len(data) - match + 1):
            window = data[start : start + match]
            if window in seen:
                gone[start : start + match] = [True] * match
            seen.add(window)
        covered[key] = gone
    out = []
    for identifier, text in rows:
        key = (identifier is None, identifier or 0, text or "")
        gone, data = covered[key], keyed[key]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((identifier, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_pack():
    columns = [np.array([5, 3, 2**40], np.int64), np.array([1, 2], np.uint8), np.empty(0, np.uint64), np.array([9, 1], np.uint32)]
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(unpack(pack(*columns)), columns, strict=True))


@pytest.mark.parametrize("runs", [1, 2, 3, 8, 13])
def test_merge_runs(runs):
    rng = random.Random(runs)
    strings = [sorted(bytes(rng.choices(b"ab", k=9)) for _ in range(rng.randrange(0, 60))) for _ in range(runs)]
    coded = [front_code(np.array([list(s) for s in own], np.uint8).reshape(-1, 9)) for own in strings]
    order, shared = merge_runs(coded, 9)
    flat = [s for own in strings for s in own]
    merged = [flat[i] for i in order]
    assert sorted(order) == list(range(len(flat))) and merged == sorted(flat)
    for before, after, length in zip(merged, merged[1:], shared[1:], strict=False):
        assert length == next((i for i in range(9) if before[i] != after[i]), 9)


def test_anchors_stand_for_every_window_and_depend_on_it_alone():
    rng = random.Random(3)
    shape = shape_of(12)
    texts = [bytes(rng.choices(b"abc", k=n)) for n in (0, 5, 12, 13, 300)] + [b"a" * 50]
    found = anchors_of(texts, shape)
    at_of = {}
    for text, at, low, high in zip(found.text, found.at, found.low, found.high, strict=True):
        for offset in range(low, high + 1):
            start = int(at) - offset
            assert (int(text), start) not in at_of
            at_of[int(text), start] = offset
    windows = {}
    for (text, start), offset in at_of.items():
        assert windows.setdefault(texts[text][start : start + 12], offset) == offset
    assert len(at_of) == sum(max(0, len(t) - 11) for t in texts)


def test_covered_bytes():
    shape = shape_of(4)
    covered = covered_bytes(10, np.array([3], np.uint32), np.array([0b101], np.uint64), shape)
    assert covered.tolist() == [False] + [True] * 6 + [False] * 3


def small_corpus():
    rng = random.Random(11)
    rows = [(i, "".join(rng.choices("ab", k=rng.randrange(0, 90)))) for i in range(60)]
    passage = "".join(rng.choices("abcdefgh", k=200))
    rows += [(100 + i, "".join(rng.choices("xyz", k=20)) + passage[rng.randrange(100) :] + str(i)) for i in range(30)]
    rows += [(200, None), (201, ""), (None, passage), (None, passage[:50]), (3, "b" * 70), (3, "b" * 70), (5, passage + "é€" * 30)]
    return rows


@pytest.mark.parametrize("match, hot", [(8, 10**6), (12, 10**6), (12, 3), (30, 5), (64, 10**6), (2, 10**6), (1, 10**6)])
def test_against_brute_force(spark, match, hot):
    # Rows that share an identifier are ordered by a hash, which the brute force does not know.
    rows = [(i, t) for i, t in dict(small_corpus()).items() if i is not None] + [(None, "tail")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in remove_repeats(frame, match=match, hot_anchors=hot).collect()]
    assert sorted(got, key=str) == brute(rows, match)


def test_shared_identifiers(spark):
    rows = [(1, "abcdefghij" * 3), (1, "abcdefghij" * 3), (1, "abcdefghij!"), (None, "abcdefghij"), (None, "abcdefghij")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_repeats(frame, match=10, keep_bytes=True).collect()
    assert len(got) == 5
    assert all(r.kept == b"" for r in got if r.doc_id is None)
    assert len({tuple(r) for r in got if r.doc_id == 1 and r.n_bytes == 30}) == 1


@pytest.mark.parametrize("identifier", [None, 7])
def test_rows_of_one_identifier_are_dealt_out(spark, monkeypatch, identifier):
    def rows_of_group(shape, keep_bytes):
        def run(documents, removals):
            n = documents.num_rows
            ids = pa.array([None] * n, pa.int64())
            return pa.table({"doc_id": ids, "n_bytes": [n] * n, "n_removed": ids, "n_spans": ids, "kept_sha256": pa.array([None] * n, pa.string())})

        return run

    rows = [(identifier, f"text number {i} of many") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "_finish", rows_of_group)
    sizes = [r.n_bytes for r in remove_repeats(frame).collect()]
    assert len(sizes) == 400 and max(sizes) < 300


def test_long_text_and_extra_columns(spark):
    rng = random.Random(5)
    unit = "".join(rng.choices("abcdefghijklmnop ", k=5000))
    rows = [(2, unit * 260, "x"), (1, unit[:300], "y"), (7, "é" * 400, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, data string")
    got = {r.doc_id: r for r in remove_repeats(frame).collect()}
    assert (got[1].n_removed, got[1].n_spans) == (0, 0)
    # Of the long text the passage of document 1 goes, and all that its first unit repeats.
    assert got[2].n_bytes - got[2].n_removed == 5000 - 300 + 0
    assert got[7].n_removed == 798


def test_empty(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
