import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lectern.llm.packing import fullest, pack, pack_documents, plan_bins
from lectern.llm.tokens import VOCABULARY, encode


def check_layout(rows, capacity):
    """No overlap, no gap, nothing beyond the capacity; returns the number of sequences."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_fullest_equals_trying_all():
    rng = random.Random(1)
    for _ in range(200):
        lengths = {rng.randrange(1, 12): rng.randrange(1, 4) for _ in range(rng.randrange(0, 5))}
        room = rng.randrange(0, 25)
        sums = {0}
        for length, count in lengths.items():
            sums = {s + length * n for s in sums for n in range(count + 1)}
        chosen = fullest(lengths, room)
        assert sum(length * n for length, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= lengths[length] for length, n in chosen.items())


@pytest.mark.parametrize("capacity", [1, 7, 64, 1024])
def test_plan_uses_every_piece_once(capacity):
    rng = random.Random(capacity)
    counts = {length: rng.randrange(0, 50) for length in range(1, capacity + 1)}
    runs = plan_bins(counts, capacity)
    used = Counter()
    for run in runs:
        assert run.pieces % run.used == 0
        used[run.length] += run.pieces
    assert {k: v for k, v in counts.items() if v} == dict(used)


def test_few_bins_are_wasted():
    rng = random.Random(2)
    counts = Counter(min(1024, int(rng.lognormvariate(5, 1.2)) + 1) for _ in range(50_000))
    runs = plan_bins(counts)
    bins = max(run.first_bin + run.pieces // run.used for run in runs)
    assert bins <= -(-sum(k * v for k, v in counts.items()) // 1024) * 1.001 + 1


def test_query_against_the_library(answer, documents):
    library = Tokenizer.from_file(VOCABULARY)
    pieces = defaultdict(dict)
    rows = answer("op1_packing")
    for row in rows:
        pieces[row.doc_id][row.piece] = row
    assert len(pieces) == len(documents)
    for document in documents:
        ids = np.array([*library.encode(document.text, add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for piece in range(len(pieces[document.doc_id])):
            row = pieces[document.doc_id][piece]
            assert row.start == at and 1 <= row.length <= 1024 and (piece == 0 or row.length == 1024)
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    tokens = sum(row.length for row in rows)
    assert check_layout(rows, 1024) <= tokens / 1024 * 1.02 + 1


def test_long_blanks_go_to_the_library():
    text = " " * 1_000_000 + "x<|endoftext|>"
    assert encode(text) == Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids


def test_edges(spark):
    rows = [(1, "a b", "u"), (1, "a b", "u"), (None, None, "v"), (2, "", None), (3, "word " * 3000, "w")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, piece string").repartition(3)
    got = pack_documents(frame, keep_ids=True).collect()
    assert check_layout(got, 1024) == 3
    assert sorted((r.doc_id or 0, r.piece, r.length) for r in got) == [(0, 0, 1), (1, 0, 3), (1, 0, 3), (2, 0, 1), (3, 0, 954), (3, 1, 1024), (3, 2, 1024)]
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)


def test_hot_length(spark):
    frame = spark.range(20_000).selectExpr("id as doc_id", "0 as piece", "if(id % 3 = 0, 341L, 1 + id % 7) as length")
    got = pack(frame).collect()
    assert len(got) == 20_000
    total = sum(r.length for r in got)
    assert check_layout(got, 1024) <= total / 1024 + 2


def test_empty(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
