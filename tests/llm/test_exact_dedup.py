import gc
import hashlib
import pickle
import random
import re
import tracemalloc
from collections import defaultdict
from functools import partial

import pytest

from lectern.llm import exact_dedup
from lectern.llm.common import join_counted
from lectern.llm.exact_dedup import exact_duplicates, normalise, without_exact_duplicates
from lectern.llm.radix_trie import Owner, RadixTrie

TEXTS = ["a b", "a  b", "a\tb", " a b", "a b ", "", None, " ", "\n\n", "ab", "a b", "a\x0b\x0cb", "x" * 300_000]


def brute(rows):
    groups = defaultdict(list)
    for identifier, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(identifier)
    out = []
    for content, members in groups.items():
        keep = min((m for m in members if m is not None), default=None)
        digest = hashlib.sha256(content.encode()).hexdigest()
        out += [(m, keep, len(members), m == keep, digest) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_normalise(text):
    assert normalise(text.encode()).decode() == re.sub(r"[\x20\x09-\x0D]+", " ", text)


@pytest.mark.parametrize("budget", [10, 200, 10**9])
def test_trie_equals_dictionary(budget):
    rng = random.Random(budget)
    keys = [bytes(rng.choices(b"ab", k=rng.randrange(0, 12))) for _ in range(2000)]
    keys += [b"shared" * 50 + key for key in keys[:200]]
    trie, want = RadixTrie(budget), {}
    for key in keys:
        identifier = rng.choice([None, rng.randrange(10_000)])
        trie.insert(key, Owner(identifier, 1, b"", None))
        low, copies = want.get(key, (None, 0))
        both = [x for x in (low, identifier) if x is not None]
        want[key] = (min(both, default=None), copies + 1)
    got = [(key, owner.identifier, owner.copies) for key, owner in trie.owners()]
    assert sorted(got, key=str) == sorted(((k, *v) for k, v in want.items()), key=str)
    assert (trie.spills > 0) == (budget < 10**9)


@pytest.mark.parametrize("number, length, rows", [(20_000, 20, False), (20_000, 20, True), (5_000, 3_000, True), (5_000, 3_000, False)])
def test_trie_knows_its_size(number, length, rows):
    rng = random.Random(length)
    keys = [bytes(rng.choices(range(97, 123), k=rng.randrange(length // 2, 2 * length))) for _ in range(number)]
    gc.collect()
    tracemalloc.start()
    trie = RadixTrie(2**62)
    for i, key in enumerate(keys):
        key = bytes(bytearray(key))
        row = pickle.dumps({"doc_id": i, "text": key.decode()}) if rows else None
        trie.insert(key, Owner(10**6 + i, 1, hashlib.sha256(key).digest(), row))
    real = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert 0.8 < trie.held / real < 1.2


def test_trie_stays_within_its_budget():
    rng = random.Random(5)
    trie, most = RadixTrie(1_000_000), 0
    for i in range(4_000):
        key = bytes(rng.choices(b"abcd", k=rng.randrange(2_000)))
        trie.insert(key, Owner(i, 1, b"", bytes(len(key))))
        most = max(most, trie.held)
    assert trie.spills and most < 1_010_000 and trie.root.weight() == trie.held + trie.root.size()
    assert sum(1 for _ in trie.owners()) > 3_900


def test_against_brute_force(spark):
    rows = [(i, text) for i, text in enumerate(TEXTS * 3)] + [(None, "a b"), (None, "alone"), (7, "a b"), (7, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(row) for row in exact_duplicates(frame).collect()), key=str)
    assert got == brute(rows)


def test_salted_groups_against_brute_force(spark, monkeypatch):
    rows = [(i, text) for i, text in enumerate(TEXTS * 4)] + [(None, "a b"), (None, "a b"), (5, "a b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(exact_dedup, "join_counted", partial(join_counted, rows_per_salt=2))
    assert sorted(map(tuple, exact_duplicates(frame).collect()), key=str) == brute(rows)


def test_survivors_keep_their_columns(spark):
    rows = [(2, "x  y", 1.5, "k"), (1, "x y", None, "digest"), (1, "x y", None, "digest"), (5, None, 2.0, None)]
    schema = "doc_id long, text string, copies double, digest string"
    frame = spark.createDataFrame(rows, schema)
    out = without_exact_duplicates(frame)
    assert out.schema == frame.schema
    assert sorted(map(tuple, out.collect())) == [(1, "x y", None, "digest"), (5, None, 2.0, None)]


def test_survivors_of_any_type(spark):
    made = """SELECT * FROM VALUES
        (2L, 'a b', timestamp'2020-01-02 03:04:05', 1.25BD, array(1, null), map('k', 1), named_struct('x', null)),
        (1L, 'a  b', null, null, null, null, null),
        (3L, 'c', timestamp'1999-01-01 00:00:00', -2.50BD, array(), map(), named_struct('x', 'y'))
        AS t(doc_id, text, at, price, list, row, nested)"""
    frame = spark.sql(made)
    out = without_exact_duplicates(frame)
    assert out.schema == frame.schema
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        (tuple(r) for r in frame.collect() if r.doc_id != 2), key=str
    )


def test_very_long_texts_and_clashing_columns(spark):
    rows = [(4, "long " * 400_000), (3, "long  " * 400_000), (5, "long " * 400_000 + "er")]
    frame = spark.createDataFrame([(*r, "a", "b") for r in rows], "doc_id long, text string, keep_id string, kept string")
    assert sorted((tuple(row) for row in exact_duplicates(frame).collect()), key=str) == brute(rows)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert exact_duplicates(frame).count() == 0
    assert without_exact_duplicates(frame).count() == 0
