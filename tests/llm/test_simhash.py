import random
from collections import Counter
from functools import partial

import numpy as np
import pytest
import xxhash

from lectern.llm import simhash
from lectern.llm.common import join_counted
from lectern.llm.simhash import fingerprint, links, near_duplicates, without_near_duplicates


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(3, len(words))
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, max_bits):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = list(values)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= max_bits:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


@pytest.mark.parametrize("text", ["", " \n", "One", "one two", "A b C", "a b c a b c a b c", "é  É x y", "w " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_keep_every_component(spark, max_bits):
    rng = random.Random(max_bits)
    values = set()
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.add(value)
            for bit in rng.sample(range(64), rng.randrange(1, 5)):
                value ^= 1 << bit
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "fingerprint long").repartition(3)
    edges = links(frame, max_bits)
    roots = {r.node % 2**64: r.root for r in simhash.components(edges).collect()}
    want = brute_components(values, max_bits)
    for a in values:
        for b in values:
            together = a in roots and b in roots and roots[a] == roots[b]
            assert (a == b or together) == (a == b or want[a] == want[b])


def test_more_cosets_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**62), 2**62, 300)
    values = np.concatenate([base, base ^ 5, base ^ (1 << 40), base ^ ((1 << 33) | 3)])
    frame = spark.createDataFrame([(int(v),) for v in values], "fingerprint long")
    few = {tuple(r) for r in simhash.components(links(frame)).collect()}
    monkeypatch.setattr(simhash, "COSET_FINGERPRINTS", 200)
    assert {tuple(r) for r in simhash.components(links(frame)).collect()} == few


def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    rows = [(100, None), (101, ""), (None, " "), (103, "One Two"), (104, "one  two"), (None, "lonely text here")]
    for group in range(6):
        text = [rng.choice(words) for _ in range(200)]
        for copy in range(5):
            rows.append((group * 10 + copy, " ".join(text)))
            text[rng.randrange(200)] = rng.choice(words)
    return rows + rows[-3:]


def test_against_brute_force(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_duplicates(frame).collect()
    prints = {text: slow_fingerprint(text) for _, text in rows}
    roots = brute_components(set(prints.values()), 3)
    least = {}
    for identifier, text in rows:
        root = roots[prints[text]]
        known = [x for x in (least.get(root), identifier) if x is not None]
        least[root] = min(known, default=None)
    want = [(i, prints[t], least[roots[prints[t]]]) for i, t in rows]
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got), key=str) == sorted(want, key=str)


def test_salted_groups_find_the_same(spark, monkeypatch):
    rows = corpus() + [(200 + i, "the same text in a third of all rows") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    plain = Counter(map(tuple, near_duplicates(frame).collect()))
    monkeypatch.setattr(simhash, "join_counted", partial(join_counted, rows_per_salt=2))
    assert Counter(map(tuple, near_duplicates(frame).collect())) == plain


def test_survivors(spark):
    rows = [(2, "a b c d", "p"), (1, "A  b c d", "q"), (3, "something else here", None), (None, "a b c d", "r")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    out = without_near_duplicates(frame)
    assert out.columns == frame.columns
    assert sorted(map(tuple, out.collect())) == [(1, "A  b c d", "q"), (3, "something else here", None)]


def test_very_long_text_and_clashing_columns(spark):
    text = " ".join(f"word{i * i % 7919}" for i in range(60_000))
    rows = [(5, text, "x", "y"), (9, text.upper(), None, None)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, component_id string, row string"))
    found = {(r.doc_id, r.fingerprint % 2**64, r.component_id) for r in got.collect()}
    assert found == {(i, slow_fingerprint(text), 5) for i in (5, 9)}


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(frame).count() == 0
    assert without_near_duplicates(frame).count() == 0
