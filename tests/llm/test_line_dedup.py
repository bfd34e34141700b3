import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import line_dedup
from lectern.llm.cuckoo import CuckooFilter
from lectern.llm.line_dedup import delete, insert, kept_documents, line_keys, lost_lines, shared_lines, without_repeated_lines

SCHEMA = "doc_id long, text string"


def key_of(line):
    key = line.strip("\t\n\x0b\x0c\r ")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in key)


def brute(rows):
    """doc_id, lines, dropped lines and what is kept, for rows of (doc_id, text)."""
    last = max((i for i, _ in rows if i is not None), default=0) + 1
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(last if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key_of(x)) < 10 or min(holders[key_of(x)]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return Counter(out)


def kept(index, rows, spark):
    return result(kept_documents(index, spark.createDataFrame(rows, SCHEMA)))


def result(frame):
    return Counter((r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in frame.collect())


def hashes(number, seed=0):
    return np.frombuffer(np.random.default_rng(seed).bytes(8 * number), np.uint64)


def test_filter_finds_what_was_inserted():
    filled = CuckooFilter(20_000)
    known, others = hashes(20_000), hashes(20_000, 1)
    for start in range(0, 20_000, 3_000):
        assert filled.insert(known[start : start + 3_000])
    assert filled.contains(known).all()
    assert filled.contains(others).mean() < 1e-3
    again = CuckooFilter(0, bytes(filled))
    assert again.contains(known).all() and again.used == filled.used == 20_000
    again.delete(known[:15_000])
    assert again.contains(known[15_000:]).all()
    assert again.contains(known[:15_000]).mean() < 1e-3 and again.used == 5_000


def test_filter_tells_when_it_is_full():
    small = CuckooFilter(10)
    assert not small.insert(hashes(1_000))


def test_filter_keeps_copies_of_a_print():
    small = CuckooFilter(100)
    same = np.repeat(hashes(1), 5)
    assert small.insert(same)
    for left in range(4, -1, -1):
        assert small.contains(same[:1]).all()
        small.delete(same[:1])
        assert small.used == left
    assert not small.contains(same[:1]).any()


def test_keys():
    same = ["  Hello World, 1\t", "HELLO WORLD, 1", "hello world, 1\r"]
    assert len({line_keys(x)[0] for x in same}) == 1
    assert line_keys("ÀÉ hello wörld")[0] != line_keys("àé hello wörld")[0]
    assert line_keys("123456789\n0123456789\néééééé\n" + "\U0001f986" * 10)[0::2] == [None, None]
    assert line_keys("  12345678 ")[0] is not None
    assert line_keys(None) == line_keys("") == [None]


def test_table_against_brute_force(spark, documents, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(d.doc_id, d.text) for d in documents]
    assert result(without_repeated_lines(docs)) == brute(rows)


ODD = [
    (3, "a shared line here\nshort\nshort\nown line number three\na shared line here"), (1, "A SHARED line here \n\n\nshort"),
    (None, "a shared line here\nnobody's line at all"), (None, "nobody's line at all\nnobody's second line"), (None, None), (7, ""),
    (3, "a shared line here\nshort\nshort\nown line number three\na shared line here"), (3, "own line number three\nand another row of 3"),
    (9, "a shared line here"), (9, "and another row of 3\n\nx\x0b"), (-5, "x" * 500_000 + "\n" + "word " * 100_000), (8, "word " * 100_000),
    (9223372036854775807, "a shared line here\nthe greatest identifier"),
]


def test_odd_rows(spark):
    index = insert(None, spark.createDataFrame(ODD, SCHEMA))
    got, want = kept(index, ODD, spark), brute([(i if i is None or i < 1 << 62 else 10_000, t) for i, t in ODD])
    assert got == Counter({(9223372036854775807 if r[0] == 10_000 else r[0], *r[1:]): n for r, n in want.items()})
    refs = {r.refs for r in shared_lines(index).collect()}
    assert refs == {2, 6}


def texts(number, seed):
    rng = random.Random(seed)
    return [(i, "\n".join(f"line of number {rng.randrange(150)}" for _ in range(rng.randrange(8)))) for i in range(number)]


def state_of(index):
    return {(bytes(r.key), r.refs, r.low, r.high, r.nulls) for r in index.counts().collect()}


def test_insertions_and_deletions_equal_one_insertion(spark):
    rows = texts(120, 1)
    frame = spark.createDataFrame(rows, SCHEMA)
    parts = [frame.where(F.col("doc_id") % 3 == k) for k in range(3)]
    index = insert(None, parts[2])
    before = state_of(index)
    index = insert(insert(index, parts[0]), parts[1])
    assert state_of(index) == state_of(insert(None, frame))
    assert kept(index, rows, spark) == brute(rows)

    index = delete(index, parts[0])
    left = [row for row in rows if row[0] % 3]
    assert kept(index, left, spark) == brute(left)
    index = delete(index, parts[1])
    assert state_of(index) == before
    # What was deleted can come again.
    index = insert(index, parts[0])
    left = [row for row in rows if row[0] % 3 != 1]
    assert kept(index, left, spark) == brute(left)
    index = delete(delete(index, parts[0]), parts[2])
    assert state_of(index) == set() and lost_lines(index).count() == 0
    assert all(not any(r.filter) for r in index.filters().collect())


def test_each_filter_holds_the_keys_of_its_counts(spark):
    index = insert(None, spark.createDataFrame(texts(200, 2), SCHEMA))
    index = delete(index, spark.createDataFrame([(i,) for i in range(0, 200, 2)], "doc_id long"))
    filters = {r.shard: CuckooFilter(0, bytes(r.filter)) for r in index.filters().collect()}
    counts = index.state.where("key is not null").collect()
    for row in counts:
        key = np.array([bytes(row.key)], "S16")
        assert filters[row.shard].contains(line_dedup._hashes(key)).all()
    assert sum(f.used for f in filters.values()) == len(counts)


def test_null_identifiers_can_be_deleted(spark):
    index = insert(None, spark.createDataFrame(ODD, SCHEMA))
    index = delete(index, spark.createDataFrame([(None,), (3,)], "doc_id long"))
    left = [(i, t) for i, t in ODD if i not in (None, 3, 9223372036854775807)]
    assert kept(delete(index, spark.createDataFrame([(9223372036854775807,)], "doc_id long")), left, spark) == brute(left)


def test_shards_are_dealt_anew_and_filters_grow(spark):
    few, many = texts(10, 3), [(1000 + i, f"a line of its own {i}\nline of number {i % 9}") for i in range(3000)]
    index = insert(None, spark.createDataFrame(few, SCHEMA), keys_each=10)
    first = index.shards
    index = insert(index, spark.createDataFrame(many, SCHEMA), keys_each=10, summed=500)
    assert index.shards > 4 * first
    assert kept(index, few + many, spark) == brute(few + many)
    # Without new shards, the filters themselves have to grow.
    index = insert(insert(None, spark.createDataFrame(few, SCHEMA)), spark.createDataFrame(many, SCHEMA))
    assert kept(index, few + many, spark) == brute(few + many)


def test_filter_spares_lookups_and_chance_hits_are_resolved():
    shard = line_dedup._Shard(0)
    keys = np.frombuffer(np.random.default_rng(5).bytes(16 * 60_000), "S16")
    ones = [np.ones(len(keys), np.int64)] * 3 + [np.zeros(len(keys), np.int64)]
    for start in range(0, 60_000, 5_000):
        shard.see(keys[start : start + 5_000], [n[start : start + 5_000] for n in ones])
    # All keys are new: only hits by chance were looked up, and these were added as well.
    assert 0 < shard.looked_up < 200
    assert len(shard.counts) == 60_000 and shard.filter.used == 60_000
    shard.see(keys[:100], [n[:100] for n in ones])
    assert shard.counts.numbers[0][: len(shard.counts)].sum() == 60_100


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert without_repeated_lines(empty).collect() == []
    index = insert(insert(None, empty), spark.createDataFrame(texts(9, 4), SCHEMA))
    assert kept(index, texts(9, 4), spark) == brute(texts(9, 4))
    clashing = spark.createDataFrame(texts(9, 4), SCHEMA)
    for name in ("id", "tie", "key", "lost", "lost_id", "row", "found", "kept", "n_lines", "refs", "owner"):
        clashing = clashing.withColumn(name, F.lit("z"))
    found = without_repeated_lines(clashing)
    assert result(found) == brute(texts(9, 4))
    assert {r.row.refs for r in found.collect()} == {"z"}


@pytest.mark.parametrize("salted", [True, False])
def test_hot_lines(spark, salted, monkeypatch):
    if salted:
        whole = line_dedup.join_per_key
        monkeypatch.setattr(line_dedup, "join_per_key", lambda *a: whole(*a, rows_per_salt=5))
    rows = [(i, f"the line of everyone\nonly of {i} itself") for i in range(100)]
    assert result(without_repeated_lines(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
