import itertools
import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.operators import blocks, similarity, terms
from lectern.sources import scratch


@pytest.fixture(autouse=True)
def many(monkeypatch):
    """These documents are few, but stand for many."""
    monkeypatch.setattr(similarity, "FEW_DOCUMENTS", 0)


@pytest.fixture(scope="module")
def documents():
    chance = random.Random(7)
    words = [f"w{i:02d}" for i in range(40)]
    made = {f"d{i:02d}": chance.choices(words[: 5 + i * 2], k=12) for i in range(16)}
    made |= {"copy1": made["d15"], "copy2": made["d15"], "alone": ["solitary"] * 3, "empty": []}
    return made


@pytest.fixture(scope="module")
def tokens(spark, documents):
    return spark.createDataFrame(
        list(documents.items()), "doc string, filtered_words array<string>"
    ).repartition(5)


@pytest.fixture(scope="module")
def weights(tokens):
    return terms.tf_idf(tokens, "doc", with_index=True).persist()


@pytest.fixture(scope="module")
def brute(documents):
    vectors = {}
    for doc, words in documents.items():
        if words:
            vectors[doc] = {
                w: words.count(w) / len(words)
                * math.log(len(documents) / sum(w in other for other in documents.values()))
                for w in set(words)
            }
    def cosine(a, b):
        dot = sum(a[w] * b[w] for w in a.keys() & b.keys())
        norms = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        return dot / norms if norms else 0.0

    return {
        pair: cosine(vectors[pair[0]], vectors[pair[1]])
        for pair in itertools.combinations(sorted(vectors), 2)
    }


def pairs(frame):
    rows = frame.collect()
    found = {(r.book1, r.book2): r.similarity for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("least, part", [(0.0001, 20_000), (0.1, 20_000), (0.1, 2), (0.5, 1), (0.5, 3), (0.9, 2), (1.0, 20_000)])
def test_cosine_equals_brute_force(weights, brute, least, part):
    got = pairs(similarity.pairwise_cosine(weights, "doc", least, postings_per_part=part))
    want = {pair: value for pair, value in brute.items() if round(value, 4) >= least}
    assert got.keys() == want.keys() and want
    assert all(got[pair] == pytest.approx(want[pair], abs=1e-12) for pair in want)
    assert all(0 < value <= 1 for value in got.values())


def test_cosine_needs_a_threshold(weights):
    with pytest.raises(ValueError):
        similarity.pairwise_cosine(weights, "doc", 0)


def test_a_number_can_be_the_key(spark, documents, brute):
    names = sorted(documents)
    rows = [(names.index(doc), words) for doc, words in documents.items()]
    frame = spark.createDataFrame(rows, "doc bigint, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    got = pairs(similarity.pairwise_cosine(weights, "doc", 0.0001))
    want = {(names.index(a), names.index(b)): value for (a, b), value in brute.items() if round(value, 4) > 0}
    assert got == pytest.approx(want)
    assert similarity.least_similar_pairs(weights, "doc", 3).count() == 3


def test_parts_before_the_rest_are_all_that_meets(spark):
    """Documents that share only their commonest words are no candidates at a high threshold."""
    rows = [(f"d{i:03d}", ["common", "usual", f"own{i}", f"self{i}"]) for i in range(200)]
    frame = spark.createDataFrame(rows + [("other", ["lone"])], "doc string, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    joined = similarity.pairwise_cosine(weights, "doc", 0.5)
    assert joined.count() == 0
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_long_posting_lists_are_cut(spark):
    """Different texts of common words alone: every list is long, and no part of one is."""
    chance = random.Random(11)
    words = [f"w{i}" for i in range(12)]
    rows = [(f"d{i:03d}", [w for w in words for _ in range(chance.randrange(1, 9)) if chance.random() < 0.9]) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc string, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    suffixes = similarity._suffixes(weights, "doc", 20)
    leading = suffixes.where("left >= 0.9")
    parted = similarity._parted(leading, "doc", 0.9, 20)
    own = [r["count"] for r in parted.groupBy("word", "part").count().collect()]
    assert sum(own) == leading.count() and max(own) <= 45 and len(own) > 25
    # Parts that cannot reach the threshold together never meet.
    whole = similarity._parted(leading, "doc", 0.0, 20)
    meetings = [sum(len(r.partners) for r in f.select("partners").collect()) for f in (parted, whole)]
    assert meetings[0] < 0.9 * meetings[1]
    cut = pairs(similarity.pairwise_cosine(weights, "doc", 0.9, postings_per_part=20))
    assert cut == pytest.approx(pairs(similarity.pairwise_cosine(weights, "doc", 0.9))) and len(cut) > 100


def test_vectors_move_once_per_tile(spark):
    """Near copies: each vector goes to its tiles, however many pairs it is in; pairs that cannot reach are not multiplied."""
    chance = random.Random(5)
    groups = [[f"g{g}w{i}" for i in range(60)] for g in range(4)]
    rows = [(f"d{g}{i:02d}", chance.sample(groups[g], 57) + [f"own{g}{i}"]) for g in range(4) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc string, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    suffixes = similarity._suffixes(weights, "doc", 20_000)
    found = similarity._candidates(suffixes, "doc", 0.7, 20_000).persist()
    sizes = suffixes.groupBy("doc").agg(F.count("*").alias("words"))
    tiled = similarity._tiles(found, sizes, "doc", 256, 2_000_000)
    assert tiled.count() == found.count() > 2500
    assert tiled.select("tile", "book1").distinct().count() < 400
    # Tiles of few documents and chunks of few words give the same products.
    whole, cut = (
        {(r.book1, r.book2): r.dot for r in similarity._products(found, suffixes, "doc", *sizes).collect()}
        for sizes in ((65_536, 256, 2_000_000), (20, 8, 100))
    )
    assert cut == pytest.approx(whole) and len(whole) == found.count()
    far = similarity._within_bound(spark.createDataFrame([("d000", "d100"), ("d000", "d001")], "book1 string, book2 string"), suffixes, "doc", 0.7)
    assert [tuple(r) for r in far.collect()] == [("d000", "d001")]


def test_copies_do_not_multiply(spark):
    rows = [(f"c{i:04d}", ["same", "text", "here"]) for i in range(3000)] + [("e1", ["same", "other"]), ("e2", ["same", "other", "more"])]
    frame = spark.createDataFrame(rows, "doc string, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    assert similarity._first_copies(weights, "doc", 5).select("doc").distinct().count() == 7
    top = [tuple(r) for r in similarity.most_similar_pairs(weights, "doc", 4).collect()]
    assert top == [("c0000", f"c000{i}", 1.0) for i in range(1, 5)]


def test_rankings(weights, brute):
    for n in (1, 4, 30):
        top = [(r.book1, r.book2) for r in similarity.most_similar_pairs(weights, "doc", n).collect()]
        assert top == sorted(brute, key=lambda pair: (-round(brute[pair], 4), pair))[:n]
    assert top[:3] == [("copy1", "copy2"), ("copy1", "d15"), ("copy2", "d15")]
    for first in (3, 100):
        low = [(r.book1, r.book2) for r in similarity.least_similar_pairs(weights, "doc", 25, first).collect()]
        assert low == sorted(brute, key=lambda pair: (round(brute[pair], 4), pair))[:25]


def test_all_pairs_rank_when_too_few_are_at_zero(weights, brute):
    got = [(r.book1, r.book2, r.similarity) for r in similarity.least_similar_pairs(weights, "doc", 1000, 8).collect()]
    assert got == sorted(((*p, round(v, 4)) for p, v in brute.items()), key=lambda r: (r[2], *r[:2]))
    positive = [p for p, v in brute.items() if round(v, 4) > 0]
    assert similarity.most_similar_pairs(weights, "doc", 1000).count() == len(positive)


@pytest.mark.parametrize("n", [1, 5, 200])
def test_lowest_pairs_where_all_documents_share_a_word(spark, n):
    """No pair is at 0 but those of the last documents, which only the last block finds."""
    chance = random.Random(5)
    rows = [(f"d{i:02d}", ["shared"] + chance.choices(["a", "b", "c", "d", "e"], k=4)) for i in range(18)]
    rows += [("x1", ["lone"]), ("x2", ["single"])]
    frame = spark.createDataFrame(rows, "doc string, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    units = {}
    for r in similarity._unit_weights(weights, "doc").collect():
        units.setdefault(r.doc, {})[r.word] = r.unit
    value = {
        (a, b): round(sum(units[a][w] * units[b][w] for w in units[a].keys() & units[b].keys()), 4)
        for a, b in itertools.combinations(sorted(d for d, _ in rows), 2)
    }
    got = [(r.book1, r.book2) for r in similarity.least_similar_pairs(weights, "doc", n, 3).collect()]
    assert got == sorted(value, key=lambda pair: (value[pair], pair))[:n]
    got = [(r.book1, r.book2) for r in similarity.least_similar_pairs(weights.where("doc < 'x'"), "doc", n, 3).collect()]
    inner = {p: v for p, v in value.items() if p[1] < "x"}
    assert got == sorted(inner, key=lambda pair: (inner[pair], pair))[:n] and min(inner.values()) > 0


def test_stats_need_no_pairs(weights, brute):
    got = similarity.similarity_stats(weights, "doc").first()
    assert tuple(got) == pytest.approx((sum(brute.values()) / len(brute), 0.0, 1.0))


def test_stats_of_one_document(tokens):
    lone = terms.tf_idf(tokens.where("doc = 'd01'"), "doc").persist()
    got = similarity.similarity_stats(lone, "doc").first()
    assert (got.average_similarity, got.max_similarity) == (None, None)


def test_documents_of_zero_norm_score_zero(spark):
    rows = [("a", ["x", "x"]), ("b", ["x"]), ("c", ["x", "y"])]
    frame = spark.createDataFrame(rows, "doc string, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc").persist()
    assert pairs(similarity.pairwise_cosine(weights, "doc", 0.0001)) == {}
    whole = pairs(similarity.least_similar_pairs(weights, "doc"))
    assert whole == {("a", "b"): 0.0, ("a", "c"): 0.0, ("b", "c"): 0.0}
    links = {tuple(r) for r in similarity.similar_documents(weights, "doc").collect()}
    assert links == {("a", "a", 0), ("b", "b", 0), ("c", "c", 0)}
    stats = {r.doc: tuple(r)[1:] for r in similarity.vector_stats(weights, "doc").collect()}
    assert stats["a"] == (0, 0.0, 0.0, 100.0)
    assert stats["c"] == (1, pytest.approx(math.log(3) / 2), pytest.approx(math.log(3) / 2), 50.0)
    near = similarity.find_similar(weights, "doc", "a").collect()
    assert [tuple(r) for r in near] == [("b", 0.0), ("c", 0.0)]


@pytest.mark.parametrize("least", [0.2])
def test_classes_and_links(weights, brute, least):
    got = {r.doc: (r.class_id, r.links) for r in similarity.similar_documents(weights, "doc", least).collect()}
    docs = {d for pair in brute for d in pair}
    want = {d: sum(round(v, 4) >= least for pair, v in brute.items() if d in pair) for d in docs}
    assert {d: n for d, (_, n) in got.items()} == want
    assert [got[d][0] for d in ("copy1", "copy2", "d15", "d14")] == ["copy1", "copy1", "copy1", "d14"]


def test_vocabulary_is_numbered_in_order(tokens, documents):
    words = terms.token_words(tokens)
    got = {r.word: r["index"] for r in similarity.vocabulary(words).collect()}
    assert got == {w: i for i, w in enumerate(sorted({w for ws in documents.values() for w in ws}))}
    assert similarity.vocabulary_size(words).first()[0] == len(got)


def test_vocabulary_over_many_partitions(spark):
    numbers = spark.range(30000).selectExpr("concat('w', id) AS word")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = similarity.vocabulary(numbers.unionByName(numbers)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(tuple(r) for r in got) == [(w, i) for i, w in enumerate(sorted(f"w{i}" for i in range(30000)))]


def test_vectors(weights, documents):
    vocabulary = sorted({w for ws in documents.values() for w in ws})
    weight = {(r.doc, r.word): r.tfidf for r in weights.collect()}
    rows = similarity.tfidf_vectors(weights, "doc").collect()
    assert {r.doc for r in rows} == {doc for doc, words in documents.items() if words}
    for row in rows:
        words = sorted(set(documents[row.doc]))
        assert row.size == len(vocabulary)
        assert [vocabulary[i] for i in row.indices] == words
        assert row["values"] == [weight[row.doc, w] for w in words]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_chunks_make_up_the_vectors(weights, size):
    chunks = similarity.tfidf_vector_chunks(weights, "doc", size).collect()
    assert all(0 < len(r.indices) <= size and {i // size for i in r.indices} == {r.chunk} for r in chunks)
    joined = {}
    for r in sorted(chunks, key=lambda r: (r.doc, r.chunk)):
        entries = joined.setdefault(r.doc, ([], []))
        entries[0].extend(r.indices)
        entries[1].extend(r["values"])
    assert joined == {r.doc: (r.indices, r["values"]) for r in similarity.tfidf_vectors(weights, "doc").collect()}


def test_find_similar(weights, brute):
    got = similarity.find_similar(weights, "doc", "d15", 30).collect()
    score = {next(d for d in pair if d != "d15"): round(v, 4) for pair, v in brute.items() if "d15" in pair}
    assert [tuple(r) for r in got] == [
        (doc, pytest.approx(score[doc])) for doc in sorted(score, key=lambda doc: (-score[doc], doc))
    ]
    with pytest.raises(ValueError):
        similarity.find_similar(weights, "doc", "nobody")


def test_few_documents_need_no_bounds(weights, brute, monkeypatch):
    """No task sorts a document's whole vector, as a source's may be a vocabulary."""
    many = {least: pairs(similarity.pairwise_cosine(weights, "doc", least)) for least in (0.0001, 0.3, 1.0)}
    top, stats = similarity.most_similar_pairs(weights, "doc", 9).collect(), similarity.similarity_stats(weights, "doc").first()
    monkeypatch.setattr(similarity, "FEW_DOCUMENTS", 32)
    monkeypatch.setattr(similarity, "_suffixes", None)
    for least, want in many.items():
        assert pairs(similarity.pairwise_cosine(weights, "doc", least)) == pytest.approx(want)
        assert want.keys() == {pair for pair, value in brute.items() if round(value, 4) >= least}
    assert similarity.most_similar_pairs(weights, "doc", 9).collect() == top
    assert tuple(similarity.similarity_stats(weights, "doc").first()) == pytest.approx(tuple(stats))


@pytest.mark.parametrize("docs, words", [(1000, 10**6), (7, 10**6), (1000, 90)])
def test_blocks_leave_hardly_any_pair_that_falls_short(spark, docs, words):
    """What is found does not depend on the blocks, and neither vectors nor pairs are kept on disk for it."""
    chance = random.Random(13)
    texts = [chance.sample([f"w{i}" for i in range(150)], 30) for _ in range(40)]
    texts += [text[:-1] + ["other"] for text in texts[:15]]
    frame = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc bigint, filtered_words array<string>")
    weights = terms.tf_idf(frame, "doc", with_index=True).persist()
    units = {}
    for r in similarity._unit_weights(weights, "doc").collect():
        units.setdefault(r.doc, {})[r.word] = r.unit
    want = {
        (a, b) for a, b in itertools.combinations(sorted(units), 2) if sum(v * units[b].get(w, 0) for w, v in units[a].items()) >= 0.8
    }
    postings = weights.where("tfidf != 0").withColumnRenamed("index", "number")
    found = blocks.near_pairs(blocks.vectors(postings, "doc"), "doc", 0.8, docs, words)
    got = [tuple(r) for r in found.collect()]
    assert want <= set(got) and len(got) == len(set(got)) <= 1.2 * len(want) and len(want) >= 10
    files = " ".join(found.inputFiles())
    assert "vectors" not in files and not [p for p in scratch._handed_out[spark.sparkContext.applicationId] if "/vectors-" in p]


def test_jobs_that_write_a_table_leave_no_shuffle_files(spark):
    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = {p for p in local.rglob("shuffle_*.data")}
    rows = scratch.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert {p for p in local.rglob("shuffle_*.data")} <= before
    assert rows.count() == 7
