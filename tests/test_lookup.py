import random
import re

import pytest

from lectern.operators import lookup, similarity, terms


@pytest.fixture(scope="module")
def weights(spark):
    chance = random.Random(9)
    words = [f"w{i:02d}" for i in range(60)]
    made = {f"d{i:02d}": chance.choices(words[: 8 + i * 2], k=9) for i in range(25)}
    made |= {"copy": made["d20"], "alone": ["solitary"] * 3, "empty": []}
    tokens = spark.createDataFrame(list(made.items()), "doc string, filtered_words array<string>")
    return terms.tf_idf(tokens, "doc").persist()


@pytest.fixture(scope="module")
def index(weights):
    return lookup.build_lookup(weights, "doc", buckets=40)


@pytest.mark.parametrize("target", ["d20", "d03", "alone", "copy"])
@pytest.mark.parametrize("top_n", [1, 5, 100])
def test_lookup_equals_the_scan(weights, index, target, top_n):
    got = [tuple(r) for r in lookup.nearest_documents(index, target, top_n).collect()]
    assert got == [tuple(r) for r in similarity.find_similar(weights, "doc", target, top_n).collect()]
    assert len(got) == min(top_n, 26) and (target != "alone" or {s for _, s in got} == {0.0})


def test_a_bucket_is_one_file(index):
    assert len(index.postings.inputFiles()) <= 40


def test_unknown_target(index):
    for target in ("nobody", "empty"):
        with pytest.raises(ValueError, match="not found"):
            lookup.nearest_documents(index, target)


def test_a_target_without_weight_scores_zero(spark):
    tokens = spark.createDataFrame([("a", ["x"]), ("b", ["x"]), ("c", ["x", "y"])], "doc string, filtered_words array<string>")
    index = lookup.build_lookup(terms.tf_idf(tokens, "doc"), "doc", 4)
    assert [tuple(r) for r in lookup.nearest_documents(index, "a").collect()] == [("b", 0.0), ("c", 0.0)]


def test_only_the_buckets_of_the_words_are_read(index, monkeypatch):
    found = lookup.products(index, "d03")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    read, all_buckets = map(int, re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", plan).groups())
    words = lookup.target_words(index, "d03").count()
    assert all_buckets == 40 and 0 < read <= words < 10
    # A target of more words than fit a filter reads all, with the same result.
    monkeypatch.setattr(lookup, "MAX_FILTER_WORDS", 1)
    whole = lookup.products(index, "d03")
    assert sorted(whole.collect()) == sorted(found.collect())


def test_many_postings_of_a_word_are_written_by_several_tasks(weights, monkeypatch):
    monkeypatch.setattr(lookup, "POSTINGS_PER_TASK", 3)
    index = lookup.build_lookup(weights, "doc", 8)
    assert index.postings.count() == weights.where("tfidf != 0").count()
    got = [tuple(r) for r in lookup.nearest_documents(index, "d20", 30).collect()]
    assert got == [tuple(r) for r in similarity.find_similar(weights, "doc", "d20", 30).collect()]


@pytest.mark.parametrize("top_n", [2, 30])
def test_lookup_over_a_term_index_sorts_no_vectors(spark, weights, top_n):
    """A target's vector comes from its row of counts, of two batches here, and is the one that the weights have."""
    made = [(r.doc, [r.word] * round(r.tf * 9)) for r in weights.where("doc LIKE 'd%'").collect()]
    words = {}
    for doc, several in made:
        words.setdefault(doc, []).extend(several)
    rows = sorted(words.items()) + [("same", ["all"]), ("void", [])]
    tokens = spark.createDataFrame([(d, [*w, "all"]) for d, w in rows], "doc string, filtered_words array<string>")
    counts = terms.add_terms(None, tokens.where("doc < 'd1'"), "doc", "one")
    counts = terms.add_terms(counts, tokens.where("doc >= 'd1'"), "doc", "two")
    whole = terms.tf_idf_of(counts).persist()
    index = lookup.build_lookup(whole, "doc", 8, counts=counts)
    assert index.vectors is counts
    for target in ("d00", "d20", "same"):
        own = {tuple(r) for r in lookup.target_words(index, target).collect()}
        assert own == {tuple(r) for r in whole.where((whole.doc == target) & (whole.tfidf != 0)).select("word", "tfidf").collect()}
        got = [tuple(r) for r in lookup.nearest_documents(index, target, top_n).collect()]
        assert got == [tuple(r) for r in similarity.find_similar(whole, "doc", target, top_n).collect()]
    with pytest.raises(ValueError, match="not found"):
        lookup.nearest_documents(index, "nobody")
