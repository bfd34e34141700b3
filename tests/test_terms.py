import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.operators import cleaning, similarity, skew, terms
from lectern.operators.skew import join_per_key
from lectern.plans.queries import QUERIES
from lectern.sources import text

DOCUMENTS = {
    "d1": "apple apple bread common".split(),
    "d2": "bread common cider".split(),
    "d3": "common".split(),
    "d4": [],
}


@pytest.fixture(scope="module")
def tokens(spark):
    # d1 comes as two rows, as a key of coarser grain would.
    rows = [("d1", ["apple", "apple"]), ("d1", ["bread", "common"])]
    rows += [(key, words) for key, words in DOCUMENTS.items() if key != "d1"]
    return spark.createDataFrame(rows, "doc string, filtered_words array<string>")


def test_term_frequency(tokens):
    got = {(r.doc, r.word): r.tf for r in terms.term_frequency(tokens, "doc").collect()}
    want = {
        (doc, word): count / len(words)
        for doc, words in DOCUMENTS.items()
        for word, count in Counter(words).items()
    }
    assert got == want
    totals = Counter()
    for (doc, _), tf in got.items():
        totals[doc] += tf
    assert all(math.isclose(total, 1) for total in totals.values())


def test_idf_counts_documents_left_without_tokens(tokens):
    rows = {r.word: r for r in terms.idf_stats(tokens, "doc").collect()}
    assert rows["common"].idf_score == pytest.approx(math.log(4 / 3))
    assert tuple(rows["apple"])[:4] == ("apple", 1, 2, 25.0)


def test_a_word_in_every_document_weighs_nothing(tokens):
    weights = terms.tf_idf(tokens.where("doc <> 'd4'"), "doc")
    assert {r.tfidf for r in weights.where("word = 'common'").collect()} == {0.0}


def test_tops(tokens):
    idf = terms.idf_stats(tokens, "doc")
    assert [r.word for r in terms.most_common_words(idf, 2).collect()] == ["common", "bread"]
    assert [r.word for r in terms.rarest_shared_words(idf, 5).collect()] == ["bread", "common"]
    top = terms.top_terms_by_tf(tokens, "doc", 2).orderBy("doc", "rank").collect()
    assert [(r.doc, r["rank"], r.word) for r in top] == [
        ("d1", 1, "apple"), ("d1", 2, "bread"), ("d2", 1, "bread"), ("d2", 2, "cider"), ("d3", 1, "common"),
    ]
    weights = terms.tf_idf(tokens, "doc")
    best = [r.word for r in terms.top_terms_by_tfidf(weights, "doc", 1).orderBy("doc").collect()]
    assert best == ["apple", "cider", "common"]
    assert [(r.doc, r.word) for r in terms.top_tfidf_overall(weights, "doc", 2).collect()] == [
        ("d1", "apple"), ("d2", "cider")
    ]


def test_ranking_cuts_each_task_before_the_shuffle(tokens):
    plan = terms.top_terms_by_tf(tokens, "doc")._jdf.queryExecution().toString()
    assert "row_number(), 10, Partial" in plan


@pytest.mark.parametrize(
    "operator", [terms.term_counts, terms.term_frequency, terms.top_terms_by_tf, terms.idf_stats, terms.tf_idf]
)
def test_counting_in_the_row_gives_the_same(spark, sf_dir, operator):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokens = cleaning.clean_tokens(documents, "doc_id")
    plain = operator(tokens, "doc_id")
    in_row = operator(tokens, "doc_id", one_row_each=True)
    assert in_row.columns == plain.columns
    assert in_row.dtypes == plain.dtypes
    assert sorted(in_row.collect()) == sorted(plain.collect())


def test_counting_in_the_row_moves_no_words(tokens):
    for operator in (terms.term_counts, terms.term_frequency, terms.top_terms_by_tf):
        plan = operator(tokens, "doc", one_row_each=True)._jdf.queryExecution().sparkPlan().toString()
        # The check of the keys is a subquery, whose lines begin with a colon.
        main = [line for line in plan.splitlines() if not line.lstrip(" +-").startswith(":")]
        assert not any(step in line for line in main for step in ("Exchange", "Aggregate", "Join", "Sort "))


@pytest.mark.parametrize("operator", [terms.term_frequency, terms.top_terms_by_tf, terms.idf_stats, terms.tf_idf])
def test_a_repeated_key_is_an_error_where_each_document_should_be_one_row(spark, tokens, operator):
    with pytest.raises(Exception, match="one_row_each: several rows have the doc d1"):
        operator(tokens, "doc", one_row_each=True).collect()


def test_two_folders_with_one_file_name(spark, tmp_path):
    for folder, words in (("a", "alpha beta"), ("b", "alpha alpha")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.txt").write_text(words)
    books = text.scan_documents(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    tokens = cleaning.clean_tokens(books, "file_name")
    with pytest.raises(Exception, match="several rows have the file_name same.txt"):
        terms.tf_idf(tokens, "file_name", one_row_each=True).collect()
    counts = {r.word: r.term_count for r in terms.term_counts(tokens, "file_name").collect()}
    assert counts == {"alpha": 3, "beta": 1}


def test_written_tokens_are_the_only_scan(spark, sf_dir):
    weights = QUERIES["tf_idf"](spark, sf_dir)
    weights.collect()
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan


def test_index_is_the_place_in_the_vocabulary(tokens):
    rows = terms.tf_idf(tokens, "doc", with_index=True).collect()
    assert {(r.word, r["index"]) for r in rows} == {("apple", 0), ("bread", 1), ("cider", 2), ("common", 3)}


def test_tokens_are_cleaned_and_shuffled_once(spark, sf_dir):
    """All uses of the word counts read one shuffle."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frame = terms.tf_idf(cleaning.clean_tokens(documents, "doc_id"), "doc_id")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffles = [
        line for line in plan.splitlines()
        if "hashpartitioning(doc_id" in line and ", word#" in line and "ReusedExchange" not in line
    ]
    assert len(shuffles) == 1


@pytest.mark.parametrize("rows_per_salt, most_hot_keys", [(1_000_000, 100), (10, 100), (7, 1), (1, 2), (1, 10**6)])
def test_skewed_join_equals_plain_join(spark, rows_per_salt, most_hot_keys):
    # A third of the rows belong to one key.
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("key"), F.col("id").alias("item")
    )
    keys = rows.groupBy("key").agg(F.count("*").alias("weight"), F.max("item").alias("last"))
    got = join_per_key(rows, keys, "key", "weight", "item", rows_per_salt, most_hot_keys)
    assert "ShuffledHashJoin" not in got._jdf.queryExecution().toString()
    want = rows.join(keys, "key")
    assert got.columns == want.columns
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.fixture(scope="module")
def written_tokens(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return cleaning.clean_tokens(documents, "doc_id").persist()


def same(left, right):
    """Equal rows, scores to the last places."""
    def rows(frame):
        return sorted(
            (tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in frame.select(sorted(frame.columns)).collect()),
            key=str,
        )

    assert rows(left) == rows(right)


def test_index_equals_the_whole_after_an_append(spark, written_tokens):
    parts = [written_tokens.where(F.col("doc_id") % 3 == k) for k in range(3)]
    index = terms.add_terms(None, parts[0], "doc_id", "first")
    index = terms.add_terms(terms.add_terms(index, parts[1], "doc_id", "second"), parts[2], "doc_id", "third")
    same(terms.idf_of(index), terms.idf_stats(written_tokens, "doc_id", one_row_each=True))
    whole = terms.tf_idf(written_tokens, "doc_id", one_row_each=True, with_index=True).persist()
    same(terms.tf_idf_of(index, with_index=True), whole)
    same(terms.top_terms_of(index, 3), terms.top_terms_by_tfidf(whole, "doc_id", 3))
    for n in (1, 10, 5000):
        same(terms.top_tfidf_of(index, n), terms.top_tfidf_overall(whole.drop("index"), "doc_id", n))
    # A batch can go, and come again.
    without = written_tokens.where("doc_id % 3 <> 1")
    index = terms.drop_terms(index, "second")
    same(terms.tf_idf_of(index), terms.tf_idf(without, "doc_id", one_row_each=True))
    index = terms.add_terms(index, parts[1], "doc_id", "second")
    same(terms.tf_idf_of(index, with_index=True), whole)


def test_an_append_reads_its_own_tokens_only(spark, written_tokens, tmp_path):
    written_tokens.where("doc_id < 50").write.parquet(str(tmp_path / "old"))
    written_tokens.where("doc_id >= 50").write.parquet(str(tmp_path / "new"))
    index = terms.add_terms(None, spark.read.parquet(str(tmp_path / "old")), "doc_id", "old")
    index = terms.add_terms(index, spark.read.parquet(str(tmp_path / "new")), "doc_id", "new")
    plan = terms.tf_idf_of(index)._jdf.queryExecution().toString()
    assert str(tmp_path) not in plan and "SortArray" not in plan


def test_index_refuses_what_it_has(spark):
    frame = spark.createDataFrame([("a", ["x", "y"]), (None, ["x"]), ("b", [])], "doc string, filtered_words array<string>")
    index = terms.add_terms(None, frame, "doc", "one")
    assert {(r.word, r.doc_freq, round(r.idf_score, 6)) for r in terms.idf_of(index).collect()} == {
        (w, 1, round(math.log(3), 6)) for w in "xy"
    }
    with pytest.raises(ValueError, match="batch 'one'"):
        terms.add_terms(index, frame.where("doc = 'c'"), "doc", "one")
    with pytest.raises(ValueError, match="document 'a'"):
        terms.add_terms(index, frame, "doc", "two")
    empty = terms.add_terms(None, frame.limit(0), "doc", "none")
    assert terms.tf_idf_of(empty).count() == terms.top_tfidf_of(empty).count() == 0


def test_common_words_stay_with_their_documents(spark):
    """Joined apart, common and rare words give the rows of the plain join; vectors take one shuffle of the weights."""
    rows = [(i, [f"c{i % 3}", f"c{(i + 1) % 3}", f"r{i}", f"s{i // 2}"]) for i in range(200)]
    tokens = spark.createDataFrame(rows, "doc bigint, filtered_words array<string>")
    counts = terms.term_frequency(tokens, "doc", one_row_each=True)
    words = counts.groupBy("word").agg(F.count("*").alias("doc_freq"))
    plain = skew.join_per_key(counts, words, "word", "doc_freq", "doc")
    for most in (5, 1, 100_000):
        apart = skew.join_common_apart(counts, words, "word", "doc_freq", "doc", most_common_keys=most)
        assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, plain.select(apart.columns).collect()))
    weights = terms.tf_idf(tokens, "doc", with_index=True)
    vectors = similarity.tfidf_vectors(weights, "doc")
    assert vectors._jdf.queryExecution().analyzed().toString().count("collect_list(") == 1
    stats = similarity.vector_stats(weights, "doc")
    assert "count(distinct" not in stats._jdf.queryExecution().analyzed().toString().lower()
    assert stats.where("unique_terms = 4").count() == 200


def test_counts_of_a_batch(spark):
    """Nulls among the words count in the total only; rows do not mix; words come in the order of their bytes."""
    rows = [("a", ["x", "é", "x", None, "Z"]), ("b", []), ("c", None), ("d", ["x"]), ("e", [None, None])]
    tokens = spark.createDataFrame(rows, "doc string, filtered_words array<string>").coalesce(1)
    got = {r.doc: (r.total_terms, r.counts and [tuple(c) for c in r.counts]) for r in terms._counted_in_row(tokens, "doc").collect()}
    assert got == {
        "a": (5, [("Z", 1), ("x", 2), ("é", 1)]), "b": (0, []), "c": (None, None), "d": (1, [("x", 1)]), "e": (2, [])
    }
    assert terms._counted_in_row(tokens.where("doc > 'x'"), "doc").collect() == []


def test_tokens_of_several_rows_are_counted_once(tokens):
    """Numbering the words is a job of its own; the counts are written, so that the weights explode no tokens again."""
    plan = terms.tf_idf(tokens, "doc", with_index=True)._jdf.queryExecution().optimizedPlan().toString()
    assert all("sequence(" in line for line in plan.splitlines() if "Generate" in line)
