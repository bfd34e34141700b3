"""Term weights over ``(key, filtered_words)``.

A document may come as several rows, as when the key is a source. Everything then starts
from one shuffled aggregate, the count of each word in each document. Totals per document
and document counts per word are summed from its result, not from the tokens again. Spark
tokenizes and shuffles once, provided that each use of the aggregate asks for the same
columns and null checks; hence ``_rows`` below, which reads ``term_count`` where ``count``
would let the optimizer prune it.

With ``one_row_each`` the caller says that each document is one row. Its words are then
counted within the row, and neither the counts nor the totals need a shuffle. The keys are
counted beside it, and a key that repeats ends the job with an error: its words would be
counted apart. Tokens are read twice by the operators that also need ``doc_freq``; give them
written tokens, so that texts are cleaned once.

A corpus that grows is better kept as a ``TermIndex``: what each document and each batch of documents
counts is written once, as the batch is added, and the weights of all follow from these tables. A batch costs
its own tokens; document frequencies of batches add up, and a batch can be taken out again.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.numbering import numbered
from lectern.operators.skew import join_common_apart, join_per_key
from lectern.operators.wordcount import exploded
from lectern.sources.scratch import written


# Words of greatest tf weighed for each wanted one, before a bound is taken from them.
FIRST_WEIGHED = 100

# Rows whose words are counted together.
ROWS_AT_ONCE = 1_000


def token_words(tokens: DataFrame, *keep: str) -> DataFrame:
    """One row ``(*keep, word)`` per token."""
    return exploded(tokens, F.col("filtered_words"), *keep)


def term_counts(tokens: DataFrame, key: str, one_row_each: bool = False) -> DataFrame:
    """``(key, word, term_count)``."""
    if one_row_each:
        counted = _counted_in_row(tokens, key)
        return _each(counted, F.inline_outer("counts"), key)
    words = token_words(tokens.where(F.col(key).isNotNull()), key)
    return words.groupBy(key, "word").agg(F.count("*").alias("term_count"))


def _counted_in_row(tokens: DataFrame, key: str) -> DataFrame:
    """``(key, total_terms, counts)``, with ``counts`` an array of ``(word, term_count)`` by word."""
    rows = tokens.where(F.col(key).isNotNull() & _keys_are_unique(tokens, key))
    return rows.select(key, _row_counts("filtered_words").alias("counted")).select(key, "counted.*")


COUNT = T.StructType([T.StructField("word", T.StringType()), T.StructField("term_count", T.LongType())])
COUNTED = T.StructType([T.StructField("total_terms", T.LongType()), T.StructField("counts", T.ArrayType(COUNT))])


@F.arrow_udf(COUNTED)
def _row_counts(words: pa.Array) -> pa.Array:
    """Rows are counted ``ROWS_AT_ONCE``, which bounds the arrays that a batch of them needs."""
    return pa.concat_arrays([_some_counts(words.slice(i, ROWS_AT_ONCE)) for i in range(0, max(len(words), 1), ROWS_AT_ONCE)])


def _some_counts(words: pa.Array) -> pa.Array:
    """Each row's words as numbers in their order; repeats of a number in a row are one sort of all rows' numbers."""
    lists, places = pc.list_flatten(words), pc.list_parent_indices(words)
    known = lists.is_valid()
    encoded = lists.filter(known).dictionary_encode()
    order = pc.array_sort_indices(encoded.dictionary)
    number = np.empty(len(order), np.int64)
    number[order.to_numpy()] = np.arange(len(order))
    size = max(len(order), 1)
    rows = places.filter(known).to_numpy().astype(np.int64)
    found, counts = np.unique(rows * size + number[encoded.indices.to_numpy()], return_counts=True)
    row, code = np.divmod(found, size)
    ends = np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays(
        [encoded.dictionary.take(order).take(pa.array(code)), pa.array(counts.astype(np.int64))], ["word", "term_count"]
    )
    counted = pa.ListArray.from_arrays(pa.array(ends), entries, mask=words.is_null())
    totals = pc.list_value_length(words).cast(pa.int64())
    return pa.StructArray.from_arrays([totals, counted], ["total_terms", "counts"])


def _each(frame: DataFrame, generator: Column, *keep: str) -> DataFrame:
    return frame.select(*keep, generator).where("word IS NOT NULL")


def _keys_are_unique(tokens: DataFrame, key: str) -> Column:
    """True, as a scalar, or an error that names a key of several rows; null keys do not count."""
    repeated = tokens.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")
    message = F.concat(F.lit(f"one_row_each: several rows have the {key} "), F.max(F.col(key).cast("string")))
    return repeated.agg(F.when(F.count("*") > 0, F.raise_error(message)).otherwise(F.lit(True))).scalar()


def document_count(tokens: DataFrame, key: str, one_row_each: bool = False) -> Column:
    """The number of distinct documents, those left without tokens included, as a scalar."""
    keys = tokens.select(key)
    return (keys if one_row_each else keys.distinct()).agg(F.count("*")).scalar()


def term_frequency(tokens: DataFrame, key: str, one_row_each: bool = False) -> DataFrame:
    """``(key, word, term_count, total_terms, tf)``."""
    if one_row_each:
        counted = _counted_in_row(tokens, key)
        joined = _each(counted, F.inline_outer("counts"), key, "total_terms")
    else:
        joined = _with_totals(term_counts(tokens, key), key)
    return _frequencies(joined, key)


def _with_totals(counts: DataFrame, key: str) -> DataFrame:
    totals = counts.groupBy(key).agg(F.sum("term_count").alias("total_terms"), _rows().alias("words"))
    return join_per_key(counts, totals, key, weight="words", spread="word")


def _frequencies(counts: DataFrame, key: str) -> DataFrame:
    tf = (F.col("term_count") / F.col("total_terms")).alias("tf")
    return counts.select(key, "word", "term_count", "total_terms", tf)


def top_terms_by_tf(
    tokens: DataFrame, key: str, n: int = 10, one_row_each: bool = False
) -> DataFrame:
    """The ``n`` words of highest ``tf`` in each document, ties by word, with their ``rank``.

    Within a document ``tf`` orders words as ``term_count`` does, so the counts are cut to
    ``n`` per document before anything is joined to them.
    """
    if one_row_each:
        ranked = "sort_array(transform(counts, c -> struct(-c.term_count AS minus_count, c.word)))"
        best = F.expr(
            f"transform(slice({ranked}, 1, {n}), (c, i) -> "
            "struct(i + 1 AS rank, c.word, -c.minus_count AS term_count))"
        )
        joined = _each(_counted_in_row(tokens, key), F.inline_outer(best), key, "total_terms")
    else:
        counts = term_counts(tokens, key)
        totals = counts.groupBy(key).agg(F.sum("term_count").alias("total_terms"))
        joined = _top_per_document(counts, key, "term_count", n).join(totals, key)
    return joined.select(
        key,
        "rank",
        "word",
        "term_count",
        "total_terms",
        (F.col("term_count") / F.col("total_terms")).alias("tf"),
    )


def idf_stats(tokens: DataFrame, key: str, one_row_each: bool = False) -> DataFrame:
    """``(word, doc_freq, total_times_used, docs_containing_percent, idf_score)``."""
    documents = document_count(tokens, key, one_row_each)
    return (
        _word_totals(term_counts(tokens, key, one_row_each))
        .withColumn("docs_containing_percent", F.col("doc_freq") / documents * 100)
        .withColumn("idf_score", F.log(documents / F.col("doc_freq")))
    )


def most_common_words(idf: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rows of ``idf_stats`` with highest ``doc_freq``, ties by word."""
    return idf.orderBy(F.desc("doc_freq"), "word").limit(n)


def rarest_shared_words(idf: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` rows with lowest ``doc_freq`` above one, ties by word."""
    return idf.where("doc_freq > 1").orderBy("doc_freq", "word").limit(n)


def tf_idf(
    tokens: DataFrame, key: str, one_row_each: bool = False, with_index: bool = False
) -> DataFrame:
    """``(key, word, doc_freq, tf, idf, tfidf)``, scores at full precision.

    With ``with_index`` also ``index``, the word's place in the vocabulary: words are numbered
    before they are joined to the documents, so that vectors need no shuffle of their own. Numbering is a
    job of its own, so counts of documents that come as several rows are written for it: tokens are counted once.
    """
    documents = document_count(tokens, key, one_row_each)
    if one_row_each:
        counts, frequencies = term_counts(tokens, key, True), term_frequency(tokens, key, True)
    else:
        counts = term_counts(tokens, key)
        counts = written(counts, "term-counts") if with_index else counts
        frequencies = _frequencies(_with_totals(counts, key), key)
    words = _word_totals(counts).select("word", "doc_freq")
    if with_index:
        words = numbered(words, ["word"])
    words = words.withColumn("idf", F.log(documents / F.col("doc_freq")))
    return _weighted(frequencies, words, key, with_index)


class TermIndex(NamedTuple):
    """Counts of documents, each one row, and of words, by batch.

    ``documents``: (batch, key, total_terms, counts), with ``counts`` an array of (word, term_count).
    ``words``: (batch, word, doc_freq, total_times_used).
    """

    key: str
    documents: DataFrame
    words: DataFrame


def add_terms(index: TermIndex | None, tokens: DataFrame, key: str, batch: str) -> TermIndex:
    """The index with one more batch, whose tokens alone are read; a new index where there is none.

    Raises ``ValueError`` when the index has the batch, or one of its documents, already.
    """
    counted = tokens.where(F.col(key).isNull()).select(
        key, F.lit(0).cast("long").alias("total_terms"), F.expr("CAST(array() AS array<struct<word:string,term_count:bigint>>)").alias("counts")
    )
    # A row without a key counts as a document, and no more.
    counted = _counted_in_row(tokens, key).unionByName(counted)
    documents = written(counted.select(F.lit(batch).alias("batch"), "*"), "term-documents")
    counts = documents.select(F.inline("counts")).where("word IS NOT NULL")
    words = written(_word_totals(counts).select(F.lit(batch).alias("batch"), "*"), "term-words")
    if index is None:
        return TermIndex(key, documents, words)
    if not index.documents.where(F.col("batch") == batch).isEmpty():
        raise ValueError(f"the index has a batch {batch!r}")
    twice = documents.select(key).join(index.documents.select(key), key, "left_semi").first()
    if twice:
        raise ValueError(f"the index has a document {twice[0]!r}")
    return TermIndex(key, index.documents.unionByName(documents), index.words.unionByName(words))


def drop_terms(index: TermIndex, batch: str) -> TermIndex:
    """The index without a batch."""
    others = F.col("batch") != batch
    return index._replace(documents=index.documents.where(others), words=index.words.where(others))


def idf_of(index: TermIndex) -> DataFrame:
    """``idf_stats`` of all batches."""
    documents = index.documents.agg(F.count("*")).scalar()
    return (
        _merged_words(index)
        .withColumn("docs_containing_percent", F.col("doc_freq") / documents * 100)
        .withColumn("idf_score", F.log(documents / F.col("doc_freq")))
    )


def _merged_words(index: TermIndex) -> DataFrame:
    return index.words.groupBy("word").agg(
        F.sum("doc_freq").alias("doc_freq"), F.sum("total_times_used").alias("total_times_used")
    )


def tf_idf_of(index: TermIndex, with_index: bool = False) -> DataFrame:
    """``tf_idf`` of all batches: one shuffle of the documents' rarer words, none of common ones and none to count them."""
    documents = index.documents.agg(F.count("*")).scalar()
    words = _merged_words(index).select("word", "doc_freq")
    words = numbered(words, ["word"]) if with_index else written(words, "words")
    words = words.withColumn("idf", F.log(documents / F.col("doc_freq")))
    counts = _each(index.documents, F.inline("counts"), index.key, "total_terms")
    frequencies = counts.select(index.key, "word", (F.col("term_count") / F.col("total_terms")).alias("tf"))
    return _weighted(frequencies, words, index.key, with_index, join_common_apart)


def vector_of(index: TermIndex, document: object) -> DataFrame:
    """``(word, tfidf)`` of one document: only its row is read, and the counts of its words."""
    documents = index.documents.agg(F.count("*")).scalar()
    own = _each(index.documents.where(F.col(index.key) == F.lit(document)), F.inline("counts"), "total_terms")
    own = own.select("word", (F.col("term_count") / F.col("total_terms")).alias("tf"))
    idf = F.log(documents / F.sum("doc_freq"))
    # No more words than one row holds.
    met = index.words.join(F.broadcast(own), "word").groupBy("word", "tf").agg(idf.alias("idf"))
    return met.select("word", (F.col("tf") * F.col("idf")).alias("tfidf")).where("tfidf != 0")


def top_terms_of(index: TermIndex, n: int = 10) -> DataFrame:
    """``top_terms_by_tfidf`` of all batches."""
    return top_terms_by_tfidf(tf_idf_of(index), index.key, n)


def top_tfidf_of(index: TermIndex, n: int = 10) -> DataFrame:
    """``top_tfidf_overall`` of all batches, without weighing all words.

    A weight is at most ``tf`` times the greatest idf that there is. The words of greatest ``tf`` are weighed
    first; the ``n``-th of their weights is a bound that only words with a ``tf`` so high can pass, and those
    alone meet the idf side.
    """
    words = _merged_words(index).select("word", "doc_freq")
    documents = index.documents.agg(F.count("*")).scalar()
    words = written(words.withColumn("idf", F.log(documents / F.col("doc_freq"))), "idf")
    counts = _each(index.documents, F.inline("counts"), index.key, "total_terms")
    frequencies = counts.select(index.key, "word", (F.col("term_count") / F.col("total_terms")).alias("tf"))

    def best(rows: DataFrame) -> DataFrame:
        return top_tfidf_overall(_weighted(rows, words, index.key), index.key, n)

    first = written(frequencies.orderBy(F.desc("tf"), index.key, "word").limit(FIRST_WEIGHED * n), "first-weighed")
    found = first.join(words, "word").agg(F.count("*"), F.max("idf")).first()
    if found[0] < n:
        return best(frequencies)
    least = best(first).agg(F.min("tfidf")).first()[0]
    greatest = words.agg(F.max("idf")).first()[0]
    # A word of tf below this weighs less than what is found already; rounding apart.
    return best(frequencies.where(F.col("tf") * greatest >= least * (1 - 1e-9)))


def _weighted(
    frequencies: DataFrame, words: DataFrame, key: str, with_index: bool = False, join: Callable = join_per_key
) -> DataFrame:
    weighted = join(frequencies, words, "word", weight="doc_freq", spread=key)
    return weighted.select(
        key,
        "word",
        "doc_freq",
        "tf",
        "idf",
        (F.col("tf") * F.col("idf")).alias("tfidf"),
        *(["index"] if with_index else []),
    )


def top_tfidf_overall(weights: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` highest ``tfidf`` rows of the corpus, ties by document and word."""
    return weights.orderBy(F.desc("tfidf"), key, "word").limit(n)


def top_terms_by_tfidf(weights: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` words of highest ``tfidf`` in each document, ties by word, with their ``rank``."""
    return _top_per_document(weights, key, "tfidf", n).select(key, "rank", "word", "tfidf")


def _rows() -> Column:
    return F.count_if(F.col("term_count") > 0)


def _word_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("word").agg(
        _rows().alias("doc_freq"), F.sum("term_count").alias("total_times_used")
    )


def _top_per_document(frame: DataFrame, key: str, score: str, n: int) -> DataFrame:
    """Rank within each document and keep ``n``.

    Spark cuts each map task's rows to ``n`` per document before the shuffle, so a
    document of any size reaches its reducer as ``n`` rows per map task.
    """
    order = Window.partitionBy(key).orderBy(F.desc(score), "word")
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
