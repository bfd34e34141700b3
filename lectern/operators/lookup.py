"""A written inverted index for looking up the documents nearest to one of them.

Three tables: postings (word, key, tfidf), bucketed by word, of which a lookup reads the buckets of the
target's words; vectors, the same rows in ranges of the key, of which it reads the target's, or a ``TermIndex``, which has them by document
already; and the norms of all documents, apart, so that no weights are read to scale a product. Words with many postings are written by several
tasks, each into the word's bucket.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.similarity import MAX_TARGET_WORDS, PLACES
from lectern.operators.terms import TermIndex, vector_of
from lectern.sources.scratch import scratch_path, written

BUCKETS = 1024
POSTINGS_PER_TASK = 1_000_000

# A target's words up to this number are put into the scan's filter, which prunes buckets.
MAX_FILTER_WORDS = 10_000


class LookupIndex(NamedTuple):
    key: str
    postings: DataFrame
    vectors: DataFrame | TermIndex
    norms: DataFrame


def build_lookup(
    weights: DataFrame, key: str, buckets: int = BUCKETS, table: str | None = None, counts: TermIndex | None = None
) -> LookupIndex:
    """Write the index of ``tf_idf`` weights. ``table`` names the postings in the catalog.

    With ``counts``, the term index that the weights are made from, a target's vector is taken from its row there, and the
    weights are not sorted by document. Choose ``buckets`` well above the words of a usual target, or its words are in all of them.
    """
    spark = weights.sparkSession
    name = table or f"postings_{uuid.uuid4().hex}"
    present = weights.where("tfidf != 0")
    tasks = F.ceil(F.col("doc_freq") / POSTINGS_PER_TASK)
    # The writer's own bucket, so that a bucket is one file, and one more for each task of a frequent word.
    bucket = F.pmod(F.hash("word"), F.lit(buckets))
    (
        present.withColumn("_bucket", bucket)
        .withColumn("_task", F.pmod(F.xxhash64(key), tasks))
        .repartition("_bucket", "_task")
        .select("word", key, "tfidf")
        .write.format("parquet")
        .bucketBy(buckets, "word")
        .sortBy("word")
        .option("path", scratch_path(spark, "postings"))
        .saveAsTable(name)
    )
    if counts is None:
        vectors = written(present.select(key, "word", "tfidf").repartitionByRange(key).sortWithinPartitions(key), "vectors")
    else:
        vectors = counts
    squares = F.sqrt(F.coalesce(F.sum(F.when(F.col("tfidf") != 0, F.col("tfidf") ** 2)), F.lit(0.0)))
    norms = weights.groupBy(key).agg(squares.alias("norm"))
    norms = written(norms.repartitionByRange(key).sortWithinPartitions(key), "norms")
    return LookupIndex(key, spark.table(name), vectors, norms)


def target_words(index: LookupIndex, target: object) -> DataFrame:
    """``(word, wanted)`` of the target. Raises ``ValueError`` when the index does not have it."""
    if index.norms.where(F.col(index.key) == F.lit(target)).isEmpty():
        raise ValueError(f"{target!r} not found")
    if isinstance(index.vectors, TermIndex):
        own = written(vector_of(index.vectors, target), "target")
    else:
        own = index.vectors.where(F.col(index.key) == F.lit(target))
    return own.select("word", F.col("tfidf").alias("wanted"))


def products(index: LookupIndex, target: object) -> DataFrame:
    """``(key, dot)`` of all other documents that share a word with the target.

    Up to ``MAX_FILTER_WORDS`` words of the target go to the scan as a filter, so that only their buckets are read.
    """
    wanted = target_words(index, target)
    words = [row.word for row in wanted.select("word").limit(MAX_FILTER_WORDS + 1).collect()]
    postings = index.postings
    if len(words) <= MAX_FILTER_WORDS:
        postings = postings.where(F.col("word").isin(words))
        wanted = F.broadcast(wanted)
    elif wanted.limit(MAX_TARGET_WORDS + 1).count() <= MAX_TARGET_WORDS:
        wanted = F.broadcast(wanted)
    return (
        postings.where(F.col(index.key) != F.lit(target))
        .join(wanted, "word")
        .groupBy(index.key)
        .agg(F.sum(F.col("tfidf") * F.col("wanted")).alias("dot"))
    )


def nearest_documents(index: LookupIndex, target: object, top_n: int = 5) -> DataFrame:
    """As ``find_similar``: the ``top_n`` documents nearest ``target`` by cosine, ties by key.

    Documents that share no word with it score 0. They are only looked for among the norms where fewer than
    ``top_n`` score more, and of them the first ``top_n`` by key suffice.
    """
    key = index.key
    own = index.norms.where(F.col(key) == F.lit(target)).select("norm")
    others = index.norms.where(F.col(key) != F.lit(target))
    cosine = F.least(F.col("dot") / (F.col("norm") * own.scalar()), F.lit(1.0))
    scored = written(
        products(index, target)
        .join(others, key)
        .select(key, F.round(cosine, PLACES).alias("similarity"))
        .where("similarity > 0")
        .orderBy(F.desc("similarity"), key)
        .limit(top_n),
        "nearest",
    )
    if scored.count() < top_n:
        # Fewer rows than top_n are above 0, and all of them are here.
        rest = others.join(F.broadcast(scored), key, "left_anti").orderBy(key).limit(top_n)
        scored = scored.unionByName(rest.select(key, F.lit(0.0).alias("similarity")))
    return scored.orderBy(F.desc("similarity"), key).limit(top_n)
