"""Word counts under several tokenization rules.

Every count is a map-side partial aggregate followed by one shuffle of distinct words,
so a word that makes up a third of the corpus costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import tokens as tk
from lectern.sources.text import Paths, scan_with_split_size


def line_rows(documents: DataFrame, text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """One row ``(*keep, value)`` per line of each document."""
    return exploded(documents, tk.lines(F.col(text)), *keep).withColumnRenamed("word", "value")


def exploded(frame: DataFrame, words: Column, *keep: str) -> DataFrame:
    """One row ``(*keep, word)`` per array element.

    A plain ``explode`` makes the optimizer filter on the array's size first, which would
    tokenize every text once more; the outer form with a null check does not.
    """
    return frame.select(*keep, F.explode_outer(words).alias("word")).where("word IS NOT NULL")


def word_count(frame: DataFrame, text: str = "value") -> DataFrame:
    """``(word, count)`` of blank-separated tokens, case and punctuation kept."""
    return _non_empty(frame, tk.blank_separated(F.col(text))).groupBy("word").count()


def word_frequency_split(lines: DataFrame, text: str = "value") -> DataFrame:
    """``(word, count)`` of a split on white space that keeps leading empty tokens.

    Takes lines: an empty line counts as one empty token.
    """
    return exploded(lines, tk.regex_split(F.col(text))).groupBy("word").count()


def word_count_no_punct(frame: DataFrame, text: str = "value") -> DataFrame:
    """``word_count`` after deleting punctuation; symbols such as ``$`` and ``+`` stay."""
    bare = tk.without_punctuation(F.col(text))
    return _non_empty(frame, tk.blank_separated(bare)).groupBy("word").count()


def clean_words(frame: DataFrame, text: str = "value") -> DataFrame:
    """``(word, count)`` of lower-cased tokens made of letters and single apostrophes only."""
    words = exploded(frame, F.split(F.lower(F.col(text)), r"\s+"))
    return words.where(tk.is_clean_word(F.col("word"))).groupBy("word").count()


def clean_word_count(frame: DataFrame, text: str = "value") -> DataFrame:
    """``clean_words``, commonest first.

    The word is part of the sort key: most words occur once, and a range sort on the
    count alone would send all of those to one task.
    """
    return clean_words(frame, text).orderBy(F.desc("count"), "word")


def top_words(frame: DataFrame, text: str = "value", n: int = 1000) -> DataFrame:
    """The ``n`` commonest clean words, ties by word."""
    return clean_words(frame, text).orderBy(F.desc("count"), "word").limit(n)


def unique_word_count(frame: DataFrame, text: str = "value") -> DataFrame:
    """One row: the number of distinct clean words."""
    return clean_words(frame, text).agg(F.count("*").alias("unique_words"))


def token_pairs(frame: DataFrame, key: str, text: str = "value") -> DataFrame:
    """One row ``(key, word, one)`` per blank-separated token."""
    return _non_empty(frame, tk.blank_separated(F.col(text)), key).withColumn("one", F.lit(1))


def word_count_by_split(
    spark: SparkSession, path: Paths, sizes_mb: Iterable[int] = (1, 2, 4, 8)
) -> DataFrame:
    """``word_count`` of a folder's lines under each split size, with the size as ``split_mb``."""
    runs = [
        word_count(scan_with_split_size(spark, path, size)).select(
            F.lit(size).alias("split_mb"), "word", "count"
        )
        for size in sizes_mb
    ]
    result = runs[0]
    for run in runs[1:]:
        result = result.unionByName(run)
    return result


def _non_empty(frame: DataFrame, words: Column, *keep: str) -> DataFrame:
    return exploded(frame, words, *keep).where(F.col("word") != "")
