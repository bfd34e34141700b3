"""Text cleaning as operators over a table of documents. All are row by row, with no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import tokens as tk


def strip_boilerplate(documents: DataFrame, text: str = "text") -> DataFrame:
    """Delete e-book start and end markers from ``text``. Meant for whole documents."""
    return documents.withColumn(text, tk.strip_boilerplate(F.col(text)))


def normalize_text(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add ``cleaned_text``: lower-case words of three or more letters, single-blanked."""
    return documents.withColumn("cleaned_text", tk.normalize(F.col(text)))


def tokenize(cleaned: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """Add ``words``: the lower-cased tokens of three or more letters."""
    return cleaned.withColumn("words", tk.tokenize(F.col(text)))


def remove_stop_words(tokenized: DataFrame, words: str = "words") -> DataFrame:
    """Add ``filtered_words``: ``words`` without English stop words."""
    return tokenized.withColumn("filtered_words", tk.remove_stop_words(words))


def filter_effect_stats(filtered: DataFrame) -> DataFrame:
    """One row: mean number of words per row before and after stop words go."""
    return filtered.agg(
        F.avg(F.size("words")).alias("avg_words_before"),
        F.avg(F.size("filtered_words")).alias("avg_words_after"),
    )


def clean_tokens(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, filtered_words)``: the four steps above in one, without the text between them."""
    return documents.select(key, tk.clean_words(tk.strip_boilerplate(F.col(text))).alias("filtered_words"))
