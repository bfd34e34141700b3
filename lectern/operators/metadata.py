"""Header metadata of books, and statistics over it.

``header_metadata`` reads lines or whole documents; the rest take its result. All of
them reduce to a few rows per map task before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import headers
from lectern.operators.wordcount import line_rows

FIELDS = list(headers.HEADER_FIELDS)


def header_metadata(books: DataFrame, text: str = "text", unit: str = "line") -> DataFrame:
    """Title, release date, language and encoding, ``""`` where absent.

    With ``unit="line"`` each line is read on its own, so a row mostly holds one field;
    with ``unit="document"`` a row is one book. Rows without any field are dropped.
    """
    value = F.col("value")
    found = (
        _values(books, text, unit)
        .where(headers.may_hold_header(value))
        .select(*[headers.header_field(value, field).alias(field) for field in FIELDS])
    )
    return found.where(" OR ".join(f"{field} != ''" for field in FIELDS))


def releases_per_year(metadata: DataFrame) -> DataFrame:
    """``(year, count)`` over release dates with a year from 1000 to 2999, by year."""
    return _year_counts(metadata).orderBy("year")


def release_year_stats(metadata: DataFrame) -> DataFrame:
    """One row ``(total_books, earliest_year, latest_year)``."""
    return _year_counts(metadata).agg(
        F.sum("count").alias("total_books"),
        F.min("year").alias("earliest_year"),
        F.max("year").alias("latest_year"),
    )


def top_release_years(metadata: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` years with most books, ties by year."""
    return _year_counts(metadata).orderBy(F.desc("count"), "year").limit(n)


def language_counts(metadata: DataFrame) -> DataFrame:
    """``(language, count)``, commonest first."""
    return _language_counts(metadata).orderBy(F.desc("count"), "language")


def language_summary(metadata: DataFrame) -> DataFrame:
    """One row: the commonest language (ties: first by name), its count, and the total."""
    best = F.min(F.struct((-F.col("count")).alias("minus_count"), "language"))
    return (
        _language_counts(metadata)
        .agg(best.alias("best"), F.sum("count").alias("total_books"))
        .select(
            F.col("best.language").alias("top_language"),
            (-F.col("best.minus_count")).alias("top_count"),
            "total_books",
        )
    )


def title_length_stats(metadata: DataFrame) -> DataFrame:
    """One row of average, least and greatest title length, and the number of titles."""
    return _title_lengths(metadata).agg(
        F.avg("title_length").alias("avg_length"),
        F.min("title_length").alias("min_length"),
        F.max("title_length").alias("max_length"),
        F.count("title_length").alias("total_titles"),
    )


def title_length_histogram(metadata: DataFrame, width: int = 10) -> DataFrame:
    """``(length_range, count)``: titles by length, rounded down to a multiple of ``width``."""
    bucket = (F.col("title_length") / width).cast("int") * width
    return (
        _title_lengths(metadata)
        .groupBy(bucket.alias("length_range"))
        .count()
        .orderBy("length_range")
    )


def missing_field_report(metadata: DataFrame) -> DataFrame:
    """One row: for each column, how many values are null or ``""``."""
    return metadata.agg(
        *[
            F.count_if(F.col(name).isNull() | (F.col(name) == "")).alias(f"missing_{name}")
            for name in metadata.columns
        ]
    )


def metadata_row_counts(books: DataFrame, text: str = "text", unit: str = "line") -> DataFrame:
    """One row: rows read, and rows with any metadata."""
    value = F.col("value")
    any_field = F.lit(False)
    for field in FIELDS:
        any_field = any_field | (headers.header_field(value, field) != "")
    return _values(books, text, unit).agg(
        F.count("*").alias("rows_read"),
        F.count_if(headers.may_hold_header(value) & any_field).alias("rows_with_metadata"),
    )


def book_profile(books: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null count, and the number of books."""
    names = books.columns
    counted = books.agg(
        F.count("*").alias("total_books"),
        *[F.count(F.col(name)).alias(f"n{i}") for i, name in enumerate(names)],
    )
    types = dict(books.dtypes)
    profile = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(types[name]).alias("data_type"),
                F.col(f"n{i}").alias("non_null_count"),
            )
            for i, name in enumerate(names)
        ]
    )
    return counted.select("total_books", F.inline(profile)).select(
        "column_name", "data_type", "non_null_count", "total_books"
    )


def _values(books: DataFrame, text: str, unit: str) -> DataFrame:
    if unit == "line":
        return line_rows(books, text)
    if unit == "document":
        return books.select(F.col(text).alias("value"))
    raise ValueError(f"unit must be 'line' or 'document', not {unit!r}")


def _year_counts(metadata: DataFrame) -> DataFrame:
    # The patterns of a year and of the years that count.
    year = F.regexp_extract("release_date", r"\d{4}", 0)
    return (
        metadata.select(year.alias("year"))
        .where(F.col("year").rlike("^[12][0-9]{3}$"))
        .groupBy("year")
        .count()
    )


def _language_counts(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("language") != "").groupBy("language").count()


def _title_lengths(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("title") != "").select(F.length("title").alias("title_length"))
