"""Registered queries: one per operator, over whole tables.

Scores are rounded in the last projection only. Arrays are shown as joined strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import cleaning, lookup, metadata, network, similarity, terms, wordcount
from lectern.plans import views
from lectern.plans.views import books, books_by, books_marked, documents, kept_lookup, kept_terms, kept_weights
from lectern.sources import sinks, text
from lectern.sources.scratch import scratch_path, written

Query = Callable[[SparkSession, str], DataFrame]

SPLIT_SIZES_MB = (1, 2, 4, 8)
FIND_SIMILAR_TARGET = 0

# Entries to a chunk of a source's vector.
VECTOR_CHUNK = 256

# Sources share little but common words; documents are alike from here on.
SOURCE_SIMILARITY = 0.05
DOCUMENT_SIMILARITY = 0.8


def rounded(frame: DataFrame, **places: int) -> DataFrame:
    return frame.withColumns({name: F.round(name, digits) for name, digits in places.items()})


# Sources and sinks


def scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.scan_lines(spark, views.text_folder(spark, sf_dir))


def scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.scan_documents(spark, views.volume_folder(spark, sf_dir), views.VOLUME_KEY)


def with_file_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = text.scan_lines(spark, views.volume_folder(spark, sf_dir))
    keyed = text.with_file_name(lines, views.VOLUME_KEY)
    return keyed.groupBy("file_name").agg(F.count("*").alias("lines"))


def source_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.source_listing(spark, views.volume_folder(spark, sf_dir), views.VOLUME_KEY)


def skipped_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.skipped_documents(spark, views.volume_folder(spark, sf_dir, broken=True), views.VOLUME_KEY)


def write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metadata-csv")
    result = metadata.header_metadata(books(spark, sf_dir))
    sinks.write_csv(result, path)
    # The reader takes an empty field for null; the operator has no nulls.
    return spark.read.schema(result.schema).csv(path).na.fill("")


def write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens-parquet")
    sinks.write_parquet(doc_tokens(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "doc_id", F.array_join("filtered_words", " ").alias("filtered_words")
    )


def write_tsv_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "counts-tsv")
    sinks.write_tsv_sorted(wordcount.word_count_no_punct(documents(spark, sf_dir), "text"), path)
    return spark.read.text(path)


def scan_with_split_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = views.text_folder(spark, sf_dir)
    result = None
    for size in SPLIT_SIZES_MB:
        scan = text.scan_with_split_size(spark, folder, size).select(
            F.lit(size).alias("split_mb"), F.length("value").alias("length")
        )
        result = scan if result is None else result.unionByName(scan)
    return result.groupBy("split_mb").agg(
        F.count("*").alias("lines"), F.sum("length").alias("characters")
    )


# Word counts


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.word_count(documents(spark, sf_dir), "text")


def word_frequency_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.word_frequency_split(wordcount.line_rows(documents(spark, sf_dir)))


def word_count_no_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.word_count_no_punct(documents(spark, sf_dir), "text")


def clean_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.clean_word_count(documents(spark, sf_dir), "text")


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.top_words(documents(spark, sf_dir), "text")


def unique_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.unique_word_count(documents(spark, sf_dir), "text")


def token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.token_pairs(documents(spark, sf_dir), "doc_id", "text")


def word_count_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordcount.word_count_by_split(spark, views.text_folder(spark, sf_dir), SPLIT_SIZES_MB)


# Header metadata


def header_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.header_metadata(books(spark, sf_dir))


def header_metadata_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.header_metadata(books(spark, sf_dir), unit="document")


def _over_metadata(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(header_metadata(spark, sf_dir))

    return query


def title_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metadata.title_length_stats(header_metadata(spark, sf_dir)), avg_length=6)


def metadata_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.metadata_row_counts(books(spark, sf_dir))


def book_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.book_profile(author_date(spark, sf_dir))


# Cleaning


def strip_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.strip_boilerplate(books_marked(spark, sf_dir))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_text(documents(spark, sf_dir)).select("doc_id", "cleaned_text")


def _tokenized(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = cleaning.strip_boilerplate(books_marked(spark, sf_dir))
    return cleaning.tokenize(cleaning.normalize_text(stripped))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tokenized(spark, sf_dir).select("doc_id", F.array_join("words", " ").alias("words"))


def remove_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.remove_stop_words(_tokenized(spark, sf_dir)).select(
        "doc_id", F.array_join("filtered_words", " ").alias("filtered_words")
    )


def filter_effect_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = cleaning.filter_effect_stats(cleaning.remove_stop_words(_tokenized(spark, sf_dir)))
    return rounded(stats, avg_words_before=6, avg_words_after=6)


# Term weights


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_tokens(documents(spark, sf_dir), "doc_id")


def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(terms.term_frequency(doc_tokens(spark, sf_dir), "doc_id", one_row_each=True), tf=6)


def top_terms_by_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(terms.top_terms_by_tf(doc_tokens(spark, sf_dir), "doc_id", one_row_each=True), tf=6)


def _idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.idf_of(kept_terms(spark, sf_dir))


def _rounded_idf(frame: DataFrame) -> DataFrame:
    return rounded(frame, docs_containing_percent=6, idf_score=6)


def idf_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_idf(_idf(spark, sf_dir))


def most_common_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_idf(terms.most_common_words(_idf(spark, sf_dir)))


def rarest_shared_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_idf(terms.rarest_shared_words(_idf(spark, sf_dir)))


def _rounded_weights(frame: DataFrame) -> DataFrame:
    shown = frame.select("doc_id", "word", "tf", "idf", "tfidf")
    return rounded(shown, tf=6, idf=6, tfidf=6)


def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_weights(terms.tf_idf_of(kept_terms(spark, sf_dir)))


def top_tfidf_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_weights(terms.top_tfidf_of(kept_terms(spark, sf_dir)))


def top_terms_by_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(terms.top_terms_of(kept_terms(spark, sf_dir)), tfidf=6)


# Vectors and similarity


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.vocabulary(terms.token_words(doc_tokens(spark, sf_dir)))


def vocabulary_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.vocabulary_size(terms.token_words(doc_tokens(spark, sf_dir)))


def _shown(vectors: DataFrame, *columns: str) -> DataFrame:
    shown = F.transform("values", lambda value: value.cast("decimal(18,6)").cast("string"))
    return vectors.select(
        *columns,
        F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
        F.array_join(shown, ",").alias("values"),
    )


def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(similarity.tfidf_vectors(kept_weights(spark, sf_dir, "doc_id"), "doc_id"), "doc_id", "size")


def tfidf_vector_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = similarity.tfidf_vector_chunks(kept_weights(spark, sf_dir, "source"), "source", VECTOR_CHUNK)
    return _shown(chunks, "source", "chunk")


def pairwise_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = similarity.pairwise_cosine(kept_weights(spark, sf_dir, "source"), "source", SOURCE_SIMILARITY)
    return rounded(pairs, similarity=4)


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.similar_documents(kept_weights(spark, sf_dir, "doc_id"), "doc_id", DOCUMENT_SIMILARITY)


def most_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.most_similar_pairs(kept_weights(spark, sf_dir, "source"), "source")


def similarity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = similarity.similarity_stats(kept_weights(spark, sf_dir, "source"), "source")
    return rounded(stats, average_similarity=4, min_similarity=4, max_similarity=4)


def least_similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.least_similar_pairs(kept_weights(spark, sf_dir, "source"), "source")


def vector_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = similarity.vector_stats(kept_weights(spark, sf_dir, "doc_id"), "doc_id")
    return rounded(stats, mean_tfidf=6, max_tfidf=6, sparsity=6)


def find_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.nearest_documents(kept_lookup(spark, sf_dir), FIND_SIMILAR_TARGET)


# Author network


def author_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.author_date(books(spark, sf_dir))


def author_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.author_dates(network.author_date(books_by(spark, sf_dir)))


def influence_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.influence_edges(author_dates(spark, sf_dir))


def influence_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.influence_classes(written(author_dates(spark, sf_dir), "dates"))


def influence_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.influence_members(author_dates(spark, sf_dir))


def influence_of_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = written(author_dates(spark, sf_dir), "dates")
    classes, members = network.influence_classes(dates), network.influence_members(dates)
    return network.edges_of_classes(classes, members, dates.agg(F.min("author").alias("author")))


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network.author_gaps(author_dates(spark, sf_dir))


def _over_gaps(operator: Callable[[DataFrame], DataFrame], **places: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(operator(_gaps(spark, sf_dir)), **places)

    return query


def _over_degrees(operator: Callable[[DataFrame], DataFrame], **places: int) -> Query:
    return _over_gaps(lambda gaps: operator(network.degree_metrics(gaps)), **places)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in [
        scan_lines, scan_documents, skipped_documents, with_file_name, source_listing,
        write_csv, write_parquet, write_tsv_sorted, scan_with_split_size,
        word_count, word_frequency_split, word_count_no_punct, clean_word_count,
        top_words, unique_word_count, token_pairs, word_count_by_split,
        header_metadata, header_metadata_by_document, title_length_stats,
        metadata_row_counts, book_profile,
        strip_boilerplate, normalize_text, tokenize, remove_stop_words, filter_effect_stats,
        term_frequency, top_terms_by_tf, idf_stats, most_common_words, rarest_shared_words,
        tf_idf, top_tfidf_overall, top_terms_by_tfidf,
        vocabulary, vocabulary_size, tfidf_vectors, tfidf_vector_chunks, pairwise_cosine, most_similar_pairs,
        similar_documents, similarity_stats, least_similar_pairs, vector_stats, find_similar,
        author_date, author_dates, influence_edges, influence_classes, influence_members, influence_of_author,
    ]
} | {
    "releases_per_year": _over_metadata(metadata.releases_per_year),
    "release_year_stats": _over_metadata(metadata.release_year_stats),
    "top_release_years": _over_metadata(metadata.top_release_years),
    "language_counts": _over_metadata(metadata.language_counts),
    "language_summary": _over_metadata(metadata.language_summary),
    "title_length_histogram": _over_metadata(metadata.title_length_histogram),
    "missing_field_report": _over_metadata(metadata.missing_field_report),
    "influencer_stats": _over_gaps(network.influencer_stats),
    "influenced_stats": _over_gaps(network.influenced_stats),
    "year_gap_stats": _over_gaps(network.year_gap_stats, avg_years=6),
    "network_summary": _over_gaps(network.network_summary, mean=6, std=6),
    "degree_metrics": _over_gaps(network.degree_metrics),
    "degree_top_in": _over_degrees(network.degree_top_in),
    "degree_top_out": _over_degrees(network.degree_top_out),
    "degree_top_total": _over_degrees(network.degree_top_total),
    "degree_stats": _over_degrees(network.degree_stats, avg_in_degree=6, avg_out_degree=6),
}
