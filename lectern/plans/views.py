"""Inputs of the registered queries, all built from whole driver tables.

``documents`` has no book headers and no boilerplate, so three views add them. Folders of
text files, clean tokens and term weights are written to shared scratch space once per
application, and anew when the table's files change; ``scratch.release`` removes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import cleaning, lookup, terms
from lectern.sources.scratch import drop_shuffles, scratch_path
from lectern.sources.tables import scan_table, table_state

# Documents to a file, where a query reads files whole.
VOLUME = 100
VOLUME_KEY = r"volume=([^/]+)/"

# Buckets of the inverted index; few, for tables of the scale they are tried at.
LOOKUP_BUCKETS = 64

# Of so many volumes, the one with number BROKEN is written with bytes that are not UTF-8.
BROKEN_OF = 2
BROKEN = 1

_kept: dict[tuple[str, str, str], tuple[tuple, str]] = {}
_indexes: dict[str, terms.TermIndex | lookup.LookupIndex] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/documents.parquet")


def _headed(spark: SparkSession, sf_dir: str, credit: str) -> DataFrame:
    """Documents with a title by ``p_partkey`` and a date and author by ``o_orderkey``, where there are any."""
    orders = scan_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate", "o_custkey")
    part = scan_table(spark, f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    # The narrow sides first, so that texts are joined once.
    heads = orders.join(part, F.col("o_orderkey") == F.col("p_partkey"), "full").withColumn(
        "key", F.coalesce("o_orderkey", "p_partkey")
    )

    def known(column: Column) -> Column:
        return F.coalesce(column, F.lit(""))

    return (
        documents(spark, sf_dir)
        .join(heads, F.col("key") == F.col("doc_id"), "left")
        .select(
            F.concat(F.lit("book"), F.col("doc_id").cast("string")).alias("file_name"),
            F.concat(
                F.lit("Title: "), known(F.col("p_name")),
                F.lit("\nRelease Date: "), known(F.date_format("o_orderdate", "MMMM d, yyyy")),
                F.lit("\nLanguage: "), known(F.col("lang")),
                F.lit("\nCharacter set encoding: UTF-8\n"),
                F.lit(f"{credit} Customer "), known(F.col("o_custkey").cast("string")),
                F.lit(";\n*** START OF THIS BOOK ***\n"),
                known(F.col("text")),
            ).alias("text"),
        )
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file_name, text)``: each document under a book header."""
    return _headed(spark, sf_dir, "Author:")


def books_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``books``, the author named by the cue that is tried first, before any in the text."""
    return _headed(spark, sf_dir, "by")


def books_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``: each document between start and end markers, of three kinds in turn."""
    starred = F.concat(
        F.lit("Front matter\n*** START OF THIS BOOK ***\n"), "text",
        F.lit("\n*** END OF THIS BOOK ***\nBack matter"),
    )
    anyone = F.concat(
        F.lit("This eBook is for the use of anyone anywhere.\n\n"), "text",
        F.lit("\nEnd of the Project Gutenberg book\nBack matter"),
    )
    produced = F.concat(
        F.lit("Project Gutenberg's Book, produced by Volunteers\n\n"), "text",
        F.lit("\nEnd of Project Gutenberg book\nBack matter"),
    )
    kind = F.col("doc_id") % 3
    marked = F.when(kind == 0, starred).when(kind == 1, anyone).otherwise(produced)
    return documents(spark, sf_dir).select("doc_id", marked.alias("text"))


def text_folder(spark: SparkSession, sf_dir: str) -> str:
    """The texts of ``documents`` as lines of ``.txt`` files, many documents to a file."""

    def write(path: str) -> None:
        documents(spark, sf_dir).select("text").write.text(path)

    return kept(spark, sf_dir, "lines", write)


def volume_folder(spark: SparkSession, sf_dir: str, broken: bool = False) -> str:
    """The texts of ``documents`` as one ``.txt`` file per ``VOLUME`` documents, in order.

    Spark names files itself, so a volume's number is in the name of its folder. With ``broken``,
    every text of some volumes begins with two bytes that are not UTF-8.
    """
    text = F.col("text")
    if broken:
        spoilt = F.concat(F.unhex(F.lit("C328")), text.cast("binary")).cast("string")
        text = F.when(F.col("volume") % BROKEN_OF == BROKEN, spoilt).otherwise(text)

    def write(path: str) -> None:
        (
            documents(spark, sf_dir)
            .select("doc_id", "text", F.expr(f"doc_id div {VOLUME}").alias("volume"))
            .repartition("volume")
            .sortWithinPartitions("volume", "doc_id")
            .select("volume", text.alias("text"))
            .write.partitionBy("volume")
            .text(path)
        )

    return kept(spark, sf_dir, "broken-volumes" if broken else "volumes", write)


def kept_tokens(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Clean tokens, written once: every operator that reads them twice reads no text."""

    def write(path: str) -> None:
        cleaning.clean_tokens(documents(spark, sf_dir), key).write.parquet(path)

    return scan_table(spark, kept(spark, sf_dir, f"tokens-{key}", write))


def kept_terms(spark: SparkSession, sf_dir: str) -> terms.TermIndex:
    """The documents' counts and those of their words, written once."""
    made: list[terms.TermIndex] = []

    def write(path: str) -> None:
        # Of the tokens only keys are read a second time, so they are not written.
        tokens = cleaning.clean_tokens(documents(spark, sf_dir), "doc_id")
        made.append(terms.add_terms(None, tokens, "doc_id", sf_dir))

    slot = kept(spark, sf_dir, "terms", write)
    if made:
        _indexes[slot] = made[0]
    return _indexes[slot]


def kept_weights(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Term weights with the words' numbers, written once for all queries that pass over them.

    ``tfidf``, which takes as much space as all other columns, is multiplied again as they are read.
    """

    def write(path: str) -> None:
        if key == "doc_id":
            weights = terms.tf_idf_of(kept_terms(spark, sf_dir), with_index=True)
        else:
            weights = terms.tf_idf(kept_tokens(spark, sf_dir, key), key, with_index=True)
        with drop_shuffles(spark):
            weights.drop("tfidf").write.option("compression", "zstd").parquet(path)

    kept_columns = scan_table(spark, kept(spark, sf_dir, f"weights-{key}", write))
    return kept_columns.select(key, "word", "doc_freq", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"), "index")


def kept_lookup(spark: SparkSession, sf_dir: str) -> lookup.LookupIndex:
    """The inverted index over the weights by document, written once."""
    made: list[lookup.LookupIndex] = []

    def write(path: str) -> None:
        weights, counts = kept_weights(spark, sf_dir, "doc_id"), kept_terms(spark, sf_dir)
        made.append(lookup.build_lookup(weights, "doc_id", LOOKUP_BUCKETS, counts=counts))

    slot = kept(spark, sf_dir, "lookup", write)
    if made:
        _indexes[slot] = made[0]
    return _indexes[slot]


def kept(spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]) -> str:
    """The folder that ``write`` has made for this application and the table's present files."""
    slot = (spark.sparkContext.applicationId, sf_dir, label)
    state = table_state(spark, f"{sf_dir}/documents.parquet")
    if slot not in _kept or _kept[slot][0] != state:
        path = scratch_path(spark, label)
        write(path)
        _kept[slot] = (state, path)
    return _kept[slot][1]


def forget(spark: SparkSession) -> None:
    """Make everything anew next time; for use with ``scratch.release``."""
    for slot in [slot for slot in _kept if slot[0] == spark.sparkContext.applicationId]:
        del _kept[slot]
