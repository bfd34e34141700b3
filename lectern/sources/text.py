"""Scans of a folder of ``.txt`` files.

A file of no bytes has no line. As a document, it is a row like any other: Spark's file sources leave it out,
so it comes from a listing made in tasks (``folders``). That reads local and shared folders and the stores that
Arrow knows; for others pass ``empty_files=False``, and such files are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources import folders

Paths = str | list[str]

TXT = "*.txt"


def scan_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """One row ``(value)`` per line of every ``.txt`` file.

    Raises ``ValueError`` when there is no such file. One line found settles that; the
    names are gathered only where no file holds any.
    """
    lines = spark.read.option("pathGlobFilter", TXT).text(path)
    if lines.isEmpty() and not lines.inputFiles():
        raise ValueError(f"no .txt file in {path}")
    return lines


def scan_with_split_size(spark: SparkSession, path: Paths, megabytes: int) -> DataFrame:
    """``scan_lines`` with input splits of at most ``megabytes``.

    The split size belongs to a session of its own on the same Spark application, so
    the frame stays lazy and the caller's setting is never touched.
    """
    return scan_lines(session_with_split_size(spark, megabytes), path)


def session_with_split_size(spark: SparkSession, megabytes: int) -> SparkSession:
    """A session that cuts at the size given, not finer to fill the cores."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.files.maxPartitionBytes", f"{megabytes}m")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    return session


def file_key(pattern: str | None = None) -> Column:
    """The base name of a row's input file, or group 1 of ``pattern`` in its path."""
    if pattern is None:
        return F.col("_metadata.file_name")
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def _listed_key(pattern: str | None) -> Column:
    """The same from a listed path."""
    if pattern is None:
        # In a path, a plus sign is no blank.
        return F.url_decode(F.replace(F.regexp_extract("path", "[^/]*$", 0), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract("path", pattern, 1)


def with_file_name(scan: DataFrame, pattern: str | None = None) -> DataFrame:
    """Add ``file_name``, the name of a row's input file without ``.txt``.

    ``scan`` must come straight from a file source. ``pattern`` takes the key from
    elsewhere in the path, such as a folder name.
    """
    name = file_key(pattern)
    return scan.withColumn("file_name", F.regexp_replace(name, r"\.txt$", ""))


def scan_documents(
    spark: SparkSession, path: Paths, pattern: str | None = None, empty_files: bool = True
) -> DataFrame:
    """One row ``(file_name, text, size_bytes)`` per ``.txt`` file that is valid UTF-8, empty ones included.

    Line ends become LF. ``skipped_documents`` lists the files left out.
    """
    found = (
        _whole_files(spark, path, pattern)
        .where(F.is_valid_utf8(F.col("content").cast("string")))
        .select(
            "file_name",
            F.regexp_replace(F.col("content").cast("string"), r"\r\n?", "\n").alias("text"),
            F.col("length").alias("size_bytes"),
        )
    )
    if not empty_files:
        return found
    empty = folders.empty_files(spark, path, ".txt")
    return found.unionByName(
        empty.select(
            _listed_key(pattern).alias("file_name"), F.lit("").alias("text"), F.lit(0).cast("long").alias("size_bytes")
        )
    )


def skipped_documents(spark: SparkSession, path: Paths, pattern: str | None = None) -> DataFrame:
    """Names and sizes of the ``.txt`` files that ``scan_documents`` leaves out, for a log."""
    return (
        _whole_files(spark, path, pattern)
        .where(~F.is_valid_utf8(F.col("content").cast("string")))
        .select("file_name", F.col("length").alias("size_bytes"))
    )


def source_listing(
    spark: SparkSession, path: Paths, pattern: str | None = None, empty_files: bool = True
) -> DataFrame:
    """Name and size in MB of every input file, empty ones included; contents are not read."""
    if empty_files:
        files, name = folders.folder_listing(spark, path), _listed_key(pattern)
    else:
        files, name = spark.read.format("binaryFile").load(path), file_key(pattern)
    return files.select(name.alias("file_name"), megabytes(F.col("length")).alias("size_mb"))


def megabytes(size_bytes: Column) -> Column:
    return F.round(size_bytes / 1048576, 2)


def _whole_files(spark: SparkSession, path: Paths, pattern: str | None) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", TXT).load(path)
    return files.select(file_key(pattern).alias("file_name"), "content", "length")
