"""Sinks. Each writes one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(frame: DataFrame, path: str) -> None:
    """Overwrite a CSV folder, without a header line."""
    frame.write.mode("overwrite").csv(path)


def write_parquet(frame: DataFrame, path: str) -> None:
    """Overwrite a parquet folder."""
    frame.write.mode("overwrite").parquet(path)


def write_tsv_sorted(counts: DataFrame, path: str) -> None:
    """Write ``word<TAB>count`` lines in word order; fails if the path exists.

    Words are distinct, so the range sort gives even parts whatever their counts.
    """
    line = F.concat_ws("\t", "word", "count").alias("value")
    counts.orderBy("word").select(line).write.mode("errorifexists").text(path)
