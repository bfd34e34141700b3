"""Quality rules: fixed base rules, and fences learned per language and source.

Each document's rates are counted in whole numbers and sketched per (language, source): counts
in bins a sixteenth wide, relative to the value. Such sketches merge by adding counts, whichever
task made them, so quartiles are the same on every run. A rate's fence lies three spreads beyond
the upper quartile (for the word length, also below the lower one); the spread is the distance
of the quartiles, or a smallest spread where a group is all alike. To the group's sketch comes
that of its language, scaled to the weight of PRIOR_DOCUMENTS documents: a group of few documents is
judged much as its language, one of many by its own, and no number of documents changes the rule. Then the
fences are joined to the documents.

Defined cases: a null text has no words and fails. A null language or source is a group of its
own. Repeated rows are judged alike. An empty table gives no rows. Sketches hold the documents
that pass the base rules; where a group has none, nothing is left to judge. Very long texts
are counted whole. Other columns are not looked at, whatever their names; kept rows keep theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import text_bytes, whole_row, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SPREADS = 3
PRIOR_DOCUMENTS = 20
# A document's weight, so that shares of a language's sketch are whole numbers.
UNITS = 10_000

# Rate: (numerator, factor, denominator, smallest spread, fenced below too).
RATES = {
    "symbols": ("n_symbols", 1000, "n_words", 100, False),
    "dup_lines": ("n_dup_lines", 1000, "n_lines", 150, False),
    "repeats": ("n_repeat_words", 1000, "n_words", 120, False),
    "capitals": ("n_capitals", 1000, "n_letters", 100, False),
    "word_length": ("word_chars", 100, "n_words", 150, True),
}

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_letters",
)
SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = CAPITALS + CAPITALS.lower()


def repeat_words(words: list[bytes]) -> int:
    """Words within three-word windows that occur twice or more in the text."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(word, len(seen)) for word in words], np.int64)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, places, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[places] >= 2
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The counts, in the order of COUNTS."""
    data = text_bytes(text)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    without = data.translate(None, SYMBOLS)
    bare = b"".join(words)
    return (
        len(words),
        len(bare.decode()),
        len(data) - len(without),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(data) - len(data.translate(None, CAPITALS)),
        len(data) - len(data.translate(None, LETTERS)),
    )


def _counts_of(texts: pa.Array) -> pa.Array:
    rows = np.array([measure(text) for text in texts.to_pylist()], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(column) for column in rows.T], names=list(COUNTS))


# Not marked deterministic, or the optimizer would measure texts once for every rate and filter.
counts_of = F.arrow_udf(
    _counts_of, T.StructType([T.StructField(name, T.LongType()) for name in COUNTS])
).asNondeterministic()


def base_failed(counts: str = "counts") -> Column:
    words, repeats = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def _rate(name: str, counts: str = "counts") -> Column:
    """A whole number; 0 where there is nothing to divide by."""
    top, factor, bottom, *_ = RATES[name]
    over, under = F.col(f"{counts}.{top}") * factor, F.col(f"{counts}.{bottom}")
    return F.when(under > 0, F.floor(over / under)).otherwise(F.lit(0)).cast("long")


def sketch_bin(value: Column) -> Column:
    """Values below 16 each; above, sixteen bins for each doubling."""
    exponent = F.length(F.bin(value)) - 1
    step = F.call_function("shiftright", value, exponent - 4).bitwiseAND(15)
    return F.when(value < 16, value).otherwise((exponent - 3) * 16 + step).cast("int")


def bin_low(bin_: Column) -> Column:
    doubling = F.floor(bin_ / 16)
    low = F.call_function("shiftleft", (bin_ % 16 + 16).cast("long"), (doubling - 1).cast("int"))
    return F.when(bin_ < 16, bin_.cast("long")).otherwise(low)


def rate_sketches(measured: DataFrame) -> DataFrame:
    """``(lang, source, rate, bin, n)``: mergeable; add ``n`` to merge two."""
    judged = measured.where(~base_failed())
    rates = F.array(*[F.struct(F.lit(n).alias("rate"), sketch_bin(_rate(n)).alias("bin")) for n in RATES])
    return (
        judged.select("lang", "source", F.inline(rates)).groupBy("lang", "source", "rate", "bin").agg(F.count("*").alias("n"))
    )


def _weighed(sketches: DataFrame) -> DataFrame:
    """``(lang, source, rate, bin, weight)``: each group's sketch with its language's added.

    A language has a few hundred bins a rate at most, whatever its documents; each of its groups takes them all.
    """
    whole = Window.partitionBy("lang", "rate")
    share = F.call_function("div", F.col("n") * (PRIOR_DOCUMENTS * UNITS), F.sum("n").over(whole))
    prior = (
        sketches.groupBy("lang", "rate", "bin")
        .agg(F.sum("n").alias("n"))
        .select(F.col("lang").alias("_lang"), "rate", "bin", share.alias("weight"))
    )
    groups = sketches.select("lang", "source").distinct()
    added = groups.join(prior, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang")
    own = sketches.withColumn("weight", F.col("n") * UNITS).drop("n")
    return own.unionByName(added).groupBy("lang", "source", "rate", "bin").agg(F.sum("weight").alias("weight"))


def _quartiles(sketches: DataFrame) -> DataFrame:
    group = Window.partitionBy("lang", "source", "rate")
    upto = F.sum("weight").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    placed = _weighed(sketches).select("*", upto.alias("upto"), F.sum("weight").over(group).alias("total"))
    return placed.groupBy("lang", "source", "rate").agg(
        F.min(F.when(4 * F.col("upto") >= F.col("total"), bin_low(F.col("bin")))).alias("lower"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), bin_low(F.col("bin") + 1) - 1)).alias("upper"),
    )


def fences(sketches: DataFrame) -> DataFrame:
    """``(lang, source, fences)``: per group, the greatest and least rate that stays."""
    # Read three times below; a few hundred rows a group.
    sketches = written(sketches, "sketches")
    limits = []
    for name, (*_, smallest, below) in RATES.items():
        spread = F.greatest(F.col("upper") - F.col("lower"), F.lit(smallest)) * SPREADS
        here = F.col("rate") == name
        limits.append(F.max(F.when(here, F.col("upper") + spread)).alias(f"{name}_most"))
        if below:
            limits.append(F.max(F.when(here, F.col("lower") - spread)).alias(f"{name}_least"))
    return _quartiles(sketches).groupBy("lang", "source").agg(*limits).select(
        "lang", "source", F.struct(F.col("*")).dropFields("lang", "source").alias("fences")
    )


def _within() -> Column:
    verdict = ~base_failed()
    for name, (*_, below) in RATES.items():
        verdict &= _rate(name) <= F.col(f"fences.{name}_most")
        if below:
            verdict &= _rate(name) >= F.col(f"fences.{name}_least")
    return F.coalesce(verdict, F.lit(False))


def _judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Fences are written first: small ones are broadcast by their size, large ones are not."""
    limits = written(limits, "fences").withColumnsRenamed({"lang": "_lang", "source": "_source"})
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    return measured.join(limits, same, "left").withColumn("kept", _within())


def quality_verdicts(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
) -> DataFrame:
    """``(doc_id, lang, source, counts, fences, base_failed, kept)``, one row per document."""
    measured = written(
        documents.select(
            F.col(id_column).alias("doc_id"),
            F.col(lang_column).alias("lang"),
            F.col(source_column).alias("source"),
            counts_of(F.col(text_column)).alias("counts"),
        ),
        "quality",
    )
    judged = _judged(measured, fences(rate_sketches(measured)))
    return judged.select(
        "doc_id", "lang", "source", "counts", "fences", base_failed().alias("base_failed"), "kept"
    )


def good_documents(
    documents: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source"
) -> DataFrame:
    """The documents' own rows and columns that are kept.

    Texts are measured twice, for the sketches and for the verdict, which costs less than
    writing or shuffling them.
    """
    measured = documents.select(
        whole_row(),
        F.col(lang_column).alias("lang"),
        F.col(source_column).alias("source"),
        counts_of(F.col(text_column)).alias("counts"),
    )
    limits = fences(rate_sketches(measured.select("lang", "source", "counts")))
    return _judged(measured, limits).where("kept").select("row.*")
