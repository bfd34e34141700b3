"""Tokenization rules and text clean-up, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space (what Python's str.isspace accepts), for a regex class, and spelled out.
UNICODE_SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
UNICODE_SPACES = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Markers around the body of an e-book, start markers first.
# They are matched ignoring case, with "." also matching line ends.
BOILERPLATE = [
    r"\*\*\* START OF .+?\*\*\*",
    r"Project Gutenberg's.+?produced by.+?\n\n",
    r"This eBook is for the use of anyone.+?\n\n",
    r"\*\*\* END OF .+?\*\*\*.*",
    r"End of Project Gutenberg.+",
    r"End of the Project Gutenberg.+",
]

# Every pattern above holds one of these, and none of their letters has a case
# variant outside ASCII, so a text with none of them matches no pattern.
_BOILERPLATE_HINTS = ["***", "project gutenberg", " of anyone"]


def lines(text: Column) -> Column:
    """The lines of a text, as a line reader cuts them: a final line end opens no new line."""
    body = F.regexp_replace(text, r"(\r\n|\r|\n)\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(body, r"\r\n|\r|\n")
    )


def blank_separated(text: Column) -> Column:
    """Tokens between runs of space, tab, LF, CR and FF. May hold one empty token at either end."""
    return F.split(text, "[ \t\n\r\f]+")


def without_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{P}", "")


def regex_split(line: Column) -> Column:
    """Split a line on white space, keeping a leading empty token and dropping trailing ones.

    An empty line is one empty token; a line of blanks only has none.
    """
    trimmed = F.rtrim(line, F.lit("\t\n\x0b\f\r "))
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, r"\s+"))
    )


def is_clean_word(word: Column) -> Column:
    """Lower-case letters and apostrophes, with no two apostrophes in a row."""
    return word.rlike("^[a-z']+$") & ~word.contains("''")


def trim_unicode(text: Column) -> Column:
    return F.btrim(text, F.lit(UNICODE_SPACES))


def strip_boilerplate(text: Column) -> Column:
    """Delete e-book start and end markers, then trim.

    The six patterns run only on texts that hold a hint of one of them; plain
    substring search spares the rest six regex passes.
    """
    lowered = F.lower(text)
    hinted = F.lit(False)
    for hint in _BOILERPLATE_HINTS:
        hinted = hinted | lowered.contains(hint)
    stripped = text
    for pattern in BOILERPLATE:
        stripped = F.regexp_replace(stripped, f"(?isu){pattern}", "")
    return trim_unicode(F.when(hinted, stripped).otherwise(text))


def letter_words(text: Column) -> Column:
    """Lower-case runs of three or more letters a-z, in order; anything else separates."""
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda word: F.length(word) >= 3)


def clean_words(text: Column) -> Column:
    """``letter_words`` without stop words, for a whole batch of texts at once."""
    stop_words = english_stop_words()

    @F.arrow_udf("array<string>")
    def words(lowered: pa.Array) -> pa.Array:
        return lowered_words(lowered, stop_words)

    return words(F.lower(text))


def lowered_words(texts: pa.Array, without: Sequence[str]) -> pa.Array:
    """Of each text, its runs of three or more letters a-z, in order, but for those in ``without``."""
    texts = texts.cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    bounds = ends - ends[0]
    letter = (data >= ord("a")) & (data <= ord("z"))
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    # A run ends with its text.
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner], last[inner - 1] = letter[inner], letter[inner - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = stops - starts >= 3
    starts, stops = starts[long], stops[long]
    steps = np.zeros(len(data) + 1, np.int8)
    steps[starts] += 1
    steps[stops] -= 1
    kept = data[np.cumsum(steps[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(kept))
    wanted = pc.invert(pc.is_in(words, value_set=pa.array(without, pa.string()))).to_numpy(zero_copy_only=False)
    places = np.searchsorted(starts[wanted], bounds).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), words.filter(pa.array(wanted)), mask=texts.is_null())


def normalize(text: Column) -> Column:
    """Lower-case words of three or more letters joined by single blanks.

    The same text as lower-casing, blanking everything but letters, deleting words
    of one or two letters and squeezing blanks, in one regex pass instead of six.
    """
    return F.array_join(letter_words(text), " ")


def tokenize(text: Column, min_length: int = 3) -> Column:
    """Lower-case tokens between white space, at least ``min_length`` long."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda word: F.length(word) >= min_length)


def english_stop_words() -> list[str]:
    """Spark's own English list."""
    return StopWordsRemover.loadDefaultStopWords("english")


def remove_stop_words(words: str, lowered: bool = False) -> Column:
    """The token array of a column without stop words, ignoring case and keeping repeats.

    ``lowered`` says that the tokens are lower-case already.
    """
    listed = ", ".join("'" + word.replace("'", "\\'") + "'" for word in english_stop_words())
    word = "word" if lowered else "lower(word)"
    return F.expr(f"filter(`{words}`, word -> {word} NOT IN ({listed}))")
