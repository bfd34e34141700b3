"""Header fields, authors and dates found in the text of a book, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.tokens import UNICODE_SPACE, trim_unicode

# Header label, and the pattern that reads its field.
HEADER_FIELDS = {
    "title": ("Title:", r"Title:\s*([^\n]+)"),
    "release_date": ("Release Date:", r"Release Date:\s*(\w+\s+\d{1,2},\s*\d{4})"),
    "language": ("Language:", r"Language:\s*(\w+)"),
    "encoding": ("Character set encoding:", r"Character set encoding:\s*(\w+[-\w]*)"),
}

# The words that introduce an author, and the white space after them, in the
# order they are tried. ("written by" comes last, but "by" already matches wherever it does.)
AUTHOR_CUES = [("by", f"[{UNICODE_SPACE}]+"), ("Author:", f"[{UNICODE_SPACE}]*")]
AUTHOR_NAME = rf"[\p{{L}}\p{{N}}_.{UNICODE_SPACE}]+"

# Fixed value: the first run of four digits is the date; longer date forms hold one too.
DATE = r"\p{Nd}{4}"


def header_field(text: Column, field: str) -> Column:
    """The field's first value, or ``""``."""
    return F.regexp_extract(text, HEADER_FIELDS[field][1], 1)


def may_hold_header(text: Column) -> Column:
    """Whether any header label occurs: a substring search, far cheaper than the patterns."""
    found = F.lit(False)
    for label, _ in HEADER_FIELDS.values():
        found = found | text.contains(label)
    return found


def cue_matches(text: Column) -> list[Column]:
    """The first match of each author cue with its name, or ``""``."""
    return [
        F.regexp_extract(text, f"(?i){cue}{space}{AUTHOR_NAME}", 0) for cue, space in AUTHOR_CUES
    ]


def author(matches: list[Column]) -> Column:
    """The author named by the first cue that matched, else ``Unknown``.

    A cue followed by blanks only ends the search. Cutting the cue's word off its match
    and trimming leaves the name, so each pattern runs over a text once.
    """
    named = F.lit("")
    for match, (cue, _) in reversed(list(zip(matches, AUTHOR_CUES))):
        named = F.when(match != "", F.substring(match, len(cue) + 1, 2**31 - 1)).otherwise(named)
    return or_unknown(trim_unicode(named))


def first_date(text: Column) -> Column:
    """The first run of four digits, or ``""``."""
    return F.regexp_extract(text, DATE, 0)


def or_unknown(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("Unknown"))


def parse_date(text: Column) -> Column:
    """A date from ``yyyy``, ``Month d, yyyy``, ``m/d/yyyy`` or ``yyyy-m-d``, else null.

    The shapes exclude each other, and guard against longer years that a Spark date
    pattern would accept.
    """
    squeezed = F.regexp_replace(text, r"\s+", " ")
    return (
        F.when(squeezed.rlike(r"\A[0-9]{4}\z"), F.try_to_date(squeezed, "yyyy"))
        .when(squeezed.rlike(r"\A\p{L}+ [0-9]{1,2}, [0-9]{4}\z"), F.try_to_date(squeezed, "MMMM d, yyyy"))
        .when(squeezed.rlike(r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"), F.try_to_date(squeezed, "M/d/yyyy"))
        .when(squeezed.rlike(r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"), F.try_to_date(squeezed, "yyyy-M-d"))
    )
