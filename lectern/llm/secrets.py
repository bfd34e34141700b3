"""Secret scans: three patterns, and windows of high Shannon entropy in candidate strings.

A candidate is a longest run of 16 or more letters, digits and ``+/_=-``. A window of 20
characters slides over it; its counts change by one character in and one out, and so does its
entropy. What a window must reach depends on its character class: hexadecimal, one case with
digits, or mixed case with digits. Windows with fewer digits, and candidates shorter than a window,
which are one themselves, count by their share of the greatest entropy, unless their letters follow
each other as in words. Windows of digits alone never count, and neither does a candidate on the
allow list (UUIDs, runs of the alphabet, paths of words). Windows that overlap or touch make one
span, of the kind ``entropy``. What a pattern covers is taken out of it; the stretches beside the
pattern stay, except those of whole words and separators.

Defined cases: a null or empty text has no spans. Repeated rows are scanned alike. Positions
are code points, ends exclusive. Very long texts are scanned whole. Other columns are not looked at, whatever
their names; masked rows keep theirs. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import hex_digest, whole_row

# The patterns of the base kinds and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 16
HEX = re.compile(r"[0-9a-f]+")
HEX_LENGTH = 32
KINDS = ("assign", "access", "hex", "entropy")

KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
WINDOW = 20

# Least bits per character by class, and least digits; a random window has about 3.4 (hexadecimal) to 4.1.
CLASSES = {"hex": (3.0, 4), "one_case": (3.6, 4), "mixed": (3.8, 2)}

# Least share of the entropy of all different characters, whatever the digits and the window's length.
SHARES = {"hex": 0.62, "one_case": 0.75, "mixed": 0.82}

# The 130 commonest pairs of letters in English text, four in five of all; of random pairs they are one in five.
PAIRS = frozenset(
    """ab ac ad ag ai al am an ap ar as at ca ce ch ck cl co ct da de di du ea ec ed ee ef el em en ep er es et ex fa fi
    fo fr ge gs ha he hi ho ic il im in io is it ke la le lf li ll lo ls lt lu ma me mo mp na nc nd ne ng ni no ns nt ob
    oc od ol om on op or os ot ou pa pe pl po pr pt ra re rg ri rn ro rr rs rt ry se si sp ss st su ta te th ti to tr ts
    tu ty ue ul um un ur us ut va ve wi xt yp""".split()
)
WORD_SHARE, WORD_PAIRS = 0.5, 4
# Letters in the form of one long word, which prose of any language has.
ONE_WORD_SHARE = 0.25

ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?i:[0-9a-f]*0123456789abcdef[0-9a-f]*|.*abcdefghijklmnop.*)"),
    re.compile(r"[A-Za-z]*([/_=-]+([A-Za-z]+|[0-9]+))+[/_=-]*"),
    re.compile(r"(.{1,8})\1{2,}.{0,7}"),
)

# What may stand beside a pattern's span without being part of a secret: ``commit/``, ``my_``, ``--``.
# Each part takes all it can and gives nothing back, or long runs of letters would be tried in every way.
PLAIN = re.compile(r"(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[+/_=-]++)*+")

MASK = "[SECRET]"


class Span(NamedTuple):
    start: int
    order: int
    end: int

    def text(self) -> str:
        return f"{KINDS[self.order]}:{self.start}:{self.end}"


def _class_of(counts: Counter) -> str | None:
    """The class of the window's characters, by how many there are of each."""
    digits = counts["digit"]
    lower, upper = counts["low_hex"] + counts["low"], counts["up_hex"] + counts["up"]
    if not digits or not lower + upper:
        return None
    if not counts["low"] + counts["up"] + counts["other"] and not (lower and upper):
        return "hex"
    return "mixed" if lower and upper else "one_case"


def _group(char: str) -> str:
    if char.isdigit():
        return "digit"
    if not char.isalpha():
        return "other"
    return ("low" if char.islower() else "up") + ("_hex" if char in "abcdefABCDEF" else "")


_TERMS = [0.0] + [count * math.log2(count) for count in range(1, WINDOW + 1)]


def _slide(candidate: str, size: int) -> Iterator[tuple[int, float, Counter]]:
    """Each window's start, entropy, and counts by group of characters and of letter pairs."""
    chars, groups, total = Counter(), Counter(), 0.0
    pairs = [_pair(candidate[at : at + 2]) for at in range(len(candidate) - 1)]
    for at, char in enumerate(candidate):
        if at >= size:
            out = candidate[at - size]
            chars[out] -= 1
            total += _TERMS[chars[out]] - _TERMS[chars[out] + 1]
            groups[_group(out)] -= 1
            groups[pairs[at - size]] -= 1
        chars[char] += 1
        total += _TERMS[chars[char]] - _TERMS[chars[char] - 1]
        groups[_group(char)] += 1
        if at:
            groups[pairs[at - 1]] += 1
        if at >= size - 1:
            yield at - size + 1, math.log2(size) - total / size, groups


def _pair(pair: str) -> str:
    if not pair.isalpha():
        return "no_pair"
    return "common_pair" if pair.lower() in PAIRS else "rare_pair"


def _spans(starts: Iterable[int], size: int) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for start in starts:
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], start + size)
        else:
            spans.append((start, start + size))
    return spans


def random_windows(candidate: str) -> list[tuple[int, int]]:
    """Spans of the candidate covered by windows of high entropy and enough digits."""
    if len(candidate) < WINDOW or any(rule.fullmatch(candidate) for rule in ALLOWED):
        return []

    def counts(entropy: float, groups: Counter) -> bool:
        kind = _class_of(groups)
        return bool(kind) and entropy >= CLASSES[kind][0] and groups["digit"] >= CLASSES[kind][1]

    return _spans((at for at, *window in _slide(candidate, WINDOW) if counts(*window)), WINDOW)


def unlike_words(candidate: str) -> list[tuple[int, int]]:
    """Spans covered by windows of high entropy, few digits or none, whose letters make no words."""
    if any(rule.fullmatch(candidate) for rule in ALLOWED):
        return []
    size = min(WINDOW, len(candidate))
    most = math.log2(size)

    def counts(entropy: float, groups: Counter) -> bool:
        # A digit more, so that letters alone have a class too.
        kind = _class_of(groups + Counter(digit=1))
        common, rare = groups["common_pair"], groups["rare_pair"]
        upper, lower = groups["up_hex"] + groups["up"], groups["low_hex"] + groups["low"]
        one_word = upper + lower == size and min(upper, lower) <= 1
        words = common >= max(WORD_PAIRS, (ONE_WORD_SHARE if one_word else WORD_SHARE) * (common + rare))
        return bool(kind) and not words and entropy >= SHARES[kind] * most

    return _spans((at for at, *window in _slide(candidate, size) if counts(*window)), size)


def entropy_spans(candidate: str) -> list[tuple[int, int]]:
    """Both rules' spans; those that touch are one."""
    spans: list[tuple[int, int]] = []
    for start, end in sorted(random_windows(candidate) + unlike_words(candidate)):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def find_secrets(text: str | None) -> list[Span]:
    """All spans, by start, then kind as listed."""
    if not text:
        return []
    base: list[Span] = []
    low = text.lower()
    # A lowered text holds a keyword wherever the text does; it only tells whether to look.
    if any(keyword in low for keyword in KEYWORDS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= ASSIGN_VALUE:
                base.append(Span(match.start(), 0, match.end()))
    extra: list[Span] = []
    # Runs of the other kinds lie within a candidate, as their characters are a candidate's too.
    for candidate in CANDIDATE.finditer(text):
        run, offset = candidate[0], candidate.start()
        for order, pattern, least in ((1, ACCESS, ACCESS_LENGTH), (2, HEX, HEX_LENGTH)):
            for match in pattern.finditer(run):
                if match.end() - match.start() >= least:
                    base.append(Span(offset + match.start(), order, offset + match.end()))
        extra += [Span(offset + start, 3, offset + end) for start, end in entropy_spans(run)]
    base.sort()
    return sorted(base + _apart(extra, base, text))


def _apart(extra: list[Span], base: list[Span], text: str) -> list[Span]:
    """Their stretches outside the base spans; both are sorted by start."""
    out, at, reach = [], 0, 0
    for span in extra:
        pieces, start = [], max(span.start, reach)
        while at < len(base) and base[at].start < span.end:
            pieces.append((start, base[at].start))
            reach = max(reach, base[at].end)
            start = max(start, reach)
            at += 1
        for begin, end in [*pieces, (start, span.end)]:
            whole = (begin, end) == (span.start, span.end)
            if begin < end and (whole or not PLAIN.fullmatch(text, begin, end)):
                out.append(Span(begin, 3, end))
    return out


FOUND = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_assign", "n_access", "n_hex")]
    + [T.StructField(name, T.StringType()) for name in ("base_sha256", "spans")]
    + [T.StructField("n_entropy", T.LongType())]
)


@F.arrow_udf(FOUND)
def secrets_of(texts: pa.Array) -> pa.Array:
    rows = []
    for text in texts.to_pylist():
        spans = find_secrets(text)
        counts = Counter(span.order for span in spans)
        base = ",".join(span.text() for span in spans if span.order < 3)
        every = ",".join(span.text() for span in spans)
        rows.append((counts[0], counts[1], counts[2], hex_digest(base.encode()), every, counts[3]))
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
    return pa.StructArray.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=FOUND.names
    )


def masked(text: str | None) -> str | None:
    """The text with each stretch of spans replaced by MASK."""
    spans = find_secrets(text)
    if not spans:
        return text
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


@F.arrow_udf(T.StringType())
def masked_of(texts: pa.Array) -> pa.Array:
    return pa.array([masked(text) for text in texts.to_pylist()], pa.string())


def secret_spans(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy)`` per document."""
    found = documents.select(F.col(id_column).alias("doc_id"), secrets_of(F.col(text_column)).alias("found"))
    return found.select("doc_id", "found.*")


def without_secrets(
    documents: DataFrame, text_column: str = "text", length_column: str = "n_chars"
) -> DataFrame:
    """All rows and columns, secrets masked; ``length_column``, if there is one, follows the text."""
    rows = documents.select(whole_row(), masked_of(F.col(text_column)).alias("_masked"))
    changed = F.col("row").withField(text_column, F.col("_masked"))
    if length_column in documents.columns:
        length = F.length("_masked").cast(documents.schema[length_column].dataType)
        given = F.col("row").getField(length_column)
        same = F.col("_masked").eqNullSafe(F.col("row").getField(text_column))
        changed = changed.withField(length_column, F.when(same, given).otherwise(length))
    return rows.select(changed.alias("row")).select("row.*")
