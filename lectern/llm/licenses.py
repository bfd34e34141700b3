"""Licence scans: one Aho-Corasick pass for notice phrases and tags, expressions by shunting-yard.

A text becomes words: ASCII lower case, cut at every other ASCII character. One automaton finds
all phrases, overlaps included. Where it finds an identifier tag, the expression after the tag is
read from the text itself, over line ends inside brackets, and evaluated: ``or`` is a choice, so the freer side counts; ``and``
binds to both, so the stricter side counts; ``with`` adds an exception to the licence before it.

Score: how free the licences found leave a reader, the least over notices and expressions; 0 where none was
found. Defined cases: a null or empty text has no words. A malformed expression gives no labels.
An identifier that is not known keeps its own name and scores UNKNOWN. Repeated rows are scanned
alike. Very long texts are scanned whole. Other columns are not looked at, whatever their names. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import text_bytes

# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notices: names, and how the bodies of the usual licences begin.
NOTICES = {
    "apache license 2 0": "apache-2",
    "artistic license": "artistic",
    "boost software license": "boost",
    "bsd 2 clause license": "bsd",
    "bsd 3 clause license": "bsd",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "cc0 1 0 universal": "cc0",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "zlib license": "zlib",
}
# Opens free licences as well, and so counts only where nothing else is found.
RESERVED = "all rights reserved"
TAG = "spdx license identifier"
TAG_TEXT = re.compile(rb"spdx-license-identifier:?[ \t]*", re.IGNORECASE)
COMMENT = re.compile(rb"^(?:[#;%*!]+|//+|--+|/\*+|<!--)?[ \t]*")

# How free: 1 permissive, less for each duty.
FREEDOM = {
    "mit": 1.0, "apache-2": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "boost": 1.0, "unlicense": 1.0, "cc0": 1.0,
    "cc-by": 0.9, "artistic": 0.8, "mpl": 0.7, "epl": 0.6, "lgpl": 0.6, "eupl": 0.5, "cc-by-sa": 0.5, "gpl": 0.4,
    "gfdl": 0.4, "agpl": 0.3, "cc-by-nc": 0.2, "proprietary": 0.0,
}
UNKNOWN = 0.1
EXCEPTION = 0.1

# What identifiers of a family are called, in lower case; a version or a variant may follow.
FAMILIES = {
    "agpl": "agpl", "apache-2": "apache-2", "artistic": "artistic", "bsd": "bsd", "bsl-1": "boost", "cc-by-nc": "cc-by-nc",
    "cc-by-sa": "cc-by-sa", "cc-by": "cc-by", "cc0": "cc0", "epl": "epl", "eupl": "eupl", "gfdl": "gfdl", "gpl": "gpl",
    "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "unlicense", "zlib": "zlib",
}
IDENTIFIER = re.compile(rf"({'|'.join(sorted(FAMILIES, key=len, reverse=True))})(?=$|[-.+]|v?[0-9])")

WORD_TABLE = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 32
    for byte in range(256)
)
TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*")
BINDS = {"or": 1, "and": 2, "with": 3}


class Terms(NamedTuple):
    labels: frozenset[str]
    freedom: float


def label_of(identifier: str) -> str:
    """The family of an identifier, if its name is one, alone or before a version; else the name."""
    low = identifier.lower()
    family = IDENTIFIER.match(low)
    return FAMILIES[family[1]] if family else low


def evaluate(expression: str) -> Terms | None:
    """The terms of an expression, or None if it is malformed; text after it is not read."""
    values: list[Terms] = []
    operators: list[str] = []
    operand_next, depth = True, 0

    def apply(operator: str) -> None:
        right, left = values.pop(), values.pop()
        if operator == "with":
            values.append(Terms(left.labels, min(1.0, left.freedom + EXCEPTION)))
        else:
            choose = max if operator == "or" else min
            values.append(Terms(left.labels | right.labels, choose(left.freedom, right.freedom)))

    for token in TOKEN.findall(expression):
        low = token.lower()
        if operand_next:
            if low == "(":
                operators.append(low)
                depth += 1
            elif low == ")" or low in BINDS:
                return None
            else:
                label = label_of(token)
                values.append(Terms(frozenset([label]), FREEDOM.get(label, UNKNOWN)))
                operand_next = False
        elif low == ")" and depth:
            while operators[-1] != "(":
                apply(operators.pop())
            operators.pop()
            depth -= 1
        elif low in BINDS:
            while operators and operators[-1] != "(" and BINDS[operators[-1]] >= BINDS[low]:
                apply(operators.pop())
            operators.append(low)
            operand_next = True
        else:
            break
    if operand_next or depth:
        return None
    while operators:
        apply(operators.pop())
    return values[0]


def expression_at(data: bytes, start: int) -> str:
    """The rest of the line, and while a bracket is open the next ones, without comment marks.

    An empty line or another tag ends it.
    """
    pieces: list[bytes] = []
    depth = 0
    while start <= len(data):
        end = data.find(b"\n", start)
        end = len(data) if end < 0 else end
        line = data[start:end].strip()
        if pieces:
            line = COMMENT.sub(b"", line)
            if not line or TAG_TEXT.search(line):
                break
        pieces.append(line)
        depth += line.count(b"(") - line.count(b")")
        if depth <= 0:
            break
        start = end + 1
    return b" ".join(pieces).decode("utf-8", "replace")


@cache
def automaton() -> ahocorasick.Automaton:
    """All phrases between blanks; text and phrases are bytes read as Latin-1."""
    found = ahocorasick.Automaton()
    for phrase in (*BASE, *NOTICES, RESERVED, TAG):
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


class Scan(NamedTuple):
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: str
    labels: str
    score: float


def scan(text: str | None) -> Scan:
    data = text_bytes(text)
    words = data.translate(WORD_TABLE).split()
    line = b" ".join([b"", *words, b""]).decode("latin-1")
    base_at: list[int] = []
    base, labels, scores, tagged, reserved = set(), set(), [], False, False
    for end, phrase in automaton().iter(line):
        if phrase in BASE:
            base_at.append(end - len(phrase) - 1)
            base.add(BASE[phrase])
        tagged |= phrase == TAG
        reserved |= phrase == RESERVED
        label = BASE.get(phrase) or NOTICES.get(phrase)
        if label and label not in labels:
            labels.add(label)
            scores.append(FREEDOM[label])
    if tagged:
        for match in TAG_TEXT.finditer(data):
            terms = evaluate(expression_at(data, match.end()))
            if terms:
                labels |= terms.labels
                scores.append(terms.freedom)
    if reserved and not labels:
        labels.add("proprietary")
        scores.append(FREEDOM["proprietary"])
    starts = [None, None]
    if base_at:
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        starts = np.searchsorted(blanks, [min(base_at), max(base_at)]).tolist()
    return Scan(
        len(words), len(base_at), *starts, ",".join(sorted(base)), ",".join(sorted(labels)), min(scores, default=0.0)
    )


SCAN = T.StructType(
    [T.StructField(name, T.LongType()) for name in Scan._fields[:4]]
    + [T.StructField(name, T.StringType()) for name in Scan._fields[4:6]]
    + [T.StructField("score", T.DoubleType())]
)


@F.arrow_udf(SCAN)
def scan_of(texts: pa.Array) -> pa.Array:
    columns = list(zip(*map(scan, texts.to_pylist()), strict=True)) or [[] for _ in Scan._fields]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    return pa.StructArray.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(Scan._fields)
    )


def license_scan(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per document."""
    found = documents.select(F.col(id_column).alias("doc_id"), scan_of(F.col(text_column)).alias("found"))
    return found.select("doc_id", "found.*")
