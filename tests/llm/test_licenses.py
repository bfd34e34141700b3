import random
import re

import pytest

from lectern.llm.licenses import BASE, evaluate, label_of, license_scan, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")
    words = WORD.findall(low)
    places = []
    for phrase, label in BASE.items():
        own = phrase.split()
        places += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


TEXTS = [
    None,
    "",
    "Released under the MIT License. Under the mit-license! Not under the mit licenses",
    "Apache License, Version 2.0 and Apache license version 20",
    "CC BY-NC CC BY NC cc by nc nd cc_by_nc ccbync éunder the mit license under the mit licenseé",
    "under the mit license under the mit license",
    "UNDER THE\x00MIT\nLICENSE Kelvin İ",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base(text):
    assert tuple(scan(text))[:5] == brute(text)


def test_random_words():
    rng = random.Random(1)
    parts = ["under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "é", ".", "\n"]
    for _ in range(300):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        assert tuple(scan(text))[:5] == brute(text)


@pytest.mark.parametrize(
    "expression, labels, freedom",
    [
        ("MIT", {"mit"}, 1.0),
        ("GPL-3.0-only OR MIT", {"gpl", "mit"}, 1.0),
        ("GPL-3.0-only AND MIT", {"gpl", "mit"}, 0.4),
        ("MIT OR GPL-2.0 AND AGPL-3.0", {"mit", "gpl", "agpl"}, 1.0),
        ("(MIT OR GPL-2.0) AND AGPL-3.0", {"mit", "gpl", "agpl"}, 0.3),
        ("GPL-2.0-only WITH Classpath-exception-2.0 OR CC-BY-NC-4.0", {"gpl", "cc-by-nc"}, 0.5),
        ("mit and ((apache-2.0 or LGPL-2.1))", {"mit", "apache-2", "lgpl"}, 1.0),
        ("Odd-1.0", {"odd-1.0"}, 0.1),
        ("MIT */ more words", {"mit"}, 1.0),
    ],
)
def test_expressions(expression, labels, freedom):
    terms = evaluate(expression)
    assert terms.labels == labels and terms.freedom == pytest.approx(freedom)


@pytest.mark.parametrize("expression", ["", "AND MIT", "MIT OR", "(MIT", "()", "MIT AND )"])
def test_malformed(expression):
    assert evaluate(expression) is None


def test_tags_add_labels():
    found = scan("// SPDX-License-Identifier: (GPL-2.0 OR BSD-3-Clause)\nunder the MIT license")
    assert (found.base_labels, found.labels, found.score) == ("mit", "bsd,gpl,mit", 1.0)
    assert scan("GNU General Public License, version 3").labels == "gpl"


def test_rights_reserved_open_free_licences_too():
    header = "Copyright 2020 A. All rights reserved.\n\nBSD 3-Clause License\n"
    assert (scan(header).labels, scan(header).score) == ("bsd", 1.0)
    body = "All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted"
    assert (scan(body).labels, scan(body).score) == ("bsd", 1.0)
    assert (scan("All rights reserved.").labels, scan("All rights reserved.").score) == ("proprietary", 0.0)


@pytest.mark.parametrize(
    "identifier, label",
    [
        ("MIT", "mit"), ("MIT-0", "mit"), ("Mitre", "mitre"), ("mitigate-1.0", "mitigate-1.0"), ("GPLv3", "gpl"), ("GPL-3.0+", "gpl"),
        ("BSD-3-Clause", "bsd"), ("bsdiff", "bsdiff"), ("Apache-2.0", "apache-2"), ("Apache-20", "apache-2"), ("CC-BY-4.0", "cc-by"),
        ("CC-BY-SA-4.0", "cc-by-sa"), ("CC-BY-NC-ND-4.0", "cc-by-nc"), ("ISC", "isc"), ("BSL-1.0", "boost"), ("iscsi", "iscsi"),
    ],
)
def test_identifiers_are_matched_whole(identifier, label):
    assert label_of(identifier) == label


def test_expressions_over_comment_lines():
    tag = "SPDX-License-Identifier: (MIT OR"
    for mark in ("# ", "// ", " * ", "-- ", ""):
        assert scan(f"{mark}{tag}\n{mark}  GPL-2.0-only)\n{mark}rest AND MPL-2.0").labels == "gpl,mit"
    assert scan(f"# {tag}\n#\n# GPL-2.0-only)").labels == ""
    assert scan(f"# {tag}\r\n# (AGPL-3.0\r\n# AND ISC))\r\n").labels == "agpl,isc,mit"
    assert scan(f"# {tag}\n# SPDX-License-Identifier: ISC").labels == "isc"
    assert scan(f"{tag}").labels == ""
    assert scan("SPDX-License-Identifier: (\n" * 20_000).labels == ""


def test_query_against_brute_force(answer, documents):
    texts = {d.doc_id: d.text for d in documents}
    got = answer("op3_licenses")
    assert len(got) == len(documents) and sum(r.n_base for r in got)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_rows(spark):
    rows = [(1, "under the mit license", "a"), (1, "under the mit license", "a"), (None, None, None), (2, "x y " * 200_000, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    assert sorted((r.doc_id or 0, r.n_words, r.labels, r.score) for r in license_scan(frame).collect()) == [
        (0, 0, "", 0.0), (1, 4, "mit", 1.0), (1, 4, "mit", 1.0), (2, 400_000, "", 0.0),
    ]
    assert license_scan(frame.limit(0)).count() == 0
