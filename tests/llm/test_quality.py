import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.llm import quality
from lectern.llm.quality import bin_low, good_documents, measure, quality_verdicts, sketch_bin

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


TEXTS = [None, "", " \n\t", "a", "a b c", "a b c a b c", "a a a a a", "x y\nx y\n\n \nx y", "é ü ñ\x0b#$", "a b c d " * 3 + "a b", "#*$%&|<> " * 40]


@pytest.mark.parametrize("text", TEXTS + ["w " * 5000 + " ".join(map(str, range(30_000)))])
def test_counts(text):
    got = dict(zip(quality.COUNTS, measure(text), strict=True))
    assert tuple(got[name] for name in NAMES) == brute_counts(text)


def test_sketch_bins_are_in_order_and_contain_their_values(spark):
    values = [*range(70), 127, 128, 1000, 1001, 123_456, 2**40]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", sketch_bin(F.col("v")).alias("b"), bin_low(sketch_bin(F.col("v"))).alias("low"), bin_low(sketch_bin(F.col("v")) + 1).alias("next")
    )
    got = sorted(map(tuple, rows.collect()))
    assert all(low <= v < after and after - low <= max(1, low / 16) for v, _, low, after in got)
    assert [b for _, b, *_ in got] == sorted(b for _, b, *_ in got)


def python_bin(value):
    if value < 16:
        return value
    exponent = value.bit_length() - 1
    return (exponent - 3) * 16 + (value >> (exponent - 4) & 15)


def python_low(b):
    return b if b < 16 else (b % 16 + 16) << (b // 16 - 1)


def brute_verdicts(rows):
    """rows: (key, lang, source, text) -> {key: (base_failed, kept)}"""
    measured = {key: dict(zip(quality.COUNTS, measure(text), strict=True)) for key, _, _, text in rows}
    failed = {k: m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] for k, m in measured.items()}

    def rates(m):
        return {n: m[top] * by // m[under] if m[under] else 0 for n, (top, by, under, *_) in quality.RATES.items()}

    def bins(keys, name):
        return Counter(python_bin(rates(measured[k])[name]) for k in keys)

    def quartiles(group, language, name):
        """Of the group's bins, with the language's at the weight of so many documents."""
        wide = bins(language, name)
        weight = Counter({b: n * quality.PRIOR_DOCUMENTS * quality.UNITS // wide.total() for b, n in wide.items()})
        for b, n in bins(group, name).items():
            weight[b] += n * quality.UNITS
        upto, ends = 0, []
        for b in sorted(weight):
            upto += weight[b]
            ends.append((b, upto))
        low = next(b for b, n in ends if 4 * n >= upto)
        high = next(b for b, n in ends if 4 * n >= 3 * upto)
        return python_low(low), python_low(high + 1) - 1

    out = {}
    for key, lang, source, _ in rows:
        kept = not failed[key]
        group = [k for k, la, so, _ in rows if (la, so) == (lang, source) and not failed[k]]
        language = [k for k, la, _, _ in rows if la == lang and not failed[k]]
        for name, (*_, smallest, below) in quality.RATES.items() if kept else ():
            low, high = quartiles(group, language, name)
            spread = 3 * max(high - low, smallest)
            rate = rates(measured[key])[name]
            kept &= rate <= high + spread and not (below and rate < low - spread)
        out[key] = (failed[key], kept)
    return out


def test_query_against_brute_force(answer, documents):
    want = brute_verdicts([(d.doc_id, d.lang, d.source, d.text) for d in documents])
    texts = {d.doc_id: d.text for d in documents}
    got = answer("op7_quality")
    assert len(got) == len(documents)
    for row in got:
        assert tuple(row[name] for name in NAMES) == brute_counts(texts[row.doc_id])
        assert (row.base_failed, row.kept) == want[row.doc_id]


def prose(rng, n=80):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(n))


def test_fences_adapt_to_the_group(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng), "en", "books") for i in range(150)]
    rows += [(1000 + i, "# " * 60 + prose(rng), "en", "tables") for i in range(150)]
    rows += [(2000, "# " * 60 + prose(rng), "en", "books"), (2001, prose(rng), None, None), (None, None, None, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_verdicts(frame).collect()}
    assert all(kept[i] for i in range(150)) and all(kept[1000 + i] for i in range(150))
    assert (kept[2000], kept[2001], kept[None]) == (False, True, False)


def test_no_number_of_documents_reverses_the_verdict(spark):
    """A clean source of its own kind beside much prose in the same language."""
    shares = []
    for number in (60, 99, 100, 101):
        rng = random.Random(number)
        rows = [(i, prose(rng), "en", "books") for i in range(300)]
        rows += [(1000 + i, "# " * 60 + prose(rng), "en", "tables") for i in range(number)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
        shares.append(sum(r.kept for r in quality_verdicts(frame).collect() if r.doc_id >= 1000) / number)
    assert shares == [1.0] * 4


def test_kept_documents_keep_their_columns(spark):
    rng = random.Random(2)
    rows = [(1, prose(rng), "en", "s", 5, "c"), (1, "short", "en", "s", 5, "c"), (2, "%&" * 90 + prose(rng), "en", None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept int, counts string")
    out = good_documents(frame)
    assert out.schema == frame.schema
    kept = list(map(tuple, out.collect()))
    assert rows[0] in kept and rows[1] not in kept


def test_very_long_text_is_counted_whole(spark):
    text = "\n".join(f"line {i} of many" for i in range(100_000)) + "\nline 7 of many"
    frame = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
    counts = quality_verdicts(frame).first().counts
    assert (counts.n_words, counts.n_dup_lines) == (400_004, 1)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_verdicts(frame).count() == 0 and good_documents(frame).count() == 0
