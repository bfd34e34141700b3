import math
import random
import zlib

import numpy as np
import pytest

from lectern.llm import langid
from lectern.llm.langid import UNDETERMINED, fit, identify_languages, predict, train, windows


def test_windows():
    assert windows(b"").shape == (1, 256) and windows(b"x" * 256).shape == (1, 256)
    cut = windows(b"y" * 300)
    assert cut.shape == (2, 256) and cut.sum() == 300 * ord("y")


def test_slopes_equal_differences():
    rng = np.random.default_rng(0)
    batch = rng.integers(97, 107, (12, 40), np.uint8)
    model = train(batch, ["a", "b", "c"] * 4, epochs=1)
    values = [model.embedding, *model.filters, *model.biases, model.weights, model.bias]
    for value in values:
        value[...] = rng.normal(0, 0.3, value.shape)
    # In doubles, so that differences are exact enough.
    values = [value.astype(np.float64) for value in values]
    n = len(langid.WIDTHS)
    model = langid.Model(model.languages, values[0], values[1 : 1 + n], values[1 + n : 1 + 2 * n], *values[1 + 2 * n :])
    target = np.array([0, 1, 2] * 4)

    def loss():
        return -np.log(langid.softmax(langid.logits(model, batch))[np.arange(12), target]).mean()

    slopes = langid._slopes(model, batch, target, np.ones(12))
    for value, slope in zip(values, slopes, strict=True):
        for place in rng.choice(value.size, 6):
            spot = np.unravel_index(place if value.ndim < 2 or value.shape[0] != 256 else 100 * value.shape[1] + place % 8, value.shape)
            kept = value[spot]
            value[spot] = kept + 1e-5
            up = loss()
            value[spot] = kept - 1e-5
            down = loss()
            value[spot] = kept
            assert slope[spot] == pytest.approx((up - down) / 2e-5, abs=2e-4)


def test_held_out_accuracy(answer, documents):
    langs = {d.doc_id: d.lang for d in documents}
    got = answer("op6_language_id")
    assert len(got) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.lang_pred in set(langs.values()) and 0 <= r.score <= 1 for r in got)
    held = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) > 0.95


def labelled(rng, n=120):
    alphabets = {"x": "abcd ", "y": "efgh ", "z": "éüñß "}
    return [(i, "".join(rng.choices(alphabets[lang], k=rng.randrange(3, 900))) + "a", lang) for i, lang in enumerate("xyz" * n)]


def test_held_out_rows_and_labels_are_not_learnt(spark):
    rows = labelled(random.Random(1))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    other = [(i, t if zlib.crc32(str(i).encode()) % 4 != 2 else "zzz", la if zlib.crc32(str(i).encode()) % 4 != 2 else "q") for i, t, la in rows]
    other += [(None, "noise", "nowhere"), (5000, None, "x"), (5001, "no label", None)]
    changed = fit(spark.createDataFrame(other, "doc_id long, text string, lang string"))
    model = fit(frame.repartition(5))
    assert model.languages == ["x", "y", "z"]
    assert all(np.array_equal(a, b) for a, b in zip(model[4:], changed[4:], strict=True))


def test_batches_do_not_change_a_prediction(spark):
    rows = labelled(random.Random(2))
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [t for _, t, _ in rows] + ["abcd" * 30_000]
    alone = [predict(model, [t])[0] for t in texts]
    together = predict(model, texts)
    assert [a for a, _ in alone] == [a for a, _ in together]
    assert np.allclose([s for _, s in alone], [s for _, s in together], atol=1e-4)


def slow_prediction(model, text):
    """The network by loops: each filter at each place of each window, bytes past the end as zeros."""
    data = text.encode()
    totals = [0.0] * len(model.languages)
    for start in range(0, len(data), 256):
        part = data[start : start + 256]
        points = [[float(x) for x in model.embedding[byte]] for byte in part.ljust(256, b"\0")]
        pooled = []
        for width, filters, bias in zip(langid.WIDTHS, model.filters, model.biases, strict=True):
            for number in range(filters.shape[1]):
                weights = [float(x) for x in filters[:, number]]
                most = max(
                    sum(x * w for x, w in zip(sum(points[at : at + width], []), weights, strict=True))
                    for at in range(len(points) - width + 1)
                )
                pooled.append(max(most + float(bias[number]), 0.0))
        for language in range(len(totals)):
            score = sum(x * float(w) for x, w in zip(pooled, model.weights[:, language], strict=True))
            totals[language] += (score + float(model.bias[language])) * len(part) / len(data)
    raised = [math.exp(total - max(totals)) for total in totals]
    best = max(range(len(raised)), key=raised.__getitem__)
    return model.languages[best], raised[best] / sum(raised)


def test_table_against_loops(spark):
    rows = labelled(random.Random(4), 12)
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit(frame)
    texts = {i: text for i, text, _ in rows}
    for row in identify_languages(frame).collect():
        lang, score = slow_prediction(model, texts[row.doc_id])
        assert (row.lang_pred, row.score) == (lang, pytest.approx(score, abs=1e-3))


def test_edges(spark):
    rows = labelled(random.Random(3)) + [(9000, None, "x"), (9001, "", "y"), (9002, "123 !?", None), (9002, "123 !?", None), (None, "abcd" * 50, "x")]
    frame = spark.createDataFrame([(*r, r[2]) for r in rows], "doc_id long, text string, lang string, lang_pred string")
    got = identify_languages(frame).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if (r.doc_id or 0) >= 9000} == {UNDETERMINED}
    assert [(r.held_out, r.lang_pred) for r in got if r.doc_id is None] == [(False, "x")]


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify_languages(frame).collect()] == [(UNDETERMINED, 0.0)]
    assert identify_languages(frame.limit(0)).count() == 0


def test_many_labels_are_learned_together(spark, monkeypatch):
    monkeypatch.setattr(langid, "EPOCHS", 1)
    rows = [(i, f"text of kind {i % 600} and no other {i}", f"l{i % 600:03d}") for i in range(1500)] + [(9999, "word", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.identify_languages(frame).collect()
    assert len(found) == 1501 and all(0 < r.score <= 1 for r in found)
    # Where the bound is lower than the number of labels, the most frequent ones are learned.
    monkeypatch.setattr(langid, "SAMPLE_TOTAL", 3)
    more = frame.unionByName(spark.createDataFrame([(20_000 + i, "usual", f"often{i % 3}") for i in range(300)], frame.schema))
    assert {r.lang for r in langid.training_sample(more).collect()} == {"often0", "often1", "often2"}
