"""Language identification by a convolutional network over bytes, trained and applied in numpy.

Bytes are embedded, filters of several widths run over a window, each filter's greatest response
in the window goes to a softmax over the languages. A text is cut into windows of fixed length, all
of them are scored in batches, and the text's scores are the means over its windows, weighted by
their bytes.

The model learns from a bounded sample: for each language at most SAMPLE_DOCUMENTS documents,
fewer where there are so many languages that they would pass SAMPLE_TOTAL together, but one at least, of
the SAMPLE_TOTAL languages with most documents, chosen by a
hash of the identifier, and at most SAMPLE_WINDOWS windows of each. Everything else covers
all documents. Training is deterministic.

Defined cases: a null text or one without letters is ``und`` with score 0. Rows with a null
language, or an identifier of the held-out fold or null, are not learnt from. With no
row to learn from, every text is ``und``. Repeated rows are predicted alike. Very long texts
are predicted from all their windows. Other columns are not looked at, whatever their names. An empty table
gives no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from lectern.llm.common import text_bytes

UNDETERMINED = "und"
FOLDS = 4
HELD_OUT_FOLD = 2

SAMPLE_DOCUMENTS = 250
SAMPLE_TOTAL = 20_000
SAMPLE_WINDOWS = 8

WINDOW_BYTES = 256
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 12
EPOCHS = 12
SHORTEST = 16
BATCH = 64
RATE = 0.01
SEED = 7

SCORE_WINDOWS = 64


class Model(NamedTuple):
    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: np.ndarray


def windows(data: bytes, size: int = WINDOW_BYTES) -> np.ndarray:
    """All windows of the text, the last one padded with zero bytes."""
    count = max(1, -(-len(data) // size))
    out = np.zeros(count * size, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(count, size)


def _respond(model: Model, batch: np.ndarray):
    """Per width: unfolded input, greatest response per filter, and where it lies."""
    embedded = model.embedding[batch]
    n, size, depth = embedded.shape
    out = []
    for width, filters, bias in zip(WIDTHS, model.filters, model.biases, strict=True):
        unfolded = np.lib.stride_tricks.sliding_window_view(embedded.reshape(n, size * depth), width * depth, axis=1)
        unfolded = unfolded[:, ::depth]
        response = (unfolded.reshape(-1, width * depth) @ filters).reshape(n, -1, FILTERS)
        at = response.argmax(axis=1)
        most = np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] + bias
        out.append((unfolded, most, at))
    return out


def logits(model: Model, batch: np.ndarray) -> np.ndarray:
    pooled = np.concatenate([most for _, most, _ in _respond(model, batch)], axis=1)
    return np.maximum(pooled, 0) @ model.weights + model.bias


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(batch: np.ndarray, labels: list[str], epochs: int = EPOCHS) -> Model:
    """Adam on the cross entropy, on shuffled batches; each language weighs the same."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(SEED)
    number = {language: i for i, language in enumerate(languages)}
    target = np.array([number[label] for label in labels])
    weigh = len(target) / (len(languages) * np.bincount(target)[target])

    def start(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    model = Model(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        [start(width * EMBEDDING, FILTERS) for width in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        start(len(WIDTHS) * FILTERS, len(languages)),
        np.zeros(len(languages), np.float32),
    )
    values = [model.embedding, *model.filters, *model.biases, model.weights, model.bias]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(epochs):
        order = rng.permutation(len(batch))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            # Half of the windows lose their end, as the last window of a text does.
            ends = rng.integers(SHORTEST, 2 * WINDOW_BYTES, len(rows))
            seen = np.where(np.arange(batch.shape[1]) < ends[:, None], batch[rows], 0)
            slopes = _slopes(model, seen, target[rows], weigh[rows])
            step += 1
            for value, slope, m, v in zip(values, slopes, first, second, strict=True):
                m += 0.1 * (slope - m)
                v += 0.001 * (slope * slope - v)
                value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _slopes(model: Model, batch: np.ndarray, target: np.ndarray, weigh: np.ndarray) -> list[np.ndarray]:
    parts = _respond(model, batch)
    pooled = np.concatenate([most for _, most, _ in parts], axis=1)
    active = np.maximum(pooled, 0)
    error = softmax(active @ model.weights + model.bias)
    error[np.arange(len(target)), target] -= 1
    error = (error * weigh[:, None] / len(target)).astype(np.float32)
    back = (error @ model.weights.T) * (pooled > 0)
    embedding = np.zeros_like(model.embedding)
    filters, biases = [], []
    n = np.arange(len(batch))[:, None]
    for i, (width, (unfolded, _, at)) in enumerate(zip(WIDTHS, parts, strict=True)):
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        # Only the place of a filter's greatest response passes a slope on.
        chosen = unfolded[n, at]
        filters.append(np.einsum("nfk,nf->kf", chosen, own))
        biases.append(own.sum(axis=0))
        down = (own[:, :, None] * model.filters[i].T[None]).reshape(-1, EMBEDDING)
        places = batch[n[:, :, None], at[:, :, None] + np.arange(width)]
        np.add.at(embedding, places.ravel(), down)
    return [embedding, *filters, *biases, active.T @ error, error.sum(axis=0)]


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and probability per text; batches of windows span texts, and long texts span batches."""
    out = [(UNDETERMINED, 0.0)] * len(texts)
    sums: dict[int, np.ndarray] = {}
    held: list[tuple[int, np.ndarray]] = []
    lengths: dict[int, int] = {}

    def flush() -> None:
        scores = logits(model, np.concatenate([rows for _, rows in held]))
        at = 0
        for owner, rows in held:
            part = scores[at : at + len(rows)]
            at += len(rows)
            sums[owner] = sums.get(owner, 0) + part.sum(axis=0)
        held.clear()

    for owner, text in enumerate(texts):
        if not text or not model.languages or not any(map(str.isalpha, text)):
            continue
        data = text_bytes(text)
        full = len(data) - len(data) % WINDOW_BYTES
        lengths[owner] = len(data)
        # The last, shorter window weighs by its bytes.
        if full < len(data):
            tail = logits(model, windows(data[full:]))[0]
            sums[owner] = tail * ((len(data) - full) / WINDOW_BYTES)
        rows = windows(data[:full]) if full else np.empty((0, WINDOW_BYTES), np.uint8)
        for begin in range(0, len(rows), SCORE_WINDOWS):
            held.append((owner, rows[begin : begin + SCORE_WINDOWS]))
            if sum(len(r) for _, r in held) >= SCORE_WINDOWS:
                flush()
    if held:
        flush()
    for owner, total in sums.items():
        share = softmax((total * (WINDOW_BYTES / lengths[owner]))[None])[0]
        best = int(share.argmax())
        out[owner] = (model.languages[best], float(share[best]))
    return out


def fold_of(identifier: str | Column) -> Column:
    """crc32 of the identifier as text, modulo FOLDS."""
    text = identifier if isinstance(identifier, Column) else F.col(identifier)
    return F.crc32(text.cast("string")) % FOLDS


def _sampled_windows(texts: pa.Array) -> pa.Array:
    out = []
    for text in texts.to_pylist():
        rows = windows(text_bytes(text))
        step = max(1, len(rows) // SAMPLE_WINDOWS)
        out.append([row.tobytes() for row in rows[::step][:SAMPLE_WINDOWS]])
    return pa.array(out, pa.list_(pa.binary()))


def training_sample(documents: DataFrame, documents_each: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``(lang, windows)`` for at most ``documents_each`` documents of a language.

    Languages are counted first, so that a hash of the identifier thins each to about twice
    the sample before any text is read; the rest is a ranking cut short in every task. All languages
    together have at most SAMPLE_TOTAL documents, each one at least. Of more languages than that, those with
    most documents are learned.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of("doc_id") != HELD_OUT_FOLD))
    counted = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE_TOTAL).collect()
    if not counted:
        return known.select("lang", F.array().cast("array<binary>").alias("windows"))
    documents_each = min(documents_each, SAMPLE_TOTAL // len(counted))
    rows = [(row.lang, min(1.0, 2 * documents_each / row.n)) for row in counted]
    shares = documents.sparkSession.createDataFrame(rows, "lang string, share double")
    mixed = F.xxhash64(F.lit("sample"), "doc_id")
    place = Window.partitionBy("lang").orderBy("_mixed", "doc_id")
    # At most SAMPLE_TOTAL rows.
    chosen = (
        known.withColumn("_mixed", mixed)
        .join(F.broadcast(shares), "lang")
        .where(F.pmod("_mixed", F.lit(1 << 30)) < F.col("share") * (1 << 30))
        .withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") <= documents_each)
    )
    cut = F.arrow_udf(_sampled_windows, T.ArrayType(T.BinaryType()))
    return chosen.select("lang", cut("text").alias("windows"))


def fit(documents: DataFrame) -> Model:
    """Train on the driver: at most SAMPLE_TOTAL * SAMPLE_WINDOWS windows, 41 MB."""
    rows = sorted((row.lang, bytes(window)) for row in training_sample(documents).collect() for window in row.windows)
    if not rows:
        return Model([], *[np.empty(0)] * 5)
    batch = np.frombuffer(b"".join(window for _, window in rows), np.uint8).reshape(-1, WINDOW_BYTES)
    return train(batch, [lang for lang, _ in rows])


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def prediction_of(model: Model, text: str | Column) -> Column:
    @F.arrow_udf(PREDICTION)
    def run(texts: pa.Array) -> pa.Array:
        columns = list(zip(*predict(model, texts.to_pylist()), strict=True)) or [[], []]
        return pa.StructArray.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64())], names=PREDICTION.names
        )

    return run(text)


def identify_languages(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per document."""
    named = documents.select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    )
    model = fit(named)
    held_out = F.coalesce(fold_of("doc_id") == HELD_OUT_FOLD, F.lit(False))
    found = named.select("doc_id", held_out.alias("held_out"), prediction_of(model, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.*")
