"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word has a form and a shape (letters, digits and marks with runs collapsed; a word that repeats
the one before it has a shape of its own). Both are hashed to a fixed number of rows. The vector of a row
is the sum of the random index vectors of the words around its occurrences in all documents: one
table of fixed size, summed over the whole corpus. A document's features are the means of its words'
vectors, of forms and of shapes, and its length. The network is trained by numpy on a bounded sample
of labelled rows, and its probabilities are calibrated by a temperature on a part of that sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.names import free_names
from rankflow.llm.words import blocks, hash_spans, text_bytes, word_spans
from rankflow.llm.workers import lean

FORMS, SHAPES, SIZE, WINDOW = 6144, 2048, 32, 2
#: Labelled rows used for training at most, those with the smallest hashes of their ids.
MAX_LABELS = 20_000
#: Bytes of texts whose word vectors are laid out together.
POOLED_BYTES = 1 << 19
_ROWS = FORMS + SHAPES
_SEED = 99

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = ord("a")


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places of the +1 and of the -1 in the index vector of each row."""
    rng = np.random.default_rng(_SEED)
    plus = rng.integers(0, SIZE, _ROWS)
    return plus, (plus + rng.integers(1, SIZE, _ROWS)) % SIZE


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of the form and of the shape of each word, and the number of words before each text."""
    data, offsets = text_bytes(texts)
    starts, ends, bounds = word_spans(data, offsets)
    forms = hash_spans(data, starts, ends)
    kinds = _CLASS[data]
    keep = np.ones(len(kinds), dtype=bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[starts] = True
    places = np.zeros(len(kinds) + 1, dtype=np.int64)
    np.cumsum(keep, out=places[1:])
    shapes = hash_spans(kinds[keep], places[starts], places[ends])
    again = np.zeros(len(forms), dtype=bool)
    again[1:] = forms[1:] == forms[:-1]
    again[bounds[:-1][bounds[:-1] < len(forms)]] = False
    shapes = np.where(again, shapes + np.uint64(0x1234567), shapes)
    return (forms % np.uint64(FORMS)).astype(np.int64), (shapes % np.uint64(SHAPES)).astype(np.int64) + FORMS, bounds


def _add_contexts(texts: pa.Array, sums: np.ndarray, plus: np.ndarray, minus: np.ndarray) -> None:
    """Add the index vectors of the words within the window to the rows of each word."""
    forms, shapes, bounds = _words(texts)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for apart in range(1, WINDOW + 1):
        near = np.flatnonzero(text[apart:] == text[:-apart])
        for target, source in ((near, near + apart), (near + apart, near)):
            for rows in (forms[target], shapes[target]):
                for others in (forms[source], shapes[source]):
                    sums += np.bincount(rows * SIZE + plus[others], minlength=sums.size)
                    sums -= np.bincount(rows * SIZE + minus[others], minlength=sums.size)


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """row, and its summed context vector c0, c1, ...: at most ``FORMS + SHAPES`` rows whatever the input."""
    names = [f"c{i}" for i in range(SIZE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (plus, minus), sums = _index_vectors(), np.zeros(_ROWS * SIZE, dtype=np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                _add_contexts(block, sums, plus, minus)
        table = sums.reshape(_ROWS, SIZE)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(table[used, i]) for i in range(SIZE)]], ["row", *names])

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = rows.mapInArrow(lean(run), "row bigint, " + ", ".join(f"{n} bigint" for n in names))
    return parts.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The table of unit vectors, ``FORMS + SHAPES`` by ``SIZE``; what the driver collects is this and no more."""
    table = np.zeros((_ROWS, SIZE), dtype=np.float64)
    for row in context_sums(docs, text_col).toLocalIterator():
        table[row[0]] = row[1:]
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(length == 0, 1, length)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean vectors of forms and shapes, and the logarithm of the number of words."""
    out = []
    for block in blocks(texts, POOLED_BYTES):
        forms, shapes, bounds = _words(block)
        counts = np.diff(bounds)
        features = np.zeros((len(counts), 2 * SIZE + 1), dtype=np.float32)
        full = np.flatnonzero(counts)
        if len(full):
            for k, rows in enumerate((forms, shapes)):
                sums = np.add.reduceat(vectors[rows], bounds[:-1][full], axis=0)
                features[full, k * SIZE : (k + 1) * SIZE] = sums / counts[full, None]
        features[:, -1] = np.log1p(counts)
        out.append(features)
    return np.concatenate(out) if out else np.zeros((0, 2 * SIZE + 1), dtype=np.float32)


# --- the network ----------------------------------------------------------------------------


@dataclass
class Network:
    """Standardised features, one hidden layer, a calibrated probability."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, batch: int = 256, rate: float = 3e-3, decay: float = 1e-4) -> Network:
    """Fit by Adam on four fifths of the rows, then the temperature on the rest. Same rows, same network.

    Without rows of both labels the probability is constant: the smoothed share of label 1.
    """
    width, rng = x.shape[1], np.random.default_rng(_SEED)
    if len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        zero = np.zeros((width, 1))
        return Network(np.zeros(width), np.ones(width), zero, np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    x, y = x.astype(np.float64), y.astype(np.float64)
    apart = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[apart])) < 2 or len(np.unique(y[~apart])) < 2:
        apart[:] = False
    tx, ty = x[~apart], y[~apart]
    scale = tx.std(axis=0)
    net = Network(
        tx.mean(axis=0), np.where(scale < 1e-6, 1, scale),
        rng.normal(0, np.sqrt(2 / width), (width, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), 0.0,
    )
    z = (tx - net.mean) / net.scale
    weights = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(ty))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            pre = z[rows] @ weights[0] + weights[1]
            active = np.maximum(pre, 0)
            error = (1 / (1 + np.exp(-np.clip(active @ weights[2] + weights[3], -50, 50))) - ty[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (pre > 0)
            slopes = [z[rows].T @ back + decay * weights[0], back.sum(axis=0), active.T @ error + decay * weights[2], error.sum(keepdims=True)]
            step += 1
            for w, g, m, v in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if apart.any():
        logits = net.logits(x[apart])
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 121))
        net.temperature = float(min(choices, key=lambda t: _loss(logits / t, y[apart])))
    return net


# --- over tables -------------------------------------------------------------------------------


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt: the checksum of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labels: int = MAX_LABELS,
) -> QualityModel:
    """Word vectors from all ``docs``; the network from at most ``max_labels`` labelled rows that are not held out.

    Rows without a label or an id don't teach; an id with several labels has that of the majority, 1 for a tie. Of an
    id with several texts the smallest one (by its bytes) teaches, so that the network depends on the rows alone.
    """
    vectors = word_vectors(docs, text_col)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [row.tobytes() for row in pooled(batch.column(2), vectors)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(features, pa.binary())], ["id", "label", "x"])

    # the size of the broadcast side is bounded by max_labels
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.join(F.broadcast(known), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    sample = sorted(rows.mapInArrow(lean(run), f"id {kind}, label int, x binary").collect(), key=lambda r: r[0])
    x = np.array([np.frombuffer(r[2], dtype=np.float32) for r in sample]).reshape(-1, 2 * SIZE + 1)
    y = np.array([r[1] for r in sample], dtype=np.float64)
    mixed = np.random.default_rng(_SEED).permutation(len(y))
    return QualityModel(vectors, train(x[mixed], y[mixed]))


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; null and empty texts are scored as texts without words."""
    if score_col in docs.columns:
        raise ValueError(f"docs already has a column {score_col}")
    vectors, network = model.vectors, model.network

    def probabilities(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(network.probability(pooled(texts, vectors).astype(np.float64)))

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from lean(probabilities)(batches)

    return docs.withColumn(score_col, probability(F.coalesce(F.col(text_col), F.lit(""))))


def judge_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row for each row of ``docs``: the id, held_out, score, predicted (1 from 0.5 on). An empty table gives no rows."""
    model = fit_quality(docs, labels, id_col, text_col, **options)
    scored = score_quality(docs.select(F.col(id_col), F.col(text_col).alias("_text")), model, "_text")
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as label 1; columns stay as they are."""
    model = fit_quality(docs, labels, id_col, text_col, **options)
    (score,) = free_names(docs, "score")
    return score_quality(docs, model, text_col, score).where(F.col(score) >= 0.5).drop(score)
