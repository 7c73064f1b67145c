"""Quality classifier: a support vector machine over naive Bayes features.

Indicators of word n-grams and of short byte n-grams are scaled by the log ratio of
their smoothed shares in the two classes; a linear hinge-loss model is then fitted by
dual coordinate descent, and its margin is turned into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import (
    Texts,
    distinct_per_text,
    inner_runs,
    mixed_bits,
    slices,
    texts_of,
    word_runs,
    words_of,
)
from tristrata.llm.shared import ship
from tristrata.llm.sparse import Features, Rows, class_counts, sampled_rows, text_sums

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BITS = 18
SAMPLE_ROWS = 12_000
SAMPLE_ENTRIES = 12_000_000
CALIBRATION_SHARE = 0.2


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def features(texts: Texts) -> Features:
    """Distinct hashed n-grams of each text: one and two words, three bytes."""
    words = words_of(texts)
    pairs = word_runs(words.hash, 2)
    within = inner_runs(words.text, 2)
    data = texts.data.astype(np.uint32)
    three = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.bounds))
    whole = inner_runs(owner, 3)
    families = [
        (words.text, words.hash),
        (words.text[: len(pairs)][within], pairs[within]),
        (owner[: len(three)][whole], mixed_bits(three[whole].astype(np.uint64) + np.uint64(1 << 40))),
    ]
    room = np.uint64((1 << BITS) - 1)
    return [distinct_per_text(text, grams & room, BITS) for text, grams in families]


@dataclass
class Model:
    """``weights`` of the indicators have the log-count ratios in them; ``squares`` are those
    of the ratios, for bringing a row to unit length."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: Texts) -> np.ndarray:
        found = features(texts)
        total = text_sums(found, self.weights, len(texts))
        length = np.sqrt(text_sums(found, self.squares, len(texts)))
        margin = total / np.maximum(length, 1e-12) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500)))


def ratios_of(inside: np.ndarray, outside: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """The log ratios of features' smoothed shares among the indicators of good and of other rows."""
    p, q = smoothing + inside, smoothing + outside
    return np.log(p / p.sum()) - np.log(q / q.sum())


def log_count_ratios(rows: Rows, good: np.ndarray, width: int) -> np.ndarray:
    owner = rows.owner()
    inside = np.bincount(rows.index[good[owner]], minlength=width)
    return ratios_of(inside, np.bincount(rows.index[~good[owner]], minlength=width))


def affordable(inside: np.ndarray, outside: np.ndarray, entries: int) -> np.ndarray:
    """Which features to fit on, by the rows of each class that have them: all, or where these rows have
    more than ``entries`` indicators, the features whose log ratios are furthest from zero, as many
    as rows have so many indicators of together. Rows are never left out."""
    order = np.argsort(-np.abs(ratios_of(inside, outside)), kind="stable")
    use = np.zeros(len(order), bool)
    use[order] = np.cumsum((inside + outside)[order]) <= entries
    return use


def dual_descent(
    rows: Rows, scale: np.ndarray, target: np.ndarray, cost: np.ndarray, rounds: int = 12, seed: int = 7
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + sum of cost * hinge loss, with the rows'
    indicators scaled by ``scale`` and brought to unit length. The bias is one more
    feature that is always set. Each step sets one dual variable to its best value."""
    length = np.maximum(np.sqrt(rows.sums(scale * scale)), 1e-12)
    w, bias = np.zeros(len(scale)), 0.0
    dual = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at = rows.row(i)
            x = scale[at] / length[i]
            gap = target[i] * (x @ w[at] + bias) - 1
            # With the bias the squared length is 2, or 1 without any indicator.
            new = min(max(dual[i] - gap / (2 if len(at) else 1), 0.0), cost[i])
            step = (new - dual[i]) * target[i]
            if step:
                w[at] += step * x
                bias += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def _sigmoid_fit(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps on the smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    y = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)])
    beta = np.array([1.0, np.log((n1 + 1) / (n0 + 1))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (y - p))
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def fit_rows(rows: Rows, cost: float = 1.0) -> Model:
    """Without rows of both classes the score is the smoothed share of good rows."""
    width = 1 << BITS
    good = rows.label == 1
    if not 0 < good.sum() < len(rows):
        share = (good.sum() + 1) / (len(rows) + 2)
        none = np.zeros(width, np.float32)
        return Model(none, none, 0.0, 1.0, float(np.log(share / (1 - share))))
    tuned = max(int(len(rows) * CALIBRATION_SHARE), 1)
    fitted = Rows(rows.bounds[: len(rows) - tuned + 1], rows.index[: rows.bounds[-tuned - 1]], rows.label[:-tuned])
    if len(set(fitted.label == 1)) < 2 or len(set(good[-tuned:])) < 2:
        fitted, tuned = rows, len(rows)
    well = fitted.label == 1
    scale = log_count_ratios(fitted, well, width)
    # The rarer class weighs as much as the other one.
    costs = cost * np.where(well, len(well) / (2 * well.sum()), len(well) / (2 * (~well).sum()))
    w, bias = dual_descent(fitted, scale, np.where(well, 1.0, -1.0), costs)
    length = np.maximum(np.sqrt(rows.sums(scale * scale)), 1e-12)
    margins = rows.sums(w * scale) / length + bias
    slope, offset = _sigmoid_fit(margins[-tuned:], good[-tuned:])
    packed = (w * scale).astype(np.float32), (scale * scale).astype(np.float32)
    return Model(*packed, bias, slope, offset)


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, entries: int = SAMPLE_ENTRIES
) -> Model:
    """Fit on ``rows`` of the labelled documents outside the held-out fold, or on all where they are fewer.

    Features are counted in Spark, and the driver gets ``entries`` indicators at most: of long texts it
    gets the more telling features alone, but of all sampled rows. Labels of absent
    documents, null labels and an empty table leave the share of good rows as the score.
    """
    ship(docs.sparkSession)
    train = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    outside, inside, *_ = class_counts(docs, train, features, rows, 1 << BITS)
    use = affordable(inside, outside, entries)

    def chosen(texts: Texts) -> Features:
        return [(number[use[feature]], feature[use[feature]]) for number, feature in features(texts)]

    return fit_rows(sampled_rows(docs, train, chosen, rows))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null texts count as empty; an empty text has the score of the bias alone. Repeated rows get
    equal scores, a null doc_id is not held out; an empty table gives no rows. Texts of any length are scored
    whole; there are no ties. The model has a fixed size, so it is broadcast.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                score = shared.value.scores(texts_of(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"]
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are predicted good, with all their columns, whatever those are called; see
    ``scored``. Repeated rows stay or go together."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    position = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.rename_columns([str(i) for i in range(batch.num_columns)])
            for part in slices(batch, str(position)):
                good = shared.value.scores(texts_of(part.column(position))) >= THRESHOLD
                yield part.filter(pa.array(good)).rename_columns(names)

    return docs.mapInArrow(run, docs.schema)
