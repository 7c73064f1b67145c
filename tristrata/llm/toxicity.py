"""Toxicity grades by cumulative-link ordinal regression.

For grades 0 to K - 1 the model has one weight per sparse text feature and K - 1 ordered
thresholds: P(grade >= k) = 1 / (1 + exp(threshold_k - sum of weights)). All thresholds
share the weights. The output is the expected grade with the most likely one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import (
    LOWER,
    NO_LETTERS,
    Texts,
    distinct_per_text,
    slices,
    texts_of,
    words_of,
)
from tristrata.llm.shared import ship
from tristrata.llm.sparse import Features, Rows, class_counts, sampled_rows, text_sums

FOLDS, HELD_OUT = 5, 0
BITS = 20
SAMPLE_ROWS = 16_000
PREFIXES = (4, 5, 6)
# A feature takes part when its shares in toxic and other sampled rows are so many standard
# errors apart, and when so many sampled rows have it.
LEAST_ERRORS = 4.0
LEAST_ROWS = 5


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def features(texts: Texts) -> Features:
    """Distinct hashed words and word beginnings of each text; case and punctuation don't count.
    Beginnings find words that are inflected or compounded."""
    words = words_of(texts, NO_LETTERS, LOWER)
    families = [(words.text, words.hash)]
    for length in PREFIXES:
        long, hashes = words.prefixes(length)
        families.append((words.text[long], hashes))
    room = np.uint64((1 << BITS) - 1)
    return [distinct_per_text(text, grams & room, BITS) for text, grams in families]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, texts: Texts) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns, a row per text."""
        total = text_sums(features(texts), self.weights, len(texts))
        return _sigmoid(total[:, None] - self.thresholds[None, :])


def _shares(rows: Rows, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature's number of rows among the toxic ones and among the others."""
    owner = rows.owner()
    inside = np.bincount(rows.index[toxic[owner]], minlength=1 << BITS)
    return inside, np.bincount(rows.index[~toxic[owner]], minlength=1 << BITS)


def telling(rows: Rows, toxic: np.ndarray) -> np.ndarray:
    """Which features tell toxic rows from the others."""
    return _far_apart(*_shares(rows, toxic), toxic.sum(), (~toxic).sum())


def _far_apart(inside: np.ndarray, outside: np.ndarray, n1: int, n0: int) -> np.ndarray:
    n1, n0 = max(n1, 1), max(n0, 1)
    pooled = (inside + outside + 0.5) / (n1 + n0 + 1)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    far = np.abs(inside / n1 - outside / n0) >= LEAST_ERRORS * error
    return far & (inside + outside >= LEAST_ROWS)


def severity_grades(rows: Rows) -> np.ndarray:
    """Grades 0, 1, 2 from labels 0 and 1: a toxic row is severe when it has more telling
    features than the median toxic row. Telling of severity are those whose share is eight
    times as large in toxic rows as in the others."""
    toxic = rows.label == 1
    inside, outside = _shares(rows, toxic)
    much = (inside + 0.5) / (toxic.sum() + 1) >= 8 * (outside + 0.5) / ((~toxic).sum() + 1)
    hits = rows.sums((much & telling(rows, toxic)).astype(float))
    middle = np.median(hits[toxic]) if toxic.any() else 0
    return np.where(toxic, 1 + (hits > middle), 0)


def fit_rows(
    rows: Rows,
    grades: np.ndarray,
    epochs: int = 20,
    batch: int = 256,
    rate: float = 0.3,
    ridge: float = 1e-4,
    seed: int = 11,
) -> Model:
    """Maximum likelihood by mini-batches with per-weight step sizes. Grades must be 0, 1, ...;
    with less than two of them the thresholds hold the smoothed shares alone."""
    width = 1 << BITS
    top = max(int(grades.max(initial=0)), 1)
    share = np.array([(np.sum(grades >= k) + 0.5) / (len(rows) + 1) for k in range(1, top + 1)])
    thresholds = -np.log(share / (1 - share))
    weights = np.zeros(width)
    if len(set(grades.tolist())) < 2:
        return Model(weights.astype(np.float32), thresholds)
    chosen_features = telling(rows, grades > 0)
    w_seen, t_seen = np.full(width, 1e-8), np.full(top, 1e-8)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        dealt = order.permutation(len(rows))
        for at in range(0, len(dealt), batch):
            chosen = dealt[at : at + batch]
            picked = [rows.row(i) for i in chosen]
            sizes = np.array([len(p) for p in picked])
            index = np.concatenate(picked)
            owner = np.repeat(np.arange(len(chosen)), sizes)
            use = chosen_features[index]
            index, owner = index[use], owner[use]
            total = np.bincount(owner, weights[index], len(chosen))
            y = grades[chosen]
            # Edges: P(grade = k) = above[k] - above[k + 1], above[0] = 1 and above[K] = 0.
            above = np.column_stack(
                [np.ones(len(chosen)), _sigmoid(total[:, None] - thresholds), np.zeros(len(chosen))]
            )
            slope = above * (1 - above)
            each = np.arange(len(chosen))
            p = np.maximum(above[each, y] - above[each, y + 1], 1e-12)
            pull = (slope[each, y] - slope[each, y + 1]) / p
            found, place = np.unique(index, return_inverse=True)
            g = np.bincount(place, pull[owner], len(found)) / len(chosen) - ridge * weights[found]
            w_seen[found] += g * g
            weights[found] += rate * g / np.sqrt(w_seen[found])
            tg = np.zeros(top)
            for k in range(1, top + 1):
                tg[k - 1] = (-(slope[:, k] / p)[y == k].sum() + (slope[:, k] / p)[y == k - 1].sum()) / len(chosen)
            t_seen += tg * tg
            thresholds = np.maximum.accumulate(thresholds + rate * tg / np.sqrt(t_seen))
            thresholds = thresholds + 1e-6 * np.arange(top)
    return Model(weights.astype(np.float32), thresholds)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of the labelled documents (``toxic`` 0 or 1) outside the held-out fold.

    The fit uses telling features alone. They are found by counts in Spark, and only they are
    brought to the driver, so the sample has its rows however long the texts are. With repeated ids
    in the documents the counts are those of all their rows.
    """
    ship(docs.sparkSession)
    train = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    use = _far_apart(*class_counts(docs, train, features, rows, 1 << BITS))

    def chosen(texts: Texts) -> Features:
        return [(number[use[feature]], feature[use[feature]]) for number, feature in features(texts)]

    found = sampled_rows(docs, train, chosen, rows)
    return fit_rows(found, severity_grades(found))


def graded(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, severity, grade, predicted``.

    ``score`` is the probability of any toxicity, ``severity`` the expected grade, ``grade``
    the most likely one and ``predicted`` 1 where ``score`` is at least a half. Null texts
    count as empty; an empty text gets what the thresholds alone say. Repeated rows get
    equal results; an empty table gives no rows. Of equally likely grades the lowest is given. Texts of any
    length are scored whole. The model has a fixed size, so it is broadcast.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                above = shared.value.at_least(texts_of(part.column("text")))
                shares = -np.diff(np.column_stack([np.ones(len(above)), above, np.zeros(len(above))]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(above[:, 0]),
                        pa.array(above.sum(axis=1)),
                        pa.array(shares.argmax(axis=1).astype(np.int32)),
                    ],
                    names=["doc_id", "score", "severity", "grade"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = rows.mapInArrow(run, "doc_id bigint, score double, severity double, grade int")
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        "severity",
        "grade",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
