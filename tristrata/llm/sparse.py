"""Sparse text rows for small linear models that are fitted on a bounded sample."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.llm.grams import Texts, slices, texts_of

# texts -> families of features, each with the text's number and the feature of every indicator
# that is set
Features = list[tuple[np.ndarray, np.ndarray]]
Featurise = Callable[[Texts], Features]


@dataclass
class Rows:
    """Indicator rows: row i has the features index[bounds[i]:bounds[i + 1]]."""

    bounds: np.ndarray
    index: np.ndarray
    label: np.ndarray

    def __len__(self) -> int:
        return len(self.label)

    def row(self, i: int) -> np.ndarray:
        return self.index[self.bounds[i] : self.bounds[i + 1]]

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """Each row's sum of weights."""
        return np.array([weights[self.row(i)].sum() for i in range(len(self))], float)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self), dtype=np.int32), np.diff(self.bounds))


def text_sums(found: Features, weights: np.ndarray, texts: int) -> np.ndarray:
    """Each text's sum of weights."""
    return sum((np.bincount(text, weights[feature], texts) for text, feature in found), np.zeros(texts))


def _picked(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, text, _label`` of the labelled documents of the sample; labels of documents that
    are not there are none. A document with several labels is there once for each."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    picked = (
        labels.where("doc_id is not null and label is not null")
        .select(F.col("doc_id").cast("bigint").alias("_id"), F.col("label").cast("int").alias("_label"))
        .join(texts.select(F.col("doc_id").alias("_id")), "_id", "left_semi")
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(rows)
    )
    # Bounded by ``rows``.
    return texts.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).drop("_id")


def class_counts(
    docs: DataFrame, labels: DataFrame, featurise: Featurise, rows: int, width: int
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Of ``width`` features the sampled rows with label 1 that have each, the other rows that have it,
    and both kinds' rows; counted in Spark, so that only counts meet on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place counts the rows.
        counts = np.zeros((2, width + 1), np.int64)
        for batch in batches:
            for part in slices(batch):
                column = texts_of(part.column("text"))
                marked = part.column("_label").to_numpy() == 1
                for number, feature in featurise(column):
                    inside = marked[number]
                    counts[1] += np.bincount(feature[inside], minlength=width + 1)
                    counts[0] += np.bincount(feature[~inside], minlength=width + 1)
                counts[:, width] += [(~marked).sum(), marked.sum()]
        found = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(counts[1, found]), pa.array(counts[0, found])],
            names=["feature", "inside", "outside"],
        )

    parts = _picked(docs, labels, rows).mapInArrow(run, "feature bigint, inside bigint, outside bigint")
    sums = parts.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).toArrow()
    counts = np.zeros((2, width + 1), np.int64)
    for i, name in enumerate(("inside", "outside")):
        counts[i, sums.column("feature").to_numpy()] = sums.column(name).to_numpy()
    return counts[0, :width], counts[1, :width], int(counts[0, width]), int(counts[1, width])


def sampled_rows(
    docs: DataFrame,
    labels: DataFrame,
    featurise: Featurise,
    rows: int,
    entries: int | None = None,
) -> Rows:
    """At most ``rows`` labelled documents (``doc_id, label``; null labels are left out) in an
    order drawn from their ids, as indicator rows on the driver; with ``entries`` reading ends after so
    many indicators.

    The ids are picked first, so only their texts are read into Python. Both bounds are
    parameters of the fit and do not depend on the size of the tables.
    """
    met = _picked(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                column = texts_of(part.column("text"))
                number, feature = (np.concatenate(x) for x in zip(*featurise(column)))
                order = np.argsort(number, kind="stable")
                number, feature = number[order], feature[order]
                cuts = np.searchsorted(number, np.arange(len(column) + 1))
                packed = [feature[a:b].astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_label"), pa.array(packed, pa.binary())],
                    names=["doc_id", "label", "packed"],
                )

    found = met.mapInArrow(run, "doc_id bigint, label int, packed binary")
    index, label, room = [], [], entries
    for row in found.orderBy(F.xxhash64("doc_id"), "doc_id", "packed").toLocalIterator():
        features = np.frombuffer(row.packed, "<u4")
        if room is None:
            if len(label) == rows:
                break
        else:
            room -= len(features)
            if room < 0 and label:
                break
        index.append(features)
        label.append(row.label)
    bounds = np.cumsum([0, *map(len, index)])
    flat = np.concatenate(index).view(np.int32) if index else np.empty(0, np.int32)
    return Rows(bounds, flat, np.array(label, np.int64))
