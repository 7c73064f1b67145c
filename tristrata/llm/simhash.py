"""Near-duplicates by SimHash fingerprints and a grid of segment bit counts.

A fingerprint's 64 bits are cut into 32 segments of two bits and each segment is
replaced by its number of set bits. The Manhattan distance between two such vectors
is at most the Hamming distance of the fingerprints, so fingerprints that differ in
at most ``distance`` bits have vectors at most that far apart. The vector's axes are
joined to ``blocks`` groups; at a Manhattan distance of ``distance`` at least
``blocks - distance`` groups are equal. Every choice of that many groups is one grid:
fingerprints meet in the cells of each grid, and pairs that meet are verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.components import components
from tristrata.llm.shared import NumberedRows, ship, staged

SEED = 42
SHINGLE_WORDS = 3
DISTANCE = 3
BLOCKS = 6
CELL_ROWS = 4096
_COUNTED_AT_ONCE = 1 << 15


def fingerprint(text: str | None) -> int:
    """64 majority bits over the XXH64 values of a text's shingles, as a signed integer.

    A-Z is lower-cased; fewer words than a shingle has make one shingle, none make zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(len(words) - SHINGLE_WORDS + 1, 1)
    first_bytes = starts[:last].tolist()
    end_bytes = ends[SHINGLE_WORDS - 1 :].tolist() or [len(joined)]
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, last, _COUNTED_AT_ONCE):
        pairs = zip(first_bytes[at : at + _COUNTED_AT_ONCE], end_bytes[at : at + _COUNTED_AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(votes * 2 > last, bitorder="little")
    return int(majority.view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = [fingerprint(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_no"), pa.array(marks, pa.int64())],
            names=["doc_id", "row_no", "fp"],
        )


def fingerprints(docs: DataFrame, row_no: Column) -> DataFrame:
    """``doc_id, row_no, fp`` of every row, staged."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), row_no.alias("row_no"), F.col("text").cast("string"))
    return staged(rows.mapInArrow(_fingerprints, "doc_id bigint, row_no bigint, fp bigint"))


def bit_counts(fp: Column) -> Column:
    """The 32 two-bit segments' bit counts (0 to 2), two bits each."""
    low = fp.bitwiseAND(F.lit(0x5555555555555555))
    high = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(0x5555555555555555))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def grid_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """One mask per grid over the packed bit counts: ``blocks - distance`` equal groups of axes."""
    if not distance < blocks <= 32:
        raise ValueError("between distance + 1 and 32 blocks are needed")
    edges = [32 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(edges, edges[1:])]
    return [_signed(sum(c)) for c in combinations(parts, blocks - distance)]


def unary_counts(values: np.ndarray) -> np.ndarray:
    """The segments' bit counts with as many bits set as each counts to: two vectors of counts are as
    far apart, in Manhattan distance, as these numbers differ in bits."""
    mask = np.uint64(0x5555555555555555)
    low, high = values & mask, (values >> np.uint64(1)) & mask
    return (low | high) | ((low & high) << np.uint64(1))


def _forest(values: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest over values that differ in at most ``distance`` bits.

    Values whose vectors of bit counts are further apart in Manhattan distance, the lower bound, are passed
    over; the others are compared exactly. Each value is taken off the open ones when it is
    first reached, so a crowd of close values shrinks at once and no pair list is made.
    """
    ends: list[int] = []
    roots: list[int] = []
    open_ = values.view(np.uint64)  # of a negative number only the size's bits would be counted
    counts = unary_counts(open_)
    while len(open_) > 1:
        root, open_, counts = open_[0], open_[1:], counts[1:]
        reached = [root]
        while reached and len(open_):
            value = reached.pop()
            bounded = np.flatnonzero(np.bitwise_count(counts ^ unary_counts(value)) <= distance)
            hit = bounded[np.bitwise_count(open_[bounded] ^ value) <= distance]
            if len(hit):
                found = open_[hit]
                left = np.ones(len(open_), bool)
                left[hit] = False
                open_, counts = open_[left], counts[left]
                reached.extend(found)
                ends.extend(found.view(np.int64).tolist())
                roots.extend([int(root.view(np.int64))] * len(found))
    return roots, ends


def _links_in_cells(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail_key, tail = None, []

        def links(values: list[np.ndarray]):
            roots, ends = _forest(np.concatenate(values), distance)
            if roots:
                yield pa.RecordBatch.from_pydict(
                    {"u": pa.array(roots, pa.int64()), "v": pa.array(ends, pa.int64())}
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("grid", "cell", "i", "j")])
            fps = batch.column("fp").to_numpy()
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            bounds = [0, *cuts.tolist(), len(fps)]
            for a, b in zip(bounds, bounds[1:]):
                key = tuple(keys[:, a].tolist())
                if key != tail_key:
                    if tail:
                        yield from links(tail)
                    tail_key, tail = key, []
                tail.append(fps[a:b])
        if tail:
            yield from links(tail)

    return run


def links(
    values: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints ``fp`` that connect all those which chains
    of links within ``distance`` connect.

    Cells with one fingerprint go no further. A cell with more than ``cell_rows`` is dealt
    into chunks, and each pair of chunks is a unit of work of its own: no task
    gathers the cell, and none of its pairs is left out.
    """
    counts = bit_counts(F.col("fp"))
    grids = [
        F.struct(F.lit(i).alias("grid"), counts.bitwiseAND(F.lit(m)).alias("cell"))
        for i, m in enumerate(grid_masks(blocks, distance))
    ]
    keyed = values.select("fp", F.inline(F.array(*grids)))
    crowded = keyed.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / cell_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    met = (
        keyed.join(crowded, ["grid", "cell"])
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("grid", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    keys = ["grid", "cell", "i", "j"]
    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_links_in_cells(distance), "u bigint, v bigint")


def labelled(marks: DataFrame, distance: int, blocks: int) -> DataFrame:
    """``fp, label`` of every distinct fingerprint, staged: equal labels, one component."""
    nodes = staged(marks.select("fp").distinct())
    labels = components(links(nodes, distance, blocks)).withColumnRenamed("node", "fp")
    return staged(nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))


def near_copies(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id that chains of links reach, the own one included.
    Null texts count as empty; empty texts have fingerprint zero and link like others. Rows with
    equal fingerprints, repeated rows among them, are one node. A null doc_id is larger than all; without another
    one the component has none. Texts of any length are read whole, and an empty table gives no rows.
    Other columns play no part.
    """
    marks = fingerprints(docs, F.lit(0).cast("bigint"))
    labels = labelled(marks, distance, blocks)
    # Rows are reduced to fingerprints and those to labels before anything is joined.
    least = marks.groupBy("fp").agg(F.min("doc_id").alias("least"))
    ids = least.join(labels, "fp").groupBy("label").agg(F.min("least").alias("component_id"))
    found = labels.join(ids, "label").select("fp", "component_id")
    return marks.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_copies(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """The rows that stay, with all their columns: of each component the row with the smallest
    doc_id, null last; of repeated rows one. An empty table gives no rows; columns may have any names."""
    rows = NumberedRows(docs)
    marks = fingerprints(rows.frame, F.col(rows.row))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")).alias("kept")
    by_mark = marks.groupBy("fp").agg(least)
    by_label = by_mark.join(labelled(marks, distance, blocks), "fp").groupBy("label").agg(F.min("kept").alias("kept"))
    keep = by_label.select(F.col("kept.row_no").alias("row"), F.lit(1).alias("times"))
    return rows.taken(keep).select(*docs.columns)
