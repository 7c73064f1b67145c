"""Finding the keys that would overload one join task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tristrata.functions.text import quoted

COUNT, HASH = "__n", "__hash"
UNKNOWN_BYTES = 1 << 62
# Groups that keys are dealt to for a first count.
GROUPS = 1 << 12


@dataclass(frozen=True)
class SkewPolicy:
    """When a join key counts as hot.

    A key is hot when it holds more than ``rows_per_task`` rows, however large its side is; a side
    has fewer hot keys than it has tasks' worth of rows. A right side within ``broadcast_bytes``
    (default: Spark's own broadcast limit) is joined without looking for any: its join has no
    shuffle. Up to ``listed`` hot keys are broadcast; beyond that they are joined like any
    other table. Keys are looked for by ``buckets`` sketches of at most ``tracked`` keys each.
    """

    rows_per_task: int = 2_000_000
    broadcast_bytes: int | None = None
    listed: int = 100_000
    buckets: int = 64
    tracked: int = 1 << 12


def estimated_bytes(df: DataFrame) -> int:
    """Spark's size estimate before any pruning, so rather too high; runs no job.

    The estimate has no public interface. Where it cannot be read, as over a remote connection,
    the size counts as unknown and therefore large.
    """
    try:
        return int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - not a classic session
        return UNKNOWN_BYTES


def measured_bytes(df: DataFrame) -> int:
    """About what a frame takes up as rows, by one pass over it: Spark's estimate knows no filter and no distinct."""
    texts = [F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)) for f in df.schema.fields if f.dataType == StringType()]
    size = sum(texts, F.lit(16 + 16 * len(df.columns)))
    return df.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def _crowded(keyed: DataFrame, policy: SkewPolicy) -> DataFrame | None:
    """The rows of the groups of keys that have more than ``rows_per_task`` rows, or nothing: a key has no more
    rows than its group. A plain count takes a fraction of what the sketches take."""
    group = F.col("hashed").bitwiseAND(GROUPS - 1)
    counts = keyed.groupBy(group.alias("of")).agg(F.count(F.lit(1)).alias("n"))
    crowded = [r["of"] for r in counts.where(F.col("n") > policy.rows_per_task).select("of").collect()]
    return keyed.where(group.isin(crowded)) if crowded else None


def _candidates(df: DataFrame, hashed: Column, policy: SkewPolicy) -> list[int]:
    """Hashes of keys that may have more than ``rows_per_task`` rows; none that has is missing.

    One pass counts groups of keys; mostly no group has that many, and this is all. Over the rows of those that have,
    another: a sketch of frequent items per bucket, merged on the map side, so that
    neither distinct keys nor rows are shuffled. A sketch of t tracked items surely names an item with more
    than 5.25 / t of its bucket's rows and never underrates one. Where that share is too coarse
    for the rows that a bucket turned out to have, the keys named so far are set aside and the others
    are dealt to more buckets.
    """
    keyed, buckets, names = _crowded(df.select(hashed.alias("hashed")), policy), policy.buckets, []
    while keyed is not None:
        # The hash's upper half: a sketch spreads its items by all of it.
        bucket = F.pmod(F.shiftright("hashed", 32), F.lit(buckets))
        sketch = F.expr(f"approx_top_k(hashed, {policy.tracked}, {policy.tracked})")
        found = keyed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), sketch.alias("items"))
        many = F.filter("items", lambda item: item["count"] > policy.rows_per_task)
        # At most as many items as there are tasks' worth of rows.
        rows = found.select("n", F.transform(many, lambda item: item["item"]).alias("hashes")).collect()
        fresh = [h for r in rows for h in r.hashes]
        names += fresh
        surely = max((r.n for r in rows), default=0) * 5.25 / policy.tracked
        if surely <= policy.rows_per_task:
            return names
        if fresh:
            keyed = keyed.join(_listed(df, fresh, "hashed", policy), "hashed", "left_anti")
        else:
            buckets *= max(2, math.ceil(surely / policy.rows_per_task))
    return names


def _listed(df: DataFrame, hashes: list[int], name: str, policy: SkewPolicy) -> DataFrame:
    table = df.sparkSession.createDataFrame([(h,) for h in hashes], f"{name} bigint")
    return F.broadcast(table) if len(hashes) <= policy.listed else table


def hot_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy) -> DataFrame | None:
    """Exact hot keys of a frame with their rows (``__n``), or nothing.

    Mostly a count by groups of keys shows that there is none, and this one pass over the key columns is all. Otherwise
    the rows of the keys that the sketches name, and of no others, are counted exactly.
    """
    columns = [quoted(k) for k in keys]
    hashed = F.xxhash64(*columns)
    names = _candidates(df, hashed, policy)
    if not names:
        return None
    met = df.select(*columns, hashed.alias(HASH)).join(_listed(df, names, HASH, policy), HASH, "left_semi")
    exact = met.groupBy(*columns).agg(F.count(F.lit(1)).alias(COUNT))
    return exact.where(F.col(COUNT) > policy.rows_per_task)


class KeyCounts:
    """Remembers which frames were counted by which keys, for the joins of one plan.

    A frame without a hot key has none by more keys either.
    """

    def __init__(self) -> None:
        self._found: dict[tuple[int, frozenset], DataFrame | None] = {}
        self._frames: list[DataFrame] = []

    def hot(self, df: DataFrame, keys: Sequence[str], policy: SkewPolicy) -> DataFrame | None:
        mine = frozenset(k.lower() for k in keys)
        for (frame, known), found in self._found.items():
            if frame == id(df) and (known == mine or known < mine and found is None):
                return found
        self._frames.append(df)  # so that its id stays its own
        found = self._found[id(df), mine] = hot_keys(df, keys, policy)
        return found
