"""Mixing sources to target weights by Pareto order sampling.

A source that is to fill ``f`` times its own words gets ``floor(f)`` whole copies of each
document for certain. For the rest, every document has the inclusion probability
``p = f - floor(f)`` and a fixed uniform number ``u`` drawn from its id and text; documents
are ranked by ``(u / (1 - u)) / (p / (1 - p))`` and taken in that order until the source's
target is met as nearly as whole documents can meet it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.llm.shared import NumberedRows, staged

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code point order, repeating, and the most copies.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
RANK_BINS = 1 << 14


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``source, source_size, target``: shares of all words by weight, none above ``most`` times
    its source's words; what a capped source leaves is shared by weight among the others.

    The sources are ordered by the share at which they reach their cap. Those that reach
    it first are capped; the others share what is left. One row per source: rows are
    summed before they meet in one task.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sums.withColumn("weight", weight.cast("bigint"))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0))
    shared = weighed.select(
        "*", left.alias("left"), F.sum("weight").over(after).alias("open"), F.row_number().over(by_cap).alias("nth")
    )
    # Capped: the share of what is left would exceed the cap. The first that is not ends them.
    fits = F.col("left") * F.col("weight") <= most * F.col("source_size") * F.col("open")
    first = F.min(F.when(fits, F.struct("nth", "left", "open"))).over(everything)
    cap = (most * F.col("source_size")).cast("double")
    share = (F.col("first.left") * F.col("weight")).cast("double") / F.col("first.open")
    return shared.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("nth") < F.col("first.nth"), cap).otherwise(share).alias("target"),
    )


def uniform(doc_id: Column, text: Column) -> Column:
    """A number strictly between 0 and 1, the same in every run. Rows that share an id, or have none, draw
    by their texts as well."""
    drawn = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(drawn), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def _planned(sizes: DataFrame, weights: Sequence[int], most: int, table_rows: int) -> DataFrame:
    """The columns of ``sizes`` with ``source_size, target, taken``."""
    targets = staged(source_targets(sizes, weights, most))
    few = targets.limit(table_rows + 1).count() <= table_rows
    key = sizes["source"].eqNullSafe(targets["source"])
    # Beyond the checked size Spark joins by source and splits what is skewed.
    met = sizes.join(F.broadcast(targets) if few else targets, key, "left").drop(targets["source"])

    copies = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    sure = F.floor(F.coalesce(copies, F.lit(0.0)))
    chance = F.coalesce(copies, F.lit(0.0)) - sure
    u = F.col("u")
    odds = (u / (1.0 - u)) / (F.col("chance") / (1.0 - F.col("chance")))
    ranked = met.select("*", sure.alias("sure"), chance.alias("chance")).withColumn(
        "rank", F.when((F.col("chance") > 0) & (F.col("size") > 0), odds)
    )
    # rank / (1 + rank) runs from 0 to 1, so equal steps of it make bins of bounded number.
    bin_ = F.floor(F.col("rank") / (1.0 + F.col("rank")) * RANK_BINS).cast("int")
    ranked = ranked.withColumn("bin", bin_).withColumn(
        "wanted", F.col("target") - F.col("sure") * F.col("source_size")
    )

    bins = ranked.where("bin is not null").groupBy("source", "bin").agg(
        F.sum("size").alias("bin_size"), F.first("wanted").alias("wanted")
    )
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = staged(bins.withColumn("before", F.coalesce(F.sum("bin_size").over(upto), F.lit(0))))
    met_in = sums.where("before <= wanted and before + bin_size > wanted").select(
        F.col("source").alias("cut_source"), F.col("bin").alias("cut_bin"), F.col("before").alias("cut_before")
    )
    cut = ranked.join(
        F.broadcast(met_in) if few else met_in, F.col("source").eqNullSafe(F.col("cut_source")), "left"
    )
    in_order = Window.partitionBy("source").orderBy("rank", "doc_id", "size", "row_no")
    middle = F.col("cut_before") + F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    inside = F.col("bin") == F.col("cut_bin")
    edge = cut.where(inside).withColumn("more", middle <= F.col("wanted"))
    # Without such a bin the whole source is wanted.
    rest = cut.where(~F.coalesce(inside, F.lit(False))).withColumn(
        "more", F.col("bin").isNotNull() & F.coalesce(F.col("bin") < F.col("cut_bin"), F.lit(True))
    )
    taken = F.col("size") * (F.col("sure") + F.col("more").cast("bigint"))
    return edge.unionByName(rest).select(*sizes.columns, "source_size", "target", taken.cast("bigint").alias("taken"))


# Up to so many sources their table is broadcast.
TABLE_ROWS = 100_000


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``.

    ``taken`` is ``size`` times the number of copies that the mix takes. Null and empty texts
    have no words and are not taken; a null source is a source. Repeated rows are sampled
    like others, ties in rank broken by doc_id and size. Other columns play no part.
    An empty table gives no rows; a text of any length is counted whole. A source of any size is spread over tasks: ranks are first summed per source and
    bin, which tells the bin where the target is met, and only that bin's rows are ordered.
    """
    sizes = _sizes(docs, F.lit(0))
    return _planned(sizes, weights, most, TABLE_ROWS).select("doc_id", "size", "source_size", "target", "taken")


def _sizes(docs: DataFrame, row_no: Column) -> DataFrame:
    """What the mix is planned by, staged: ``doc_id, source, size, u, row_no``."""
    text = F.col("text").cast("string")
    return staged(
        docs.select(
            "doc_id", "source", n_words(text).alias("size"), uniform(F.col("doc_id"), text).alias("u"), row_no.alias("row_no")
        )
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns it came with, whatever those are
    called; see ``mixed``."""
    rows = NumberedRows(docs)
    plan = _planned(_sizes(rows.frame, F.col(rows.row)), weights, most, TABLE_ROWS).where("taken > 0")
    times = plan.select(F.col("row_no").alias("row"), (F.col("taken") / F.col("size")).cast("int").alias("times"))
    taken = rows.taken(times, most)
    again = F.explode(F.sequence(F.lit(1), F.col(taken.columns[-1])))
    return taken.withColumn(taken.columns[-1], again).select(*docs.columns)
