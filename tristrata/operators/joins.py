"""The equi-join every fact and dimension is assembled with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tristrata.functions.text import quoted
from tristrata.operators.schema import find_column
from tristrata.operators.skew import COUNT, KeyCounts, SkewPolicy, estimated_bytes, measured_bytes

_LEFT_FAN, _RIGHT_FAN = "__left_fan", "__right_fan"
_LEFT_SALT, _RIGHT_SALT, _HIT = "__left_salt", "__right_salt", "__hit"


def attach(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    policy: SkewPolicy = SkewPolicy(),
    keys_from: DataFrame | None = None,
    unique: bool = False,
    left_unique: bool = False,
    right_keys_from: DataFrame | None = None,
    counts: KeyCounts | None = None,
    measured: bool = False,
) -> DataFrame:
    """Join ``right`` to ``left`` on equally named keys; ``how`` is left or inner.

    A right side within Spark's own broadcast limit is joined without a shuffle,
    whatever the keys look like. Two larger sides are checked for hot keys, and
    rows of a hot key are spread over several tasks: its rows on the hot side get
    a salt, those on the other side are repeated once per salt. The result is that
    of the plain join.

    ``keys_from`` and ``right_keys_from`` name frames that have a side's keys in the same
    proportions but are cheaper to count, such as the base table of a join chain. Keys that are hot
    there are looked up in the right side itself, as it may lack them.
    ``unique`` says that the right side has about one row per key, being grouped or cleansed by it,
    and ``left_unique`` the same of the left side; such a side needs no counting. ``counts``
    is shared by the joins of one plan, so that none counts what another has counted.
    ``measured`` is for a right side that costs little to run and may be smaller than Spark's estimate:
    it is measured by one pass then, and broadcast if it is within the limit.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"cannot attach with a {how} join")
    keys = list(keys)
    for k in keys:
        sides = [df.schema[find_column(df, k) or k].dataType for df in (left, right)]
        if sides[0] != sides[1]:
            raise ValueError(f"{k} is {sides[0]} on one side only")
    limit = policy.broadcast_bytes
    if limit is None:
        limit = _bytes(left.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    if estimated_bytes(right) <= limit:
        return left.join(right, keys, how)
    if measured and limit > 0 and measured_bytes(right) <= limit:
        return left.join(F.broadcast(right), keys, how)

    counts = counts or KeyCounts()
    hot_left = None if left_unique else counts.hot(left if keys_from is None else keys_from, keys, policy)
    hot_right = None if unique else counts.hot(right if right_keys_from is None else right_keys_from, keys, policy)
    if hot_right is not None and right_keys_from is not None:
        hot_right = _there(hot_right, right, keys, policy)
    if hot_left is None and hot_right is None:
        return left.join(right, keys, how)
    fans = _fans(keys, hot_left, hot_right, policy)
    rows = fans.limit(policy.listed + 1).collect()
    if not rows:
        return left.join(right, keys, how)
    if len(rows) <= policy.listed:
        fans = F.broadcast(left.sparkSession.createDataFrame(rows, fans.schema))
        widest = max(max(r[_LEFT_FAN], r[_RIGHT_FAN]) for r in rows)
    else:
        widest = fans.agg(F.max(F.greatest(_LEFT_FAN, _RIGHT_FAN))).first()[0]
    return _spread_join(left, right, keys, how, fans, widest)


def _there(hot: DataFrame, right: DataFrame, keys: list[str], policy: SkewPolicy) -> DataFrame:
    """The hot keys that the right side has: an unmatched row is told from a copy that met an
    empty salt by its key being hot."""
    rows = hot.limit(policy.listed + 1).collect()
    known = hot
    if len(rows) <= policy.listed:
        known = F.broadcast(hot.sparkSession.createDataFrame(rows, hot.schema))
    present = right.select(*[quoted(k) for k in keys]).join(known.drop(COUNT), keys, "left_semi").distinct()
    return known.join(present, keys, "left_semi")


def _fans(
    keys: list[str], left: DataFrame | None, right: DataFrame | None, policy: SkewPolicy
) -> DataFrame:
    """The number of tasks that each hot key's rows go to, on either side."""
    parts = []
    for hot, mine, other in ((left, _LEFT_FAN, _RIGHT_FAN), (right, _RIGHT_FAN, _LEFT_FAN)):
        if hot is not None:
            fan = F.ceil(F.col(COUNT) / policy.rows_per_task).cast("int")
            named = [quoted(k).alias(k) for k in keys]
            parts.append(hot.select(*named, fan.alias(mine), F.lit(1).alias(other)))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.groupBy(*[quoted(k) for k in keys]).agg(
        F.max(_LEFT_FAN).alias(_LEFT_FAN), F.max(_RIGHT_FAN).alias(_RIGHT_FAN)
    )


def _bytes(setting: str) -> int:
    """A size setting in bytes; Spark reports sizes as plain or suffixed numbers."""
    text = setting.strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)


def _spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: DataFrame, widest: int
) -> DataFrame:
    left_fan, right_fan = F.coalesce(_LEFT_FAN, F.lit(1)), F.coalesce(_RIGHT_FAN, F.lit(1))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | quoted(k).isNull()
    # A row without a key matches nothing: it may go anywhere, so it goes everywhere.

    spread_left = (
        left.join(hot, keys, "left")
        .withColumn(_LEFT_SALT, _salt(left, keys, F.when(no_key, widest).otherwise(left_fan)))
        .withColumn(_RIGHT_SALT, F.explode(F.sequence(F.lit(0), right_fan - 1)))
        .drop(_LEFT_FAN)
    )
    spread_right = (
        right.join(hot, keys, "left")
        .withColumn(_RIGHT_SALT, _salt(right, keys, right_fan))
        .withColumn(_LEFT_SALT, F.explode(F.sequence(F.lit(0), left_fan - 1)))
        .withColumn(_HIT, F.lit(True))
        .drop(_LEFT_FAN, _RIGHT_FAN)
    )
    joined = spread_left.join(spread_right, [*keys, _LEFT_SALT, _RIGHT_SALT], how)
    # A key that is hot on the right has a match for sure, so copies of a left row
    # that met an empty salt are no unmatched rows.
    kept = joined.where(F.col(_HIT).isNotNull() | (right_fan == 1))
    return kept.drop(_LEFT_SALT, _RIGHT_SALT, _RIGHT_FAN, _HIT)


def _salt(df: DataFrame, keys: list[str], fan: Column) -> Column:
    """Spread a key's rows over ``fan`` salts: by content, and by input partition so
    that copies of one row part too. Both are the same when a task is run again."""
    content = [
        quoted(f.name)
        for f in df.schema.fields
        if f.name not in keys and not isinstance(f.dataType, MapType)
    ]
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *content), fan).cast("int")
    return F.when(fan > 1, spread).otherwise(0)
