"""Join helpers: joins that adaptive execution can split, tables dealt out before they grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def splittable_left_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """facts LEFT JOIN lookup, planned so that a hot key's facts can be split.

    Adaptive execution splits a skewed partition only where both inputs arrive
    through a plain exchange. A lookup that was grouped by the join keys is
    already partitioned on them and would skip its exchange, which pins every
    row of a hot key to one task. Leading the keys with their hash keeps both
    exchanges (the lookup, one row per key, is the small one to move twice) and
    makes the sort compare one number first. NULL keys match nothing, as usual.
    """
    code = F.xxhash64(*on)
    left, right = facts.withColumn("_code", code), lookup.withColumn("_code", code)
    return left.join(right, ["_code", *on], "left").drop("_code")


def sharing_left_join(facts: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """:func:`splittable_left_join` for a lookup whose plan is read elsewhere too.

    An equality would have the planner drop null keys all the way down the lookup, which then differs from its other
    uses and shares no exchange with them. Here nulls meet, and what they would bring is left out.
    """
    code = F.xxhash64(*on)
    others = [c for c in lookup.columns if c not in on]
    right = lookup.select(code.alias("_lookup_code"), *[F.col(c).alias(f"_lookup_{c}") for c in on], *others)
    match = F.col("_code") == F.col("_lookup_code")
    whole = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_lookup_{c}"))
        whole = whole & F.col(c).isNotNull()
    joined = facts.withColumn("_code", code).join(right, match, "left")
    return joined.select(*facts.columns, *[F.when(whole, F.col(c)).alias(c) for c in others])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal out a table about to grow, so that every core gets some of it, whatever its files look like."""
    return df.repartition(key)


def deal_out(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Rows with equal keys together, in order of the keys or of ``order``, in as many partitions as the session shuffles into.

    For a table about to grow: adaptive execution would join its partitions by the size they have before it, and the
    tasks after it would hold too much to sort or group in memory.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*(order or keys))


#: Bytes in memory for a byte of the planner's estimate, which counts files as they are compressed.
UNPACKED = 8


def may_broadcast(df: DataFrame) -> bool:
    """Whether a table is small enough, by the planner's estimate, to be sent to every task. Runs no job."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate * UNPACKED <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
