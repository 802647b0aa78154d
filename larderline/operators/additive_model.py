"""Additive regression of many series at once: trend with changepoints, seasons, holidays, from sums of products.

A fit needs only the sums of products of its features (the Gram matrix) and of features and values. Those sums are
mergeable, so a backtest fold is the running sum of the weeks up to its cutoff, and no week is copied to a fold.
Features are whole numbers of 2^-20, so the sums are exact whatever the order of rows. The systems are then solved
side by side in array expressions, by symmetric elimination without pivots (the penalties keep them positive definite).

Ridge penalties play the part of the priors: strong on trend changes, weak on the seasons. Changepoints lie at fixed
shares of the whole series; a fold that ends before one leaves it at zero.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT = 2**20
CHANGEPOINTS = 10
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR = 0.05
SEASONAL_PRIOR = 10.0
#: Period in days and number of waves.
YEARLY = (365.25, 10)
MONTHLY = (30.5, 3)
INTERVAL_Z = 1.2815515655446004  # central 80 %
LEAST_NOISE = 1e-6

#: Places of the trend: level, slope, changepoints.
TREND = 2 + CHANGEPOINTS
SEASON = 2 * (YEARLY[1] + MONTHLY[1])


def frequencies() -> list[float]:
    """Radians a day of every wave, the yearly ones first."""
    return [2.0 * math.pi * k / period for period, order in (YEARLY, MONTHLY) for k in range(1, order + 1)]


def penalties(holidays: int) -> list[float]:
    return [1e-8] * 2 + [1.0 / CHANGEPOINT_PRIOR**2] * CHANGEPOINTS + [1.0 / SEASONAL_PRIOR**2] * (SEASON + holidays)


def features(day: Column, start: Column, span: Column, holidays: Sequence[Sequence[int]]) -> Column:
    """array<bigint>: level, slope, changepoints, waves (all sines, then all cosines), one flag for each list of days."""
    elapsed = F.call_function("div", (day - start) * (2 * UNIT) + span, span * 2)
    bends = [F.greatest(F.lit(0).cast("bigint"), elapsed - round(UNIT * CHANGEPOINT_RANGE * c / CHANGEPOINTS)) for c in range(1, CHANGEPOINTS + 1)]
    whole = lambda x: F.floor(x * float(UNIT) + 0.5)
    waves = [whole(turn(day.cast("double") * w)) for turn in (F.sin, F.cos) for w in frequencies()]
    flags = [F.when(day.isin(list(days)), UNIT).otherwise(0).cast("bigint") if days else F.lit(0).cast("bigint") for days in holidays]
    return F.array(F.lit(UNIT).cast("bigint"), elapsed, *bends, *waves, *flags)


def _entries(size: int) -> Column:
    """array<struct<g, h>> of a row with ``_f`` and ``_y``: products of features, then of features and value, then the
    count, the sums of values and squares, and the value itself (for its maximum)."""
    exact = "decimal(38,0)"
    y = F.col("_y").cast("decimal(18,0)")
    pair = lambda g, h: F.struct(g.cast("bigint").alias("g"), h.cast(exact).alias("h"))
    none = F.lit(None)
    products = F.flatten(
        F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.transform(F.slice("_f", i, size), lambda x: pair(x * F.element_at("_f", i), none)))
    )
    moments = F.transform("_f", lambda x: pair(none, x.cast("decimal(19,0)") * y))
    rest = F.array(pair(F.lit(1), none), pair(none, y), pair(none, (y * y).cast(exact)), pair(F.col("_y"), none))
    return F.concat(products, moments, rest)


def places(size: int) -> int:
    """Number of sums of a fold with ``size`` features."""
    return size * (size + 1) // 2 + size + 4


def fold_sums(rows: DataFrame, keys: Sequence[str], size: int, constants: Sequence[str]) -> DataFrame:
    """(*keys, _fold, *constants, _sums, _tests): for every fold the sums over all rows of its number or a higher one.

    ``rows`` hold keys, ``_fold``, ``_y``, ``_f``, ``_day`` and columns that are constant for a key. A row without ``_f`` is
    not summed: it is handed on as (g: day, h: value) in ``_tests`` of its fold, which must have rows of its own.
    """
    test = F.array(F.struct(F.col("_day").cast("bigint").alias("g"), F.col("_y").cast("decimal(38,0)").alias("h")))
    each = rows.select(*keys, "_fold", *constants, "_day", F.col("_f").isNull().alias("_is_test"), F.posexplode(F.coalesce(F.when(F.col("_f").isNotNull(), _entries(size)), test)))
    place = F.when(F.col("_is_test"), F.col("_day") + places(size)).otherwise(F.col("pos").cast("bigint")).alias("pos")
    by_place = each.groupBy(*keys, "_fold", place).agg(
        F.sum("col.g").alias("g"), F.sum("col.h").alias("h"), F.max("col.g").alias("m"), *[F.max(c).alias(c) for c in constants]
    )
    # One row a fold and place; the sums run from the fold with the earliest cutoff.
    later = Window.partitionBy(*keys, "pos").orderBy(F.desc("_fold"))
    sums = F.struct("pos", F.sum("g").over(later).alias("g"), F.sum("h").over(later).alias("h"), F.max("m").over(later).alias("m"))
    running = by_place.select(*keys, "_fold", *constants, sums.alias("_sum"))
    whole = running.groupBy(*keys, "_fold").agg(F.sort_array(F.collect_list("_sum")).alias("_sums"), *[F.max(c).alias(c) for c in constants])
    return whole.withColumn("_tests", F.slice("_sums", places(size) + 1, F.greatest(F.size("_sums") - places(size), F.lit(0))))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """A few wide rows over all cores, which adaptive execution would put into one task.

    The exchange also keeps the arrays made before it from being written into the lambdas that read them.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def systems(sums: DataFrame, size: int, holidays: int) -> DataFrame:
    """The equations of every fold: ``_system`` (rows of coefficients and right side), with ``_noise``, ``_scale``, ``_right``,
    ``_n`` and ``_yy``. Values are divided by the largest one, products by the square of the unit."""
    pairs = size * (size + 1) // 2
    at = lambda i: F.get("_sums", i)
    number = lambda place: at(F.lit(pairs + size + place))
    n, y, yy = number(0)["g"].cast("double"), number(1)["h"].cast("double"), number(2)["h"].cast("double")
    named = sums.filter(F.size("_sums") > pairs).withColumns({"_n": n, "_mean": y / n, "_yy": yy})
    named = named.withColumn("_scale", F.greatest(number(3)["m"].cast("double"), F.lit(1.0)))
    spread = (F.col("_yy") / F.col("_n") - F.col("_mean") * F.col("_mean")) / (F.col("_scale") * F.col("_scale"))
    named = named.withColumn("_noise", F.greatest(spread, F.lit(LEAST_NOISE)))
    weights = F.array(*map(F.lit, penalties(holidays)))
    rows_ = F.sequence(F.lit(0), F.lit(size - 1))

    def product(i: Column, j: Column) -> Column:
        low, high = F.least(i, j), F.greatest(i, j)
        return at(low * size - F.call_function("div", low * (low - 1), F.lit(2)).cast("int") + high - low)["g"].cast("double") / float(UNIT**2)

    right = lambda i: at(i + pairs)["h"].cast("double") / float(UNIT) / F.col("_scale")
    row = lambda i: F.transform(rows_, lambda j: product(i, j) + F.when(i == j, F.get(weights, i) * F.col("_noise")).otherwise(0.0))
    made = {
        "_system": F.transform(rows_, lambda i: F.concat(row(i), F.array(right(i)))),
        "_right": F.transform(rows_, right),
    }
    return named.withColumns(made).drop("_sums", "_mean")


def solved(equations: DataFrame, size: int, holidays: int) -> DataFrame:
    """Adds ``_beta`` (coefficients of the features in their natural scale) and ``_spread`` of the residuals to every fold."""
    rows_ = F.sequence(F.lit(0), F.lit(size - 1))

    def eliminate(m: Column, k: Column) -> Column:
        """Solve for unknown k: its column leaves every row, so that what is left at the end is the solution."""
        top = F.get(m, k)
        rest = F.slice(top, 2, size)
        return F.transform(
            m,
            lambda r, i: F.when(i == k, F.transform(rest, lambda x: x / F.get(top, F.lit(0)))).otherwise(
                F.zip_with(F.slice(r, 2, size), rest, lambda a, b: a - (F.get(r, F.lit(0)) / F.get(top, F.lit(0))) * b)
            ),
        )

    named = equations.withColumn("_beta", F.flatten(F.aggregate(rows_, F.col("_system"), eliminate)))
    explained = F.zip_with("_beta", "_right", lambda b, r: b * r)
    weights = F.array(*map(F.lit, penalties(holidays)))
    shrunk = F.zip_with("_beta", weights, lambda b, w: b * b * (w * F.col("_noise")))
    added = lambda values: F.aggregate(values, F.lit(0.0), lambda s, x: s + x)
    left = F.col("_yy") / (F.col("_scale") * F.col("_scale")) - added(explained) - added(shrunk)
    sigma = F.sqrt(F.greatest(left, F.lit(0.0)) / F.greatest(F.col("_n") - 2.0, F.lit(1.0))) * F.col("_scale")
    return named.withColumn("_spread", sigma).drop("_system", "_right", "_noise", "_n", "_yy")


def predicted(made: Column, places: int | None = None) -> Column:
    """The value at features ``made`` of a row with ``_beta`` and ``_scale``; of the first ``places`` features only."""
    used = made if places is None else F.slice(made, 1, places)
    terms = F.zip_with(used, F.slice("_beta", 1, F.size(used)), lambda x, b: x.cast("double") / float(UNIT) * b)
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) * F.col("_scale")
