"""Column helpers shared by every mart."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of the given columns, with a mark in place of NULL."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK))
        for c in columns
    ]
    return F.md5(F.concat_ws("|", *parts))


def day(value: date) -> Column:
    """A reference date (the caller's "today") as a DATE literal."""
    return F.lit(value.isoformat()).cast("date")


def in_cents(money: Column) -> Column:
    """Exact cents of a two-decimal amount."""
    return (money * F.lit(100)).cast("bigint")


def rounded_ratio(numerator: Column, denominator: Column, digits: int = 0) -> Column:
    """round(numerator / denominator, digits) of two integers, as a BIGINT in units of 10^-digits.

    Works in integers of up to 38 digits, half away from zero, so half-cent cases do not
    depend on binary fractions; in 64 bits where they hold every step, which is many times faster.
    NULL when the denominator is 0 or NULL.
    """
    sign = F.signum(numerator.cast("double")).cast("bigint") * F.signum(denominator.cast("double")).cast("bigint")

    def size(top: Column, bottom: Column, kind: str) -> Column:
        return F.call_function("div", (F.abs(top) * 2 + bottom).cast(kind), (bottom * 2).cast(kind))

    wide = "decimal(38,0)"
    bottom = F.nullif(F.abs(denominator.cast("bigint")), F.lit(0).cast("bigint"))
    wide_size = size((numerator.cast(wide) * F.lit(10**digits)).cast(wide), bottom, wide)
    short, most = numerator.try_cast("bigint"), 2**60
    fits = short.between(-most // 10**digits, most // 10**digits) & denominator.cast("bigint").between(-most, most)
    short_size = size(short * F.lit(10**digits).cast("bigint"), bottom, "bigint")
    return F.when(fits, short_size).otherwise(wide_size) * sign


def to_units(scaled: Column, digits: int) -> Column:
    """Undo the 10^digits scale of :func:`rounded_ratio` as a DOUBLE."""
    return scaled.cast("double") / F.lit(float(10**digits))


def true_when(condition: Column) -> Column:
    """TRUE where the condition holds, FALSE otherwise (also when it is NULL)."""
    return F.when(condition, F.lit(True)).otherwise(F.lit(False))


def lookup(key: Column, table: dict) -> Column:
    """CASE key WHEN k THEN v ... END; NULL for keys outside the table."""
    branches = iter(table.items())
    first, value = next(branches)
    chain = F.when(key == F.lit(first), F.lit(value))
    for name, value in branches:
        chain = chain.when(key == F.lit(name), F.lit(value))
    return chain
