"""Data-quality expectations, evaluated in fused passes.

All count-type checks of a table share one aggregate over it. Uniqueness adds
one grouped pass, and every foreign key one pre-aggregated anti-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from larderline.functions.columns import day, rounded_ratio, to_units
from larderline.operators.prints import maybe_repeated

NO_NULLS = "expect_no_nulls"
UNIQUE = "expect_unique"
ACCEPTED = "expect_accepted_values"
BETWEEN = "expect_values_between"
ROW_COUNT = "expect_row_count_between"
REFERENCE = "expect_referential_integrity"
FRESH = "expect_freshness"


@dataclass(frozen=True)
class Check:
    """One expectation on one table; ``options`` holds its parameters."""

    expectation: str
    table: str
    column: str = "*"
    options: dict = field(default_factory=dict)


def no_nulls(table: str, column: str) -> Check:
    return Check(NO_NULLS, table, column)


def unique(table: str, column: str) -> Check:
    return Check(UNIQUE, table, column)


def accepted_values(table: str, column: str, values: Sequence[str]) -> Check:
    return Check(ACCEPTED, table, column, {"values": list(values)})


def values_between(table: str, column: str, low: float, high: float, mostly: float = 1.0) -> Check:
    return Check(BETWEEN, table, column, {"low": float(low), "high": float(high), "mostly": float(mostly)})


def row_count_between(table: str, low: int, high: int) -> Check:
    return Check(ROW_COUNT, table, "*", {"low": low, "high": high})


def references(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check(REFERENCE, table, column, {"parent": parent, "parent_column": parent_column})


def fresh(table: str, column: str, max_days: int) -> Check:
    return Check(FRESH, table, column, {"max_days": max_days})


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bad_rows(check: Check) -> str:
    """SQL condition of a failing row for the row-wise expectations; NULL values fail only no_nulls."""
    value = f"`{check.column}`"
    if check.expectation == NO_NULLS:
        return f"{value} IS NULL"
    if check.expectation == ACCEPTED:
        return f"{value} NOT IN ({', '.join(_text(v) for v in check.options['values'])})"
    if check.expectation == BETWEEN:
        return f"{value} < {check.options['low']}D OR {value} > {check.options['high']}D"
    raise ValueError(f"{check.expectation} is not a row-wise expectation")


def _result(check: Check, passed: Column, **details: Column) -> Column:
    label = check.column
    if check.expectation == REFERENCE:
        label = f"{check.column} → {check.options['parent']}.{check.options['parent_column']}"
    return F.struct(
        F.lit(check.expectation).alias("expectation"),
        F.lit(check.table).alias("table_name"),
        F.lit(label).alias("column_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        F.to_json(F.struct(*[value.alias(name) for name, value in details.items()])).alias("details"),
    )


@dataclass(frozen=True)
class Keyed:
    """A column whose values are counted one by one; with ``parent``, they are looked up in its ``parent_column``."""

    column: str
    parent: DataFrame | None = None
    parent_column: str | None = None


def counted_by_prints(df: DataFrame, sums: dict[str, Column], maxima: dict[str, Column], keyed: dict[str, Keyed]) -> DataFrame:
    """The row of :func:`counted_once` for a table that is cheap to read again: three passes, but few keys are moved.

    Columns that meet no parent are compared by prints first (see ``prints``), and only values that may come twice in full.
    """
    alone = [x for x, k in keyed.items() if k.parent is None]
    nulls = {f"_nulls_{x}": F.col(keyed[x].column).isNull().cast("bigint") for x in alone}
    counted = counted_once(df, {**sums, **nulls}, maxima, {x: k for x, k in keyed.items() if k.parent is not None})
    if not alone:
        return counted
    by_value = maybe_repeated(df, [keyed[x].column for x in alone]).groupBy("place", *_by_bytes("value")).agg(F.count(F.lit(1)).alias("rows"))
    here = [(F.col("place") == i) & (F.col("rows") > 1) for i in range(len(alone))]
    repeated = by_value.agg(*[F.count_if(c).alias(f"_{x}") for x, c in zip(alone, here, strict=True)])
    # Both are one row: they come together as the largest of two.
    both = counted.unionByName(repeated, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in [*counted.columns, *repeated.columns]])
    for x in alone:
        empty = F.coalesce(f"_nulls_{x}", F.lit(0).cast("bigint"))
        null_repeated = (empty > 1).cast("bigint")
        found = {f"{x}_repeated": F.col(f"_{x}") + null_repeated, f"{x}_null_repeated": null_repeated, f"{x}_lost": F.col("n") - empty, f"{x}_parent_null": F.lit(False)}
        both = both.withColumns(found)
    return both.drop(*nulls, *[f"_{x}" for x in alone])


def _by_bytes(column: str) -> list[Column]:
    """What to group a text by: hex digits of whole bytes as these bytes, other text as it is."""
    packed = F.unhex(column)
    is_hex = F.coalesce(F.lower(F.hex(packed)) == F.col(column), F.lit(False))
    return [F.when(~is_hex, F.col(column)).alias("value"), F.when(is_hex, packed).alias("packed")]


def counted_once(df: DataFrame, sums: dict[str, Column], maxima: dict[str, Column], keyed: dict[str, Keyed]) -> DataFrame:
    """One row of everything that checks need to know of a table, from one pass over it and one exchange.

    Columns: ``n`` rows, the sums and maxima by name, and for each entry of ``keyed`` ``<name>_repeated`` (values seen
    more than once, all NULLs being one value), ``<name>_null_repeated`` (whether NULL is one of them), ``<name>_lost``
    (rows whose value is no value of the parent) and ``<name>_parent_null``.

    Each row becomes one row for its measures and one for each keyed column (entry, value as text); partial counts
    reduce them before the exchange, so a value held by a third of the table is one row of each task. Parents bring
    their values as rows of the same form, so children meet them without a join. Values that are hex digits of whole
    bytes, as digests are, travel as these bytes: half the size, and as distinct.
    """
    measures = {**sums, **maxima}
    if not keyed:
        return df.agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(m) for m, c in sums.items()], *[F.max(c).alias(m) for m, c in maxima.items()]
        )
    named = df.select(*[c.alias(f"_m_{m}") for m, c in measures.items()], *[F.col(k.column).cast("string").alias(f"_v_{x}") for x, k in keyed.items()])
    kinds = {m: named.schema[f"_m_{m}"].dataType for m in measures}
    whole = F.struct(
        F.lit("").alias("entry"), F.lit(None).cast("string").alias("value"), *[F.col(f"_m_{m}").alias(m) for m in measures]
    )
    single = [
        F.struct(F.lit(x).alias("entry"), F.col(f"_v_{x}").alias("value"), *[F.lit(None).cast(kinds[m]).alias(m) for m in measures])
        for x in keyed
    ]
    rows = named.select(F.inline(F.array(whole, *single))).withColumns({"_own": F.lit(1).cast("bigint"), "_known": F.lit(0)})
    for x, k in keyed.items():
        if k.parent is not None:
            values = k.parent.select(F.lit(x).alias("entry"), F.col(k.parent_column).cast("string").alias("value"))
            empty = {m: F.lit(None).cast(kinds[m]) for m in measures}
            rows = rows.unionByName(values.withColumns({**empty, "_own": F.lit(0).cast("bigint"), "_known": F.lit(1)}))
    text, packed = _by_bytes("value")
    rows = rows.withColumns({"packed": packed, "value": text})
    by_value = rows.groupBy("entry", "value", "packed").agg(
        F.sum("_own").alias("_own"), F.max("_known").alias("_known"), *[F.sum(m).alias(m) for m in sums], *[F.max(m).alias(m) for m in maxima]
    )
    own, is_null = F.col("_own"), F.col("value").isNull() & F.col("packed").isNull()
    out = [F.coalesce(F.sum(F.when(F.col("entry") == "", own)), F.lit(0)).cast("bigint").alias("n")]
    out += [F.sum(m).alias(m) for m in sums] + [F.max(m).alias(m) for m in maxima]
    for x in keyed:
        here = F.col("entry") == x
        out += [
            F.count_if(here & (own > 1)).alias(f"{x}_repeated"),
            F.count_if(here & (own > 1) & is_null).alias(f"{x}_null_repeated"),
            F.coalesce(F.sum(F.when(here & (F.col("_known") == 0) & ~is_null, own)), F.lit(0)).cast("bigint").alias(f"{x}_lost"),
            F.coalesce(F.bool_or(here & is_null & (F.col("_known") == 1)), F.lit(False)).alias(f"{x}_parent_null"),
        ]
    return by_value.agg(*out)


def _flag(condition: str) -> Column:
    return F.expr(f"CASE WHEN {condition} THEN 1L ELSE 0L END")


def _keyed(checks: list[Check], parents: dict[str, DataFrame]) -> dict[str, Keyed]:
    found = {}
    for i, check in enumerate(checks):
        if check.expectation == UNIQUE:
            found[f"k{i}"] = Keyed(check.column)
        elif check.expectation == REFERENCE:
            found[f"k{i}"] = Keyed(check.column, parents[check.options["parent"]], check.options["parent_column"])
    return found


def _table_results(df: DataFrame, checks: list[Check], parents: dict[str, DataFrame], as_of: date) -> DataFrame:
    """All checks of one table from one pass over it."""
    sums, maxima = {}, {}
    for i, check in enumerate(checks):
        if check.expectation == FRESH:
            maxima[f"m{i}"] = F.col(check.column).cast("date")
        elif check.expectation in (NO_NULLS, ACCEPTED, BETWEEN):
            sums[f"m{i}"] = _flag(bad_rows(check))
    counted = counted_once(df, sums, maxima, _keyed(checks, parents))
    results = []
    for i, check in enumerate(checks):
        m, o = F.col(f"m{i}"), check.options
        if check.expectation not in (ROW_COUNT, FRESH, UNIQUE, REFERENCE):
            m = F.coalesce(m, F.lit(0).cast("bigint"))
        if check.expectation == ROW_COUNT:
            results.append(
                _result(
                    check,
                    F.col("n").between(o["low"], o["high"]),
                    row_count=F.col("n"),
                    min_rows=F.lit(o["low"]),
                    max_rows=F.lit(o["high"]),
                )
            )
        elif check.expectation == FRESH:
            age = F.datediff(day(as_of), m)
            results.append(
                _result(check, age <= o["max_days"], days_since_latest=age, max_allowed=F.lit(o["max_days"]))
            )
        elif check.expectation == UNIQUE:
            repeated = F.col(f"k{i}_repeated")
            results.append(_result(check, repeated == 0, duplicate_count=repeated))
        elif check.expectation == REFERENCE:
            has_null = F.col(f"k{i}_parent_null")
            orphans = F.when(has_null, F.lit(0).cast("bigint")).otherwise(F.col(f"k{i}_lost"))
            results.append(_result(check, orphans == 0, orphan_count=orphans, parent_has_null=has_null))
        elif check.expectation == NO_NULLS:
            results.append(_result(check, m == 0, null_count=m))
        elif check.expectation == ACCEPTED:
            allowed = F.array(*[F.lit(v) for v in o["values"]])
            results.append(_result(check, m == 0, bad_count=m, accepted_values=allowed))
        else:
            share = F.coalesce(F.try_divide((F.col("n") - m).cast("double"), F.col("n")), F.lit(1.0))
            shown = F.coalesce(to_units(rounded_ratio(F.col("n") - m, F.col("n"), 4), 4), F.lit(1.0))
            results.append(
                _result(
                    check,
                    share >= o["mostly"],
                    min_val=F.lit(o["low"]),
                    max_val=F.lit(o["high"]),
                    mostly=F.lit(o["mostly"]),
                    pct_passing=shown,
                    bad_count=m,
                )
            )
    return counted.select(F.inline(F.array(*results)))


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """One row (orphans, parent_has_null) under NOT IN rules: a NULL in the parent hides all orphans."""
    counted = counted_once(child, {}, {}, {"k": Keyed(column, parent, parent_column)})
    has_null = F.col("k_parent_null")
    return counted.select(
        F.when(has_null, F.lit(0).cast("bigint")).otherwise(F.col("k_lost")).alias("orphans"), has_null.alias("parent_has_null")
    )


def run_checks(tables: dict[str, DataFrame], checks: Sequence[Check], as_of: date) -> DataFrame:
    """(expectation, table_name, column_name, passed, details as JSON), one row per check; each table is read once."""
    names = dict.fromkeys(check.table for check in checks)
    parts = [_table_results(tables[name], [c for c in checks if c.table == name], tables, as_of) for name in names]
    return reduce(DataFrame.unionByName, parts)


def summarise(results: DataFrame) -> DataFrame:
    """One row: passed and failed counts and the overall verdict."""
    return results.agg(
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("all_passed"),
    )


def profile(name: str, df: DataFrame) -> DataFrame:
    """(table_name, column_name, row_count, null_count, zero_count) of every column in one pass."""
    measures, rows = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema):
        numeric = isinstance(f.dataType, NumericType)
        measures.append(F.count_if(F.col(f.name).isNull()).alias(f"nulls{i}"))
        if numeric:
            measures.append(F.count_if(F.col(f.name) == 0).alias(f"zeros{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.col("n").alias("row_count"),
                F.col(f"nulls{i}").alias("null_count"),
                (F.col(f"zeros{i}") if numeric else F.lit(None).cast("bigint")).alias("zero_count"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def source_freshness(
    tables: dict[str, DataFrame], loaded_at: dict[str, str], as_of: date, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """(table_name, loaded_at_field, age_hours, status): pass, warn or error by age at ``as_of``."""
    parts = []
    for name, column in loaded_at.items():
        latest = F.max(F.col(column).cast("timestamp_ntz")).cast("date")
        parts.append(
            tables[name]
            .agg((F.datediff(day(as_of), latest).cast("bigint") * 24).alias("age_hours"))
            .select(F.lit(name).alias("table_name"), F.lit(column).alias("loaded_at_field"), "age_hours")
        )
    age = F.col("age_hours")
    status = F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def run_model_tests(
    layer: str,
    model: str,
    df: DataFrame,
    checks: Sequence[Check],
    parents: dict[str, DataFrame],
    as_of: date | None = None,
    read_again: bool = False,
) -> DataFrame:
    """(layer, model, column_name, test, failures, passed) for the declared tests of one model.

    ``failures`` counts failing rows; for uniqueness it counts repeated values
    and ignores NULLs, and a relationship ignores NULLs on both sides. The model
    is evaluated once, whatever its tests; with ``read_again``, for large models
    that are cheap to evaluate, unique columns cost two more passes and little
    disk. A kind of test that is not known is refused, and freshness needs ``as_of``.
    """
    unknown = [check.expectation for check in checks if check.expectation not in TEST_NAMES]
    if unknown:
        raise ValueError(f"{model}: no such test: {', '.join(unknown)}")
    if any(check.expectation == FRESH for check in checks) and as_of is None:
        raise ValueError(f"{model}: freshness needs as_of")
    plain = {f"m{i}": check for i, check in enumerate(checks) if check.expectation in (NO_NULLS, ACCEPTED, BETWEEN)}
    latest = {f"m{i}": F.col(check.column).cast("date") for i, check in enumerate(checks) if check.expectation == FRESH}
    count = counted_by_prints if read_again else counted_once
    counted = count(df, {m: _flag(bad_rows(check)) for m, check in plain.items()}, latest, _keyed(list(checks), parents))
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    # Bounds on size or age of one column are one test: it counts the bounds that do not hold.
    failing: dict[tuple[str, str, int | None], Column] = {}
    for i, check in enumerate(checks):
        if check.expectation == UNIQUE:
            failures = F.col(f"k{i}_repeated") - F.col(f"k{i}_null_repeated")
        elif check.expectation == REFERENCE:
            failures = F.col(f"k{i}_lost")
        elif check.expectation == ROW_COUNT:
            failures = F.when(F.col("n").between(check.options["low"], check.options["high"]), zero).otherwise(one)
        elif check.expectation == FRESH:
            failures = F.when(F.datediff(day(as_of), f"m{i}") <= check.options["max_days"], zero).otherwise(one)
        else:
            failures = F.coalesce(F.col(f"m{i}"), zero)
        name = check.expectation, check.column, None if check.expectation in (ROW_COUNT, FRESH) else i
        failing[name] = failing[name] + failures if name in failing else failures
    rows = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit(TEST_NAMES[expectation]).alias("test"),
            failures.alias("failures"),
            (failures == 0).alias("passed"),
        )
        for (expectation, column, _), failures in failing.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


TEST_NAMES = {
    NO_NULLS: "not_null",
    UNIQUE: "unique",
    ACCEPTED: "accepted_values",
    BETWEEN: "between",
    REFERENCE: "relationships",
    ROW_COUNT: "row_count",
    FRESH: "freshness",
}
