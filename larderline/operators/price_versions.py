"""Slowly changing versions (type 2): building, merging, closing, joining at a date."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from larderline.functions.columns import day
from larderline.operators.dedup import keep_first

LAST_FIRST = F.desc_nulls_last


def close_versions(
    changes: DataFrame,
    key: str,
    changed_at: str,
    updated_at: Sequence[Column] = (),
    block: str = "month",
) -> DataFrame:
    """Turn a change log into half-open versions: adds ``valid_from`` and ``valid_to``.

    A version ends where the next change of its key starts; the last one stays
    open (NULL). Repeated (key, changed_at) rows are reduced to the latest one.

    The next change is looked up in two levels, inside (key, calendar block) and
    then over the blocks of a key, so the whole history of a hot key never has
    to sit in one window partition.
    """
    versions = keep_first(changes, [key, changed_at], list(updated_at) or [F.col(changed_at)])
    versions = versions.withColumn("_block", F.date_trunc(block, F.col(changed_at)))
    block_starts = versions.groupBy(key, "_block").agg(F.min(changed_at).alias("_start"))
    over_blocks = Window.partitionBy(key).orderBy("_block")
    next_blocks = block_starts.select(key, "_block", F.lead("_start").over(over_blocks).alias("_next_block"))
    in_block = Window.partitionBy(key, "_block").orderBy(changed_at)
    return (
        versions.join(next_blocks, [key, "_block"], "left")
        .withColumn("valid_to", F.coalesce(F.lead(changed_at).over(in_block), F.col("_next_block")))
        .withColumn("valid_from", F.col(changed_at))
        .drop("_block", "_next_block")
    )


def merge_versions(
    existing: DataFrame, changes: DataFrame, key: str, changed_at: str
) -> DataFrame:
    """Fold changes into an existing version table.

    ``existing`` is the output of :func:`close_versions`. A change that comes late, dated before the newest version
    of its key, splits the version it falls into; one dated like an existing version is known already. A version
    closed earlier than its successor's start (a deleted key that came back) keeps its own end.
    """
    known = existing.select(F.col(key).alias("_key"), F.col("valid_from").alias("_known"))
    fresh = changes.join(known, (F.col(key) == F.col("_key")) & (F.col(changed_at) == F.col("_known")), "left_anti")
    kept = existing.withColumnRenamed("valid_to", "_closed").drop("valid_from")
    together = kept.unionByName(fresh, allowMissingColumns=True)
    return (
        close_versions(together, key, changed_at, [F.asc_nulls_last("_closed")])
        .withColumn("valid_to", F.least("valid_to", "_closed"))
        .drop("_closed")
    )


def close_missing(versions: DataFrame, source_keys: DataFrame, key: str, as_of: date) -> DataFrame:
    """Hard deletes: end the open version of every key that the source no longer holds."""
    present = source_keys.select(F.col(key).alias("_present")).distinct()
    kind = versions.schema["valid_to"].dataType
    gone = F.col("_present").isNull() & F.col("valid_to").isNull()
    return (
        versions.join(present, F.col(key) == F.col("_present"), "left")
        .withColumn("valid_to", F.when(gone, day(as_of).cast(kind)).otherwise(F.col("valid_to")))
        .drop("_present")
    )


def join_at(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str | Column,
    as_of: date,
    by_year: bool = False,
) -> DataFrame:
    """facts LEFT JOIN the version whose [valid_from, valid_to) holds ``at``, a column of the facts or made of some.

    ``versions`` must be disjoint per key, so a fact meets at most one version
    and needs no second dedup. An open version counts until the day after
    ``as_of``. ``by_year`` adds the calendar year to the join key: the choice for
    version tables too large to broadcast, since it spreads a hot key over its
    years and bounds the versions compared with one fact.
    """
    ends = F.coalesce(F.col("valid_to"), F.date_add(day(as_of), 1))
    spans = versions.withColumnRenamed(key, "_key").withColumn("_ends", ends)
    at = F.col(at) if isinstance(at, str) else at
    match = (F.col(key) == F.col("_key")) & (at >= F.col("valid_from")) & (at < F.col("_ends"))
    if by_year:
        spans = spans.filter(F.col("_ends") > F.col("valid_from")).withColumn(
            "_version_year",
            F.explode(F.sequence(F.year("valid_from"), F.year(F.date_sub(F.col("_ends"), 1)))),
        )
        match = match & (F.year(at) == F.col("_version_year"))
        return facts.join(spans, match, "left").drop("_key", "_ends", "_version_year")
    return facts.join(spans, match, "left").drop("_key", "_ends")


def disjoint_versions(versions: DataFrame, key: str, as_of: date) -> DataFrame:
    """Resolve overlapping versions: on every day the latest start wins, then the latest end, open ones last.

    The overlap is settled once on the version table, not once per fact; the result feeds :func:`join_at`. Of versions
    of a key that start together, only the last-ending one and an open one can win, so each key keeps at most two rows
    per start (reduced before the exchange). The rest is one sweep over the rows of a key in order of their starts, with
    a stack of the versions that are open and not yet outlived by a later one: rows, pieces and steps are linear in the
    versions. The stack is all that passes from one block of sorted rows to the next, so no key is ever held whole.
    Versions without a key or start, and those that end before they start, are left out.
    """
    ends = F.coalesce(F.col("valid_to"), F.date_add(day(as_of), 1))
    spans = versions.withColumn("_ends", ends).filter(
        F.col(key).isNotNull() & F.col("valid_from").isNotNull() & (F.col("_ends") > F.col("valid_from"))
    )
    others = [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    is_open = F.col("valid_to").isNull().alias("_open")
    # The largest of equal ends by the other columns, so that the choice does not depend on the order of rows.
    best = F.max(F.struct("_ends", *others)).alias("_best")
    reduced = spans.groupBy(key, "valid_from", is_open).agg(best).select(key, "valid_from", "_open", "_best.*")
    rows = reduced.repartition(key).sortWithinPartitions(key, "valid_from", F.desc("_open"), "_ends")
    kinds = {f.name: f.dataType for f in versions.schema}
    target = StructType([StructField(c, kinds[c]) for c in [key, *others, "valid_from", "valid_to"]])
    pieces = rows.select(key, *others, F.col("valid_from").cast(rows.schema["_ends"].dataType).alias("_from"), "_ends")
    swept = pieces.mapInArrow(_sweep(key), StructType([*target.fields[:-2], *[StructField(c, rows.schema["_ends"].dataType) for c in ("valid_from", "valid_to")]]))
    return swept.select(*[F.col(c).cast(kinds[c]).alias(c) for c in versions.columns])


def _sweep(key: str) -> Callable:
    """A function from sorted blocks of versions (key, ..., _from, _ends) to the pieces on which each of them wins."""

    def run(blocks: Iterator) -> Iterator:
        import pyarrow as pa

        held = None  # the open versions of the key at hand
        stack: list[int] = []  # their rows: starts rise and ends fall towards its top
        now_key, now = None, 0

        def advance(ends: list[int], until: int | None, out: list[tuple[int, int, int]]) -> None:
            """Give the time up to ``until`` to the versions on the stack, from its top."""
            nonlocal now
            while stack and (until is None or now < until):
                top = stack[-1]
                end = ends[top] if until is None else min(ends[top], until)
                if end > now:
                    out.append((top, now, end))
                    now = end
                if ends[top] <= now:
                    stack.pop()

        def pieces(rows: pa.Table, out: list[tuple[int, int, int]]) -> Iterator:
            if not out:
                return
            kind = rows.schema.field("_from").type
            top, begins, stops = zip(*out)
            kept = rows.drop_columns(["_from", "_ends"]).take(pa.array(top, pa.int64()))
            for name, values in (("valid_from", begins), ("valid_to", stops)):
                kept = kept.append_column(name, pa.array(values, numbers(kind)).cast(kind))
            yield from kept.combine_chunks().to_batches()

        def numbers(kind: pa.DataType) -> pa.DataType:
            return pa.int32() if pa.types.is_date32(kind) else pa.int64()

        def listed(rows: pa.Table, name: str) -> list[int]:
            return rows.column(name).cast(numbers(rows.schema.field(name).type)).to_pylist()

        for block in blocks:
            rows = pa.Table.from_batches([block])
            first = 0 if held is None else held.num_rows
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys, starts, ends = rows.column(key).to_pylist(), listed(rows, "_from"), listed(rows, "_ends")
            out: list[tuple[int, int, int]] = []
            for at in range(first, len(keys)):
                if keys[at] != now_key:
                    advance(ends, None, out)
                    now_key = keys[at]
                advance(ends, starts[at], out)
                while stack and ends[stack[-1]] <= ends[at]:
                    stack.pop()
                stack.append(at)
                now = starts[at]
            yield from pieces(rows, out)
            held = rows.take(pa.array(stack, pa.int64())).combine_chunks()
            stack = list(range(len(stack)))
        if held is not None:
            out = []
            advance(listed(held, "_ends"), None, out)
            yield from pieces(held, out)

    return run
