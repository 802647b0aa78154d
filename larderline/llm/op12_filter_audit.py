"""Audit of how filters interact, by retractions over a stream of files.

Five filters judge whole texts: A (under 100 words), B (100 distinct words < 80 words), C (100 capitals > 10 code points),
D (holds one of # $ % & * |), E (identical to the text of a smaller doc_id). What any order of them removes follows from
the counts of documents by part and by mask, the set of filters that a document fails.

A to D need the text alone. E is incremental: the files are read as a stream in available-now micro-batches, and keyed
state holds, for each text (by 128 bits of its SHA-256), the smallest doc_id met and how its documents are counted; texts are dealt
by hash to groups of a few hundred, which are read and written together. When a smaller id arrives later, the earlier
documents are retracted from the part counters and counted again with E. Increments are written by an exactly-once file
sink and added up at the end: state, offsets and sink lie in the shared folder, so a run that loses executors goes on
from the last batch.

Copies are reduced before they meet: each map task sends, for a text, one row for each way in which its documents with
the smallest id are counted and one for each way of the others, so a text that a third of the documents share
costs a few rows a batch.

Null text is empty. A null doc_id has no smaller one and is none: it never fails E. Rows that repeat an id and a text are
not copies of each other. A null lang is the part of the empty string. An id with several labels has each mark that
one of them has; ids without a label have none, and labels without an id are left out. An empty table gives an empty
result; extra columns are left out.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from larderline.llm.common import arrow_map, column_of, shared_folder, table, texts_of

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
#: Every order of the filters.
ORDERS = ["".join(p) for p in permutations(FILTERS)]

CAPITALS, MARKS = bytes(range(65, 91)), b"#$%&*|"


def failed(text: str) -> int:
    """Mask of A to D."""
    data = text.encode()
    words = data.split()  # bytes split at exactly 0x20 and 0x09 to 0x0D
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        BIT["A"] * (len(words) < 100)
        | BIT["B"] * (100 * len(set(words)) < 80 * len(words))
        | BIT["C"] * (100 * capitals > 10 * len(text))
        | BIT["D"] * (len(data.translate(None, MARKS)) < len(data))
    )


def judged(documents: DataFrame) -> DataFrame:
    """key (128 bits of the SHA-256 of the text), mask of A to D, doc_id and part of every row."""

    def rows(batch):
        texts = texts_of(batch)
        return {
            "key": [sha256(t.encode()).digest()[:16] for t in texts],
            "mask": [failed(t) for t in texts],
            "doc_id": column_of(batch, "doc_id"),
            "part": column_of(batch, "part"),
        }

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("part"))
    return arrow_map(narrow, "key binary, mask int, doc_id long, part string", rows)


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with good and toxic, of the labels of their doc_id. Rows without an id are dealt by text, and match none."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("__of"))
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(f"__{c}")
    marks = marks.agg(one("quality"), one("toxic")).withColumn("__salt", F.lit(0).cast("long"))
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("key")).otherwise(0)
    on = (F.coalesce("doc_id", F.lit(0)) == F.col("__of")) & (salt == F.col("__salt")) & F.col("doc_id").isNotNull()
    flag = lambda c: F.coalesce(f"__{c}", F.lit(False))
    return rows.join(marks, on, "left").select(*rows.columns, flag("quality").alias("good"), flag("toxic").alias("toxic"))


REDUCED = "key binary, mask int, doc_id long, part string, good boolean, toxic boolean, n long"


def reduced(rows: DataFrame) -> DataFrame:
    """Counts of a batch's rows by text and way of counting, apart for the smallest id of the text.

    Rows that are surely copies (a smaller id stands in the same batch) keep that smaller id and a negative count.
    """

    def counted(batch):
        columns = [column_of(batch, c).to_pylist() for c in ("key", "mask", "doc_id", "part", "good", "toxic")]
        least: dict[bytes, int] = {}
        for key, name in zip(columns[0], columns[2]):
            if name is not None and name <= least.get(key, name):
                least[key] = name
        found: Counter = Counter()
        for key, mask, name, *way in zip(*columns):
            if name is not None and name > least[key]:
                found[(key, mask, least[key], *way, -1)] += 1
            else:
                found[(key, mask, name, *way, 1)] += 1
        names = ["key", "mask", "doc_id", "part", "good", "toxic"]
        made = dict(zip(names, map(list, zip(*[row[:6] for row in found]))))
        return made | {"n": [row[6] * n for row, n in found.items()]}

    return arrow_map(rows, REDUCED, counted)


CHANGE = "part string, mask int, good boolean, toxic boolean, n long"
#: The state of a group of texts: packed entries, one for each way in which the documents of a text's smallest id are
#: counted, and the ways that occur.
STATE = "entries binary, part array<string>, good array<boolean>, toxic array<boolean>"
ENTRY = np.dtype([("key", "V16"), ("doc_id", "<i8"), ("way", "<u4"), ("n", "<i8")])


def changes(group: tuple, frames: Iterator, state) -> Iterator:
    """Increments of the part counters by the rows of a group of texts; retractions when a smaller id of a text comes."""
    import pandas as pd

    least: dict[bytes, int] = {}
    ways: dict[bytes, Counter] = {}
    if state.exists:
        entries, *columns = state.get
        known_ways = list(zip(*columns))
        for key, name, way, n in np.frombuffer(bytes(entries), ENTRY).tolist():
            least[key] = name
            ways.setdefault(key, Counter())[known_ways[way]] = n
    out: Counter = Counter()
    copy = BIT["E"]
    for frame in frames:
        missing = frame["doc_id"].isna().tolist()
        rows = zip(*[frame[c].tolist() for c in ("key", "mask", "doc_id", "part", "good", "toxic", "n")], missing)
        for key, mask, name, part, good, toxic, n, is_missing in rows:
            way = part, good, toxic
            if is_missing:
                out[(*way, mask)] += n
                continue
            known = least.get(key)
            if n < 0:
                out[(*way, mask | copy)] -= n
                continue
            if known is not None and name > known:
                out[(*way, mask | copy)] += n
                continue
            if known is None:
                ways[key] = Counter()
            elif name < known:
                for old, m in ways[key].items():
                    out[(*old, mask)] -= m
                    out[(*old, mask | copy)] += m
                ways[key].clear()
            least[key] = int(name)
            ways[key][way] += n
            out[(*way, mask)] += n
    if least:
        place = {way: i for i, way in enumerate(dict.fromkeys(way for of in ways.values() for way in of))}
        entries = np.array([(key, least[key], place[way], n) for key, of in ways.items() for way, n in of.items()], ENTRY)
        state.update((entries.tobytes(), *map(list, zip(*place))))
    rows = [(part, mask, good, toxic, n) for (part, good, toxic, mask), n in out.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def added(rows: DataFrame) -> DataFrame:
    """Increments of a batch of rows, added up by counter."""

    def total(batch):
        table_ = pa.Table.from_batches([batch]).group_by(["part", "mask", "good", "toxic"]).aggregate([("n", "sum")])
        return {c: table_.column("n_sum" if c == "n" else c).combine_chunks() for c in ("part", "mask", "good", "toxic", "n")}

    return arrow_map(rows, CHANGE, total)


def counters(
    spark: SparkSession,
    documents_path: str,
    labels: DataFrame,
    batches: int = 4,
    files: int | None = None,
    group_texts: int = 200,
) -> DataFrame:
    """n documents by part, mask, good and toxic, after all files have gone through the stream.

    ``files`` a micro-batch; by default as many as make ``batches`` of them. Texts are dealt by hash to state groups of
    about ``group_texts``, since a call of the state function costs more than a text.
    The state store is the session's. Some 40 bytes a text are kept; the default store holds them in executor memory,
    so name a store on disk (spark.sql.streaming.stateStore.providerClass) where that is too much.
    """
    held = spark.read.parquet(documents_path)
    names = held.inputFiles()
    if files is None:
        files = max(1, -(-len(names) // batches))
    source = documents_path.rstrip("/")
    if len(names) == 1 and names[0].rsplit("/", 1)[-1] == source.rsplit("/", 1)[-1]:
        # A stream takes a folder or a pattern: a table of one file is named by a pattern that fits its name only.
        source = f"{source[:-1]}[{source[-1]}]"
    folder = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(held.schema).option("maxFilesPerTrigger", files).parquet(source)
    rows = reduced(marked(judged(stream), labels))
    groups = max(1, held.count() // group_texts)
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups).cast("long")))
    made = dealt.groupBy("group").applyInPandasWithState(changes, CHANGE, STATE, "append", GroupStateTimeout.NoTimeout)
    query = (
        added(made).writeStream.format("parquet").outputMode("append").option("path", f"{folder}/changes")
        .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    written = spark.read.schema(CHANGE).parquet(f"{folder}/changes")
    return written.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n != 0")


def audit(counted: DataFrame) -> DataFrame:
    """The report for every part, order and step, from the counters: at most 128 numbers a part, of which one row is made."""
    n = F.col("n")
    by_mask = counted.groupBy("part", "mask").agg(
        F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic")
    )
    parts = by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("of"))
    orders = F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order")
    steps = parts.select("part", "of", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    earlier, letter = F.expr("substring(filter_order, 1, step - 1)"), F.expr("substring(filter_order, step, 1)")
    bits = lambda text: sum((F.when(text.contains(f), b).otherwise(0) for f, b in BIT.items()), F.lit(0))
    steps = steps.select("*", bits(earlier).alias("before"), bits(letter).alias("own"))

    def total(of, when) -> Column:
        return F.aggregate("of", F.lit(0).cast("long"), lambda s, m: s + F.when(when(m["mask"]), of(m)).otherwise(0))

    fails = lambda mask: mask.bitwiseAND(F.col("own")) != 0
    gone = lambda mask: mask.bitwiseAND(F.col("before")) != 0
    # A document that fails k filters falls to each of them first in one of k orders.
    share = lambda m: m["n"] * F.element_at(F.array(*[F.lit(len(ORDERS) // k) for k in range(1, 6)]), F.bit_count(m["mask"]))
    here = lambda m: fails(m) & ~gone(m)
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: m["n"], lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(lambda m: m["n"], here).alias("removed"),
        total(lambda m: m["n"], lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m["n"], lambda m: m == F.col("own")).alias("unique_fails"),
        total(lambda m: m["good"], here).alias("good_lost"),
        total(lambda m: m["toxic"], here).alias("toxic_lost"),
        total(share, fails).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(counters(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")))


ORACLE = r"""
WITH judged AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), masks AS (
  SELECT j.part, coalesce(m.good, false) AS good, coalesce(m.bad, false) AS bad,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN coalesce(j.doc_id > min(j.doc_id) OVER (PARTITION BY body), false) THEN 16 ELSE 0 END AS mask
  FROM judged j LEFT JOIN marks m ON j.doc_id = m.doc_id
), counted AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM masks GROUP BY part, mask
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, bit)
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a JOIN letters b ON b.f <> a.f JOIN letters c ON c.f NOT IN (a.f, b.f)
  JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, l.bit AS own,
         (SELECT coalesce(sum(p.bit), 0)::INTEGER FROM letters p WHERE contains(substr(filter_order, 1, CAST(step AS INTEGER) - 1), p.f)) AS earlier
  FROM orders, range(1, 6) AS r(step), letters l WHERE l.f = substr(filter_order, CAST(step AS INTEGER), 1)
), report AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (mask & (own + earlier) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & own <> 0 AND mask & earlier <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(bad) FILTER (mask & own <> 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM report
"""
