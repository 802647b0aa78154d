"""Extendible hashing: limits, minimal splits, hot keys."""

from collections import defaultdict

import cases
from larderline.llm.op1_sharding import shards
from pyspark.sql import functions as F


def check(rows, limit):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for bits, held in by.items():
        size = sum(r.n_bytes for r in held)
        assert size <= limit or len(held) == 1
        assert all((r.shard_bytes, r.shard_rows, r.depth) == (size, len(held), len(bits)) for r in held)
        # Only buckets over the limit were split: the parent of a shard was over it.
        if bits:
            family = [r for r in rows if r.shard.startswith(bits[:-1])]
            assert sum(r.n_bytes for r in family) > limit and len(family) > 1
    assert not any(a != b and b.startswith(a) for a in by for b in by)
    return by


def test_awkward_documents_fit_their_shards(spark):
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        for limit in (100, 10_000, 10**9):
            rows = shards(docs, limit=limit).collect()
            assert sorted(((r.doc_id, r.n_bytes) for r in rows), key=repr) == sorted(((i, len((t or "").encode())) for i, t, *_ in cases.ROWS), key=repr)
            check(rows, limit)
    assert shards(cases.empty(spark)).collect() == []


def test_a_key_with_a_third_of_all_rows_is_split(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("source"), F.repeat(F.lit("x"), 10).alias("text")
    )
    rows = shards(docs, key="source", limit=500).collect()
    assert len(rows) == 3000
    assert len({r.shard for r in rows if r.source == "hot"}) >= 20
    check(rows, 500)
