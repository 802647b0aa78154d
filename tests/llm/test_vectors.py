"""Searches against brute force."""

import numpy as np
import pytest
from conftest import SMALL
from larderline.llm.op8_ann import Forest, Running, meetings, reranked, search
from larderline.llm.op9_exact_top_k import top_k
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def truth(rows, k, scale=None, zero_counts=True):
    good = {}
    for vec_id, v, *_ in rows:
        if vec_id is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        if not zero_counts and not any(v):
            continue
        w = [float(np.float32(x)) for x in v]
        good[vec_id] = min(good[vec_id], w) if vec_id in good else w
    found = []
    for q, a in good.items():
        if q % 20:
            continue
        near = []
        for c, b in good.items():
            if c != q:
                x, y = (np.floor(scale * np.array(a)), np.floor(scale * np.array(b))) if scale else (np.array(a), np.array(b))
                total = 0.0
                for p in x * y:
                    total += p
                near.append((-total, c))
        found += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(near)[:k], 1)]
    return sorted(found)


def awkward(n=300, dims=8):
    random = np.random.default_rng(4)
    rows = [(i, random.normal(size=dims).tolist(), 0) for i in range(n)]
    rows += [(n + i, [0.5] * dims, 1) for i in range(150)]  # a third are equal: ties
    rows += [(1000, None, 0), (1020, [NAN] * dims, 0), (1040, [INF] + [0.0] * (dims - 1), 0), (1060, [None] * dims, 0), (None, [1.0] * dims, 0)]
    return rows + [(1080, [0.0] * dims, None), rows[0], rows[40]]


def test_exact_search_with_ties_nulls_and_repeated_rows(spark):
    rows = awkward()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit(1), "vector": F.lit(2), "block": F.lit(3)}).repartition(5)
    got = sorted(tuple(r) for r in top_k(frame, query_rows=8, block_rows=50).collect())
    assert got == [(q, r, c, int(s)) for q, r, c, s in truth(rows, 20, 64)]


def test_exact_search_of_wide_ranges_narrows_in_several_rounds(spark):
    random = np.random.default_rng(6)
    rows = [(i, (random.normal(size=4) * 10.0 ** random.integers(0, 5)).astype("f4").tolist(), 0) for i in range(100)]
    got = sorted(tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA), k=5).collect())
    assert got == [(q, r, c, int(s)) for q, r, c, s in truth(rows, 5, 64)]


def test_exact_search_of_few_rows(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).collect() == []
    assert top_k(spark.createDataFrame([(0, [1.0, 2.0], 0)], SCHEMA)).collect() == []
    assert top_k(spark.createDataFrame([(1, [1.0], 0), (3, [2.0], 0)], SCHEMA)).collect() == []
    got = top_k(spark.createDataFrame([(0, [1.0], 0), (3, [-2.0], 0)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 3, -8192)]


def test_forest_finds_the_nearest_of_the_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    expected = {(q, c): s for q, _, c, s in truth([tuple(r) for r in frame.collect()], 20)}
    got = search(frame).collect()
    assert len(got) == len(expected)
    found = [(r.query_id, r.vec_id) for r in got]
    assert sum(p in expected for p in found) >= 0.9 * len(expected)
    assert all(expected[p] == r.score for p, r in zip(found, got) if p in expected)


def test_forest_with_ties_nulls_repeats_and_other_lengths(spark):
    rows = awkward()
    rows = [(i, [3 * x for x in v] if i and i % 7 == 0 and v and None not in v else v, x) for i, v, x in rows]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit(1), "vector": F.lit(2), "leaves": F.lit(3)}).repartition(5)
    got = sorted(tuple(r) for r in search(frame, leaf_block=40).collect())
    expected = truth(rows, 20, zero_counts=False)
    assert len(got) == len(expected) and {(q, r) for q, r, *_ in got} == {(q, r) for q, r, *_ in expected}
    assert len({(q, c) for q, _, c, _ in got} & {(q, c) for q, _, c, _ in expected}) >= 0.9 * len(expected)
    assert search(spark.createDataFrame([], SCHEMA)).collect() == []
    assert search(spark.createDataFrame([(1, [1.0], 0), (3, [2.0], 0)], SCHEMA)).collect() == []
    assert [tuple(r) for r in search(spark.createDataFrame([(0, [1.0], 0), (3, [-2.0], 0)], SCHEMA)).collect()] == [(0, 1, 3, -2.0)]


def test_shared_queue_visits_every_leaf_once():
    rows = np.random.default_rng(1).normal(size=(500, 6))
    forest = Forest(rows, float(np.linalg.norm(rows, axis=1).max()), trees=3, leaf_rows=20, seed=1)
    sizes = np.bincount(forest.leaves(rows).ravel(), minlength=forest.first[-1])
    # The longest row needs no further component, so it goes down the trees as a query does.
    row = rows[np.linalg.norm(rows, axis=1).argmax()]
    visited = [leaf for leaf, _ in forest.visit(row, sizes, np.inf)]
    assert sorted(visited) == list(range(forest.first[-1]))
    assert set(visited[:3]) == set(forest.leaves(row[None])[0].tolist())


def test_visitors_come_before_the_rows_of_their_leaf_in_every_slot(spark):
    rows = spark.range(600).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0)).alias("vector"), F.array(F.lit(0), F.lit(1)).cast("array<long>").alias("leaves"))
    queries = rows.where("vec_id % 2 = 0").withColumn("leaves", F.array(F.lit(0).cast("long")))
    stream = meetings(rows, queries, np.array([600, 600]), 300, query_block=30, leaf_block=60, slots=4)
    parts = [p for p in stream.rdd.map(lambda r: (r.block, r.slot, r.leaf, r.kind, r.vec_id)).glom().collect() if p]
    assert all([r[:4] for r in p] == sorted(r[:4] for r in p) for p in parts)
    every = [r for p in parts for r in p]
    # Leaf 0 is large: its rows are dealt to the slots, its visitors go to all of them; nobody visits leaf 1.
    held = [(b, i) for b, _, leaf, kind, i in every if kind == 2 and leaf == 0]
    come = [(b, s, i) for b, s, leaf, kind, i in every if kind == 1 and leaf == 0]
    assert len(held) == len(set(held)) == 10 * 600 and len(come) == len(set(come)) == 4 * 300
    assert sum(kind == 0 for *_, kind, _ in every) == 4 * 300 and not any(leaf == 1 for _, _, leaf, *_ in every)


def test_reranked_rows_grow_with_the_queries_only(spark):
    random = np.random.default_rng(5)
    for n in (400, 2000):
        frame = spark.createDataFrame([(i, random.normal(size=8).tolist(), 0) for i in range(n)], SCHEMA)
        rows = frame.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"), F.array(F.lit(0), F.lit(1), F.lit(2)).cast("array<long>").alias("leaves"))
        asking = rows.where("vec_id % 20 = 0")
        found = reranked(meetings(rows, asking, np.array([n, n, n]), n // 20, query_block=8, leaf_block=10**6, slots=4), 5)
        assert found.count() <= n // 20 * 4 * 5


def test_running_best_drops_repeats_and_keeps_ties_by_id():
    best_of = Running(2, limit=3)
    for q, c, s in [([1, 1, 2], [5, 6, 7], [1.0, 2.0, 0.5]), ([1, 1], [6, 4], [2.0, 1.0]), ([2], [7], [0.5]), ([1], [3], [1.0])]:
        best_of.add((np.array(q), np.array(c), np.array(s)))
    assert [x.tolist() for x in best_of.top()] == [[1, 1, 2], [6, 3, 7], [2.0, 1.0, 0.5]]
    assert [len(x) for x in Running(2).top()] == [0, 0, 0]


def test_vectors_of_different_lengths_are_refused(spark):
    ragged = spark.createDataFrame([(i, [1.0] * (2 + i % 2), 0) for i in range(40)], SCHEMA).coalesce(1)
    for run in (search, top_k):
        with pytest.raises(Exception, match="same length"):
            run(ragged).collect()


def test_blocks_of_visitors_change_no_result(spark):
    random = np.random.default_rng(9)
    frame = spark.createDataFrame([(i, random.normal(size=6).tolist(), 0) for i in range(800)], SCHEMA)
    got = [sorted(tuple(r) for r in search(frame, every=2, leaf_block=40, query_block=b).collect()) for b in (10**6, 16)]
    assert got[0] == got[1] and len(got[0]) == 400 * 20


def test_queries_of_small_clusters_get_all_their_rows(spark):
    random = np.random.default_rng(3)
    centres = random.normal(size=(40, 16)) * 10
    rows = [(i, (centres[i % 40] + random.normal(size=16) * 0.01).tolist(), 0) for i in range(500)]
    # An aim of nothing: the share alone would end a query in its first leaf of eight rows.
    got = search(spark.createDataFrame(rows, SCHEMA), aim=0.0).groupBy("query_id").count().collect()
    assert len(got) == 25 and all(r["count"] == 20 for r in got)
