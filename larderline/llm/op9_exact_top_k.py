"""Exact top-k by distributed histogram selection over integer scores.

Blocks of candidates meet blocks of the stated queries, and every pair is scored in each pass. A pass counts, per query,
the scores in 256 equal bins of the range in which the kth score must lie, and narrows the range to the bin that holds
it; the first range follows from the norms. When every range is one integer wide, the last pass keeps the scores above
the kth, and of those equal to it the smallest ids. Scores are never stored. A task counts only its own k best scores
of a query: the kth score of all rows cannot be below the kth of any part.

Rows left out and repeated ids: see ``vectors.clean`` (zero vectors take part here). Fewer than k candidates: all are
returned. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larderline.llm.common import arrow_map, column_of, stored, table
from larderline.llm.vectors import blocks, clean, ranked, unpacked

BINS = 256
EXACT = 2**53


def scores(queries: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating matrix products where those are exact, else in 64-bit integers."""
    most = np.abs(queries).max(initial=0) * np.abs(values).max(initial=0) * queries.shape[1]
    if most < EXACT:
        return (queries @ values.T).astype(np.int64)
    if most >= 2**63 or np.abs(queries).max() >= EXACT or np.abs(values).max() >= EXACT:
        raise OverflowError("a score does not fit a long")
    return queries.astype(np.int64) @ values.astype(np.int64).T


def scored(pairs: DataFrame, schema: str, keep) -> DataFrame:
    """Run ``keep(query_ids, state arrays, ids, scores)`` over every pair of blocks; own rows get no score."""

    def run(batch):
        parts = []
        get = {n: column_of(batch, n).to_pylist() for n in ("ids", "vals", "q_ids", "q_vals", "q_low", "q_width", "q_need")}
        for i in range(batch.num_rows):
            ids, values = unpacked(get["ids"][i], get["vals"][i])
            names, queries = unpacked(get["q_ids"][i], get["q_vals"][i])
            found = scores(queries, values)
            own = names[:, None] == ids[None, :]
            state = [np.frombuffer(get[n][i], np.int64) for n in ("q_low", "q_width", "q_need")]
            parts.append(keep(names, *state, ids, found, own))
        return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}

    return arrow_map(pairs, schema, run)


def counted(k: int):
    """Histogram of the k best scores of each query in its range; better scores count in the bin above the range."""

    def keep(names, low, width, need, ids, found, own):
        found = np.where(own, np.iinfo(np.int64).min, found)
        top = min(k, found.shape[1])
        part = np.partition(found, found.shape[1] - top, axis=1)[:, found.shape[1] - top :]
        bin_ = np.clip((part - low[:, None]) // width[:, None], 0, BINS)
        ok = (part >= low[:, None]) & (part > np.iinfo(np.int64).min)
        pair, n = np.unique((np.arange(len(names))[:, None] * (BINS + 1) + bin_)[ok], return_counts=True)
        return {"query_id": names[pair // (BINS + 1)], "bin": pair % (BINS + 1), "n": n}

    return keep


def chosen(names, low, width, need, ids, found, own):
    """What beats a query's kth score (low), and the smallest ids of what equals it."""
    order = np.argsort(ids, kind="stable")
    ids, found, own = ids[order], found[:, order], own[:, order]
    above = (found > low[:, None]) & ~own
    equal = (found == low[:, None]) & ~own
    equal &= np.cumsum(equal, axis=1) <= need[:, None]
    q, c = np.nonzero(above | equal)
    return {"query_id": names[q], "vec_id": ids[c], "score": found[q, c]}


def query_blocks(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of queries with their state: block, q_ids, q_vals, q_low, q_width, q_need."""
    order = ["vec_id", "vector", "low", "width", "need"]
    grouped = rows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("all"))

    def cut(batch):
        out = {n: [] for n in ("block", "q_ids", "q_vals", "q_low", "q_width", "q_need")}
        for block, all_ in zip(column_of(batch, "block").to_pylist(), column_of(batch, "all").to_pylist()):
            out["block"].append(block)
            for name, field in (("q_ids", "vec_id"), ("q_low", "low"), ("q_width", "width"), ("q_need", "need")):
                out[name].append(np.array([r[field] for r in all_], np.int64).tobytes())
            out["q_vals"].append(np.array([r["vector"] for r in all_], np.float64).tobytes())
        return out

    return arrow_map(grouped, "block long, q_ids binary, q_vals binary, q_low binary, q_width binary, q_need binary", cut)


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: int = 64, block_rows: int = 4096, query_rows: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query (ids divisible by ``every``)."""
    rows = clean(embeddings, zero_counts=True)
    rows = rows.select("vec_id", F.transform("vector", lambda x: F.floor(x * scale).cast("double")).alias("vector"))
    rows = stored(rows)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm"), F.sum((F.col("vec_id") % every == 0).cast("long")).alias("queries")).first()
    empty = facts.n < 2 or not facts.queries
    parts = 1 if empty else -(-facts.queries // query_rows)
    candidates = stored(blocks(rows, block_rows))
    # Each block of candidates goes to every block of queries, by an equi-join on the query block.
    dealt = candidates.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    most = F.ceil(norm * (0.0 if empty else facts.norm) * 1.000001) + 1
    state = rows.where(F.col("vec_id") % every == 0).select(
        "vec_id",
        "vector",
        F.pmod(F.xxhash64("vec_id"), F.lit(parts).cast("long")).alias("block"),
        (-most).cast("long").alias("low"),
        F.ceil((2 * most + 1) / BINS).cast("long").alias("width"),
        F.lit(0 if empty else min(k, facts.n - 1)).cast("long").alias("need"),
    )
    widest = 0 if empty else 2
    while widest > 1:
        state = stored(state)
        widest = state.agg(F.max("width")).first()[0]
        pairs = dealt.join(query_blocks(state, query_rows), "block")
        bins = scored(pairs, "query_id long, bin long, n long", counted(k)).groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        kth = bins.withColumn("up_to", F.sum("n").over(down)).join(state.select(F.col("vec_id").alias("query_id"), "need"), "query_id")
        # The first bin from the top with which enough scores are counted; scores better than the range were counted first.
        kth = kth.where((F.col("up_to") >= F.col("need")) & (F.col("up_to") - F.col("n") < F.col("need")))
        kth = kth.select(F.col("query_id").alias("vec_id"), "bin", (F.col("up_to") - F.col("n")).alias("above"))
        state = state.join(kth, "vec_id").select(
            "vec_id",
            "vector",
            "block",
            (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
            F.ceil(F.col("width") / BINS).cast("long").alias("width"),
            "need",
            "above",
        )
        if widest > 1:
            state = state.drop("above")
    if not empty:
        state = state.withColumn("need", F.col("need") - F.col("above")).drop("above")
    pairs = dealt.join(query_blocks(state, query_rows), "block")
    return ranked(scored(pairs, "query_id long, vec_id long, score long", chosen), k)


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH good AS (
  SELECT vec_id, min([CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
  GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs
) WHERE rank <= 20
"""
