"""Vectors for the searches: clean rows, blocks of them, and exact local top lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larderline.llm.common import arrow_map, column_of


def clean(embeddings: DataFrame, zero_counts: bool) -> DataFrame:
    """vec_id (long) and vector (array<double>) of the rows that take part in a search.

    Left out: null ids, null or empty vectors, vectors with null or non-finite components and, unless ``zero_counts``,
    zero vectors. Of rows that repeat an id, the smallest vector stands for the id.
    """
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & ~bad
    )
    if not zero_counts:
        rows = rows.where(F.exists("vector", lambda x: x != 0.0))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as a matrix; other lengths are an error."""
    lengths = column.value_lengths()
    if len(lengths) and (short := pc.min(lengths).as_py()) != (long := pc.max(lengths).as_py()):
        raise ValueError(f"vectors of {short} to {long} components: all must have the same length")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def blocks(rows: DataFrame, size: int = 4096) -> DataFrame:
    """ids and values (binary: int64, float64, row by row) of blocks of at most ``size`` rows."""

    def cut(batch):
        ids, values = column_of(batch, "vec_id").to_numpy(), matrix(column_of(batch, "vector"))
        parts = range(0, len(ids), size)
        return {"ids": [ids[i : i + size].tobytes() for i in parts], "vals": [values[i : i + size].tobytes() for i in parts]}

    return arrow_map(rows, "ids binary, vals binary", cut)


def unpacked(ids: bytes, values: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    return names, np.frombuffer(values, np.float64).reshape(len(names), -1)


def inner(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, summed in order of the components, so equal vectors get equal scores."""
    total = np.zeros(len(many))
    for d in range(many.shape[1]):
        total += one[:, d] * many[:, d]
    return total


def best(queries: np.ndarray, query_ids: np.ndarray, values: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query id, vector id and score of each query's k nearest of these rows, ties to the smaller id; never its own row."""
    rough = queries @ values.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        least = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k]
        # Matrix products round differently from row to row: keep what may tie with the kth.
        slack = 1e-12 * (1 + np.sqrt((queries**2).sum(1)) * np.sqrt((values**2).sum(1).max()))
        keep = rough >= np.where(np.isfinite(least), least - slack, -np.inf)[:, None]
    else:
        keep = np.ones(rough.shape, bool)
    keep &= rough > -np.inf
    q, c = np.nonzero(keep)
    scores = inner(queries[q], values[c])
    order = np.lexsort((ids[c], -scores, q))
    q, c, scores = q[order], c[order], scores[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    top = place < k
    return query_ids[q[top]], ids[c[top]], scores[top]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best of the rows found."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
