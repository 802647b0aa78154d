"""Approximate nearest neighbours by a forest of random-projection trees under one shared priority queue.

The trees are fitted on a bounded sample (``sample_rows``); a split is the hyperplane between two centres drawn by a
few steps of two-means over random rows, put at the sample's median. Every row is then indexed: it goes down every
tree to a leaf. A query keeps one queue over all trees, ordered by the smallest margin crossed on the way, and visits
leaves until those hold a given share of the index and, in one of the trees, more than k rows. All candidates in the
visited leaves are scored exactly on the original vectors.

The share is set by measurement: the exact neighbours of ``probe_queries`` queries are found over all rows, and the
share is the one at which the queue has met ``aim`` of them. Largest inner product becomes a nearest direction by one
more component, sqrt(longest norm^2 - norm^2), which is 0 for a query.

Rows left out and repeated ids: see ``vectors.clean``. Equal scores go to the smaller id. An empty table gives an empty
result, and so does one without queries; extra columns are left out.

Queries are dealt to blocks of about ``query_block``. A task streams the leaves that its block visits, sorted so that a
leaf's visitors come before its rows, and keeps the k best of each query: memory holds one block, whatever the size of a
leaf, and what comes out is k rows for each query and slot.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.llm.common import arrow_map, column_of, ship_code, stored, table
from larderline.llm.vectors import best, clean, matrix, ranked


class Tree:
    """Arrays of nodes: plane and offset, children (negative: leaf number - 1)."""

    def __init__(self, rows: np.ndarray, leaf_rows: int, random: np.random.Generator) -> None:
        planes, offsets, children, self.leaves = [], [], [], 0
        waiting = [(np.arange(len(rows)), None)]
        while waiting:
            members, slot = waiting.pop()
            split = self.plane(rows[members], random) if len(members) > leaf_rows else None
            if split is None:
                number = -self.leaves - 1
                self.leaves += 1
            else:
                number = len(planes)
                planes.append(split[0])
                offsets.append(split[1])
                children.append([0, 0])
                side = rows[members] @ split[0] > split[1]
                waiting += [(members[~side], (number, 0)), (members[side], (number, 1))]
            if slot:
                children[slot[0]][slot[1]] = number
        width = rows.shape[1]
        self.planes = np.array(planes, np.float64).reshape(-1, width)
        self.offsets = np.array(offsets, np.float64)
        self.children = np.array(children, np.int32).reshape(-1, 2)

    @staticmethod
    def plane(rows: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, float] | None:
        for _ in range(4):
            drawn = rows[random.choice(len(rows), min(len(rows), 64), replace=False)]
            centres = drawn[:2].copy()
            for _ in range(3):
                near = ((drawn[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
                for c in (0, 1):
                    if (near == c).any():
                        centres[c] = drawn[near == c].mean(0)
            normal = centres[0] - centres[1]
            length = np.linalg.norm(normal)
            if length > 0:
                normal = normal / length
                along = rows @ normal
                middle = float(np.median(along))
                if 0 < (along > middle).sum() < len(rows):
                    return normal, middle
        return None

    def route(self, rows: np.ndarray) -> np.ndarray:
        """Leaf number of each row."""
        at = np.zeros(len(rows), np.int64) if len(self.planes) else np.full(len(rows), -1, np.int64)
        while (inner := at >= 0).any():
            node = at[inner]
            side = (rows[inner] * self.planes[node]).sum(1) > self.offsets[node]
            at[inner] = self.children[node, side.astype(int)]
        return -at - 1


class Forest:
    def __init__(self, rows: np.ndarray, longest: float, trees: int, leaf_rows: int, seed: int) -> None:
        self.longest = longest
        random = np.random.default_rng(seed)
        self.trees = [Tree(self.lifted(rows), leaf_rows, random) for _ in range(trees)]
        self.first = np.cumsum([0, *(t.leaves for t in self.trees)])

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (rows**2).sum(1), 0))
        return np.hstack([rows, rest[:, None]]) / (self.longest or 1)

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """Leaf of each row in each tree, numbered over the forest."""
        lifted = self.lifted(rows)
        return np.stack([t.route(lifted) + self.first[i] for i, t in enumerate(self.trees)], axis=1)

    def visit(self, query: np.ndarray, sizes: np.ndarray, enough: float, distinct: int = 0):
        """Leaves in the order of the shared queue, each with the rows that it and those before hold, up to ``enough``.

        It goes on until the leaves of one tree hold ``distinct`` rows: a tree has each row once.
        """
        vector = np.append(query, 0.0)
        vector /= np.linalg.norm(vector) or 1
        margins = [t.planes @ vector - t.offsets for t in self.trees]
        queue = [(0.0, i, 0 if len(t.planes) else -1) for i, t in enumerate(self.trees)]
        seen, by_tree = 0, [0] * len(self.trees)
        while queue and (seen < enough or max(by_tree) < distinct):
            crossed, i, node = heapq.heappop(queue)
            children, margin = self.trees[i].children, margins[i]
            while node >= 0:
                m = margin[node]
                heapq.heappush(queue, (max(crossed, abs(m)), i, int(children[node, int(m <= 0)])))
                node = int(children[node, int(m > 0)])
            leaf = int(self.first[i] - node - 1)
            seen += int(sizes[leaf])
            by_tree[i] += int(sizes[leaf])
            yield leaf, seen


#: What a row of the stream is: a query of the block, a visitor of a leaf, a row held by a leaf (in order of arrival).
QUERY, VISITOR, HELD = 0, 1, 2
STREAM = ["block", "slot", "leaf", "kind", "vec_id", "vector"]


def meetings(index: DataFrame, asking: DataFrame, sizes: np.ndarray, queries: int, query_block: int, leaf_block: int, slots: int) -> DataFrame:
    """Rows by (block of queries, slot), in order of leaf and kind, so that each leaf's visitors come before its rows.

    A block's leaves are dealt to a fixed number of slots; the rows of a leaf larger than ``leaf_block`` are dealt to
    all of them, and so are its visitors. A query's vector is sent once for each slot, not for each leaf it visits.
    """
    spark = index.sparkSession
    blocks = max(1, -(-queries // query_block))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks).cast("long")).alias("block")
    # Bounded by trees x leaves.
    wide = F.broadcast(spark.createDataFrame([(leaf, bool(n > leaf_block)) for leaf, n in enumerate(sizes.tolist())], "leaf long, wide boolean"))
    all_slots = F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))
    dealt = lambda c: F.pmod(F.xxhash64(c), F.lit(slots).cast("long"))
    nothing = F.lit(None).cast("array<double>")
    asked = asking.select(block, "vec_id", "vector", F.explode(all_slots).alias("slot"))
    visits = asking.select(block, "vec_id", F.explode("leaves").alias("leaf")).join(wide, "leaf")
    come = visits.select("block", F.explode(F.when(F.col("wide"), all_slots).otherwise(F.array(dealt("leaf")))).alias("slot"), "leaf", "vec_id")
    rows = index.select("vec_id", "vector", F.explode("leaves").alias("leaf")).join(wide, "leaf").join(visits.select("leaf", "block").distinct(), "leaf")
    held = rows.select("block", F.when(F.col("wide"), dealt("vec_id")).otherwise(dealt("leaf")).alias("slot"), "leaf", "vec_id", "vector")
    parts = [
        asked.select("block", "slot", F.lit(-1).cast("long").alias("leaf"), F.lit(QUERY).alias("kind"), "vec_id", "vector"),
        come.select("block", "slot", "leaf", F.lit(VISITOR).alias("kind"), "vec_id", nothing.alias("vector")),
        held.select("block", "slot", "leaf", F.lit(HELD).alias("kind"), "vec_id", "vector"),
    ]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return together.repartition(blocks * slots, "block", "slot").sortWithinPartitions("block", "slot", "leaf", "kind")


class Running:
    """The k best rows found so far for the queries of one block, as rows of (query, row, score)."""

    def __init__(self, k: int, limit: int = 400_000) -> None:
        self.k, self.limit, self.parts, self.size = k, limit, [], 0

    def add(self, found: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.parts.append(found)
        self.size += len(found[0])
        if self.size > self.limit:
            self.parts = [self.top()]
            self.size = len(self.parts[0][0])
            # At least twice what a cleaned-up list holds, so that cleaning stays linear.
            self.limit = max(self.limit, 2 * self.size)

    def top(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.array([], np.int64), np.array([], np.int64), np.array([])
        q, c, s = (np.concatenate(part) for part in zip(*self.parts))
        order = np.lexsort((c, -s, q))
        q, c, s = q[order], c[order], s[order]
        # A row met in several trees has the same score each time, so its repeats stand together.
        new = np.append(True, (q[1:] != q[:-1]) | (c[1:] != c[:-1])) if len(q) else np.zeros(0, bool)
        q, c, s = q[new], c[new], s[new]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < self.k
        return q[kept], c[kept], s[kept]


def reranked(stream: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of every query in each slot; memory holds a block of queries and their best."""

    def run(batches):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        at, leaf_at = None, None
        ids, vectors, visitors, best_of = [], [], [], Running(k)
        block_ids = block_vectors = wanted = None

        def done():
            columns = [pa.array(x) for x in best_of.top()]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([column_of(batch, c).to_numpy().astype(np.int64) for c in ("block", "slot", "leaf", "kind")], axis=1)
            names, values = column_of(batch, "vec_id").to_numpy(), column_of(batch, "vector")
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for begin, end in zip(cuts, cuts[1:]):
                block, slot, leaf, kind = keys[begin].tolist()
                if (block, slot) != at:
                    if at is not None:
                        yield done()
                    at, leaf_at = (block, slot), None
                    ids, vectors, visitors, best_of = [], [], [], Running(k)
                    block_ids = None
                if kind == QUERY:
                    ids.append(names[begin:end])
                    vectors.append(matrix(values.slice(begin, end - begin)))
                    continue
                if block_ids is None:
                    order = np.argsort(np.concatenate(ids), kind="stable")
                    block_ids, block_vectors = np.concatenate(ids)[order], np.concatenate(vectors)[order]
                if leaf != leaf_at:
                    leaf_at, visitors, wanted = leaf, [], None
                if kind == VISITOR:
                    visitors.append(names[begin:end])
                    continue
                if not visitors:
                    continue
                if wanted is None:
                    wanted = np.searchsorted(block_ids, np.concatenate(visitors))
                held = matrix(values.slice(begin, end - begin))
                best_of.add(best(block_vectors[wanted], block_ids[wanted], held, names[begin:end], k))
        if at is not None:
            yield done()

    ship_code(stream.sparkSession)
    return stream.mapInArrow(run, "query_id long, vec_id long, score double")


def search(
    embeddings: DataFrame,
    k: int = 20,
    every: int = 20,
    trees: int = 8,
    leaves: int = 64,
    leaf_rows: int = 2048,
    slots: int = 8,
    sample_rows: int = 16_384,
    probe_queries: int = 100,
    aim: float = 0.95,
    leaf_block: int = 4096,
    query_block: int = 2048,
    seed: int = 11,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for every query (ids divisible by ``every``)."""
    spark = embeddings.sparkSession
    rows = stored(clean(embeddings, zero_counts=False))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    sizes_ = [F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")]
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("longest"), *sizes_).first()
    if not facts.n:
        return ranked(rows.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")), k)
    if facts.least != facts.most:
        raise ValueError(f"vectors of {facts.least} to {facts.most} components: all must have the same length")
    is_query = F.col("vec_id") % every == 0
    by_hash = F.xxhash64("vec_id")
    sample = np.array([r.vector for r in rows.orderBy(by_hash, "vec_id").limit(sample_rows).collect()])
    ship_code(spark)
    # Leaves grow with the table, as far as the sample can split them.
    leaves = max(leaves, min(-(-facts.n // leaf_rows), len(sample) // 8))
    forest = Forest(sample, facts.longest, trees, max(2, -(-len(sample) // leaves)), seed)
    shared = spark.sparkContext.broadcast(forest)  # bounded by the sample

    def routed(batch):
        vectors = column_of(batch, "vector")
        found = shared.value.leaves(matrix(vectors))
        return {"vec_id": column_of(batch, "vec_id"), "vector": vectors, "leaves": list(found)}

    index = stored(arrow_map(rows, "vec_id long, vector array<double>, leaves array<long>", routed))
    sizes = np.zeros(forest.first[-1], np.int64)  # bounded by trees x leaves
    for r in index.select(F.explode("leaves").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r.leaf] = r.n

    probes = rows.where(is_query).orderBy(by_hash, "vec_id").limit(probe_queries).collect()
    probe_ids = np.array([r.vec_id for r in probes], np.int64)
    probe_vectors = np.array([r.vector for r in probes]).reshape(len(probes), sample.shape[1])

    def nearest(batch):
        ids, values = column_of(batch, "vec_id").to_numpy(), matrix(column_of(batch, "vector"))
        q, c, s = best(probe_vectors, probe_ids, values, ids, k) if len(probe_ids) else ([], [], [])
        return {"query_id": q, "vec_id": c, "score": s}

    truth = ranked(arrow_map(rows, "query_id long, vec_id long, score double", nearest), k)
    # At most probe_queries x k rows.
    met = truth.join(index.select("vec_id", "leaves"), "vec_id").collect()
    seen_by = {int(i): dict(forest.visit(v, sizes, np.inf)) for i, v in zip(probe_ids, probe_vectors)}
    needed = sorted(min(seen_by[r.query_id][leaf] for leaf in r.leaves) for r in met)
    enough = float(needed[min(len(needed) - 1, int(aim * len(needed)))]) if needed else np.inf

    def visits(batch):
        vectors = column_of(batch, "vector")
        visited = [[leaf for leaf, _ in shared.value.visit(v, sizes, enough, k + 1)] for v in matrix(vectors)]
        return {"vec_id": column_of(batch, "vec_id"), "vector": vectors, "leaves": visited}

    asking = stored(arrow_map(rows.where(is_query), "vec_id long, vector array<double>, leaves array<long>", visits))
    queries = asking.count()
    if not queries:
        return ranked(rows.limit(0).select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")), k)
    local = reranked(meetings(index, asking, sizes, queries, query_block, leaf_block, slots), k)
    return ranked(local.dropDuplicates(["query_id", "vec_id"]), k)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
