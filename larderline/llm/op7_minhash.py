"""Near-duplicate documents by HyperMinHash.

Texts with the same shingle set are one class; only classes go on. A class has 128 buckets, each with a hash function
of its own; the register of a bucket keeps the smallest hash as its number of leading zeros and ten bits of mantissa.
Bands of four registers make the candidates: at a similarity of 0.75 a pair meets in one of 32 bands with a chance of
0.999995, and of pairs that meet, the Jaccard estimate (share of equal registers, less the expected share of accidental
ones) sorts out what is five deviations too low. What is left is confirmed on the full sets.

No bucket is expanded into pairs. First every class of a bucket is held against the bucket's smallest class; confirmed
links make components. Then each bucket that still holds several components is worked through in blocks: classes
outside its largest component are held against all others, and only links that join components come out.

Sets are sets of 64-bit hashes (two shingles of one document fall together with a chance of 10^-13 at 2,000 words).
Documents without words have an empty set and are linked with nothing. Documents with a null id take part and have no
say in the name of a component; if nobody in it has an id, component_id is null and ``kept`` is true. Repeated rows keep
a row each. An empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.llm.common import arrow_map, column_of, ship_code, stored, table
from larderline.llm.components import components
from larderline.llm.shingles import mixed, shingles

BUCKETS = 128
MANTISSA = 10
BAND = 4
LEAST = 75
#: Five standard deviations of an estimate from 128 registers at a similarity of 0.75.
SLACK = 5 * (0.75 * 0.25 / BUCKETS) ** 0.5
BLOCK = 2048

#: Odd multipliers, one hash function for each bucket: with its own function no bucket is empty, however small the set,
#: and the registers of small sets are as independent as those of large ones.
_FUNCTIONS = mixed(np.arange(1, BUCKETS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def registers(values: np.ndarray) -> np.ndarray:
    """Registers (uint16) of a set of hashes; the set isn't empty."""
    least = np.full(BUCKETS, np.uint64(2**64 - 1))
    for at in range(0, len(values), 1024):
        part = values[at : at + 1024]
        np.minimum(least, (part[:, None] * _FUNCTIONS[None, :]).min(0), out=least)
    # Leading zeros from the exponent as a floating number; the lowest eleven bits are cut so that it is exact.
    wide = least >> np.uint64(11)
    zeros = np.where(wide > 0, 53 - np.frexp(wide.astype(np.float64))[1], 53)
    mantissa = least << (zeros + 1).astype(np.uint64) >> np.uint64(64 - MANTISSA)
    return (zeros.astype(np.uint64) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)


def estimate(equal: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard similarity from the number of equal registers and the set sizes.

    Two unequal minima share leading zeros and mantissa with a chance of about 0.17 / 2^MANTISSA at like sizes, less at
    unlike ones.
    """
    big, small = np.maximum(one, other), np.maximum(1, np.minimum(one, other))
    chance = 0.169919487159739 / 2**MANTISSA * 4 * (big / small) / (1 + big / small) ** 2
    share = equal / BUCKETS
    return np.maximum(0.0, (share - chance) / (1 - chance))


def linked(common: np.ndarray | int, one: np.ndarray | int, other: np.ndarray | int) -> np.ndarray | bool:
    """The exact rule on set sizes and the size of the intersection."""
    return 100 * common >= LEAST * (one + other - common)


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class (hash of the set) and registers (binary) of every document."""

    def sign(batch):
        out = {"n_shingles": [], "set_hash": [], "registers": []}
        for text in column_of(batch, "text").to_pylist():
            found = shingles(text) if text else np.zeros(0, np.uint64)
            out["n_shingles"].append(len(found))
            out["set_hash"].append(named(found) if len(found) else None)
            out["registers"].append(registers(found).tobytes() if len(found) else None)
        return out | {"doc_id": column_of(batch, "doc_id")}

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    return arrow_map(rows, f"doc_id {kind}, n_shingles long, set_hash long, registers binary", sign)


def banded(classes: DataFrame) -> DataFrame:
    """band (hash), set_hash: one row for each band of a class."""

    def bands(batch):
        raw = b"".join(column_of(batch, "registers").to_pylist())
        cells = np.frombuffer(raw, np.uint64).reshape(batch.num_rows, BUCKETS // BAND)  # four registers are one word
        keys = mixed(mixed(cells) + np.arange(1, BUCKETS // BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ids = column_of(batch, "set_hash").to_numpy()
        return {"band": keys.ravel().view(np.int64), "set_hash": np.repeat(ids, BUCKETS // BAND)}

    return arrow_map(classes.select("set_hash", "registers"), "band long, set_hash long", bands)


def close(batch) -> dict:
    """Of rows with two classes' sizes and registers (n1, r1, n2, r2): the estimate."""
    one = np.frombuffer(b"".join(column_of(batch, "r1").to_pylist()), np.uint16).reshape(-1, BUCKETS)
    other = np.frombuffer(b"".join(column_of(batch, "r2").to_pylist()), np.uint16).reshape(-1, BUCKETS)
    similar = estimate((one == other).sum(1), column_of(batch, "n1").to_numpy(), column_of(batch, "n2").to_numpy())
    return {"a": column_of(batch, "a"), "b": column_of(batch, "b"), "similar": similar}


def first_links(members: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """Confirmed links a, b of each class to the likeliest of the smallest classes of its buckets."""
    facts = classes.select("set_hash", "n_shingles", "registers")
    one = facts.withColumnsRenamed({"set_hash": "a", "n_shingles": "n1", "registers": "r1"})
    other = facts.withColumnsRenamed({"set_hash": "b", "n_shingles": "n2", "registers": "r2"})
    pairs = members.where("set_hash <> center").select(F.col("set_hash").alias("a"), F.col("center").alias("b")).distinct()
    seen = arrow_map(pairs.join(one, "a").join(other, "b"), "a long, b long, similar double", close)
    seen = seen.where(F.col("similar") >= LEAST / 100 - SLACK)
    best = stored(seen.groupBy("a").agg(F.max_by("b", F.struct("similar", "b")).alias("b")))
    wanted = best.select(F.col("a").alias("set_hash")).unionByName(best.select(F.col("b").alias("set_hash"))).distinct()
    sets = stored(sets_of(wanted, classes, documents))
    both = best.join(sets.withColumnsRenamed({"set_hash": "a", "shingles": "s1"}), "a")
    both = both.join(sets.withColumnsRenamed({"set_hash": "b", "shingles": "s2"}), "b")

    def confirm(batch):
        keep = []
        for one, other in zip(column_of(batch, "s1").to_pylist(), column_of(batch, "s2").to_pylist()):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            keep.append(bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
        keep = np.array(keep)
        return {n: column_of(batch, n).to_numpy()[keep] for n in ("a", "b")}

    return arrow_map(both, "a long, b long", confirm)


def sets_of(wanted: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """set_hash and shingles (binary) of the classes in ``wanted`` (set_hash), from the document that stands for each."""
    ids = wanted.join(classes.select("set_hash", F.col("first_id").alias("__id")), "set_hash").select("__id").distinct()
    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    # Ids may repeat: each text names its own class again.
    chosen = texts.join(ids, F.col("doc_id").eqNullSafe(F.col("__id"))).select("text")

    def read(batch):
        found = [shingles(t) if t else np.zeros(0, np.uint64) for t in column_of(batch, "text").to_pylist()]
        found = [f for f in found if len(f)]
        return {"set_hash": [named(f) for f in found], "shingles": [f.tobytes() for f in found]}

    read_back = arrow_map(chosen, "set_hash long, shingles binary", read)
    return read_back.join(wanted, "set_hash", "left_semi").dropDuplicates(["set_hash"])


def named(found: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63


def open_blocks(members: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Buckets that hold several components, as blocks: a row for each class and block it takes part in.

    band, low, high (numbers of the two blocks), asks, set_hash, label, n_shingles: classes outside a bucket's largest
    component ask, all are asked. A block holds at most about BLOCK classes and BLOCK * 1000 shingles of either side.
    """
    label = F.coalesce(F.col("root"), F.col("set_hash")).alias("label")
    rows = members.select("band", "set_hash").join(roots.withColumnRenamed("node", "set_hash"), "set_hash", "left")
    rows = stored(rows.join(classes.select("set_hash", "n_shingles"), "set_hash").select("band", "set_hash", label, "n_shingles"))
    by = rows.groupBy("band", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"))
    by = by.groupBy("band").agg(
        F.count(F.lit(1)).alias("labels"),
        F.sum("n").alias("n"),
        F.sum("size").alias("size"),
        F.max(F.struct("n", "size", "label")).alias("top"),
    )
    parts = lambda n, size: F.greatest(F.ceil(n / BLOCK), F.ceil(size / (BLOCK * 1000))).cast("long")
    by = by.where("labels > 1").select(
        "band",
        F.col("top.label").alias("largest"),
        parts(F.col("n") - F.col("top.n"), F.col("size") - F.col("top.size")).alias("lows"),
        parts(F.col("n"), F.col("size")).alias("highs"),
    )
    dealt = rows.join(by, "band")
    part = lambda count: F.pmod(F.xxhash64("set_hash"), F.col(count))
    asking = dealt.where("label <> largest").select(
        "band", part("lows").alias("low"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("highs") - 1)).alias("high"), F.lit(True).alias("asks"), "set_hash", "label", "n_shingles"
    )
    asked = dealt.select(
        "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lows") - 1)).alias("low"), part("highs").alias("high"), F.lit(False).alias("asks"), "set_hash", "label", "n_shingles"
    )
    return asking.unionByName(asked)


def in_groups(rows: DataFrame, work, schema: str, per_group: int = 10_000) -> DataFrame:
    """Run ``work`` on each block of ``rows``; small blocks share a task's group, whose size does not grow."""
    rows = stored(rows)
    groups = int(max(1, rows.count() // per_group))
    ship_code(rows.sparkSession)
    names = [n for n in rows.columns if n not in ("band", "low", "high")]

    def run(table):
        import pandas as pd

        table = table.sort_values(["band", "low", "high"], kind="stable")
        key = table[["band", "low", "high"]].to_numpy()
        cuts = np.nonzero((key[1:] != key[:-1]).any(1))[0] + 1
        columns = {n: table[n].to_numpy() for n in names}
        found = []
        for begin, end in zip([0, *cuts], [*cuts, len(table)]):
            for row in work({n: c[begin:end] for n, c in columns.items()}, key[begin]):
                found.append(row)
        return pd.DataFrame(found, columns=[c.split()[0] for c in schema.split(", ")])

    return rows.groupBy(F.pmod(F.xxhash64("band", "low", "high"), F.lit(groups).cast("long")).alias("g")).applyInPandas(run, schema)


def plausible(block: dict, key: np.ndarray) -> list[tuple]:
    """Rows of the classes of a block that may be linked to one of another component, judged by their registers.

    A pair counts only in the first of the bands it shares.
    """
    asks = block["asks"].astype(bool)
    if not asks.any():
        return []
    held = np.frombuffer(b"".join(block["registers"]), np.uint16).reshape(-1, BUCKETS)
    words = mixed(mixed(held.copy().view(np.uint64)) + np.arange(1, BUCKETS // BAND + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
    here = int(np.argmax((words == key[0]).all(0)))
    n, label = block["n_shingles"], block["label"]
    others = np.nonzero(~asks)[0]
    keep = np.zeros(len(asks), bool)
    for i in np.nonzero(asks)[0]:
        across = others[label[others] != label[i]]
        similar = estimate((held[across] == held[i]).sum(1), n[across], n[i])
        across = across[similar >= LEAST / 100 - SLACK]
        if here and len(across):
            across = across[~(words[across, :here] == words[i, :here]).any(1)]
        if len(across):
            keep[i] = True
            keep[across] = True
    return [(*key.tolist(), bool(asks[i]), int(block["set_hash"][i]), int(label[i])) for i in np.nonzero(keep)[0]]


def joining(block: dict, key: np.ndarray) -> list[tuple[int, int]]:
    """Links of a block that join components, confirmed on the full sets."""
    asks = block["asks"].astype(bool)
    ids, label = block["set_hash"], block["label"]
    sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
    others = np.nonzero(~asks)[0]
    if not len(others) or not asks.any():
        return []
    # Postings of the asked sets: for each shingle, who holds it.
    values = np.concatenate([sets[j] for j in others])
    owner = np.repeat(np.arange(len(others)), [len(sets[j]) for j in others])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    sizes = np.array([len(sets[j]) for j in others])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    links = []
    for i in np.nonzero(asks)[0]:
        low, high = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        lengths = high - low
        places = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[places], minlength=len(others))
        for j in np.nonzero(linked(common, sizes, len(sets[i])))[0]:
            a, b = root(int(label[i])), root(int(label[others[j]]))
            if a != b:
                parent[a] = b
                links.append((int(ids[i]), int(ids[others[j]])))
    return links


def last_links(members: DataFrame, classes: DataFrame, documents: DataFrame, roots: DataFrame) -> DataFrame:
    """Links a, b between components, from every candidate pair that the first links have not settled."""
    rows = open_blocks(members, classes, roots).join(classes.select("set_hash", "registers"), "set_hash")
    kept = in_groups(rows, plausible, "band long, low long, high long, asks boolean, set_hash long, label long")
    kept = stored(kept)
    sets = sets_of(kept.select("set_hash").distinct(), classes, documents)
    return in_groups(kept.join(sets, "set_hash"), joining, "a long, b long", per_group=2000)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    rows = stored(signed(documents))
    full = rows.where(F.col("set_hash").isNotNull())
    classes = full.groupBy("set_hash").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
    classes = stored(classes)
    bands = banded(classes)
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("set_hash").alias("center")).where("n > 1").select("band", "center")
    members = stored(bands.join(shared, "band"))
    found = stored(first_links(members, classes, documents))
    more = last_links(members, classes, documents, components(found))
    roots = components(found.unionByName(more))
    named_ = classes.select("set_hash", "first_id").join(roots.withColumnRenamed("node", "set_hash"), "set_hash", "left")
    named_ = named_.select("set_hash", "first_id", F.coalesce("root", "set_hash").alias("root"))
    least = named_.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named_ = named_.join(least, "root").select("set_hash", "component_id")
    joined = rows.join(named_, "set_hash", "left")
    component = F.when(F.col("set_hash").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")
    )


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


#: Every pair of documents that share a shingle, the exact rule on it, and the links' transitive closure.
ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id
GROUP BY s.doc_id, len(s.s)
"""
