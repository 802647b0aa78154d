"""Sharding by extendible hashing under a byte limit.

A row's place is a string of bits, taken from digests of its key. The directory begins with one bucket of no bits; only
a bucket over the limit is split on the next bit, until every bucket fits or holds a single row. The splits are found
level by level on sums: rows are added up once per fine prefix, and only prefixes inside buckets that are still too
large go on to more bits.

Rows that repeat a key cannot be told apart by its bits. Behind the key's bits come those of a digest of the row's
number among its equals, so a key with a third of all rows splits like any other. Null keys are one key; null and empty
texts weigh 0 bytes; a single row over the limit has a shard of its own. An empty table gives an empty result. Extra
columns, whatever their names, are left out; the shard columns are returned beside the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.llm.common import numbered, stored, table

#: Bits of one digest used, and bits of a prefix examined in one round of sums.
DIGEST_BITS = 60
STEP = 10


def digest_bits(value: Column) -> Column:
    """The first 60 bits of the MD5 of a text, as a long."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def prefix(depth: Column | int) -> Column:
    """The first ``depth`` of the 120 bits in columns __high and __low, as text of 0 and 1."""
    bits = F.concat(F.lpad(F.bin("__high"), DIGEST_BITS, "0"), F.lpad(F.bin("__low"), DIGEST_BITS, "0"))
    return F.substring(bits, F.lit(1), depth if isinstance(depth, Column) else F.lit(depth))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """bucket (bits), depth, n_rows and n_bytes of the leaves, from rows of __high, __low and n_bytes."""
    spark = rows.sparkSession
    leaves, whole = [], rows
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("b")).first()
    if total.n <= 1 or total.b <= limit:
        return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_bytes").alias("n_bytes")).where("n_rows > 0").select(
            F.lit("").alias("bucket"), F.lit(0).alias("depth"), "n_rows", "n_bytes"
        )
    known = None
    for depth in range(0, 2 * DIGEST_BITS, STEP):
        # Sums at the end of this round's bits; shorter prefixes add them up.
        fine = whole.groupBy(prefix(depth + STEP).alias("fine")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))
        if known is not None:
            fine = fine.join(known.select(F.col("bucket").alias("__open")), F.substring("fine", 1, depth) == F.col("__open"), "left_semi")
        fine = stored(fine)
        levels = F.explode(F.sequence(F.lit(depth), F.lit(depth + STEP))).alias("depth")
        sums = fine.select(levels, "fine", "n_rows", "n_bytes").groupBy("depth", F.substring(F.col("fine"), F.lit(1), F.col("depth")).alias("bucket"))
        sums = stored(sums.agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes")))
        open_ = (F.col("n_bytes") > limit) & (F.col("n_rows") > 1)
        parents = sums.where(open_).select((F.col("depth") + 1).alias("d"), F.col("bucket").alias("parent"))
        # A leaf fits and its parent did not; every bucket over the limit lies inside buckets over the limit.
        fits = sums.where(~open_ & (F.col("depth") > depth))
        leaves.append(
            fits.join(parents, (fits.depth == parents.d) & (F.substring(fits.bucket, F.lit(1), fits.depth - 1) == parents.parent), "left_semi")
        )
        known = sums.where(open_ & (F.col("depth") == depth + STEP))
        if not known.head(1):
            break
    else:
        leaves.append(known)  # rows whose 120 bits are all equal
    found = leaves[0].select("bucket", "depth", "n_rows", "n_bytes")
    for more in leaves[1:]:
        found = found.unionByName(more.select("bucket", "depth", "n_rows", "n_bytes"))
    return found


def shards(documents: DataFrame, key: str = "doc_id", weight: Column | None = None, limit: int = 1 << 20) -> DataFrame:
    """The key, n_bytes, shard (its bits), depth, shard_rows and shard_bytes of every row."""
    weight = F.coalesce(F.octet_length(F.col("text")), F.lit(0)).cast("long") if weight is None else weight
    rows = documents.select(F.col(key).alias("__key"), weight.alias("n_bytes"))
    name = F.coalesce(F.col("__key").cast("string"), F.lit("null"))
    rows = numbered(stored(rows), ["__key"], ["n_bytes"], ["n_bytes"], "__copy")
    rows = stored(
        rows.select(
            "__key",
            "n_bytes",
            digest_bits(name).alias("__high"),
            digest_bits(F.concat(name, F.lit("/"), F.col("__copy").cast("string"))).alias("__low"),
        )
    )
    leaves = stored(directory(rows, limit).withColumnsRenamed({"n_rows": "shard_rows", "n_bytes": "shard_bytes"}))
    depths = [r.depth for r in leaves.select("depth").distinct().orderBy("depth").collect()]  # at most 121
    # A row's leaf is the only leaf that is a prefix of its bits.
    tried = rows.withColumn("__depth", F.explode(F.array(*[F.lit(d) for d in depths]) if depths else F.array(F.lit(0))))
    joined = tried.withColumn("__prefix", prefix(F.col("__depth"))).join(
        leaves, (F.col("__depth") == F.col("depth")) & (F.col("__prefix") == F.col("bucket"))
    )
    return joined.select(
        F.col("__key").alias(key),
        "n_bytes",
        F.col("bucket").alias("shard"),
        "depth",
        "shard_rows",
        "shard_bytes",
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"))


#: The same splits where ids are unique: prefixes of every depth with their sums, and each row's shortest that fits.
ORACLE = """
WITH rows_ AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM documents
), tried AS (
  SELECT doc_id, n_bytes, d AS depth, right(lpad(bin(h), 60, '0'), 60)[1:d] AS shard
  FROM rows_, range(0, 61) t(d)
), sums AS (
  SELECT depth, shard, count(*) AS shard_rows, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes
  FROM tried GROUP BY depth, shard
)
SELECT doc_id, n_bytes, shard, CAST(depth AS INTEGER) AS depth, shard_rows, shard_bytes
FROM tried JOIN sums USING (depth, shard)
WHERE shard_bytes <= 1048576 OR shard_rows = 1
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""
