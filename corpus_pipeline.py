"""A training corpus from raw documents: toxicity, line dedup, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its result is written as Parquet
and read again as the next one's docs. All but the last return the columns of docs. Null and empty texts, null ids and
repeated rows are handled as each operator's docstring says; empty tables give empty results at every stage, extra
columns are carried along whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larderline.llm.common import stored, table
from larderline.llm.op2_toxicity import without_toxic
from larderline.llm.op3_packing import packed
from larderline.llm.op4_line_dedup import cleaned
from larderline.llm.op5_pii import masked
from larderline.llm.op7_minhash import near_duplicates


def counted(before: DataFrame, after: DataFrame) -> DataFrame:
    """``after`` with the columns of ``before``, n_chars following the new text."""
    if "n_chars" not in before.columns:
        return after.select(*before.columns)
    kind = before.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))).select(*before.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; so do documents of which no line is left."""
    return counted(docs, cleaned(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays, of its texts the one with the smallest hash.

    Rows are told apart by id and text, so rows that share an id compete only if their texts are near-duplicates; rows
    that repeat both are one. A document without an id comes after all with one. Rows without words all stay.
    """
    null_id, doc_id = F.col("doc_id").isNull(), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    key = F.struct(null_id.alias("__null"), doc_id.alias("__id"), F.xxhash64("text").alias("__text"))
    decided = near_duplicates(docs.select(key.alias("doc_id"), "text")).where("kept")
    kept = decided.select("doc_id.*", (F.col("n_shingles") == 0).alias("__alone")).distinct()
    rows = docs.select(F.struct("*").alias("__row"), key.alias("__key")).select("__row", "__key.*")
    on = ["__null", "__id", "__text"]
    # The window finds the rows where the join has dealt them; rows without words are a group each.
    alone = F.when(F.col("__alone"), F.monotonically_increasing_id()).otherwise(-1)
    first = Window.partitionBy(*on, "__each").orderBy("__text")
    joined = rows.join(kept, on).withColumn("__each", alone).withColumn("__place", F.row_number().over(first))
    return joined.where("__place = 1").select("__row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by the name of its kind."""
    return counted(docs, masked(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with the sequence and offset where each is packed."""
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Trees, a span classifier and a tokenizer cannot be said in SQL; tests/llm holds the pipeline to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
