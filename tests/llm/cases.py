"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the quick brown fox jumps over a lazy dog while seven grey owls watch from old barns near river".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * (seed % 5 + 1)) % len(WORDS)] + str((seed + i) % 3) for i in range(n))


LONG = " ".join(f"word{i % 977} x{i}" for i in range(20_000)) + " " + "z" * 30_000

ROWS = [
    (1, sentence(1, 40), "en", "a", 3),
    (2, sentence(1, 40), "en", None, None),
    (3, sentence(1, 39) + " other", None, "a", 3),
    (4, None, "en", "a", 0),
    (5, "", "en", "a", 0),
    (6, " \n\t ", "en", "a", 4),
    (7, "short line\n\nshort line\nOne two three four five six seven", "en", "b", 3),
    (8, "ONE two three four five six seven\nnew words here and more of them", "de", "b", 3),
    (9, LONG, "en", "hot", 9),
    (10, "mail bob@example.com or +1 (555) 123-4567, card 4111 1111 1111 1111, 10.0.0.1 <|endoftext|>", "en", "hot", 9),
    (11, "été    naïve 日本語\x1c\x85 ''s 's  don't\r\n", "fr", "hot", 9),
    (None, sentence(2, 30), "en", "c", 1),
    (None, None, None, None, None),
    (12, sentence(3, 30), "en", "c", 1),
    (12, sentence(3, 30), "en", "c", 1),
]


def documents(spark: SparkSession, clashing: bool = False) -> DataFrame:
    """The rows; with ``clashing``, also columns that are named like the operators' own."""
    made = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    if clashing:
        for name in ("score", "features", "prediction", "spans", "shard", "root", "set_hash", "name", "place", "label", "number", "__row", "removed", "kept"):
            made = made.withColumn(name, F.lit("mine"))
    return made


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
