"""Toxicity of whole texts: gradient-boosted trees over dense features, with isotonic calibration.

The labelled rows that may be learned from are cut into three parts, each class for itself in an order by hash. On the
first a lexicon is counted: words and word beginnings that are far more frequent in toxic documents. On the second the
trees are fitted over lexicon densities, second-person words near lexicon words, capitals, punctuation and obfuscation
(letters replaced by digits and signs). On the third the trees' probability is calibrated by isotonic regression. If a
class is too small to be cut, the features of each fifth of the rows come from a lexicon of the other four, and trees
and calibration are fitted over all rows. At most ``sample_labels`` labelled rows are used, chosen by hash in each
class: half of each, more of one if the other has fewer. The calibration weighs a row as the labels it stands for. The
features of all documents are computed from their whole texts, in one pass.

Language, source, ids and labels are no features. Null text is empty and is scored like any text without words. Labels
that are null or contradict each other are left out. With fewer than ``least`` rows of either class there is no
classifier: every score is the share of toxic rows (0 without labels), and ``without_toxic`` keeps all rows. Rows are
independent: repeated rows, ties and null ids keep their own score; an empty table gives an empty result; extra columns
are never features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from larderline.llm.common import arrow_map, column_of, ship_code, stored, table, texts_of
from larderline.llm.pretokens import Cache

#: Second-person words of the languages at hand.
SECOND_PERSON = {"you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "toi", "te"}
SECOND_PERSON |= {"ton", "ta", "tes", "vous", "votre", "vos", "usted", "ustedes", "tus", "ti", "vosotros"}

#: Signs that stand for letters in obfuscated words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGE = ".,;:!?\"'()[]{}<>«»¿¡…"
LETTERS = re.compile(r"[^\W\d_]+")
SHORTEST_BEGINNING, LONGEST_BEGINNING = 5, 6

PERSON, CAPITALS, HIDDEN = 1, 2, 4
FEATURES = 16
#: Parts of the rows where a class is too small for parts of its own.
FOLDS = 5


def plain(chunk: str) -> str:
    return chunk.strip(EDGE).lower()


def units(word: str) -> list[str]:
    """A word, and its beginnings (marked by a star)."""
    return [word] + [word[:n] + "*" for n in range(SHORTEST_BEGINNING, LONGEST_BEGINNING + 1) if len(word) > n]


def undisguised(chunk: str) -> str | None:
    """The word that a chunk with digits or signs between letters may stand for."""
    inner = chunk.strip(EDGE.replace("!", "")).rstrip("!").lower()
    if len(inner) < 3 or inner.isalpha() or not any(c.isalpha() for c in inner):
        return None
    word = re.sub(r"[*._-]", "", inner.translate(DISGUISE))
    return word if word.isalpha() else None


class Coder(Cache):
    """chunk -> flags, and the number of its heaviest lexicon unit (from 1) above them."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        super().__init__(self.code, entries=300_000)
        self.number = {unit: i for i, unit in enumerate(lexicon, 1)}
        self.weights = np.array([0.0, *lexicon.values()])

    def heaviest(self, word: str) -> int:
        return max((self.number[u] for u in units(word) if u in self.number), key=lambda i: self.weights[i], default=0)

    def code(self, chunk: str) -> int:
        word = plain(chunk)
        flags = (PERSON if word in SECOND_PERSON else 0) | (CAPITALS if len(word) > 1 and chunk.isupper() else 0)
        number = self.heaviest(word)
        if not number and (hidden := undisguised(chunk)):
            flags |= HIDDEN
            number = self.heaviest(hidden)
        return number << 3 | flags

    def features(self, text: str) -> list[float]:
        codes = np.fromiter(map(self.__getitem__, found := text.split()), np.int64, -1)
        raw = np.frombuffer(text.encode(), np.uint8)
        words, signs = max(len(found), 1), max(len(raw), 1)
        weights = self.weights[codes >> 3]
        hit = np.nonzero(codes >> 3)[0]
        person = np.nonzero(codes & PERSON)[0]
        hidden = (codes & HIDDEN) > 0
        gap = np.inf
        near = 0
        if len(hit) and len(person):
            at = np.searchsorted(person, hit)
            before = hit - person[np.maximum(at - 1, 0)]
            after = person[np.minimum(at, len(person) - 1)] - hit
            gaps = np.minimum(np.where(before >= 0, before, words), np.where(after >= 0, after, words))
            gap, near = gaps.min(), int((gaps <= 5).sum())
        upper = ((raw >= 65) & (raw <= 90)).sum()
        marks = text.count("!")
        return [
            len(hit) / words,
            math.log1p(len(hit)),
            float(weights.max(initial=0)),
            float(weights.sum()) / words,
            float(np.unique(codes[hit] >> 3).size),
            len(person) / words,
            near / words,
            0.0 if gap == np.inf else 1 / (1 + float(gap)),
            upper / signs,
            float((codes & CAPITALS > 0).sum()) / words,
            marks / signs,
            text.count("?") / signs,
            text.count("!!") / words,
            float(hidden.sum()) / words,
            float((hidden & (codes >> 3 > 0)).sum()) / words,
            math.log1p(len(found)),
        ]


def learnable(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) != 0


def training_rows(documents: DataFrame, labels: DataFrame, sample_labels: int) -> DataFrame:
    """text, toxic (0 or 1), part (0 to 9) and weight of at most ``sample_labels`` labelled documents.

    Parts are dealt by rank within a class. A row weighs as the labels of its class that it stands for. Of rows that
    share an id one counts, that of the smallest text hash, so the sample is never larger than stated.
    """
    spark = documents.sparkSession
    known = labels.where(learnable(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy("doc_id")
    known = known.agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("__most")).where("toxic = __most")
    known = stored(known.select("doc_id", "toxic"))
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = []
    for toxic in (0, 1):
        size = sizes.get(toxic, 0)
        n = min(size, max(sample_labels // 2, sample_labels - sizes.get(1 - toxic, 0)))
        ids = known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id").collect()
        # Steps of seven: parts next to each other fill evenly, however few the rows.
        chosen += [(r.doc_id, toxic, 7 * i % 10, size / n) for i, r in enumerate(ids)]
    kind = known.schema["doc_id"].dataType.simpleString()
    sample = spark.createDataFrame(chosen, f"doc_id {kind}, toxic int, part int, weight double")
    # Bounded by sample_labels, so broadcast: the texts stay where they are.
    found = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic", "part", "weight")
    one = found.agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return one.select("first.text", "toxic", "part", "weight")


def lexicon(rows: DataFrame, least_count: int = 4, entries: int = 2000) -> dict[str, float]:
    """Units of toxic documents by log odds of their document counts; at most ``entries``, the best supported."""

    def counted(batch):
        seen = {0: Counter(), 1: Counter()}
        for text, toxic in zip(texts_of(batch), column_of(batch, "toxic").to_pylist()):
            seen[toxic].update({u for c in set(text.split()) if (w := plain(c)) and w.isalpha() for u in units(w)})
        every = set(seen[0]) | set(seen[1])
        return {"unit": list(every), "toxic": [seen[1][u] for u in every], "other": [seen[0][u] for u in every]}

    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    units_ = arrow_map(rows.select("text", "toxic"), "unit string, toxic long, other long", counted)
    sums = units_.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (bad + 1.0)) - F.log((F.col("other") + 0.5) / (good + 1.0))
    # How sure the odds are: log odds less two standard errors.
    sure = odds - 2 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    kept = sums.where((F.col("toxic") >= least_count) & (sure > 0)).select("unit", odds.alias("odds"), sure.alias("sure"))
    return {r.unit: r.odds for r in kept.orderBy(F.desc("sure"), "unit").limit(entries).collect()}


class Scorer:
    """What was learned: lexicon, trees and calibration, or one score for all."""

    def __init__(self, share: float, words: dict[str, float] | None = None, trees: GBTClassificationModel | None = None, calibration: IsotonicRegressionModel | None = None) -> None:
        self.share, self.words, self.trees, self.calibration = share, words, trees, calibration

    def score(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep`` of ``rows`` (which has __text) and __score."""
        if self.trees is None:
            return rows.select(*keep, F.lit(self.share).cast("double").alias("__score"))
        ready = rows.select(*keep, array_to_vector(dense(rows.sparkSession, self.words)(F.col("__text"))).alias("features"))
        raw = self.trees.transform(ready).select(*keep, vector_to_array("probability")[1].alias("features"))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction")))
        return self.calibration.transform(raw).select(*keep, score.alias("__score"))


def dense(spark: SparkSession, words: dict[str, float]):
    """The features of a text as a column function."""
    ship_code(spark)
    shared = spark.sparkContext.broadcast(words)
    made: list[Coder] = []

    @pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        if not made:
            made.append(Coder(shared.value))
        return pd.Series([made[0].features(t or "") for t in texts])

    return features


def fitted(documents: DataFrame, labels: DataFrame, sample_labels: int = 20_000, least: int = 5, trees: int = 30, depth: int = 3, seed: int = 5) -> Scorer:
    """Lexicon, trees and calibration from the labelled rows that may be learned from."""
    spark = documents.sparkSession
    rows = stored(training_rows(documents, labels, sample_labels))
    by = rows.groupBy("toxic", group().alias("group")).agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).collect()
    counts = {(r.toxic, r.group): r.n for r in by}
    total = [sum(r.weight for r in by if r.toxic == c) for c in (0, 1)]
    share = total[1] / max(1, sum(total))
    if any(sum(counts.get((c, g), 0) for g in range(3)) < least for c in (0, 1)):
        return Scorer(share)

    def ready_rows(part: DataFrame, words: dict[str, float]) -> DataFrame:
        return part.select(F.col("toxic").cast("double").alias("label"), "weight", group().alias("group"), dense(spark, words)("text").alias("dense"))

    crossed = any(counts.get((c, g), 0) < least for c in (0, 1) for g in (0, 1))
    if crossed:
        words = lexicon(rows)
        fold = F.col("part") % FOLDS
        ready = reduce(DataFrame.unionByName, [ready_rows(rows.where(fold == i), lexicon(rows.where(fold != i))) for i in range(FOLDS)])
    else:
        words = lexicon(rows.where(group() == 0))
        ready = ready_rows(rows.where(group() > 0), words)
    ready = stored(ready).select("label", "weight", "group", array_to_vector("dense").alias("features"))
    boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=64, seed=seed).fit((ready if crossed else ready.where("group = 1")).coalesce(4))
    third = ready.where("group = 2") if not crossed and all(counts.get((c, 2), 0) >= least for c in (0, 1)) else ready
    raw = boosted.transform(third).select("label", "weight", vector_to_array("probability")[1].alias("features"))
    return Scorer(share, words, boosted, IsotonicRegression(weightCol="weight").fit(raw.coalesce(4)))


def group() -> Column:
    """Part of the training rows: 0 lexicon, 1 trees, 2 calibration."""
    return F.when(F.col("part") < 4, 0).when(F.col("part") < 8, 1).otherwise(2)


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, **fit) -> DataFrame:
    """doc_id, held_out (not learned from), score and predicted of every document."""
    scorer = fitted(documents, labels, **fit)
    rows = documents.select("doc_id", F.col("text").alias("__text"))
    return scorer.score(rows, ["doc_id"]).select(
        "doc_id",
        F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("__score").alias("score"),
        (F.col("__score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, **fit) -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with all their columns; all rows without a classifier."""
    scorer = fitted(documents, labels, **fit)
    if scorer.trees is None:
        return documents
    rows = documents.select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    return scorer.score(rows, ["__row"]).where(F.col("__score") < threshold).select("__row.*")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
