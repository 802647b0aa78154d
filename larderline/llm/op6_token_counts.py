"""Token counts by a two-tier lookup inside the map tasks; nothing is shuffled.

A chunk (pre-tokens between white space, with the leading space) has a fixed number of tokens. Tier one is a compact
table of the lengths of frequent chunks, counted in a bounded sample of documents and broadcast. Tier two is a cache in
each Python worker, filled by the tokenizer library with the misses. The tables change speed only, never a count.

Null text counts as empty. Texts that hold a special string of the vocabulary are encoded whole by the library, since a
special string also cuts the white space around it. Rows are independent, so ties, repeated rows and null ids keep
their own result; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import os
from collections import Counter

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.llm.common import arrow_map, column_of, table, texts_of
from larderline.llm.pretokens import Cache, chunks

LONGEST_CACHED = 64


class Lengths(Cache):
    """Worker cache: chunk -> number of tokens, by the tokenizer library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(self.whole, longest=LONGEST_CACHED)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def learn(self, found: list[str]) -> None:
        """Encode the chunks that are not yet known, many in one call."""
        new = self.unknown(found)
        for at in range(0, len(new), 1024):
            part = new[at : at + 1024]
            for chunk, made in zip(part, self.library.encode_batch(part, add_special_tokens=False)):
                self.keep(chunk, len(made.ids))

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)


_CACHES: dict[str, Lengths] = {}


def worker_cache(path: str) -> Lengths:
    if path not in _CACHES:
        _CACHES[path] = Lengths(path)
    return _CACHES[path]


def frequent_lengths(documents: DataFrame, path: str, sample_docs: int = 2000, entries: int = 50_000) -> dict[str, int]:
    """Lengths of the most frequent chunks of at most ``sample_docs`` documents; at most ``entries`` of them.

    Each task counts its own share of the sample and returns its counts: bounded by the sample, without a shuffle.
    """
    texts = documents.select("text").where(F.col("text").isNotNull())
    rows = documents.count()
    if not rows:
        return {}
    if rows > sample_docs:
        texts = texts.sample(fraction=sample_docs / rows, seed=7)

    def counted(batch):
        seen = Counter()
        for text in texts_of(batch):
            seen.update(c for c in chunks(text) if len(c) <= LONGEST_CACHED)
        top = seen.most_common(entries)
        return {"chunk": [c for c, _ in top], "n": [n for _, n in top]}

    total: Counter = Counter()
    for row in arrow_map(texts, "chunk string, n long", counted).toLocalIterator():
        total[row.chunk] += row.n
    cache = worker_cache(path)
    top = [c for c, n in total.most_common(entries) if n > 1]
    cache.learn(top)
    return {c: cache[c] for c in top}


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = 1024, sample_docs: int = 2000, entries: int = 50_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every whole text."""
    spark = documents.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(documents, tokenizer_path, sample_docs, entries))

    def start():
        first, second = frequent.value, worker_cache(tokenizer_path)

        def count(batch):
            texts = texts_of(batch)
            sizes, tokens = [], []
            for text in texts:
                sizes.append(len(text.encode()))
                if any(s in text for s in second.special):
                    tokens.append(second.whole(text))
                    continue
                found = chunks(text)
                lengths = list(map(first.get, found))
                if None in lengths:
                    misses = [c for c, n in zip(found, lengths) if n is None]
                    second.learn([c for c in misses if len(c) <= LONGEST_CACHED])
                    tokens.append(sum(n for n in lengths if n is not None) + sum(map(second.__getitem__, misses)))
                else:
                    tokens.append(sum(lengths))
            return {"doc_id": column_of(batch, "doc_id"), "n_bytes": sizes, "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

        return count

    narrow = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return arrow_map(narrow, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", None, start)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
