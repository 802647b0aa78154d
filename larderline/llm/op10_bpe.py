"""Byte-level BPE with a hierarchical-bitmap rank queue, and decoding.

Each pre-token is merged on a linked list of its bytes. A bucket per merge rank holds the list positions whose pair has
that rank; a bitmap over the ranks, with summary levels of 64 bits above it, finds the lowest rank that has positions by
find-first-set at each level. A merge moves only the two neighbouring pairs to other buckets; entries that no longer
describe the list are skipped when met. One merge thus costs the same however long the pre-token is.

Null text is empty: no ids, and the digest of nothing. Rows are independent: repeated rows, ties and null ids keep their
own result, an empty table gives an empty result, extra columns are left out.
"""

from __future__ import annotations

import base64
import re
from hashlib import sha256
from heapq import heappop, heappush
from struct import pack

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from larderline.llm.common import arrow_map, column_of, table, texts_of
from larderline.llm.pretokens import SPACE, Cache, pretoken_pattern

#: Chunks on which the pattern works independently: a word of common letters up to a mark or white space, since a run of
#: letters always ends a pre-token; else a run without white space. Each takes the one space before it along.
COMMON = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
PIECES = re.compile(f" ?[{COMMON}]+(?=[!-/:-@\\[-`{{-~{SPACE}]|$)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class RankQueue:
    """Buckets of list positions by rank, under a bitmap of three levels of 64-bit words (262,144 ranks a top word).

    Built once for an encoder: every merge run leaves it empty.
    """

    def __init__(self, ranks: int) -> None:
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, place: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, place)
            return
        self.buckets[rank] = [place]
        word = rank >> 6
        if not self.low[word]:
            if not self.mid[rank >> 12]:
                self.top |= 1 << (rank >> 12)
            self.mid[rank >> 12] |= 1 << (word & 63)
        self.low[word] |= 1 << (rank & 63)

    def pop(self) -> tuple[int, int]:
        """The lowest rank, by find-first-set down the levels, and its leftmost position, taken out. Not for an empty queue."""
        a = (self.top & -self.top).bit_length() - 1
        mid = self.mid[a]
        b = a << 6 | (mid & -mid).bit_length() - 1
        low = self.low[b]
        rank = b << 6 | (low & -low).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        self.low[b] = low = low & (low - 1)
        if not low:
            self.mid[a] = mid = mid & (mid - 1)
            if not mid:
                self.top &= self.top - 1
        return rank, bucket[0]


class Encoder(Cache):
    """chunk -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__(self.encode_chunk)
        self.ranks = ranks
        self.words = {rank: word for word, rank in ranks.items()}
        self.pattern = pretoken_pattern(pattern)
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(word)
        if whole is not None:
            return [whole]
        n = len(word)
        queue, get = self.queue, ranks.get
        ends, left, right = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
        # Rank of the pair that now starts at each place, None if it is no token; other entries of the queue are stale.
        waits = [get(word[i : i + 2]) for i in range(n - 1)]
        waits.append(None)
        for i, rank in enumerate(waits):
            if rank is not None:
                queue.push(rank, i)
        while queue.top:
            rank, i = queue.pop()
            if waits[i] != rank:
                continue
            j = right[i]
            end = ends[i] = ends[j]
            waits[j] = None
            right[i] = after = right[j]
            waits[i] = new = get(word[i : ends[after]]) if after < n else None
            if new is not None:
                queue.push(new, i)
            if after < n:
                left[after] = i
            before = left[i]
            if before >= 0:
                new = get(word[before:end])
                if new != waits[before]:
                    waits[before] = new
                    if new is not None:
                        queue.push(new, before)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i : ends[i]]])
            i = right[i]
        return ids

    def encode_chunk(self, chunk: str) -> bytes:
        words = self.pattern.findall(chunk)
        if len(words) > 1:
            return b"".join(map(self.__getitem__, words))
        ids = self.merge(chunk.encode())
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, PIECES.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def worker_encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(read_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encoded(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array<int>) of every whole text."""

    def start():
        encoder = worker_encoder(ranks_path, pattern)
        return lambda batch: {
            "doc_id": column_of(batch, "doc_id"),
            "ids": [np.frombuffer(encoder.encode(t), "<u4").astype("int32") for t in texts_of(batch)],
        }

    kind = documents.schema["doc_id"].dataType.simpleString()
    return arrow_map(documents.select("doc_id", "text"), f"doc_id {kind}, ids array<int>", None, start)


def decoded(ids: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and text (binary, the bytes that the ids stand for) of rows of doc_id and ids; null ids give null."""

    def start():
        encoder = worker_encoder(ranks_path, pattern)
        return lambda batch: {
            "doc_id": column_of(batch, "doc_id"),
            "text": [None if x is None else encoder.decode(np.array(x, "<u4").tobytes()) for x in column_of(batch, "ids").to_pylist()],
        }

    kind = ids.schema["doc_id"].dataType.simpleString()
    return arrow_map(ids.select("doc_id", "ids"), f"doc_id {kind}, text binary", None, start)


def round_trip(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes decoded from them, in one pass over the texts."""

    def start():
        encoder = worker_encoder(ranks_path, pattern)

        def digests(batch):
            counts, ids, texts = [], [], []
            for text in texts_of(batch):
                made = encoder.encode(text)
                counts.append(len(made) // 4)
                ids.append(sha256(made).hexdigest())
                texts.append(sha256(encoder.decode(made)).hexdigest())
            return {"doc_id": column_of(batch, "doc_id"), "n_tokens": counts, "ids_sha256": ids, "decoded_sha256": texts}

        return digests

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(documents.select("doc_id", "text"), schema, None, start)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return round_trip(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
