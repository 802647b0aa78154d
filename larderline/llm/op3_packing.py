"""Best-two-fit packing of tokenized documents into sequences.

The packing is decided on the histogram of piece lengths, which has at most ``capacity`` entries however many pieces
there are. A bin is filled greedily with the longest piece that still fits; then its smallest piece is replaced by two
unpacked pieces whose lengths together fit the widened gap more tightly. A bin so found is a pattern of lengths, used
as often as the histogram allows, so the number of patterns is bounded by the lengths and not by the documents. The
pieces are then numbered within each length, in distributed parts, and a piece's number picks its place in a pattern.

Only documents longer than ``capacity`` are cut. Null text is empty and packs as the separator alone. Rows are
independent documents: repeated rows and null ids are packed like any others. An empty table gives an empty result;
extra columns are left out.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import arrow_map, column_of, numbered, stored, table, worker_cache
from larderline.llm.pretokens import Cache

#: Characters that Python's str.split takes for white space and the tokenizer libraries do not.
PYTHON_ONLY_SPACE = "\x1c\x1d\x1e\x1f"
#: Closing marks that are cut from a word before it is looked up.
CLOSING = ".,!?;:"
#: A text that shows whether a tokenizer ends every word at white space, whatever its kind and case.
PROBE = "It's a Plain line, with 3 words.\tAnd tabs;\nLINES!  gaps?\u00a0wide\u2003ones \u00c9T\u00c9: x1y (so) Stop..."
#: Small Latin letters: no two of them compose, and none has another normal form.
LATIN = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower())
#: Bytes of text whose words are told apart at once.
BLOCK = 4 << 20


class Ids(Cache):
    """Worker cache: word between white space -> its ids as little-endian unsigned 32-bit integers.

    What it takes for granted is probed from the tokenizer: ``by_words``, that white space ends every word (otherwise
    texts are encoded whole), ``plain_case``, that a word of letters is its small letters and its closing marks, and
    ``by_letters``, that a word of small Latin letters is one pre-token, which the library makes letter by letter.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(self.whole, entries=700_000)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: What sends a text to the library whole.
        self.odd = "|".join([f"[{PYTHON_ONLY_SPACE}]", *map(re.escape, self.special)])
        words = PROBE.split()
        self.by_words = self.whole(PROBE) == b"".join(map(self.whole, words))
        lettered = [(w, core) for w in words if (core := w.rstrip(CLOSING)).isalpha()]
        self.plain_case = all(self.whole(w) == self.whole(core.lower()) + self.whole(w[len(core) :]) for w, core in lettered)
        self.letters = {ord(c): self.pretoken(c) for c in LATIN}
        probes = [LATIN, LATIN[::-1], *LATIN, *(core.lower() for _, core in lettered)]
        self.by_letters = all(self.letters.values()) and all(self.whole(p) == self.one(p) for p in probes)

    def pretoken(self, letter: str) -> str | None:
        """What the tokenizer's model is given for a letter, if it is one pre-token."""
        normal, cutter = self.library.normalizer, self.library.pre_tokenizer
        text = normal.normalize_str(letter) if normal else letter
        made = cutter.pre_tokenize_str(text) if cutter else [(text, (0, len(text)))]
        return made[0][0] if len(made) == 1 else None

    def one(self, word: str) -> bytes:
        """Ids of a word of Latin letters, by the library's model alone."""
        ids = [t.id for t in self.model.tokenize(word.translate(self.letters))]
        return pack(f"<{len(ids)}I", *ids)

    def whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def learn(self, words: Iterable[str]) -> None:
        new = [w for w in self.unknown(words) if len(w) <= self.longest]
        # Letters with closing punctuation are two pre-tokens, and the vocabulary is lower-case: this saves the library
        # many words. (A capital sigma has two small ones; letters that turn into letters with marks are no letters.)
        cut = {}
        for word in new if self.plain_case else ():
            core = word.rstrip(CLOSING)
            low = core.lower()
            if low != word and low.isalpha() and "\u03a3" not in core:
                cut[word] = low, word[len(core) :]
        plain = self.unknown([w for w in new if w not in cut] + [part for both in cut.values() for part in both if part])
        known = {"": b""}
        if self.by_letters:
            latin = [w for w in plain if not w.strip(LATIN)]
            known.update(zip(latin, map(self.one, latin)))
            for word in latin:
                self.keep(word, known[word])
            plain = [w for w in plain if w not in known]
        for at in range(0, len(plain), 1024):
            # One call for many words, each encoded by itself; its ids are those between two cuts.
            some = plain[at : at + 1024]
            made = self.library.encode(some, is_pretokenized=True, add_special_tokens=False)
            ids, cuts = np.array(made.ids, "<u4").tobytes(), 4 * np.searchsorted(np.array(made.word_ids, np.int64), np.arange(len(some) + 1))
            known.update((word, ids[a:b]) for word, a, b in zip(some, cuts[:-1].tolist(), cuts[1:].tolist()))
        for word in plain:
            self.keep(word, known[word])
        for word, (low, tail) in cut.items():
            both = [known[p] if p in known else self[p] for p in (low, tail)]
            self.keep(word, both[0] + both[1])

    def encode(self, text: str) -> bytes:
        """Ids of a text: of its words, except around special strings."""
        return self.encode_words(text, text.split())

    def encode_words(self, text: str, words: list[str]) -> bytes:
        if not self.by_words or any(c in text for c in PYTHON_ONLY_SPACE) or any(s in text for s in self.special):
            return self.whole(text)
        return b"".join(map(self.__getitem__, words))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text, as ``encode`` gives them. The words of many texts are told apart at once, so that each
        different word among them is looked up once."""
        texts = texts.fill_null("")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < len(texts):
            before = ends[first - 1] if first else 0
            until = max(first + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
            yield from self.encode_block(texts.slice(first, until - first))
            first = until

    def encode_block(self, texts: pa.Array) -> Iterator[bytes]:
        if self.by_words:
            odd = pc.match_substring_regex(texts, self.odd)
            plain = pc.if_else(odd, "", texts) if pc.any(odd).as_py() else texts
        else:
            odd, plain = pa.repeat(True, len(texts)), pa.repeat("", len(texts))
        split = pc.utf8_split_whitespace(plain)
        found = split.flatten().dictionary_encode()
        made = self.encode_different(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        # The ids of all different words one after the other, and from where and how many to take for each word.
        known = np.frombuffer(b"".join(made), "<u4")
        sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
        starts = np.cumsum(sizes) - sizes
        words = found.indices.to_numpy()
        taken = sizes[words]
        ends = np.concatenate(([0], np.cumsum(taken)))
        places = np.arange(ends[-1])
        places += np.repeat(starts[words] - ends[:-1], taken)
        ids = known[places]
        cuts = split.offsets.to_numpy().astype(np.int64)
        bounds = ends[cuts - cuts[0]].tolist()
        for i, (whole, a, b) in enumerate(zip(odd.to_pylist(), bounds[:-1], bounds[1:])):
            yield self.whole(texts[i].as_py()) if whole else ids[a:b].tobytes()

    def encode_different(self, words: list[str]) -> list[bytes]:
        """Ids of words that are all different."""
        made = list(map(self.get, words))
        new = [i for i, ids in enumerate(made) if ids is None]
        # Few words at a time, so that what the cache has just learned is still there when it is used.
        for at in range(0, len(new), 65_536):
            some = new[at : at + 65_536]
            self.learn([words[i] for i in some])
            for i in some:
                made[i] = self[words[i]]
        return made


def worker_ids(path: str) -> Ids:
    return worker_cache(("ids", path), lambda: Ids(path))


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int, separator: int, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's pieces; with ``with_ids`` also ids (binary)."""
    end = pack("<I", separator)
    step = 4 * capacity

    def start():
        cache = worker_ids(tokenizer_path)

        def cut(batch):
            doc_ids = batch.column(0).to_pylist()
            out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
            for doc_id, ids in zip(doc_ids, cache.encode_all(column_of(batch, "text"))):
                ids += end
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(at // step)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            return out

        return cut

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return arrow_map(documents.select("doc_id", "text"), schema, None, start)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns of lengths, longest first, and how many bins have each; every counted piece is in one bin."""
    left = dict(counts)
    lengths = sorted(left)
    made: list[tuple[list[int], int]] = []

    def largest(most: int, below: dict[int, int]) -> int | None:
        """The longest length of at most ``most`` that has pieces beyond those that ``below`` uses."""
        i = bisect_right(lengths, most) - 1
        while i >= 0 and left[lengths[i]] <= below.get(lengths[i], 0):
            i -= 1
        return lengths[i] if i >= 0 else None

    while lengths:
        used: dict[int, int] = {}
        bin_, gap = [], capacity
        while (one := largest(gap, used)) is not None:
            # As many of this length as fit, at once.
            n = min(gap // one, left[one] - used.get(one, 0))
            used[one] = used.get(one, 0) + n
            bin_ += [one] * n
            gap -= one * n
        if gap and len(bin_) > 1:
            smallest = bin_[-1]
            used[smallest] -= 1
            room, best = gap + smallest, (smallest, ())
            i, j = 0, bisect_right(lengths, room) - 1
            # Two pointers over the lengths: the pair with the largest sum that fits the room.
            while i <= j and best[0] < room:
                a, b = lengths[i], lengths[j]
                if left[a] - used.get(a, 0) <= 0:
                    i += 1
                elif left[b] - used.get(b, 0) <= 0 or a + b > room or (a == b and left[a] - used.get(a, 0) < 2):
                    j -= 1
                else:
                    if a + b > best[0]:
                        best = (a + b, (b, a))
                    i += 1
            bin_ = bin_[:-1] + list(best[1] or (smallest,))
            for one in best[1] or (smallest,):
                used[one] = used.get(one, 0) + 1
        need = {one: n for one, n in used.items() if n}
        times = min(left[one] // n for one, n in need.items())
        made.append((bin_, times))
        for one, n in need.items():
            left[one] -= n * times
        if any(not left[one] for one in need):
            lengths = [one for one in lengths if left[one]]
    return made


def places(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For runs of a length's numbered pieces: length, first number, pieces, pieces per bin, first bin, first offset."""
    runs, given, first = [], {}, 0
    for lengths, times in patterns:
        at, i = 0, 0
        while i < len(lengths):
            one, n = lengths[i], 1
            while i + n < len(lengths) and lengths[i + n] == one:
                n += 1
            runs.append((one, given.get(one, 0), n * times, n, first, at))
            given[one] = given.get(one, 0) + n * times
            at, i = at + one * n, i + n
        first += times
    return runs


def packed(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 0, with_ids: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset: which sequence holds each, and where."""
    spark = documents.sparkSession
    found = stored(pieces(documents, tokenizer_path, capacity, separator, with_ids))
    # At most ``capacity`` rows.
    counts = {r.length: r.n for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = places(best_two_fit(counts, capacity))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("r_length", "r_from", "r_count", "r_each", "r_bin", "r_offset")])
    rows = spark.createDataFrame(runs, schema)
    order = ["doc_id", "piece", "ids_crc32", "start"]
    numbers = numbered(found, ["length"], order, order, "number")
    at = F.col("number") - F.col("r_from")
    return numbers.join(
        F.broadcast(rows),  # its size is bounded by the number of lengths
        (F.col("length") == F.col("r_length")) & (at >= 0) & (at < F.col("r_count")),
    ).select(
        *found.columns,
        (F.col("r_bin") + F.floor(at / F.col("r_each"))).cast("long").alias("sequence_id"),
        (F.col("r_offset") + F.col("length") * (at % F.col("r_each"))).cast("long").alias("offset"),
    )


def sequences(pieces_with_ids: DataFrame) -> DataFrame:
    """sequence_id and ids (binary, little-endian unsigned 32-bit), from ``packed(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, one: F.concat(all_, one["ids"]))
    return pieces_with_ids.groupBy("sequence_id").agg(joined.alias("ids"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
