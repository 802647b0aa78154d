"""Line dedup by an exact set-similarity join of all lines of all documents.

A line is the set of its word shingles (five words; fewer words are one token). It goes when a line before it, in order
of document id, text (by hash) and place, has a Jaccard similarity of at least 0.75; the line before need not itself
stay. Lines without words are left alone.

1. Lines that say the same, word for word, are one: the first stands for all, the others go.
2. Tokens are ordered by rarity: each task counts the tokens that repeat within its batches, the sums over all lines
   rank the most frequent ones (a table of bounded size) behind all others; the rest are in order of their hash. Any
   one order makes the join exact; this one keeps frequent tokens out of the prefixes.
3. The rarest tokens of a line, so many that similar lines must share one, are dealt out by token. Lines that meet and
   pass the length and positional filters are candidates, confirmed on their full sets.
   Prefix rows of a hot token (of more lines than a task should hold) are dealt to several groups by line.
4. In a token's group of up to HEADS + 1 lines all pairs are tried, in a larger one each line and HEADS of the others.
   Lines of larger groups, and of hot tokens, without an earlier match by then are held against all lines of the
   token, in blocks, without writing out pairs. So nothing is left untried, and a frequent token makes no square of pairs.

What stays is found from the other side: the first place of each distinct line, unless the join removes that line, is
kept with its document, so the places of a line that many documents hold never meet in one task.

Null text has no lines. Documents with a null id come after all others. Rows are told apart by id and text; of rows that
repeat both, one counts as the first and the lines of the others go (which one, extra columns do not decide). An empty
table gives an empty result. Extra columns are left out by ``marked`` and kept by ``cleaned``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from larderline.llm.common import arrow_map, column_of, ship_code, stored, table
from larderline.llm.op7_minhash import BLOCK, in_groups
from larderline.llm.shingles import WIDTH, distinct, hashed_words, of_few, rolled, sequence_hashes

HEADS = 8
#: Bits of a line's number within a part (beyond it, pairs are sorted as pairs), and of a token's place in the order.
LINE_BITS, ORDER_BITS = 20, 44
COLD_BITS = ORDER_BITS - 1


def similar(common: np.ndarray | int, one: np.ndarray | int, other: np.ndarray | int) -> np.ndarray | bool:
    return 100 * common >= 75 * (one + other - common)


#: Bytes of text whose lines are worked on at once: what is made of them fits a processor's cache.
PART_BYTES = 256 << 10
#: Bytes of text whose prefixes are packed together.
PACK_BYTES = 4 << 20


class Lines:
    """The lines of some texts: document (index), place, words, name (hash of the words), and the tokens of all lines."""

    def __init__(self, texts: list[bytes | None]) -> None:
        full = [(d, t) for d, t in enumerate(texts) if t]
        raw = b"\n".join(t for _, t in full)
        breaks = np.nonzero(np.frombuffer(raw, np.uint8) == 10)[0]
        line_starts = np.concatenate([[0], breaks + 1]) if full else np.zeros(0, np.int64)
        text_starts = np.cumsum([0, *(len(t) + 1 for _, t in full)])[:-1]
        which = np.searchsorted(text_starts, line_starts, "right") - 1
        self.document = np.array([d for d, _ in full], np.int64)[which]
        first = np.searchsorted(line_starts, text_starts, "left")
        self.place = np.arange(len(line_starts)) - first[which]
        words, at = hashed_words(raw)
        owner = np.searchsorted(line_starts, at, "right") - 1
        self.words = np.bincount(owner, minlength=len(line_starts))
        some = np.nonzero(self.words)[0]
        starts = np.concatenate([[0], np.cumsum(self.words[some])[:-1]]).astype(np.int64)
        self.name = np.zeros(len(line_starts), np.uint64)
        self.name[some] = sequence_hashes(words, starts[: len(some)], self.words[some])
        n = max(0, len(words) - WIDTH + 1)
        inside = owner[:n] == owner[len(owner) - n :]
        few = np.nonzero((self.words > 0) & (self.words < WIDTH))[0]
        self.tokens = np.concatenate([rolled(words)[inside] if n else words[:0], of_few(self.name[few])])
        self.owner = np.concatenate([owner[:n][inside], few])


def parts(texts: list[bytes | None], most: int = PART_BYTES):
    """Index of the first text and texts of consecutive parts, each of at most ``most`` bytes if it has several texts."""
    first, part, size = 0, [], 0
    for i, text in enumerate(texts):
        n = len(text or b"") + 1
        if part and size + n > most:
            yield first, part
            first, part, size = i, [], 0
        part.append(text)
        size += n
    if part:
        yield first, part


def firsts_of(names: np.ndarray) -> np.ndarray:
    """Which lines are the first of their name."""
    first = np.zeros(len(names), bool)
    first[np.unique(names, return_index=True)[1]] = True
    return first


#: The columns that tell rows of documents apart, in order: id is 0 where doc_id is null, key is the hash of the text.
ROW = ["null_id", "id", "key"]


def row_key() -> list[Column]:
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    return [F.col("doc_id").isNull().alias("null_id"), doc_id.alias("id"), F.xxhash64("text").alias("key")]


def line_rows(documents: DataFrame) -> DataFrame:
    """Row key, place, name, words of every line (name null: no words); and tokens that repeat in a batch, as rows of
    place -1 with the token as name and its count as words (lines that say the same count once in a part)."""

    def read(batch):
        found = [(first, Lines(part)) for first, part in parts(column_of(batch, "text").to_pylist())]
        tokens = np.concatenate([lines.tokens[firsts_of(lines.name)[lines.owner]] for _, lines in found])
        cells = (tokens & np.uint64(2**21 - 1)).astype(np.int64)
        again = tokens[np.bincount(cells, minlength=2**21)[cells] > 2]
        token, n = np.unique(again, return_counts=True)
        token, n = token[n > 2], n[n > 2]
        gather = lambda get: np.concatenate([get(first, lines) for first, lines in found])
        at = pa.array(gather(lambda first, lines: lines.document + first))
        row = {n: column_of(batch, n).take(at) for n in ROW}
        words = gather(lambda _, lines: lines.words)
        names = pa.array(gather(lambda _, lines: lines.name).view(np.int64), mask=words == 0)
        return {n: pa.concat_arrays([x, pa.nulls(len(token), x.type)]) for n, x in row.items()} | {
            "place": np.concatenate([gather(lambda _, lines: lines.place), np.full(len(token), -1)]).astype(np.int32),
            "name": pa.concat_arrays([names, pa.array(token.view(np.int64))]),
            "words": np.concatenate([words, n]),
        }

    rows = documents.select(*row_key(), F.col("text").cast("binary").alias("text"))
    return arrow_map(rows, "null_id boolean, id long, key long, place int, name long, words long", read)


def frequent(rows: DataFrame, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent tokens (ascending) and their rank by frequency, the most frequent last; at most ``entries``.
    And the counts by rank."""
    counts = rows.where("place = -1").groupBy("name").agg(F.sum("words").alias("n")).where("n > 2")
    top = counts.orderBy(F.desc("n"), "name").limit(entries).collect()[::-1]
    tokens = np.array([r.name for r in top], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], order, np.array([r.n for r in top], np.int64)


def first_hot(counts: np.ndarray, buckets: int, bucket_lines: int) -> int:
    """Place in the order from which on tokens are hot: seen in more than ``bucket_lines`` lines. With one bucket none is."""
    if buckets == 1:
        return 2**COLD_BITS + len(counts)
    return 2**COLD_BITS + int(np.searchsorted(counts, bucket_lines, "right"))


class Order:
    """Place of each token in the order by rarity, in ORDER_BITS bits."""

    def __init__(self, tokens: np.ndarray, ranks: np.ndarray) -> None:
        self.tokens, self.ranks = tokens, ranks.astype(np.uint64)
        self.maybe = np.zeros(2**22, bool)
        self.maybe[(tokens & np.uint64(2**22 - 1)).astype(np.int64)] = True

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        places = tokens >> np.uint64(64 - COLD_BITS)
        look = np.nonzero(self.maybe[(tokens & np.uint64(2**22 - 1)).astype(np.int64)])[0]
        if len(look) and len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens[look]), len(self.tokens) - 1)
            found = self.tokens[at] == tokens[look]
            places[look[found]] = np.uint64(2**COLD_BITS) + self.ranks[at[found]]
        return places


def prefixes(documents: DataFrame, order: tuple[np.ndarray, np.ndarray, np.ndarray], buckets: int, bucket_lines: int) -> DataFrame:
    """Prefix tokens of all lines, packed by bucket: place in the order, line's name, its tokens, position.

    A hot token has several buckets, of about ``bucket_lines`` of its lines each; a line is in one of them.
    """
    hot = first_hot(order[2], buckets, bucket_lines)
    salts = np.minimum(-(-order[2] // bucket_lines), buckets)[hot - 2**COLD_BITS :].astype(np.uint64)
    shared = documents.sparkSession.sparkContext.broadcast((*order[:2], salts))  # bounded by ``entries``
    made: list[Order] = []

    def pack(batch):
        if not made:
            made.append(Order(*shared.value[:2]))
        salts = shared.value[2]
        out = {"bucket": [], "low": [], "high": [], "name": [], "size": [], "position": []}
        texts = column_of(batch, "text").to_pylist()
        for _, pack_ in parts(texts, PACK_BYTES):
            pieces = [Lines(part) for _, part in parts(pack_)]
            # The first of the lines that say the same is enough for this pack.
            first, at, cells = firsts_of(np.concatenate([lines.name for lines in pieces])), 0, []
            for lines in pieces:
                names = lines.name.view(np.int64)
                use = first[at : at + len(names)][lines.owner] if len(names) else np.zeros(0, bool)
                at += len(names)
                owner, token = in_order(lines.owner[use], made[0](lines.tokens[use]), len(names))
                size = np.bincount(owner, minlength=len(names))
                start = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size
                position = np.arange(len(owner)) - start[owner]
                n = size[owner]
                keep = position < n - -(-3 * n // 4) + 1
                cells.append((names[owner[keep]], token[keep], position[keep], n[keep]))
            name, token, position, n = (np.concatenate(column) for column in zip(*cells))
            bucket = (token * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % buckets
            split = np.nonzero(token >= np.uint64(hot))[0]
            salt = name[split].view(np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)
            salt = salt % salts[(token[split] - np.uint64(hot)).astype(np.int64)]
            bucket[split] = (bucket[split] + salt.astype(np.int64)) % buckets
            by = np.argsort(bucket.astype(np.uint16) if buckets <= 2**16 else bucket, kind="stable")
            name, token, position, n, bucket = name[by], token[by], position[by], n[by], bucket[by]
            cuts = np.nonzero(np.diff(bucket))[0] + 1
            for a, b in zip([0, *cuts], [*cuts, len(bucket)]):
                if a < b:
                    out["bucket"].append(int(bucket[a]))
                    # Most lines are short: two bytes hold their sizes and positions.
                    kind = np.uint16 if n[a:b].max() < 2**16 else np.uint32
                    out["low"].append(token[a:b].astype(np.uint32).tobytes())
                    out["high"].append((token[a:b] >> np.uint64(32)).astype(np.uint16).tobytes())
                    out["name"].append(name[a:b].tobytes())
                    out["size"].append(n[a:b].astype(kind).tobytes())
                    out["position"].append(position[a:b].astype(kind).tobytes())
        return out

    schema = "bucket int, low binary, high binary, name binary, size binary, position binary"
    return arrow_map(documents.select(F.col("text").cast("binary").alias("text")), schema, pack)


def in_order(owner: np.ndarray, token: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of each line, rarest first, lines one after the other."""
    if lines < 2**LINE_BITS:
        keys = distinct(owner.astype(np.uint64) << np.uint64(ORDER_BITS) | token)
        return (keys >> np.uint64(ORDER_BITS)).astype(np.int64), keys & np.uint64(2**ORDER_BITS - 1)
    return distinct_pairs(owner, token)


def distinct_pairs(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of two columns, ascending."""
    by = np.lexsort((other, one))
    one, other = one[by], other[by]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (other[1:] != other[:-1])
    return one[new], other[new]


def passing(n1: np.ndarray, p1: np.ndarray, n2: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Length filter, and positional filter: what can still be common from these positions on is enough."""
    common = -(-3 * (n1 + n2) // 7)
    return (100 * np.minimum(n1, n2) >= 75 * np.maximum(n1, n2)) & (np.minimum(n1 - p1, n2 - p2) >= common)


def met(packed: DataFrame, hot: int) -> DataFrame:
    """a, b of candidate pairs (token null); and the lines of groups too large for all pairs: token, a (name), no b.

    Tokens from place ``hot`` on have lines in other groups too, so theirs are always too large.
    """
    ship_code(packed.sparkSession)

    def meet(table):
        import pandas as pd

        get = lambda n, kind: np.frombuffer(b"".join(table[n]), kind)
        token = get("low", np.uint32) | get("high", np.uint16).astype(np.uint64) << np.uint64(32)
        name = get("name", np.int64)
        kinds = [np.uint16 if len(s) * 4 == len(x) else np.uint32 for s, x in zip(table["size"], table["name"])]
        size, position = (np.concatenate([np.frombuffer(x, k) for x, k in zip(table[c], kinds)]).astype(np.int64) for c in ("size", "position"))
        by = np.lexsort((name, token))
        token, name, size, position = token[by], name[by], size[by], position[by]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (name[1:] != name[:-1])
        token, name, size, position = token[new], name[new], size[new], position[new]
        start = np.searchsorted(token, token, "left")
        count = np.searchsorted(token, token, "right") - start
        ones, others = [], []
        here = np.arange(len(token))
        for k in range(HEADS):
            i = here[here - start > k]
            j = start[i] + k
            ok = passing(size[i], position[i], size[j], position[j])
            ones.append(name[j[ok]])
            others.append(name[i[ok]])
        a, b = distinct_pairs(np.concatenate(ones), np.concatenate(others))
        large = (count > HEADS + 1) | (token >= np.uint64(hot))
        return pd.DataFrame(
            {
                "token": pd.array([None] * len(a) + token[large].astype(np.int64).tolist(), "Int64"),
                "a": np.concatenate([a, name[large]]),
                "b": pd.array(b.tolist() + [None] * int(large.sum()), "Int64"),
            }
        )

    return packed.groupBy("bucket").applyInPandas(meet, "token long, a long, b long")


def sets_of(wanted: DataFrame, firsts: DataFrame, documents: DataFrame) -> DataFrame:
    """name and tokens (binary) of the lines named in ``wanted``, read again from the first text that has each."""
    names = wanted.join(firsts, "name").select("name", "first.*").groupBy(*ROW).agg(F.collect_set("name").alias("names"))
    texts = documents.select(*row_key(), F.col("text").cast("binary").alias("text"))
    chosen = texts.join(names, ROW).select("text", "names")

    def read(batch):
        out = {"name": [], "tokens": []}
        asked = column_of(batch, "names")
        for begin, part in parts(column_of(batch, "text").to_pylist()):
            lines = Lines(part)
            names = lines.name.view(np.int64)
            use = firsts_of(names) & (lines.words > 0) & np.isin(names, asked.slice(begin, len(part)).flatten().to_numpy())
            mine = use[lines.owner]
            owner, tokens = distinct_pairs(lines.owner[mine], lines.tokens[mine])
            which, raw = np.nonzero(use)[0], tokens.tobytes()
            out["name"] += names[which].tolist()
            begins, ends = (8 * np.searchsorted(owner, which, side) for side in ("left", "right"))
            out["tokens"] += [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())]
        return out

    return arrow_map(chosen, "name long, tokens binary", read).dropDuplicates(["name"])


def earlier_matches(block: dict, _: np.ndarray) -> list[tuple[int]]:
    """Names of the asking lines of a block that match an earlier one in it."""
    asks = block["asks"].astype(bool)
    others = np.nonzero(~asks)[0]
    if not asks.any() or not len(others):
        return []
    sets = [np.frombuffer(s, np.uint64) for s in block["tokens"]]
    values = np.concatenate([sets[j] for j in others])
    sizes = np.array([len(sets[j]) for j in others])
    owner = np.repeat(np.arange(len(others)), sizes)
    by = np.argsort(values, kind="stable")
    values, owner = values[by], owner[by]
    null, doc, key, place = (np.asarray(block[n]) for n in (*ROW, "place"))
    found = []
    for i in np.nonzero(asks)[0]:
        low, high = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        lengths = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[at], minlength=len(others))
        near = others[similar(common, sizes, len(sets[i]))]
        before = place[near] < place[i]
        for part in (key, doc, null):
            before = (part[near] < part[i]) | (part[near] == part[i]) & before
        if before.any():
            found.append((int(block["name"][i]),))
    return found


def removed_names(documents: DataFrame, rows: DataFrame, firsts: DataFrame, entries: int, bucket_lines: int) -> DataFrame:
    """name of every line of words whose first place has a similar line before it."""
    spread = max(1, firsts.count() // bucket_lines)
    order = frequent(rows, entries)
    packed = prefixes(documents, order, spread, bucket_lines)
    found = stored(met(packed, first_hot(order[2], spread, bucket_lines)))
    pairs = found.where("token is null").select("a", "b").distinct()
    wanted = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).distinct()
    sets = stored(sets_of(wanted, firsts, documents).join(firsts, "name"))
    both = pairs.join(sets.select(F.col("name").alias("a"), F.col("tokens").alias("s1"), F.col("first").alias("f1")), "a")
    both = both.join(sets.select(F.col("name").alias("b"), F.col("tokens").alias("s2"), F.col("first").alias("f2")), "b")
    both = both.select("s1", "s2", F.when(F.col("f1") > F.col("f2"), F.col("a")).otherwise(F.col("b")).alias("name"))

    def confirm(batch):
        keep = []
        for one, other in zip(column_of(batch, "s1").to_pylist(), column_of(batch, "s2").to_pylist()):
            x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            keep.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
        return {"name": column_of(batch, "name").to_numpy()[np.array(keep)]}

    settled = stored(arrow_map(both, "name long", confirm).distinct())
    large = found.where("token is not null").select(F.col("token").alias("band"), F.col("a").alias("name"))
    large = large.join(settled.withColumn("done", F.lit(True)), "name", "left").join(firsts, "name")
    large = stored(large.select("band", "name", F.col("done").isNull().alias("open"), "first", "words"))
    size = F.greatest(F.lit(1), F.col("words") - WIDTH + 1)
    part = lambda n, total: F.greatest(F.ceil(n / BLOCK), F.ceil(total / (BLOCK * 1000)), F.lit(1)).cast("long")
    by = large.groupBy("band").agg(
        part(F.sum(F.col("open").cast("long")), F.sum(F.when(F.col("open"), size))).alias("lows"),
        part(F.count(F.lit(1)), F.sum(size)).alias("highs"),
        F.max("open").alias("any_open"),
    )
    dealt = large.join(by.where("any_open"), "band")
    of = lambda n: F.pmod(F.xxhash64("name"), F.col(n))
    columns = ["name", F.col("first.null_id").cast("int").alias("null_id"), "first.id", "first.key", "first.place"]
    asking = dealt.where("open").select("band", of("lows").alias("low"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("highs") - 1)).alias("high"), F.lit(True).alias("asks"), *columns)
    asked = dealt.select("band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lows") - 1)).alias("low"), of("highs").alias("high"), F.lit(False).alias("asks"), *columns)
    blocks = stored(asking.unionByName(asked))
    more = sets_of(blocks.select("name").distinct().join(sets, "name", "left_anti"), firsts, documents)
    tokens = sets.select("name", "tokens").unionByName(more)
    rest = in_groups(blocks.join(tokens, "name"), earlier_matches, "name long", per_group=4000)
    return settled.unionByName(rest).distinct()


def kept_lines(documents: DataFrame, entries: int, bucket_lines: int) -> tuple[DataFrame, DataFrame]:
    """All lines, as ``line_rows`` gives them; and by row key the places of the lines of words that stay."""
    rows = stored(line_rows(documents))
    place = F.struct(*ROW, "place")
    lines = rows.where("place >= 0 and name is not null")
    firsts = stored(lines.groupBy("name").agg(F.min(place).alias("first"), F.first("words").alias("words")))
    gone = removed_names(documents, rows, firsts, entries, bucket_lines)
    kept = firsts.join(gone, "name", "left_anti").select("first.*")
    return rows, kept.groupBy(*ROW).agg(F.collect_set("place").alias("stay"))


def marked(documents: DataFrame, entries: int = 2**18, bucket_lines: int = 20_000, step: int = 10_000) -> DataFrame:
    """doc_id, n_lines, n_removed and removed (places from 0, comma-joined) of every document."""
    rows, kept = kept_lines(documents, entries, bucket_lines)
    by = rows.where("place >= 0").groupBy(*ROW).agg(
        F.count(F.when(F.col("place") == 0, 1)).alias("copies"),
        (F.max("place") + 1).cast("long").alias("n_lines"),
        F.collect_set(F.when(F.col("name").isNotNull(), F.col("place"))).alias("worded"),
    )
    # A row for each copy, in steps, so that no array grows with the copies; the lines of all but the first go.
    by = by.join(kept, ROW, "left").withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / step))))
    copy = F.sequence(F.col("step") * step, F.least(F.col("copies"), (F.col("step") + 1) * step) - 1)
    by = by.withColumn("copy", F.explode(copy))
    stay = F.when(F.col("copy") == 0, F.col("stay"))
    gone = F.array_sort(F.when(stay.isNull(), F.col("worded")).otherwise(F.array_except("worded", stay)))
    by = by.select(F.when(~F.col("null_id"), F.col("id")).alias("doc_id"), "n_lines", gone.alias("gone"))
    found = by.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), F.concat_ws(",", F.transform("gone", lambda p: p.cast("string"))).alias("removed"))
    none = documents.where(F.coalesce(F.col("text"), F.lit("")) == "").select(F.col("doc_id").cast("long").alias("doc_id"))
    zero = F.lit(0).cast("long")
    return found.unionByName(none.select("doc_id", zero.alias("n_lines"), zero.alias("n_removed"), F.lit("").alias("removed")))


#: What makes a line one of words.
WORDED = re.compile(r"[^\x20\x09-\x0d]")


def cleaned(documents: DataFrame, entries: int = 2**18, bucket_lines: int = 20_000) -> DataFrame:
    """``documents`` with the removed lines cut from ``text``; a document that had words and has lost them all goes.

    So do the copies of a row, as their lines all go.
    """
    _, kept = kept_lines(documents, entries, bucket_lines)
    worded = F.coalesce(F.col("text").cast("string").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    on = [f"__{n}" for n in ROW]
    keyed = documents.where(worded).select(F.struct("*").alias("__row"), *[c.alias(n) for c, n in zip(row_key(), on)])
    # One row of each id and text goes on, found before the exchange. The join has the window's keys: texts move once.
    first = keyed.withColumn("__first", F.row_number().over(Window.partitionBy(*on).orderBy(on[-1]))).where("__first = 1")
    kept = kept.select(*[F.col(n).alias(m) for n, m in zip(ROW, on)], F.col("stay").alias("__stay"))
    joined = first.join(kept, on, "left").select("__row", "__stay")
    columns = joined.schema["__row"].dataType.fields
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in columns])

    def cut(batch):
        row, text, whole = column_of(batch, "__row"), [], []
        old = row.field("text").cast(pa.string()).to_pylist()
        for x, stay in zip(old, column_of(batch, "__stay").to_pylist()):
            lines, at = x.split("\n"), set(stay or ())
            left = [line for p, line in enumerate(lines) if p in at or not WORDED.search(line)]
            text.append("\n".join(left))
            whole.append(len(left) == len(lines) or bool(at))
        keep = pa.array(whole, pa.bool_())
        return {f.name: (pa.array(text, pa.string()) if f.name == "text" else row.field(f.name)).filter(keep) for f in columns}

    # Rows without words all stay as they are.
    others = documents.where(~worded).withColumn("text", F.col("text").cast("string"))
    return arrow_map(joined, schema, cut).unionByName(others)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(table(spark, sf_dir, "documents"))


#: Every pair of different lines that share a token, with the exact rule; places in order of doc_id and line.
ORACLE = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place
  FROM documents WHERE text IS NOT NULL AND text <> ''
), worded AS (
  SELECT doc_id, place, [w FOR w IN regexp_split_to_array(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS w
  FROM lines
), named AS (
  SELECT doc_id, place, w, array_to_string(w, ' ') AS name FROM worded
), firsts AS (
  SELECT name, any_value(w) AS w, min(CAST(doc_id AS HUGEINT) * 1000000000 + place) AS first FROM named WHERE name <> '' GROUP BY name
), sets AS (
  SELECT name, first, CASE WHEN len(w) < 5 THEN [name]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM firsts
), items AS (
  SELECT name, first, len(s) AS n, unnest(s) AS item FROM sets
), gone AS (
  SELECT DISTINCT name FROM (
    SELECT b.name FROM items a JOIN items b ON a.item = b.item AND a.first < b.first
    GROUP BY a.name, b.name, a.n, b.n
    HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
  )
), judged AS (
  SELECT n.doc_id, n.place, coalesce(g.name IS NOT NULL OR CAST(n.doc_id AS HUGEINT) * 1000000000 + n.place <> f.first, false) AS removed
  FROM named n LEFT JOIN firsts f ON n.name = f.name LEFT JOIN gone g ON n.name = g.name
)
SELECT d.doc_id, count(j.place) AS n_lines, count(j.place) FILTER (WHERE j.removed) AS n_removed,
  coalesce(string_agg(CAST(j.place AS VARCHAR), ',' ORDER BY j.place) FILTER (WHERE j.removed), '') AS removed
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id
GROUP BY d.doc_id
"""
