"""Packing, token counts and byte-level BPE against the tokenizer libraries."""

import random
from hashlib import sha256
from struct import pack
from zlib import crc32

import cases
import public_tokenizers
import pyarrow as pa
import tiktoken
from larderline.llm.op3_packing import Ids, best_two_fit, packed, places, sequences
from larderline.llm.op6_token_counts import token_counts
from larderline.llm.op10_bpe import Encoder, RankQueue, decoded, encoded, read_ranks, round_trip
from tokenizers import Tokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def noise(n: int, seed: int = 3):
    random.seed(seed)
    letters = "aaab  \n\t\r'sSt12é日<|>\x1c\x85 ​.!?ßİΣ"
    return ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(n)]


def test_token_counts_equal_the_library(spark):
    library = Tokenizer.from_file(BYTE)
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        got = cases.rows_of(token_counts(docs, BYTE))
        expected = []
        for doc_id, text, *_ in cases.ROWS:
            n = len(library.encode(text or "", add_special_tokens=False).ids)
            expected.append((doc_id, len((text or "").encode()), n, n > 1024))
        assert got == sorted(expected, key=repr)
    assert token_counts(cases.empty(spark), BYTE).collect() == []


def test_token_counts_of_odd_texts(spark):
    library = Tokenizer.from_file(BYTE)
    texts = noise(2000) + ["a <|endoftext|>  b", "<|endoftext|>" * 3]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts(rows, BYTE, sample_docs=50, entries=20).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_bpe_equals_the_library_and_decodes(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        got = cases.rows_of(round_trip(docs, RANKS, public_tokenizers.PATTERN))
        expected = []
        for doc_id, text, *_ in cases.ROWS:
            ids = library.encode_ordinary(text or "")
            expected.append((doc_id, len(ids), sha256(pack(f"<{len(ids)}I", *ids)).hexdigest(), sha256((text or "").encode()).hexdigest()))
        assert got == sorted(expected, key=repr)
    assert round_trip(cases.empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []
    ids = encoded(cases.documents(spark), RANKS, public_tokenizers.PATTERN)
    back = cases.rows_of(decoded(ids, RANKS, public_tokenizers.PATTERN))
    assert [(i, bytes(t)) for i, t in back] == sorted([(i, (t or "").encode()) for i, t, *_ in cases.ROWS], key=repr)


def test_bpe_of_odd_texts_and_very_long_pretokens():
    ranks = read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    for text in noise(3000) + ["a" * 20_000, "ab" * 10_000 + "c" * 777, "!?" * 5_000]:
        assert encoder.encode(text) == pack(f"<{len(ids := library.encode_ordinary(text))}I", *ids)


def test_bpe_of_ranks_that_are_not_in_learning_order():
    ranks = {bytes([b]): 300 + b for b in range(256)} | {b"ab": 9, b"abc": 2, b"bc": 5, b"ca": 1, b"caca": 0}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    random.seed(1)
    for _ in range(300):
        text = "".join(random.choice("abc") for _ in range(random.randint(1, 30)))
        assert encoder.encode(text) == pack(f"<{len(ids := library.encode_ordinary(text))}I", *ids)


def test_rank_queue_gives_the_lowest_rank_and_the_leftmost_place():
    queue, held = RankQueue(300_000), []
    random.seed(2)
    for _ in range(2000):
        if held and random.random() < 0.45:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            item = (random.choice([3, 64, 4095, 4096, 299_999, random.randrange(300_000)]), random.randrange(50))
            if item not in held:
                held.append(item)
                queue.push(*item)


def test_word_ids_of_odd_texts():
    ids = Ids(WORD)
    for text in noise(3000) + ["a<|endoftext|>b <|startoftext|>", "word, word.", "naïve... (x)"]:
        ids.learn(text.split())
        assert ids.encode(text) == ids.whole(text)


def check_packing(pieces, expected, capacity):
    """Pieces as expected, sequences gapless from 0 and within capacity; returns their number."""
    assert sorted([(p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces], key=repr) == sorted(expected, key=repr)
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


def test_packing_of_whole_documents(spark):
    library = Tokenizer.from_file(WORD)
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        for capacity in (2048, 64):
            expected = []
            for doc_id, text, *_ in cases.ROWS:
                ids = library.encode(text or "", add_special_tokens=False).ids + [0]
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    expected.append((doc_id, k, at, len(part), crc32(pack(f"<{len(part)}I", *part))))
            check_packing(packed(docs, WORD, capacity).collect(), expected, capacity)
    assert packed(cases.empty(spark), WORD).collect() == []


def test_a_tokenizer_of_another_kind_gives_its_own_ids():
    for path, by_words in ((WORD, True), (BYTE, False)):
        ids = Ids(path)
        assert (ids.by_words, ids.plain_case) == (by_words, by_words)
        for text in [*noise(300), *(t for _, t, *_ in cases.ROWS if t)]:
            ids.learn(text.split() if by_words else [])
            assert ids.encode(text) == ids.whole(text)


def test_ids_of_many_texts_equal_those_of_each(monkeypatch):
    texts = [*noise(3000), "a<|endoftext|>b <|startoftext|>", "word, word.", "naïve... (x)", "", " ", "x" * 70 + " " + "é" * 70]
    texts += ["Cafe\u0301 caf\u00e9 \u00c9t\u00e9 \u01c4 \u0130i \u017f \u0149 \u1100\u1161 \u212b", "a\u0085b\u00a0c\u2028d\u3000e\x0bf\x0cg\u180eh\u200bi"] * 2
    for path in (WORD, BYTE):
        for block, entries in ((4 << 20, 700_000), (500, 20)):
            monkeypatch.setattr("larderline.llm.op3_packing.BLOCK", block)
            ids = Ids(path)
            ids.entries = entries
            some = texts if path == WORD else texts[-400:]
            # A slice with nulls, as a batch may be one.
            made = list(ids.encode_all(pa.array(["cut off", *some, None, None]).slice(1)))
            assert made == [*map(ids.whole, some), b"", b""]
    assert list(ids.encode_all(pa.array([], pa.string()))) == []
    assert list(Ids(WORD).encode_all(pa.array([None, ""], pa.string()))) == [b"", b""]


def test_a_word_is_looked_up_once_for_many_texts():
    ids = Ids(WORD)
    asked, whole = [], []
    ids.encode_different = lambda words, then=ids.encode_different: asked.extend(words) or then(words)
    ids.model = type("Model", (), {"tokenize": lambda self, word, then=ids.model.tokenize: whole.append(word) or then(word)})()
    list(ids.encode_all(pa.array(["The one and the other, one and all."] * 1000)))
    assert sorted(asked) == sorted({"The", "one", "and", "the", "other,", "all."})
    # Words of letters need the library's model alone, and that once.
    assert sorted(whole) == ["all", "and", "one", "other", "the"]


def test_sequences_hold_the_ids_of_their_pieces(spark):
    pieces = packed(cases.documents(spark), WORD, 64, with_ids=True)
    rows = pieces.collect()
    for r in sequences(pieces).collect():
        parts = sorted((p.offset, bytes(p.ids)) for p in rows if p.sequence_id == r.sequence_id)
        assert bytes(r.ids) == b"".join(ids for _, ids in parts)


def test_two_for_one_exchange_fills_what_greedy_leaves():
    # Greedy takes 6 + 3 and leaves 1; taking out the 3 makes room for 2 + 2.
    assert best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)


def test_patterns_use_every_piece_once_and_come_close_to_the_bound():
    random.seed(5)
    counts = {}
    for _ in range(20_000):
        n = min(2048, int(random.lognormvariate(5.5, 1.0)) + 1)
        counts[n] = counts.get(n, 0) + 1
    patterns = best_two_fit(counts, 2048)
    used = {}
    for lengths, times in patterns:
        assert sum(lengths) <= 2048
        for n in lengths:
            used[n] = used.get(n, 0) + times
    assert used == counts
    bins, total = sum(t for _, t in patterns), sum(n * c for n, c in counts.items())
    assert bins <= -(-total // 2048) * 1.01 + 1
    assert sum(r[2] for r in places(patterns)) == sum(counts.values())
    assert len(patterns) < 5 * len(counts)
