"""Ids, spans and decoded texts against the library, with and without a compiled character map."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from cases import ROWS, documents, empty, rows_of
from conftest import SMALL
from pyspark.sql import functions as F

from larderline.llm import op13_sentencepiece as op13

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*"  ▁▁ab1\n\t\r é́日😀\x00ﬁ　 Ａｶﾞ½①…<s></s>�한각.,;:_'²"]
ALPHABET += ["<s>", "<0x0A>", "the", "\r\n", "é", "   ", "가", "​", "word.", "word,", "don't"]


def texts(seed, count):
    draw = random.Random(seed)
    made = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 40))) for _ in range(count)]
    return [*made, "", " ", "  ", "▁", "▁▁", " a", "z" * 5000, "ab" * 3000 + " " * 300, "é" * 50, "😀" * 9]


def with_normaliser(proto, rule, prefix, squeeze):
    """The model with another normaliser, whose map the library compiles."""
    made = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, remove_extra_whitespaces=squeeze)
    spec = [value for name, value in op13.fields(made.serialized_model_proto()) if name == op13.NORMALIZER][-1]
    size, length = b"", len(spec)
    while length > 127:
        size, length = size + bytes([length & 127 | 128]), length >> 7
    return proto + bytes([op13.NORMALIZER << 3 | 2]) + size + bytes([length]) + spec


def agree(model, library, some):
    for text in some:
        ids, ends, first = model.encode(text)
        pieces = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in pieces], text
        assert ends.tolist() == [p.end for p in pieces], text
        assert [first, *ends[:-1].tolist()][: len(ends)] == [p.begin for p in pieces], text
        assert model.decode(ids.tolist()) == library.decode(ids.tolist()), text


def test_ids_spans_and_decoding_equal_the_library():
    model = op13.worker_model(PATH)
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    agree(model, library, texts(1, 3000))
    draw = random.Random(2)
    for _ in range(3000):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(3, 259), 0, 1, 2, 259, 28705]) for _ in range(draw.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_longest_prefixes_of_a_compiled_map(rule, prefix, squeeze):
    with open(PATH, "rb") as file:
        proto = with_normaliser(file.read(), rule, prefix, squeeze)
    agree(op13.Model(proto), sentencepiece.SentencePieceProcessor(model_proto=proto), texts(3, 600))


def test_both_ways_of_merging_agree():
    model = op13.worker_model(PATH)
    for text in texts(5, 500):
        chunk = text[:300]
        assert model.cut_by_scanning(chunk) == model.cut_by_queue(chunk)


def test_query_digests_and_spans(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    digest = lambda text: sha256(text.encode()).hexdigest()
    for docs in (documents(spark), spark.read.parquet(f"{SMALL}/documents.parquet")):
        expected = []
        for doc_id, text in docs.select("doc_id", "text").collect():
            ids = library.encode(text or "")
            expected.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
        got = op13.round_trip(docs, PATH)
        assert rows_of(got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == sorted(expected, key=repr)
        full = {(r.doc_id, r.covered) for r in got.collect()}
        assert full == {(d, len((t or "").encode())) for d, t in docs.select("doc_id", "text").collect()}


def test_spans_cover_the_text_and_decoding_is_an_operator(spark):
    docs = documents(spark, clashing=True).withColumn("ids", F.lit("mine"))
    made = op13.encoded(docs, PATH)
    by_id = {r[0]: (r[1] or "").encode() for r in ROWS}
    for row in made.where("doc_id IS NOT NULL").collect():
        data = by_id[row.doc_id]
        assert b"".join(data[a:b] for a, b in zip(row.begins, row.ends)) == data
    back = {r.doc_id: r.text for r in op13.decoded(made, PATH).where("doc_id IS NOT NULL").collect()}
    assert back == {r[0]: r[1] or "" for r in ROWS if r[0] is not None}
    assert op13.encoded(empty(spark), PATH).count() == 0 and op13.round_trip(empty(spark), PATH).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert op13.decoded(nothing, PATH).first().text is None


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="merging"):
        op13.Model(b"")
