"""The stages in a row, and the registered queries of this part against their SQL."""

import time

import cases
import corpus_pipeline
import pytest
from compare import connect, differences
from conftest import SMALL
from larderline.llm.common import CLEANUP, stored
from larderline.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F
from test_near_copies import alike, tokens, words
from test_text_models import plain_spans

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stored(stage(spark, made[-1], SMALL)))
    return made


def test_stages_keep_the_columns_and_take_effect(results):
    docs, clean, lines, unique, masked, packed = results
    assert all(r.columns == COLUMNS for r in results[:-1])
    text = [{r.doc_id: r.text for r in df.collect()} for df in results[:-1]]
    assert all(text[0][i] == t for i, t in text[1].items())
    # Lines of words: no line kept is alike to an earlier line of the stage's input.
    seen, expected = [], {}
    for i in sorted(text[1]):
        kept = []
        for line in text[1][i].split("\n"):
            w = words(line)
            if not any(v == w or alike(tokens(w), s) for v, s in seen) or not w:
                kept.append(line)
            if w:
                seen.append((w, tokens(w)))
        expected[i] = "\n".join(kept)
    assert text[2] == {i: t for i, t in expected.items() if t.strip() or not text[1][i].strip()}
    sets = {i: tokens(words(t)) for i, t in text[3].items()}
    assert not any(a < b and alike(sets[a], sets[b]) for a in sets for b in sets)
    assert all(text[3][i] == t for i, t in text[2].items() if i in text[3])
    assert set(text[4]) == set(text[3]) and not any(plain_spans(t) for t in text[4].values())
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(text[4])
    assert all(r.n_chars == len(r.text) for r in masked.collect())


def test_run_gives_the_last_stage(spark, results):
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL)
    assert cases.rows_of(got.select(*pieces)) == cases.rows_of(results[-1].select(*pieces))


def test_stages_take_awkward_and_empty_documents(spark):
    for docs in (cases.documents(spark, clashing=True), cases.empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stored(stage(spark, docs, SMALL))
            assert after.columns == docs.columns
            docs = after
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_rows_that_share_an_id_compete_only_with_their_near_duplicates(spark):
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")
    rows = [
        (3, one), (5, one + " more"), (5, two), (5, three), (5, three), (6, two + " more"), (6, four), (6, four + " more"),
        (None, one + " else"), (None, "only here " + " ".join(f"n{i}" for i in range(40))), (42, None), (None, None), (7, ""), (7, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], cases.SCHEMA).repartition(3)
    got = cases.rows_of(corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).select("doc_id", "text"))
    assert len([r for r in got if r in ((6, four), (6, four + " more"))]) == 1
    got = [r for r in got if r != (6, four + " more") and r != (6, four)]
    assert got == sorted([rows[0], rows[2], rows[3], *rows[9:]], key=repr)


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in found.split("\n") if "/shuffle_" in f}

    before, setting = files(), spark.conf.get(CLEANUP)
    kept = stored(spark.range(5000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while files() - before and time.time() < until:  # they are removed in the background
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(CLEANUP) == setting
    assert sum(r["count"] for r in kept.collect()) == 5000


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "personal_data", "packing"]
