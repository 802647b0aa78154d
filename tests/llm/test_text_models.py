"""Personal data and toxicity: base spans against plain patterns, models on held-out and planted rows."""

import random
import re
import time

import cases
from conftest import SMALL
from larderline.llm import op5_pii as pii
from larderline.llm.op2_toxicity import fitted, learnable, toxicity, training_rows, without_toxic
from pyspark.sql import functions as F

PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = [
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                kind == 2 and 12 <= len(digits) <= 19 and pii.luhn(digits),
                9 <= len(digits) <= 15,
            ][kind]
            if ok:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    random.seed(1)
    for letters in ("a.@-_ b1", "12.3. 0", "0123456789 -4", "+1 ().-23", "a1@.+ -é()"):
        for _ in range(4000):
            text = "".join(random.choice(letters) for _ in range(random.randint(0, 40)))
            assert pii.base_spans(text) == plain_spans(text)


def test_spans_of_awkward_rows(spark):
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        got = {r.doc_id: r for r in pii.found(docs).collect()}
        text = cases.ROWS[9][1]
        base = plain_spans(text)
        assert got[10].spans == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert [got[10][f"n_{k}"] for k in pii.KINDS] == [1, 1, 1, 1]
        assert got[4].spans == "" and got[9].n_card == len([s for s in plain_spans(cases.LONG) if s[1] == 2])
        assert pii.found(docs).count() == len(cases.ROWS)
    assert pii.found(cases.empty(spark)).collect() == []
    assert pii.masked(cases.empty(spark)).collect() == []


def test_added_spans_and_masks(spark):
    texts = [f"mail x{i}@ex.com tel +1 (555) 123-45{i:02d} card 4111 1111 1111 1111 ip 10.0.0.{i}" for i in range(50)]
    texts += ["call tel (555) 123-4567 or mail bob at example dot com now", "they met at the end of a long road, dot by dot", "version 1.2.3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit("mine"))
    got = {r.doc_id: r.spans for r in pii.found(docs.drop("spans")).collect()}
    assert got[50] == "phone:9:23,email:32:54" and got[51] == "" and got[52] == ""
    left = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert left[50] == "call tel <PHONE> or mail <EMAIL> now" and left[51] == texts[51]
    assert left[3] == "mail <EMAIL> tel <PHONE> card <CARD> ip <IP>"
    assert pii.masked(docs).columns == docs.columns


def test_addresses_of_every_form_of_at_and_dot_alone_in_a_text(spark):
    ats = ["@", " @", "@ ", " @ ", " at ", "(at)", " [at] ", "{ at }", " (at) "]
    dots = [".", " dot ", "[dot]", " (dot) ", "{ dot }"]
    texts = [f"mail bob{a}example{d}com" for a in ats for d in dots]
    for text in texts:
        base = pii.base_spans(text)
        assert [(a, k, b) for a, k, b in base + pii.loose_spans(text, base)] == [(5, 0, len(text))]
    filler = [f"mail x{i}@ex.com tel +1 (555) 123-45{i:02d} card 4111 1111 1111 1111 ip 10.0.0.{i}" for i in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts + filler)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.found(docs).collect()}
    left = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    for i, text in enumerate(texts):
        assert (found[i], left[i]) == (f"email:5:{len(text)}", "mail <EMAIL>")


def test_looser_spans_touch_no_span_found_before():
    def slowly(text, base):
        taken, found = [(a, b) for a, _, b in base], []
        for kind, name in enumerate(pii.KINDS):
            for m in pii.LOOSE[name].finditer(text):
                if all(m.end() <= a or m.start() >= b for a, b in taken):
                    found.append((m.start(), kind, m.end()))
                    taken.append((m.start(), m.end()))
        return sorted(found)

    random.seed(6)
    bits = ["bob at ex.com", "bob@ex.com", "10[.]1[.]2[.]3", "10.1.2.3", "4111_1111_1111_1111", "4111 1111 1111 1111", "555-123-4567", "+1 555 123 4567", " ", " x ", "@", "."]
    for _ in range(3000):
        text = "".join(random.choice(bits) for _ in range(random.randint(1, 8)))
        base = pii.base_spans(text)
        assert pii.loose_spans(text, base) == slowly(text, base)


def test_a_text_of_many_spans_takes_linear_time():
    text = "call (555) 123-4567 or x@example.com, " * 50_000
    began = time.process_time()
    base = pii.base_spans(text)
    assert len(base) == 50_000 and len(pii.loose_spans(text, base)) == 50_000
    assert time.process_time() - began < 10  # a second or two; by comparing all spans with all, an hour


def test_the_sample_of_labels_is_bounded_when_ids_repeat(spark):
    docs = spark.createDataFrame([(i % 40 if i < 400 else 1, f"text {i % 7}") for i in range(1400)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = training_rows(docs, labels, 10).collect()
    assert len(rows) == 10 and sum(r.toxic for r in rows) == 5
    assert sorted(map(tuple, rows)) == sorted(map(tuple, training_rows(docs, labels, 10).collect()))


def test_reliabilities_separate_good_from_bad_patterns():
    good, bad = pii.pattern(2, [2, 2, 2, 2, 2], 16), pii.pattern(2, [0, 1, 1, 1, 1], 16)
    chance = pii.expectation_maximisation({good: 500, bad: 300})
    fit = pii.classifier({good: 500, bad: 300}, chance)
    assert chance[good] > 0.9 > 0.1 > chance[bad] and fit[good] > 0.5 > fit[bad]
    assert pii.parts_of(good) == (2, [2, 2, 2, 2, 2], 4)


def test_the_classifier_weighs_patterns_alike_at_every_size():
    # Three sizes of one vote, which no line through the sizes fits: the weights decide.
    codes = [pii.pattern(0, [0, 2, 0, 0, 2], n) for n in (0, 12, 28)]
    chance = dict(zip(codes, (0.9, 0.1, 0.9)))
    small, large = (pii.classifier({c: n * m for c, n in zip(codes, (900_000, 300_000, 20_000))}, chance) for m in (1, 100))
    assert all(abs(small[c] - large[c]) < 1e-3 for c in codes)


def planted(n=1500):
    """Documents of neutral words; one in eight holds insults, some disguised."""
    random.seed(3)
    rows, labels = [], []
    for i in range(n):
        words = [random.choice(cases.WORDS) for _ in range(random.randint(20, 60))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                at = random.randrange(len(words))
                words[at : at + 1] = random.choice([["you", "idiot"], ["stupid!!"], ["YOU", "MORON"], ["id1ot"], ["moron"]])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_documents(spark):
    rows, labels = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity(docs, known).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and 0.1 < len(held) / len(got) < 0.3
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    # Labels of held-out documents are not learned from.
    turned = known.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted((r.doc_id, r.score) for r in toxicity(docs, turned).collect()) == sorted((r.doc_id, r.score) for r in got)


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (7, 0), (7, 1), (99, 1)], "doc_id long, toxic int")
    for docs in (cases.documents(spark), cases.documents(spark, clashing=True)):
        got = toxicity(docs, labels).collect()
        assert len(got) == len(cases.ROWS) and all(0 <= r.score <= 1 for r in got)
        kept = without_toxic(docs, labels.where("toxic = 0"))
        assert kept.columns == docs.columns and kept.count() == len(cases.ROWS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity(cases.documents(spark), none).collect()} == {0.0}
    assert toxicity(cases.empty(spark), labels).collect() == []
    rows, known = planted(600)
    scorer = fitted(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, toxic int"))
    docs = cases.documents(spark, clashing=True).select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    assert scorer.trees is not None and scorer.score(docs, ["__row"]).count() == len(cases.ROWS)


def test_toxicity_of_the_table(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    assert toxicity(docs, labels).count() == docs.count()


def test_a_rare_class_is_learned_from(spark):
    rows, labels = planted(3000)
    toxic = [i for i, t in labels if t]

    def case(few, sample_labels):
        known = [(i, t) for i, t in labels if not t or i in few]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return docs, spark.createDataFrame(known, "doc_id long, toxic int"), {"sample_labels": sample_labels}

    # 60 toxic labels among 2,600, and a sample of which a share by hash would hold four; ten without a sample.
    learned = {r.doc_id for r in spark.createDataFrame(rows, "doc_id long, text string").where(learnable(F.col("doc_id"))).collect()}
    few = [i for i in toxic if i in learned]
    for docs, known, fit in (case(few[:60], 200), case(few[:10], 20_000)):
        assert fitted(docs, known, **fit).trees is not None
        got = {r.doc_id: r.predicted for r in toxicity(docs, known, **fit).collect()}
        assert sum(got[i] for i in toxic) >= 0.9 * len(toxic)
        assert sum(got.values()) - sum(got[i] for i in toxic) <= 0.02 * len(rows)
        assert without_toxic(docs, known, **fit).count() == len(rows) - sum(got.values())


def test_toxicity_without_a_classifier_drops_nothing(spark):
    rows, _ = planted(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i > 2)) for i, _ in rows], "doc_id long, toxic int")
    assert fitted(docs, known).trees is None and without_toxic(docs, known).count() == len(rows)


def test_few_toxic_labels_of_the_table_are_enough(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    assert fitted(docs, labels).trees is not None
