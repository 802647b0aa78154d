"""The audit against SQL and against brute force over every order; late smaller ids retract earlier counts."""

import re
from itertools import permutations

import duckdb
import pytest
from cases import ROWS, SCHEMA
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from larderline.llm import op12_filter_audit as op12

LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, 1, 1), (9, None, None), (None, 1, 1), (99, 1, 1)]


def brute(docs, labels):
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in docs),
        }
        mine = [] if doc_id is None else [x for x in labels if x[0] == doc_id]
        rows.append((lang or "", fails, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    report, removed_by = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for part in {r[0] for r in rows}:
            left = [r for r in rows if r[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                alone = sum(r[1][f] and sum(r[1].values()) == 1 for r in everyone)
                redundant = sum(r[1][f] for r in everyone) - len(gone)
                report[part, order, step] = [len(left), len(gone), redundant, alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in report.items()}


def found(report):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in report.collect()
    }


def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def test_equals_sql(spark):
    assert differences(op12.op12_filter_audit(spark, SMALL), connect(SMALL), op12.ORACLE) == []


@pytest.mark.parametrize("falling", [False, True])
def test_awkward_rows_in_any_order_of_arrival(spark, tmp_path, falling):
    long = "Plain words " * 60
    more = [(30, long, "en"), (21, long, "de"), (20, long, "en"), (20, long, "de"), (20, long, "en"), (25, "A B|C", None), (24, "A B|C", "")]
    docs = [(r[0], r[1], r[2]) for r in ROWS] + more
    by_id = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0), reverse=falling)
    for at in range(0, len(by_id), 3):
        made = spark.createDataFrame(by_id[at : at + 3], "doc_id long, text string, lang string").coalesce(1)
        for name in ("key", "mask", "part", "good", "n", "__of"):
            made = made.withColumn(name, F.lit("mine"))
        made.write.mode("append").parquet(str(tmp_path / "documents.parquet"))
    counted = op12.counters(spark, str(tmp_path / "documents.parquet"), labels(spark), files=1)
    assert counted.where("n < 0").count() == 0
    assert found(op12.audit(counted)) == brute(docs, LABELS)


def test_retractions_are_written(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "documents.parquet")
    for doc_id in (3, 2, 1):
        spark.createDataFrame([(doc_id, "same", "en")], "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(path)
    folder = tmp_path / "shared"
    monkeypatch.setattr(op12, "shared_folder", lambda _: str(folder))
    by_mask = op12.counters(spark, path, labels(spark), files=1).groupBy("mask").agg(F.sum("n").alias("n"))
    counted = {r["mask"]: r.n for r in by_mask.collect()}
    assert counted == {1: 1, 1 | 16: 2}
    written = duckdb.sql(f"SELECT count(*) FILTER (n < 0), sum(n) FROM read_parquet('{folder}/*/changes/*.parquet')").fetchall()
    assert written[0][1] == 3 and len(list(folder.glob("*/state/commits/[0-9]*"))) >= 3


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    assert op12.audit(op12.counters(spark, str(tmp_path / "documents.parquet"), labels(spark))).count() == 0
