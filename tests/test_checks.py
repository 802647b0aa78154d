"""Expectations, model tests and anomalies on edge cases."""

import json
from datetime import date, timedelta

from pyspark.sql import functions as F

from larderline.operators import anomaly, quality as q

AS_OF = date(2023, 12, 31)


def results(tables, checks):
    return {(r["expectation"], r["column_name"]): r for r in q.run_checks(tables, checks, AS_OF).collect()}


def test_null_rules(spark):
    t = spark.createDataFrame([(None, "A", 1.0), (None, "Z", None), ("k", None, 300.0)], "k string, s string, v double")
    out = results(
        {"t": t},
        [q.no_nulls("t", "k"), q.unique("t", "k"), q.accepted_values("t", "s", ["A"]), q.values_between("t", "v", 0, 100, 0.6)],
    )
    assert json.loads(out[(q.NO_NULLS, "k")]["details"]) == {"null_count": 2}
    assert json.loads(out[(q.UNIQUE, "k")]["details"]) == {"duplicate_count": 1}
    assert json.loads(out[(q.ACCEPTED, "s")]["details"])["bad_count"] == 1
    between = json.loads(out[(q.BETWEEN, "v")]["details"])
    assert between["bad_count"] == 1 and between["pct_passing"] == 0.6667 and out[(q.BETWEEN, "v")]["passed"]


def test_empty_table(spark):
    t = spark.createDataFrame([], "k string, v double, d date")
    out = results(
        {"t": t},
        [q.values_between("t", "v", 0, 1), q.row_count_between("t", 1, 2), q.fresh("t", "d", 400), q.unique("t", "k")],
    )
    assert out[(q.BETWEEN, "v")]["passed"] and out[(q.UNIQUE, "k")]["passed"]
    assert not out[(q.ROW_COUNT, "*")]["passed"] and not out[(q.FRESH, "d")]["passed"]


def test_orphans_and_null_parent(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "f string")
    parent = spark.createDataFrame([("a",)], "f string")
    holed = spark.createDataFrame([("a",), (None,)], "f string")
    plain = results({"c": child, "p": parent}, [q.references("c", "f", "p", "f")])
    assert json.loads(list(plain.values())[0]["details"])["orphan_count"] == 2
    hidden = results({"c": child, "p": holed}, [q.references("c", "f", "p", "f")])
    assert json.loads(list(hidden.values())[0]["details"]) == {"orphan_count": 0, "parent_has_null": True}
    tests = q.run_model_tests("source", "c", child, [q.references("c", "f", "p", "f"), q.no_nulls("c", "f")], {"p": holed})
    assert {r["test"]: r["failures"] for r in tests.collect()} == {"relationships": 2, "not_null": 1}


def test_model_unique_ignores_nulls(spark):
    t = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", None)], "k string, v int")
    out = q.run_model_tests("mart", "t", t, [q.unique("t", "k"), q.no_nulls("t", "k"), q.no_nulls("t", "v")], {})
    assert {(r["test"], r["column_name"]): r["failures"] for r in out.collect()} == {
        ("unique", "k"): 1,
        ("not_null", "k"): 2,
        ("not_null", "v"): 1,
    }


def scored(spark, counts):
    """counts: rows per day offset, None = no rows that day."""
    start = date(2023, 1, 1)
    rows = [(start + timedelta(days=i),) for i, n in enumerate(counts) for _ in range(n or 0)]
    df = spark.createDataFrame(rows, "d date")
    measured = anomaly.bucket_metrics("m", df, "d", "day", [anomaly.Metric("*", "row_count", 3)])
    return sorted(anomaly.score(anomaly.fill_gaps(measured)).collect(), key=lambda r: r["bucket"])


def test_flat_past_is_not_scored(spark):
    assert all(r["z_score"] is None and not r["is_anomalous"] for r in scored(spark, [5] * 12 + [50]))


def test_missing_day_counts_as_zero_and_is_anomalous(spark):
    out = scored(spark, [10, 12, 11, 10, 12, 11, 10, 12, None, 11])
    assert len(out) == 10
    gap = out[8]
    assert gap["value"] == 0.0 and gap["is_anomalous"] and gap["z_score"] < -3
    assert all(r["z_score"] is None for r in out[:7])


def test_one_pass_counts_equal_separate_ones(spark):
    rows = [(i, None if i % 10 == 0 else f"K{i % 7}", None if i < 3 else i % 5, i % 4) for i in range(200)] + [(1, "K1", 99, 0)]
    t = spark.createDataFrame(rows, "id int, k string, parent int, v int")
    parents = spark.createDataFrame([(0,), (1,), (1,), (2,)], "p int")
    with_null = spark.createDataFrame([(0,), (None,)], "p int")
    keyed = {
        "a": q.Keyed("id"),
        "b": q.Keyed("k"),
        "c": q.Keyed("parent", parents, "p"),
        "d": q.Keyed("parent", with_null, "p"),
    }
    got = q.counted_once(t, {"s": F.col("v")}, {"x": F.col("v")}, keyed).first()
    assert (got.n, got.s, got.x) == (201, sum(r[3] for r in rows), 3)
    assert (got.a_repeated, got.a_null_repeated) == (1, 0) and (got.b_repeated, got.b_null_repeated) == (8, 1)
    assert (got.c_lost, got.c_parent_null) == (sum(r[2] in (3, 4, 99) for r in rows if r[2] is not None), False)
    assert (got.d_lost, got.d_parent_null) == (sum(r[2] != 0 for r in rows if r[2] is not None), True)
    empty = q.counted_once(t.limit(0), {"s": F.col("v")}, {}, keyed).first()
    assert (empty.n, empty.s, empty.a_repeated, empty.c_lost, empty.d_parent_null) == (0, None, 0, 0, True)


def test_model_tests_build_the_model_once(spark):
    t = spark.range(100).selectExpr("id", "id % 7 AS k", "id % 3 AS p")
    parents = {"a": spark.range(3).toDF("p"), "b": spark.range(9).toDF("k")}
    tests = [
        q.unique("t", "id"), q.unique("t", "k"), q.no_nulls("t", "p"),
        q.references("t", "p", "a", "p"), q.references("t", "k", "b", "k"),
    ]
    out = q.run_model_tests("mart", "t", t, tests, parents)
    assert [(r.test, r.failures) for r in out.collect()] == [("unique", 0), ("unique", 7), ("not_null", 0), ("relationships", 0), ("relationships", 0)]
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Range (0, 100") == 1
