"""Versions, dedup and joins on small hand-made rows, some against brute force."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from larderline.operators import price_versions as pv
from larderline.operators.joins import splittable_left_join
from larderline.plans import staging

AS_OF = date(2023, 12, 31)


def day(n):
    return date(2023, 1, 1) + timedelta(days=n)


def test_duplicate_sale_keeps_largest_total_then_first_store(spark):
    rows = [
        ("S1", "STR2", "P1", datetime(2023, 1, 2), 2, 5.0, 10.0),
        ("S1", "STR1", "P1", datetime(2023, 1, 2), 2, 5.0, 10.0),
        ("S1", "STR0", "P1", datetime(2023, 1, 2), 1, 5.0, 5.0),
        ("S2", "STR1", "P1", datetime(2023, 1, 7), 3, 5.0, 15.02),
    ]
    raw = spark.createDataFrame(
        rows,
        "sale_id string, store_id string, product_id string, sale_date timestamp_ntz, quantity bigint, "
        "unit_price double, total_amount double",
    )
    out = {r["sale_id"]: r for r in staging.stg_sales(raw).collect()}
    assert out["S1"]["store_id"] == "STR1"
    assert not out["S1"]["is_weekend"] and not out["S1"]["has_price_discrepancy"]
    assert out["S2"]["is_weekend"] and out["S2"]["has_price_discrepancy"]


def random_changes(seed, products=6, changes=40, days=400):
    rng = random.Random(seed)
    hot = [("P0", day(d)) for d in rng.sample(range(days), changes * 2)]
    rest = [(f"P{rng.randrange(1, products)}", day(rng.randrange(days))) for _ in range(changes)]
    return sorted(set(hot + rest))


def test_close_versions_matches_plain_successor(spark):
    changes = random_changes(1)
    df = spark.createDataFrame(changes, "product_id string, effective_from date")
    got = {(r["product_id"], r["valid_from"]): r["valid_to"] for r in pv.close_versions(df, "product_id", "effective_from").collect()}
    expected = {}
    for product, start in changes:
        later = [s for p, s in changes if p == product and s > start]
        expected[(product, start)] = min(later) if later else None
    assert got == expected


def test_merge_equals_full_build(spark):
    changes = random_changes(2)
    df = spark.createDataFrame(changes, "product_id string, effective_from date")
    split = F.lit(day(200).isoformat()).cast("date")
    early = pv.close_versions(df.filter(F.col("effective_from") < split), "product_id", "effective_from")
    merged = pv.merge_versions(early, df.filter(F.col("effective_from") >= split), "product_id", "effective_from")
    full = pv.close_versions(df, "product_id", "effective_from")
    columns = ["product_id", "valid_from", "valid_to"]
    assert sorted(map(tuple, merged.select(*columns).collect()), key=str) == sorted(
        map(tuple, full.select(*columns).collect()), key=str
    )


def test_hard_delete_closes_open_version_and_return_keeps_the_gap(spark):
    df = spark.createDataFrame([("A", day(0)), ("B", day(0))], "product_id string, effective_from date")
    closed = pv.close_missing(
        pv.close_versions(df, "product_id", "effective_from"),
        spark.createDataFrame([("A",)], "product_id string"),
        "product_id",
        day(10),
    )
    assert {r["product_id"]: r["valid_to"] for r in closed.collect()} == {"A": None, "B": day(10)}
    back = spark.createDataFrame([("B", day(20))], "product_id string, effective_from date")
    merged = pv.merge_versions(closed, back, "product_id", "effective_from")
    spans = {(r["product_id"], r["valid_from"]): r["valid_to"] for r in merged.collect()}
    assert spans[("B", day(0))] == day(10) and spans[("B", day(20))] is None


def test_join_window_is_half_open_and_both_paths_agree(spark):
    changes = random_changes(3, days=800)
    versions = pv.close_versions(
        spark.createDataFrame(changes, "product_id string, effective_from date"), "product_id", "effective_from"
    ).select("product_id", "valid_from", "valid_to")
    rng = random.Random(4)
    sales = [(i, f"P{rng.randrange(7)}", day(rng.randrange(-20, 820))) for i in range(400)]
    sales += [(1000 + i, p, s) for i, (p, s) in enumerate(changes)]
    facts = spark.createDataFrame(sales, "sale int, product_id string, sale_date date")
    as_of = day(1000)
    plain = pv.join_at(facts, versions, "product_id", "sale_date", as_of)
    yearly = pv.join_at(facts, versions, "product_id", "sale_date", as_of, by_year=True)
    expected = {}
    for sale, product, at in sales:
        starts = [s for p, s in changes if p == product and s <= at]
        expected[sale] = max(starts) if starts else None
    for joined in (plain, yearly):
        rows = joined.collect()
        assert len(rows) == len(sales)
        assert {r["sale"]: r["valid_from"] for r in rows} == expected


def test_overlapping_versions_resolve_to_latest_start_then_latest_end(spark):
    rng = random.Random(5)
    spans = []
    for i in range(60):
        start = rng.randrange(300)
        end = None if rng.random() < 0.2 else start + rng.randrange(0, 120)
        spans.append((i, f"P{rng.randrange(3)}", day(start), None if end is None else day(end)))
    versions = spark.createDataFrame(spans, "version int, product_id string, valid_from date, valid_to date")
    sales = [(i, f"P{rng.randrange(4)}", day(rng.randrange(-5, 360))) for i in range(300)]
    facts = spark.createDataFrame(sales, "sale int, product_id string, sale_date date")
    as_of = day(330)
    resolved = pv.disjoint_versions(versions, "product_id", as_of)
    got = {r["sale"]: r["version"] for r in pv.join_at(facts, resolved, "product_id", "sale_date", as_of).collect()}
    chosen = {i: (f, t) for i, _, f, t in spans}
    for sale, product, at in sales:
        covering = [
            (f, t or date.min, i)
            for i, p, f, t in spans
            if p == product and f <= at < (t or as_of + timedelta(days=1))
        ]
        if not covering:
            assert got[sale] is None
        else:
            best = max(covering)[:2]
            found = chosen[got[sale]]
            assert (found[0], found[1] or date.min) == best


def test_splittable_join_is_a_left_join_with_null_keys_unmatched(spark):
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int").withColumn("j", F.lit("x"))
    lookup = spark.createDataFrame([("a", "x", 10), (None, "x", 99)], "k string, j string, w int")
    out = {r["v"]: r["w"] for r in splittable_left_join(facts, lookup, ["k", "j"]).collect()}
    assert out == {1: 10, 2: 10, 3: None, 4: None}


def winner_by_day(rows, n):
    """The version that wins on each day: latest start, then latest end with open ones last."""
    out = {}
    for d in range(n):
        covering = [r for r in rows if r[1] <= d and d < (n if r[2] is None else r[2])]
        if covering:
            out[d] = max(covering, key=lambda r: (r[1], r[2] is not None, r[2] or 0))[:3]
    return out


def test_sweep_gives_each_day_its_version_in_blocks_of_any_size(spark):
    draw, days = random.Random(11), 90
    rows = []
    for k in range(12):
        for i in range(draw.randint(1, 40)):
            start = draw.randrange(days - 1)
            rows.append((f"P{k}", start, draw.choice([None, start, draw.randint(start, days)]), i))
    made = [(k, day(s), None if e is None else day(e), i) for k, s, e, i in rows] + [(None, day(1), None, 0), ("P0", None, None, 1)]
    schema = "product_id string, valid_from date, valid_to date, place int"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("3", before):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = pv.disjoint_versions(spark.createDataFrame(made, schema), "product_id", day(days - 1)).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        by_row = {(k, i): (s, e) for k, s, e, i in rows}
        found = {}
        for r in got:
            s, e = by_row[r.product_id, r.place]
            for d in range((r.valid_from - day(0)).days, (r.valid_to - day(0)).days):
                assert (r.product_id, d) not in found
                found[r.product_id, d] = (s, e)
        expected = {}
        for k in {r[0] for r in rows}:
            mine = [(i, s, e) for kk, s, e, i in rows if kk == k and (e is None or e > s)]
            expected |= {(k, d): (v[1], v[2]) for d, v in winner_by_day(mine, days).items()}
        assert found == expected
        assert len(got) <= 2 * len(rows)


def test_many_open_versions_of_one_key_stay_linear(spark):
    start = date(2000, 1, 1)
    rows = [("HOT", start + timedelta(days=i % 5000), None, i) for i in range(10_000)]
    resolved = pv.disjoint_versions(spark.createDataFrame(rows, "product_id string, valid_from date, valid_to date, place int"), "product_id", AS_OF)
    got = resolved.collect()
    assert len(got) == 5000 and sum((r.valid_to - r.valid_from).days for r in got) == (AS_OF + timedelta(days=1) - start).days
    text = resolved._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Window" not in text
