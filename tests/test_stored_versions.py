"""The stored version table: only the parts of changed or vanished keys are rewritten."""

import os
from datetime import date, datetime, timedelta

import pytest

from larderline.operators import price_versions as pv
from larderline.operators.stored_versions import VersionStore

SCHEMA = "product_id string, unit_price int, effective_from timestamp_ntz"
AS_OF = date(2023, 12, 31)


def changes(spark, rows):
    at = lambda d: datetime(2023, 1, 1) + timedelta(days=d)
    return spark.createDataFrame([(k, p, None if d is None else at(d)) for k, p, d in rows], SCHEMA)


def files(path):
    return {name: sorted(os.listdir(f"{path}/{name}")) for name in os.listdir(path) if name.startswith("__part=")}


def content(df):
    return sorted(map(tuple, df.select("product_id", "unit_price", "valid_from", "valid_to").collect()))


@pytest.fixture
def store(spark, tmp_path):
    made = VersionStore(spark, str(tmp_path / "versions"), "product_id", "effective_from", parts=32)
    made.create(changes(spark, [(f"P{i}", i, 0) for i in range(60)]))
    return made


def test_only_parts_of_changed_keys_are_rewritten(spark, store):
    before = files(store.path)
    batch = changes(spark, [("P1", 100, 10), ("P2", 101, 11), ("NEW", 5, 3), ("P3", 3, 0), (None, 1, 1), ("P4", 1, None)])
    touched = store.apply(batch)
    after = files(store.path)
    assert 1 <= len(touched) <= 3
    same = {name for name in before if after[name] == before[name]}
    assert same == before.keys() - {f"__part={p}" for p in touched}
    expected = [(f"P{i}", i, 0) for i in range(60)] + [("P1", 100, 10), ("P2", 101, 11), ("NEW", 5, 3)]
    assert content(store.versions()) == content(pv.close_versions(changes(spark, expected), "product_id", "effective_from"))


def test_a_batch_applied_again_writes_nothing(spark, store):
    batch = changes(spark, [("P1", 100, 10), ("P1", 90, 5)])
    sold = changes(spark, [(f"P{i}", 0, 0) for i in range(50)]).select("product_id")
    assert store.apply(batch, sold, AS_OF)
    before, rows = files(store.path), content(store.versions())
    assert store.apply(batch, sold, AS_OF) == [] and store.apply(batch) == [] and store.apply() == []
    assert files(store.path) == before and content(store.versions()) == rows


def test_late_changes_and_vanished_keys(spark, store):
    store.apply(changes(spark, [("P1", 100, 20)]))
    store.apply(changes(spark, [("P1", 50, 10), ("GONE", 1, 1)]), changes(spark, [(f"P{i}", 0, 0) for i in range(59)]).select("product_id"), AS_OF)
    day = lambda d: datetime(2023, 1, 1) + timedelta(days=d)
    got = content(store.versions())
    assert [r for r in got if r[0] == "P1"] == [("P1", 1, day(0), day(10)), ("P1", 50, day(10), day(20)), ("P1", 100, day(20), None)]
    closed = datetime(2023, 12, 31)
    assert [r[3] for r in got if r[0] in ("P59", "GONE")] == [closed, closed]
    assert all(r[3] is None for r in got if r[0] not in ("P1", "P59", "GONE"))
    with pytest.raises(ValueError, match="as_of"):
        store.apply(source_keys=changes(spark, []).select("product_id"))
