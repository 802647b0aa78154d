"""Whitening against a dense eigensolver on the same integers, and the slicing on awkward spectra."""

import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from larderline.llm.op11_whitening import above, leading, op11_whitening, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def expected(vectors, k=16):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    off = fit - sums / n
    v = off.T @ off / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(1), (x - sums / n) @ u / np.sqrt(e), e / np.trace(v)


def test_equals_a_dense_eigensolver(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    n, far, white, explained = expected([r.embedding for r in rows])
    got = op11_whitening(spark, SMALL).toPandas()
    assert got.columns.tolist() == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(got) == 16 * len(rows) and set(got.n) == {n} and got.identity_error.max() < 1e-12
    wide = got.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    signs = np.sign((wide * white).sum(0))
    assert np.abs(wide * signs - white).max() < 1e-9
    first = got[got.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == far.tolist()
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-10)


def test_left_out_rows_repeats_and_extra_columns(spark):
    draw = random.Random(4)
    vectors = [[draw.gauss(0, 1) for _ in range(3)] for _ in range(50)]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(7, vectors[7], None), (None, vectors[8], 1), (90, vectors[9], 1)]
    bad = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [float("nan"), 0.0, 0.0], 1), (103, [float("inf"), 0.0, 0.0], 1), (104, [], 1)]
    made = table(spark, rows + bad)
    for name in ("x", "n", "deviation", "whitened", "value", "vector"):
        made = made.withColumn(name, F.lit("mine"))
    got = whiten(made).collect()
    assert len(got) == len(rows) and {r.n for r in got} == {50} and all(len(r.whitened) == 3 for r in got)
    by_id = {r.vec_id: r for r in got if r.vec_id not in (7, None)}
    assert by_id[90].whitened == by_id[9].whitened and by_id[90].deviation == by_id[9].deviation
    assert sum(r.vec_id is None for r in got) == 1 and sum(r.vec_id == 7 for r in got) == 2


def test_components_without_variance_have_no_value(spark):
    line = whiten(table(spark, [(i, [float(i), 2.0 * i, 5.0], 0) for i in range(8)])).collect()
    assert all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in line)
    assert all(abs(r.explained[0] - 1) < 1e-12 and r.explained[1:] == [0.0, 0.0] and r.identity_error < 1e-12 for r in line)
    same = whiten(table(spark, [(i, [1.0, 2.0], 0) for i in range(3)])).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.identity_error) for r in same] == [(1, 0, [None, None], None)] * 3


def test_empty_table_ragged_vectors_and_large_deviations(spark):
    assert whiten(table(spark, [])).count() == 0
    with pytest.raises(ValueError, match="same length"):
        whiten(table(spark, [(1, [1.0, 2.0], 0), (2, [1.0], 0)]))
    wide = [(i, [float(i * 2**24), float(-i % 3 * 2**27)], 0) for i in range(64)]
    n, far, white, _ = expected([v for _, v, _ in wide])
    got = sorted(whiten(table(spark, wide)).collect(), key=lambda r: r.vec_id)
    x = [[int(64 * c) + 1_000_000 for c in v] for _, v, _ in wide]
    sums = [sum(c) for c in zip(*x)]
    assert [int(r.deviation) for r in got] == [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert max(int(r.deviation) for r in got) > 2**63 and got[0].identity_error < 1e-9


@pytest.mark.parametrize(
    "spectrum",
    [
        np.arange(24.0, 0, -1),
        np.array([5.0] * 5 + [3.0] * 9 + [1e-3] * 10),
        10.0 ** -np.arange(24),
        np.ones(24),
        np.array([1.0 - 1e-9 * i for i in range(8)] + [0.5] * 16),
        np.zeros(24),
    ],
)
def test_slices_are_numbered_by_counts(spectrum):
    random_ = np.random.default_rng(1)
    q, _ = np.linalg.qr(random_.standard_normal((24, 24)))
    v = q @ np.diag(spectrum) @ q.T
    v = (v + v.T) / 2
    values, vectors = leading(v, 16)
    most = max(spectrum.max(), 1.0)
    assert np.abs(values - spectrum[:16]).max() < 1e-13 * most
    assert np.abs(vectors @ vectors.T - np.eye(16)).max() < 1e-12
    assert np.abs(vectors @ v - values[:, None] * vectors).max() < 1e-13 * most
    for shift in (-1.0, 0.25, 2.5, 4.0 + 1e-6, 30.0):
        assert above(v, shift) == int((spectrum > shift).sum())
