"""Tables that several runs share: publication behind checks, metrics kept between runs."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from larderline import registry
from larderline.operators import quality as q
from larderline.operators.anomaly import Metric, bucket_metrics, fill_gaps, score
from larderline.operators.metric_history import MetricHistory
from larderline.plans import checks
from larderline.sources.publish import Publication

START = date(2024, 1, 1)


def gate(name, rows):
    return q.run_model_tests("mart", name, rows, [q.unique(name, "k"), q.no_nulls(name, "v")], {})


def writer(publication, run, tables, log):
    for name, df in tables.items():
        path = f"{publication.run_folder(run)}/{name}"
        df.write.parquet(path)
        log.append((run, name))
        yield name, df.sparkSession.read.parquet(path)


def test_readers_see_the_last_run_that_passed(spark, tmp_path):
    publication, log = Publication(spark, str(tmp_path)), []
    make = lambda n, v=1: spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    with pytest.raises(LookupError):
        publication.table("a")
    assert publication.publish("one", writer(publication, "one", {"a": make(3), "b": make(5)}, log), gate) == []
    bad = make(2).unionByName(make(2))
    failed = publication.publish("two", writer(publication, "two", {"a": bad, "b": make(9)}, log), gate)
    assert [(r.model, r.column_name, r.test, r.failures) for r in failed] == [("a", "k", "unique", 2)]
    assert publication.current() == "one" and publication.table("a").count() == 3 and publication.table("b").count() == 5
    assert ("two", "b") not in log  # the first failure ends the run
    files = {f for f, _, _ in os.walk(tmp_path / "runs" / "one")}
    assert publication.publish("three", writer(publication, "three", {"a": make(4)}, log), gate) == []
    assert publication.current() == "three" and publication.table("a").count() == 4
    assert files == {f for f, _, _ in os.walk(tmp_path / "runs" / "one")}


def test_a_run_that_dies_publishes_nothing(spark, tmp_path):
    publication = Publication(spark, str(tmp_path))

    def dying():
        yield from writer(publication, "one", {"a": spark.range(3).select(F.col("id").alias("k"), F.lit(1).alias("v"))}, [])
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        publication.publish("one", dying(), gate)
    assert publication.current() is None


def events(spark, days):
    draw = random.Random(4)
    rows = [(START + timedelta(days=d), i) for d in range(days) for i in range(20 + draw.randint(0, 5) + (60 if d == 25 else 0))]
    return spark.createDataFrame(rows, "at date, v int")


def measured(df):
    return bucket_metrics("events", df, "at", "day", [Metric("*", "row_count"), Metric("v", "average")])


def test_runs_with_late_rows_add_up_to_one_measurement(spark, tmp_path):
    df = events(spark, 40)
    day = lambda d: F.lit((START + timedelta(days=d)).isoformat()).cast("date")
    history = MetricHistory(spark, str(tmp_path / "metrics"))
    history.record(1, START, measured(df.filter((F.col("at") < day(20)) & ((F.col("at") < day(17)) | (F.col("v") % 3 != 0)))))
    history.record(2, START + timedelta(days=17), measured(df.filter((F.col("at") >= day(17)) & (F.col("at") < day(30)))))
    history.record(3, START + timedelta(days=30), measured(df.filter(F.col("at") >= day(30))))
    expected = score(fill_gaps(measured(df)))
    assert history.scored().exceptAll(expected).count() == 0 and expected.exceptAll(history.scored()).count() == 0
    assert {r.bucket for r in history.scored().filter("is_anomalous AND metric = 'row_count'").collect()} == {START + timedelta(days=25)}
    assert history.runs() == [(1, START), (2, START + timedelta(days=17)), (3, START + timedelta(days=30))]


def test_a_repeated_run_and_withdrawn_rows(spark, tmp_path):
    df = events(spark, 12)
    history = MetricHistory(spark, str(tmp_path / "metrics"))
    for _ in range(2):
        history.record(1, START, measured(df))
    assert history.metrics().count() == 24
    # A later run that finds nothing takes the days from its first on away.
    history.record(2, START + timedelta(days=10), measured(df.limit(0)))
    assert {r.bucket for r in history.metrics().collect()} == {START + timedelta(days=d) for d in range(10)}


def test_runs_measured_in_one_pass_equal_runs_of_their_own(spark):
    day = lambda d: START + timedelta(days=d)
    rows = [(day(d), v) for d in range(9) for v in (1, 0, None, d)] + [(None, 1), (day(3), 7)]
    df = spark.createDataFrame(rows, "at date, v int")
    metrics = [Metric("*", "row_count"), *[Metric("v", kind) for kind in ("null_count", "zero_count", "sum", "max", "average")]]
    early, odd = F.col("at") < F.lit(day(4).isoformat()).cast("date"), F.col("v") % 2 == 1
    for bucket in ("day", "week"):
        together = bucket_metrics("events", df, "at", bucket, metrics, {1: early, 2: odd})
        for run, chosen in ((1, early), (2, odd)):
            alone = bucket_metrics("events", df.filter(chosen), "at", bucket, metrics)
            got = together.filter(F.col("run") == run).drop("run")
            assert got.columns == alone.columns and sorted(got.collect(), key=str) == sorted(alone.collect(), key=str)


def test_history_of_two_runs_reads_the_feeds_once(spark):
    shop, measured = registry.shop(spark, SMALL), []
    volumes, checks.volumes = checks.volumes, lambda *args: measured.append(args) or volumes(*args)
    try:
        scored = registry.QUERIES["anomaly_history"](spark, SMALL).collect()
    finally:
        checks.volumes = volumes
    assert len(measured) == 1 and measured[0][0] is shop and scored
