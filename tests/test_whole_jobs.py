"""Queries over own rows: the whole job, in even shares."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakegauge.plans import dataset
from lakegauge.plans.queries import QUERIES
from lakegauge.plans.readings import readings

KINDS = ("click", "view", "purchase", "signup", "error")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Events as one file with one row group."""
    home = str(tmp_path_factory.mktemp("events"))
    start = datetime(2024, 1, 2, 3)
    rows = [(n, start + timedelta(minutes=37 * n), n % 5, KINDS[n % 5], n % 40 + 0.25, "{}") for n in range(410)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{home}/events.parquet")
    return home


def job_ids(df):
    return sorted(int(r["job_id"]) for r in df.select("job_id").collect())


def test_landing_fetch_takes_every_reading(spark, folder):
    """Those with a broken descriptor too, once it was sent again."""
    fetched = QUERIES["landing_fetch"](spark, folder)
    assert job_ids(fetched) == list(range(410))
    # number 9 lacks its digest at first, number 3 names an object and counts its tries from 0
    assert {int(r["job_id"]) for r in fetched.filter("content_sha256 IS NOT NULL").collect()} >= {3, 9}


def test_integrity_check_takes_every_reading(spark, folder):
    checked = QUERIES["integrity_check"](spark, folder)
    assert job_ids(checked) == list(range(410))
    # the hint of number 5 is mended, its digest is wrong still
    assert {r["job_id"][-3:]: r["reason"] for r in checked.collect()}["005"] == "sha256_mismatch"


def test_events_are_dealt_out(spark, folder):
    """One row group does not mean one task for whatever is made of the rows."""
    tasks = max(spark.sparkContext.defaultParallelism, 4)
    held = readings(spark, folder).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in held) == 410
    assert len(held) == tasks and max(r["count"] for r in held) <= 2 * 410 // tasks


def test_iris_of_plain_and_odd_names(spark):
    names = ["unit:W", "unit:W-HR", "qudt:a b", "<x>", 'q"\\^`{|}', "\n\x00é", "", None]
    told = spark.createDataFrame([(n,) for n in names], "n string").select(dataset.iri(F.col("n"))).collect()
    unit, kind = dataset.PREFIXES["unit"], dataset.PREFIXES["qudt"]
    assert [r[0] for r in told] == [f"<{unit}W>", f"<{unit}W-HR>", f"<{kind}a%20b>", "<%3Cx%3E>", "<q%22%5C%5E%60%7B%7C%7D>", "<%0A%00é>", "<>", None]
