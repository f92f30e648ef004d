import glob
import os
from datetime import datetime, timedelta

import pytest

from signalwatch.operators.upsert import BUCKET, latest, upsert
from signalwatch.storage import fresh_path, save
from signalwatch.streaming import events
from signalwatch.streaming.events import Layer

START = datetime(2024, 5, 1)


def rows_at(spark, *rows):
    """``(event_id, minutes)`` pairs."""
    return spark.createDataFrame(
        [(i, None if m is None else START + timedelta(minutes=m), 1, "view", 1.0, "") for i, m in rows],
        events.EVENTS)


def ids(df):
    return sorted((r["event_id"] for r in df.collect()), key=str)


def test_late_and_repeated_rows_over_runs_of_one_checkpoint(spark):
    layer = Layer(fresh_path(spark, "events"))
    events.ingest(spark, layer)  # nothing has landed
    assert ids(events.read_bronze(spark, layer)) == ids(events.read_late(spark, layer)) == []
    events.land(rows_at(spark, (1, 0), (2, 30), (2, 30), (3, 300), (4, None)), layer)
    events.ingest(spark, layer)
    # in the first batch nothing is late, however old; a row without a time always is
    assert ids(events.read_bronze(spark, layer)) == [1, 2, 3]
    assert ids(events.read_late(spark, layer)) == [4]
    events.land(rows_at(spark, (3, 300), (5, 179), (6, 181), (7, 400), (3, 310)), layer)
    events.ingest(spark, layer)
    events.ingest(spark, layer)  # nothing new
    assert ids(events.read_bronze(spark, layer)) == [1, 2, 3, 6, 7]
    assert ids(events.read_late(spark, layer)) == [4, 5]
    assert {r["batch"] for r in events.read_late(spark, layer).collect()} == {1, 2}  # 0 was empty
    # windows that end by 400 - 120 minutes are closed
    closed = events.read_windows(spark, layer).orderBy("window_start").collect()
    assert [(r["window_start"], r["n_events"]) for r in closed] == [
        (START, 2), (START + timedelta(hours=3), 1)]


def test_a_batch_that_is_run_again_changes_nothing(spark):
    layer = Layer(fresh_path(spark, "events"))
    first, second = rows_at(spark, (1, 0), (2, 500)), rows_at(spark, (3, 100), (4, 450))
    events.create(spark, layer)
    for _ in range(2):
        events._timely(first, 0, layer, events.DELAY)
    for _ in range(2):
        events._timely(second, 1, layer, events.DELAY)
    assert ids(events.read_late(spark, layer)) == [3]
    events.to_bronze(spark, layer)
    assert ids(events.read_bronze(spark, layer)) == [1, 2, 4]


TABLE = "k string, at int, v string"


def test_latest_of_each_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c"), ("b", None, "y"), ("b", 0, None), (None, 1, "n"),
         (None, 0, "m"), ("c", None, None)], TABLE)
    found = latest(rows, ["k"], ["at"]).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("a", 2, "c"), ("b", 0, None), (None, 1, "n"), ("c", None, None)], key=str)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/{BUCKET}=*/*.parquet")}


def test_only_touched_buckets_are_rewritten(spark):
    path = fresh_path(spark, "upsert")
    first = spark.createDataFrame([(f"k{i}", 1, "old") for i in range(200)], TABLE)
    upsert(spark, path, first, ["k"], ["at"], buckets=16)
    before = files(path)
    assert len(before) == 16
    batch = spark.createDataFrame([("k3", 2, "new"), ("k3", 0, "older"), ("k4", 0, "older")], TABLE)
    found = upsert(spark, path, batch, ["k"], ["at"], buckets=16)
    expected = {f"k{i}": "old" for i in range(200)} | {"k3": "new"}
    assert {r["k"]: r["v"] for r in found.collect()} == expected
    after = files(path)
    kept = set(before) & set(after)
    assert len(kept) in (14, 15) and all(before[f] == after[f] for f in kept)
    again = upsert(spark, path, batch, ["k"], ["at"], buckets=16)
    assert {r["k"]: r["v"] for r in again.collect()} == expected and again.count() == 200


@pytest.mark.parametrize("complete", [True, False])
def test_a_merge_that_was_broken_off(spark, complete):
    path = fresh_path(spark, "upsert")
    rows = spark.createDataFrame([(f"k{i}", 1, "old") for i in range(50)], TABLE)
    upsert(spark, path, rows, ["k"], ["at"], buckets=4)
    bucket = spark.read.parquet(path).where(f"{BUCKET} = 2")
    inside = {r["k"] for r in bucket.collect()}
    save(bucket.withColumn("v", bucket["k"]), f"{path}.other")
    spark.read.parquet(f"{path}.other").write.partitionBy(BUCKET).parquet(f"{path}.merged")
    if not complete:
        os.remove(f"{path}.merged/_SUCCESS")
    found = upsert(spark, path, rows.where("k = 'none'"), ["k"], ["at"], buckets=4)
    assert found.count() == 50
    assert {r["k"] for r in found.collect() if r["v"] == r["k"]} == (inside if complete else set())


def test_nothing_to_merge(spark):
    path = fresh_path(spark, "upsert")
    none = spark.createDataFrame([], TABLE)
    assert upsert(spark, path, none, ["k"], ["at"]).count() == 0
    assert upsert(spark, path, spark.createDataFrame([("a", 1, "x")], TABLE), ["k"], ["at"]).count() == 1
    assert upsert(spark, path, none, ["k"], ["at"]).count() == 1
