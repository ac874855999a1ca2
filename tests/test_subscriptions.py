import datetime
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from streamlog.operators import offsets as off
from streamlog.plans import fixtures as fx
from streamlog.session import scratch_path
from streamlog.sinks.log import create_log, publish, send
from streamlog.sources.subscriptions import (
    AutoPartition, AutoPartitionBasic, AutoPartitionWithManualOffset, ManualOffset, ManualOffsetForTimes, ManualPartition,
)
from streamlog.streaming import commits, consume

SF_DIR = "/root/testdata/sf0.001"
PLACE = ["topic", "partition", "offset"]


@pytest.fixture(scope="module")
def log(spark):
    return publish(
        fx.event_records(spark, SF_DIR), scratch_path(spark, "log"), ["timestamp", "event_id"], segment_rows=10
    )


def place(df):
    return rows(df.select(*PLACE))


def collected(spark, stream):
    """All rows of a stream that ends."""
    path = scratch_path(spark, "collected")
    consume.start(
        stream, lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}"), f"{path}-checkpoint"
    ).awaitTermination()
    return spark.read.parquet(path).drop("batch")


def millis(text):
    return int(datetime.datetime.fromisoformat(text + "+00:00").timestamp() * 1000)


def test_every_mode_reads_its_records(spark, log):
    committed = off.of(spark, {("click", 0): 50, ("view", 1): 3})
    clicks = log.records().filter("topic = 'click'")
    for mode in (AutoPartition, AutoPartitionBasic):
        assert place(mode(("click",)).read(log)) == place(clicks)
        assert place(mode(("click",)).read(log, committed, "earliest")) == place(clicks.filter("partition != 0 or offset >= 50"))
        assert place(mode(("click",)).read(log, committed)) == place(clicks.filter("partition = 0 and offset >= 50"))
    asked = []

    def load(partitions):
        asked.extend(partitions)
        return {("click", 1): 20}

    manual = AutoPartitionWithManualOffset(("click",), load)
    assert place(manual.read(log, reset="earliest")) == place(clicks.filter("partition != 1 or offset >= 20"))
    assert asked == [("click", p) for p in range(4)]
    expected = clicks.filter("(partition = 1 and offset >= 20) or (partition = 0 and offset >= 50)")
    assert place(manual.read(log, committed)) == place(expected)
    assert place(ManualPartition((("click", 2), ("nowhere", 0))).read(log)) == place(clicks.filter("partition = 2"))
    assert place(ManualOffset({("click", 2): 40}).read(log)) == place(clicks.filter("partition = 2 and offset >= 40"))
    timed = ManualOffsetForTimes({("click", 2): millis("2024-01-20T00:00:00")})
    assert place(timed.read(log)) == place(clicks.filter("partition = 2 and timestamp >= '2024-01-20'"))


def test_failures_advance_partition_modes_only():
    confirmed = {("t", 0): 5}
    for sub in (AutoPartition(("t",)), AutoPartitionBasic(("t",)), AutoPartitionWithManualOffset(("t",), dict)):
        assert sub.advance(confirmed) is sub
    for sub in (ManualPartition((("t", 0),)), ManualOffset({("t", 0): 1}), ManualOffsetForTimes({("t", 0): 99})):
        assert sub.advance(confirmed) == ManualOffset(confirmed)
        assert sub.advance(None) is sub


def test_partitions_without_a_confirmation_are_not_lost(log):
    two = (("click", 0), ("click", 1))
    assert ManualOffset({("click", 0): 1, ("click", 1): 2}).advance({("click", 0): 50}) == ManualOffset({("click", 0): 50, ("click", 1): 2})
    clicks = log.records().filter("topic = 'click'")
    on = ManualPartition(two).advance({("click", 0): 50})
    assert place(on.read(log)) == place(clicks.filter("partition = 1 or (partition = 0 and offset >= 50)"))
    assert on.advance({("click", 1): 7}) == ManualOffset({("click", 0): 50, ("click", 1): 7})
    timed = ManualOffsetForTimes({p: millis("2024-01-20T00:00:00") for p in two}).advance({("click", 0): 50})
    assert place(timed.read(log)) == place(clicks.filter("(partition = 1 and timestamp >= '2024-01-20') or (partition = 0 and offset >= 50)"))
    for mixed in (on, timed):
        with pytest.raises(ValueError, match="advance with all"):
            mixed.kafka_options()


def test_kafka_options_of_each_mode():
    assert AutoPartition(("a", "b")).kafka_options("earliest") == {"subscribe": "a,b", "startingOffsets": "earliest"}
    stored = AutoPartitionWithManualOffset(("a",), lambda tps: {("a", 0): 3}).kafka_options([("a", 0), ("a", 1)])
    assert json.loads(stored["startingOffsets"]) == {"a": {"0": 3, "1": -1}}
    assert json.loads(ManualPartition((("a", 1),)).kafka_options()["assign"]) == {"a": [1]}
    assert json.loads(ManualOffset({("a", 1): 7}).kafka_options()["startingOffsets"]) == {"a": {"1": 7}}
    assert json.loads(ManualOffsetForTimes({("a", 1): 7}).kafka_options()["startingOffsetsByTimestamp"]) == {"a": {"1": 7}}


def test_streams_take_the_same_subscriptions(spark, log, monkeypatch):
    stream = log.as_stream(max_records=20)
    committed = off.of(spark, {("click", 0): 50})
    assert place(collected(spark, stream.subscribe(["click"], committed, "earliest"))) == place(
        log.subscribe(["click"], committed, "earliest")
    )
    assert place(collected(spark, stream.seek({("view", 1): 12}))) == place(log.seek({("view", 1): 12}))
    at = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    timed = place(log.seek_times(at))
    monkeypatch.setattr(off, "LITERAL_LIMIT", 2)
    assert place(collected(spark, stream.seek_times(at, start_path=scratch_path(spark, "start")))) == timed
    with pytest.raises(ValueError, match="fixed start"):
        stream.seek_times(at)
    with pytest.raises(ValueError, match="fixed start"):
        stream.subscribe(["click"], committed, "latest")


def test_only_the_folders_of_the_topics_are_listed(log):
    clicks = log.subscribe(["click"])
    assert "topic=view" not in "".join(clicks.inputFiles())
    assert clicks.columns == log.records().columns
    assert place(log.subscribe(["click", "nowhere"])) == place(clicks)


def record(spark, value):
    return spark.createDataFrame(
        [("t", 0, None, None, value, 0)], "topic string, partition int, timestamp timestamp, key string, value string, i int"
    )


def test_recovery_to_the_commit_point(spark):
    """One record is committed, the next only confirmed: a new subscription gets the second again."""
    schema = record(spark, "").schema.add("offset", "long")
    log = create_log(spark, scratch_path(spark, "recovery"), schema)
    store = commits.commits_store(spark, scratch_path(spark, "commits"))
    checkpoint, seen = scratch_path(spark, "checkpoint"), []

    def handle(batch, offsets, batch_id):
        seen.append((off.get(offsets, "t", 0), [r["value"] for r in batch.collect()]))
        return batch_id == 0

    send(record(spark, "first"), log, ["i"])
    commits.start(log.stream(), handle, store, "test", checkpoint).awaitTermination()
    send(record(spark, "second"), log, ["i"])
    commits.start(log.stream(), handle, store, "test", checkpoint).awaitTermination()
    assert seen == [(1, ["first"]), (2, ["second"])]
    assert rows(commits.committed(store, "test")) == [("t", 0, 1)]
    assert commits.committed(store, "other").count() == 0

    again = log.as_stream().subscribe(["t"], commits.committed(store, "test"), "earliest")
    commits.start(again, handle, store, "test", scratch_path(spark, "checkpoint")).awaitTermination()
    assert seen[2] == (2, ["second"])
    assert rows(commits.committed(store, "test")) == [("t", 0, 2)]
    assert rows(off.positions(ManualOffset({("t", 0): 1}).read(log))) == [("t", 0, 2)]


def test_stop_and_start_go_on_from_the_position(spark):
    schema = record(spark, "").schema.add("offset", "long")
    log = create_log(spark, scratch_path(spark, "stop"), schema)
    checkpoint, seen = scratch_path(spark, "checkpoint"), []

    def handle(batch, batch_id):
        seen.extend(r["value"] for r in batch.collect())

    for value in ("first", "second"):
        send(record(spark, value), log, ["i"])
        query = consume.start(log.stream(), handle, checkpoint, interval="200 milliseconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    assert seen == ["first", "second"]
