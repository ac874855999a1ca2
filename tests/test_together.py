"""Several batches of a stream in one trigger are the batches that would be delivered one by one."""

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.model import struct_of
from streamlog.session import scratch_path
from streamlog.sinks.log import create_log, publish
from streamlog.sources.ranges import BATCH
from streamlog.streaming import consume, relay, state

PLACE = ["topic", "partition", "offset"]
BATCHES = 12


@pytest.fixture(scope="module")
def log(spark):
    """Partitions of 60 and 25 records."""
    at = F.timestamp_seconds(F.col("id")).cast("timestamp_ntz")
    records = spark.range(85).select(
        F.when(F.col("id") < 60, "a").otherwise("b").alias("topic"), F.lit(0).alias("partition"), at.alias("timestamp"),
        F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("event_id"),
    )
    return publish(records, scratch_path(spark, "events"), ["timestamp", "event_id"], segment_rows=20)


def one_by_one(log, spark, begin):
    seen = {}
    consume.start_with_offsets(
        log.stream(max_records=5), lambda batch, offsets, number: seen.update({number: (rows(batch.select(*PLACE)), rows(offsets))}),
        scratch_path(spark, "checkpoint"), assigned=begin, positions_path=scratch_path(spark, "positions"),
    ).awaitTermination()
    return seen


def test_batches_together_are_those_one_by_one(log, spark):
    begin = log.partitions().withColumn("offset", F.lit(0).cast("long"))
    begin = begin.union(spark.createDataFrame([("c", 0, 7)], begin.schema))
    seen, triggers, path, positions = {}, [], scratch_path(spark, "checkpoint"), scratch_path(spark, "positions")

    def handle(batches, offsets, numbers):
        triggers.append(numbers)
        if len(triggers) == 2:
            raise InterruptedError("stopped")
        for number in numbers:
            own = batches.filter(F.col(BATCH) == number).select(*PLACE)
            seen[number] = (rows(own), rows(offsets.filter(F.col(BATCH) == number).drop(BATCH)))

    def run():
        consume.start_with_offsets(log.stream(max_records=5).together(), handle, path, assigned=begin, positions_path=positions).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert seen == one_by_one(log, spark, begin) and len(seen) == BATCHES
    assert triggers[0] == range(1) and triggers[1] == triggers[2] and len([t for t in triggers if len(t)]) < BATCHES


def test_a_trigger_is_bounded_by_its_offsets(log, spark):
    triggers = []
    consume.start(log.stream(max_records=5).together(20), lambda batches, numbers: triggers.append(len(numbers)), scratch_path(spark, "c")).awaitTermination()
    # Two partitions at first, later one.
    assert sum(triggers) == BATCHES and max(triggers) <= 4 and max(triggers[:3]) <= 2


def test_the_column_of_batches_must_stay(log, spark):
    stream = log.stream(max_records=5).transform(lambda b: b.drop(BATCH)).together()
    with pytest.raises(StreamingQueryException, match="_batch"):
        consume.start(stream, lambda b, n: None, scratch_path(spark, "c")).awaitTermination()
    kept = []
    consume.start(log.stream(max_records=5).select("key").together(), lambda b, n: kept.append(b.columns), scratch_path(spark, "c")).awaitTermination()
    assert all(columns == ["key", BATCH] for columns in kept)


def test_a_relay_of_batches_together_gives_the_same_offsets(log, spark):
    found = []
    for stream in (log.stream(max_records=12), log.stream(max_records=12).together()):
        target = create_log(spark, scratch_path(spark, "target"), log.schema)
        # Within a batch the largest value first: the order tells the batches apart.
        relay.relay_with_offsets(
            stream, lambda b: b.drop("offset").withColumn("event_id", -F.col("event_id")), target, ["event_id"], "g", scratch_path(spark, "c"),
        ).awaitTermination()
        found.append((rows(target.records().select(*PLACE, "event_id")), rows(target.committed("g"))))
    assert found[0] == found[1] and len(found[0][0]) == 85


def test_state_of_batches_together_is_that_of_one_by_one(log, spark):
    """A sum of the largest of each batch depends on where batches end; runs that no state uses are removed."""
    schema = struct_of(topic=T.StringType(), top=T.LongType())
    update = {"top": (F.max("offset"), F.sum)}

    def store():
        return state.StateStore(spark, scratch_path(spark, "state"), schema, ["topic"], update, keep=2)

    single, several, applied = store(), store(), []
    consume.start(log.stream(max_records=5), lambda b, n: single.apply(b, n), scratch_path(spark, "c")).awaitTermination()
    apply = several.apply
    several.apply = lambda records, number: applied.append(number) or apply(records, number)
    state.run(log.stream(max_records=5), several, scratch_path(spark, "c")).awaitTermination()
    assert rows(several.read()) == rows(single.read())
    assert len(applied) < BATCHES and applied[-1] == BATCHES - 1
    assert not several.apply(log.records(), BATCHES - 1)
