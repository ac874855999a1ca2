import datetime
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from streamlog.model import (
    COMMITS_SCHEMA, LOG_SCHEMA, OFFSETS_SCHEMA, SchemaMismatch, TopicPartition, has_schema, match_schema, require_schema,
)
from streamlog.operators import offsets as off
from streamlog.operators import records as rec


@pytest.fixture(scope="module")
def offsets(spark):
    return off.of(spark, {("a", 0): 10, ("a", 1): 20, ("b", 0): 30})


def test_empty_lookup_and_text(spark, offsets):
    nothing = off.empty(spark)
    assert off.is_empty(nothing) and not off.is_empty(offsets)
    require_schema(nothing, OFFSETS_SCHEMA)
    assert off.get(offsets, *TopicPartition("a", 1)) == 20
    assert off.get(offsets, "a", 7) is None
    assert off.get(nothing, "a", 1) is None
    assert rows(off.as_text(offsets)) == [("a-0 = 10",), ("a-1 = 20",), ("b-0 = 30",)]


def test_keep_and_remove_split_the_table(spark, offsets):
    some = off.of(spark, {("a", 1): 0, ("c", 5): 0})
    assert rows(off.keep_only(offsets, some)) == [("a", 1, 20)]
    assert rows(off.remove(offsets, some)) == [("a", 0, 10), ("b", 0, 30)]
    assert rows(off.keep_only(offsets, off.empty(spark))) == []
    assert rows(off.remove(offsets, off.empty(spark))) == rows(offsets)
    assert rows(off.topic_partitions(offsets)) == [("a", 0), ("a", 1), ("b", 0)]


def test_commit_form_and_json(offsets):
    at = F.lit(datetime.datetime(2024, 1, 1))
    commits = off.to_commits(offsets, "g", at)
    require_schema(commits, COMMITS_SCHEMA)
    assert {r["group_id"] for r in commits.collect()} == {"g"}
    expected = {"a": {"0": 10, "1": 20}, "b": {"0": 30}}
    assert json.loads(off.starting_offsets_json(offsets)) == expected
    assert json.loads(off.starting_offsets_json({("a", 0): 10, ("a", 1): 20, ("b", 0): 30})) == expected


def test_start_offsets_follow_the_reset_policy(spark, offsets):
    stored = off.of(spark, {("a", 0): 4})
    assert rows(off.start_offsets(offsets, stored, "latest")) == [("a", 0, 4), ("a", 1, 20), ("b", 0, 30)]
    assert rows(off.start_offsets(offsets, stored, "earliest")) == [("a", 0, 4), ("a", 1, 0), ("b", 0, 0)]
    with pytest.raises(ValueError):
        off.start_offsets(offsets, stored, "none")


def test_two_values_before_subscribing(spark):
    """Latest sees none of two earlier records, earliest sees both."""
    log = spark.createDataFrame([("t", 0, 0, "value"), ("t", 0, 1, "value2")], "topic string, partition int, offset long, value string")
    for reset, expected in (("latest", 0), ("earliest", 2)):
        start = off.start_offsets(off.positions(log), off.empty(spark), reset)
        assert log.join(start, ["topic", "partition"]).filter("offset >= start_offset").count() == expected


def asked(spark, batches, partitions):
    return spark.createDataFrame([(b, "t", p) for b in batches for p in range(partitions)], "batch_no long, topic string, partition int")


def test_batch_positions_carry_over_partitions_without_rows(spark):
    log = spark.createDataFrame(
        [(0, "t", 0, 0), (0, "t", 0, 1), (2, "t", 1, 0), (3, "t", 0, 2), (25, "t", 1, 1), (26, "t", 0, 3)],
        "batch_no long, topic string, partition int, offset long",
    )
    expected = {
        0: (2, 0, 0), 2: (2, 1, 0), 3: (3, 1, 0), 25: (3, 2, 0), 26: (4, 2, 0),
    }
    for chunk in (1, 3, 10, 10_000):
        found = off.positions_at(off.position_changes(log), asked(spark, expected, 3), chunk=chunk)
        assert rows(found) == sorted((b, "t", p, o) for b, os in expected.items() for p, o in enumerate(os))


def test_batch_positions_do_not_go_back_on_a_redelivered_batch(spark):
    log = spark.createDataFrame(
        [(0, "t", 0, 0), (1, "t", 0, 9), (2, "t", 0, 3)], "batch_no long, topic string, partition int, offset long"
    )
    for chunk in (1, 2, 100):
        assert rows(off.positions_at(off.position_changes(log), asked(spark, range(3), 1), chunk=chunk).select("batch_no", "offset")) == [(0, 1), (1, 10), (2, 10)]


def test_exact_schema_match(spark):
    strings = spark.createDataFrame([("foo", 1)], "key string, value int")
    assert has_schema(strings, strings.schema)
    with pytest.raises(SchemaMismatch):
        require_schema(strings, LOG_SCHEMA)
    other = spark.createDataFrame([(9, "asdf")], "key int, value string")
    cases = [(strings.schema, lambda df: df.first()["key"])]
    assert match_schema(strings, *cases) == "foo"
    assert match_schema(other, *cases) is None


def test_output_records(spark):
    log = spark.createDataFrame([("k", "v"), (None, "w")], "key string, value string")
    assert rec.complete_output(rec.to_producer_records(log, "out")).columns == rec.OUTPUT_COLUMNS
    assert rows(rec.to_producer_records(log, "out")) == [("out", None, "w"), ("out", "k", "v")]
    assert rows(rec.values_to_producer_records(log, F.col("value"))) == [("v", None, "v"), ("w", None, "w")]
    assert rows(rec.values_with_key(log, "out", "same")) == [("out", "same", "v"), ("out", "same", "w")]
    assert rows(rec.with_destination(log, "out", 3, key="key")) == [
        ("out", 3, None, None, "w"), ("out", 3, None, "k", "v"),
    ]
    assert rows(rec.with_destination(log, "out")) == [("out", None, None, None, "v"), ("out", None, None, None, "w")]
    assert rows(rec.map_records(log, F.col("key").isNotNull(), rec.pairs)) == [("k", "v")]


def test_typed_keeps_only_what_reads_as_the_types(spark):
    log = spark.createDataFrame([("1", "5"), ("x", "6"), ("2", "y"), (None, "7")], "key string, value string")
    assert rows(rec.typed(log, "bigint", "int")) == [(1, 5)]
    assert rows(rec.typed(log, value_type="int").select("value")) == [(5,), (6,), (7,)]


def test_dedup_keeps_one_copy(spark):
    log = spark.createDataFrame([("t", 0, 1, "a")] * 5 + [("t", 0, 1, "b"), ("t", 0, 2, None)],
                                "topic string, partition int, offset long, value string")
    assert rows(rec.dedup(log, ["topic", "partition", "offset"])) == [("t", 0, 1, "b"), ("t", 0, 2, None)]


def test_read_committed_hides_aborted(spark):
    log = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "tx int, value string")
    aborted = spark.createDataFrame([(1,), (1,)], "tx int")
    assert rows(rec.read_committed(log, "tx", aborted).select("value")) == [("c",), ("d",)]
