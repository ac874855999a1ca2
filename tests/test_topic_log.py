import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from streamlog.model import struct_of
from streamlog.operators import offsets as off
from streamlog.operators.records import TooFewRecords
from streamlog.plans import fixtures as fx
from streamlog.session import scratch_path
from streamlog.sinks.log import LogTransaction, append, create_log, publish, send
from streamlog.sources.topic_log import PastTheEnd, TopicLog

SF_DIR = "/root/testdata/sf0.001"
PLACE = ["topic", "partition", "offset"]


@pytest.fixture(scope="module")
def log(spark):
    """The event log in many small segments."""
    path = scratch_path(spark, "small-segments")
    publish(fx.event_records(spark, SF_DIR), path, ["timestamp", "event_id"], segment_rows=10)
    return TopicLog.open(spark, path)


@pytest.fixture(scope="module")
def plain(log, spark):
    """The same records without any folders to prune."""
    return spark.createDataFrame(log.records().toPandas(), log.records().schema)


def full_plan(df):
    conf, name = df.sparkSession.conf, "spark.sql.maxMetadataStringLength"
    conf.set(name, 20_000)
    try:
        return df.filter(F.lit(True))._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.unset(name)


def test_open_restores_schema_and_segment_size(log):
    assert log.segment_rows == 10
    assert log.records().columns == ["topic", "partition", "offset", "timestamp", "key", "value", "event_id"]
    assert log.records().count() == 1000


def test_files_are_sorted_by_offset_within_their_segment(log):
    bad = log._stored().filter(F.floor(F.col("offset") / 10) != F.col("segment"))
    assert bad.isEmpty()


def test_seek_prunes_segments_and_pushes_the_offset(log, plain):
    found = log.seek({("click", 0): 45, ("click", 1): 30})
    expected = plain.filter("(topic='click' and partition=0 and offset>=45) or (topic='click' and partition=1 and offset>=30)")
    assert rows(found.select(*PLACE)) == rows(expected.select(*PLACE))
    plan = full_plan(found)
    assert "topic" in plan.split("PartitionFilters")[1] and "segment" in plan.split("PartitionFilters")[1]
    assert "GreaterThanOrEqual(offset,45)" in plan


def test_seek_gives_the_same_with_a_join(log, plain, spark, monkeypatch):
    start = off.of(spark, {("click", 0): 45, ("click", 1): 30, ("view", 2): 0})
    literal = rows(log.seek(start).select(*PLACE))
    resumed = {reset: rows(log.resume(start, reset).select(*PLACE)) for reset in ("earliest", "latest")}
    ends, click = rows(log.end_offsets()), rows(log.partitions_for("click"))
    monkeypatch.setattr(off, "LITERAL_LIMIT", 1)
    for limit in (200_000, 1):
        monkeypatch.setattr(off, "BROADCAST_LIMIT", limit)
        assert rows(log.seek(start).select(*PLACE)) == literal
        for reset, expected in resumed.items():
            assert rows(log.resume(start, reset).select(*PLACE)) == expected
        assert rows(log.end_offsets()) == ends
        assert rows(log.partitions_for("click")) == click


def test_many_ranges_prune_folders_while_running(log, spark, monkeypatch):
    monkeypatch.setattr(off, "LITERAL_LIMIT", 1)
    start = off.of(spark, {("click", 0): 45, ("view", 1): 30})
    found = log.seek(start)
    expected = "(topic='click' and partition=0 and offset>=45) or (topic='view' and partition=1 and offset>=30)"
    assert rows(found.select(*PLACE)) == rows(log.records().filter(expected).select(*PLACE))
    spark.conf.set("spark.sql.maxMetadataStringLength", 20_000)
    plan = log.seek(start)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "dynamicpruningexpression(concat_ws(/, topic" in plan
    bounded = log.bounded(5, start)
    assert bounded.count() == 10


def test_resume_reset_policies(log, spark):
    stored = off.of(spark, {("click", 0): 55})
    latest = log.resume(stored, "latest")
    assert rows(off.topic_partitions(latest)) == [("click", 0)]
    assert latest.agg(F.min("offset")).first()[0] == 55
    earliest = log.resume(stored, "earliest")
    assert earliest.count() == 1000 - 55
    with pytest.raises(ValueError):
        log.resume(stored, "none")


def test_subscribe_from_commits(log, spark):
    committed = off.of(spark, {("click", 0): 58, ("view", 0): 0})
    found = log.subscribe(["click"], committed, reset="latest")
    assert rows(off.topic_partitions(found)) == [("click", 0)]
    assert log.subscribe(["click"]).count() == log.records().filter("topic = 'click'").count()


def test_partitions_come_from_the_ledger(log, plain):
    assert rows(log.partitions()) == rows(off.topic_partitions(plain))
    assert log.assigned(["click"]) == [("click", p) for p in range(4)]
    plan = full_plan(log.partitions())
    assert "/data" not in plan


def test_end_offsets_read_the_ledger_only(log, plain, spark):
    ends = log.end_offsets()
    assert rows(ends) == rows(off.positions(plain))
    plan = full_plan(log.end_offsets())
    assert "/data" not in plan
    assert rows(log.partitions_for("click")) == rows(off.partitions_for(plain, "click"))


def test_bounded_batches(log, plain, spark):
    assert rows(log.bounded(15).select(*PLACE)) == rows(plain.filter("offset < 15").select(*PLACE))
    found = log.bounded(7, {("click", 0): 9, ("view", 1): 30})
    expected = plain.filter(
        "(topic='click' and partition=0 and offset between 9 and 15) or (topic='view' and partition=1 and offset between 30 and 36)"
    )
    assert rows(found.select(*PLACE)) == rows(expected.select(*PLACE))
    assert found.count() == 14


def test_start_by_time(log, plain, spark):
    at = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    expected = plain.filter(F.col("timestamp") >= at)
    assert rows(log.seek_times(at, "error").select(*PLACE)) == rows(expected.select(*PLACE))
    late = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")
    assert log.seek_times(late, "latest").isEmpty()
    with pytest.raises(PastTheEnd):
        log.seek_times(late, "error")
    assert rows(log.offsets_for_times(late).filter("offset is null")) == [(t, p, None) for t, p in log.assigned()]


def test_start_by_time_per_partition(log, plain, spark):
    times = spark.sql(
        "select 'click' topic, 1 partition, timestamp_ntz'2024-01-20 00:00:00' timestamp "
        "union all select 'view', 0, timestamp_ntz'2024-01-05 00:00:00'"
    )
    expected = plain.filter(
        "(topic='click' and partition=1 and timestamp >= '2024-01-20') or (topic='view' and partition=0 and timestamp >= '2024-01-05')"
    )
    assert rows(log.seek_times(times).select(*PLACE)) == rows(expected.select(*PLACE))


def test_two_records_around_a_time(spark):
    data = spark.sql("""select 't' topic, 0 partition, timestamp_ntz'2024-01-01 00:00:01' timestamp, 'first' value
                        union all select 't', 0, timestamp_ntz'2024-01-01 00:00:03', 'second'""")
    log = publish(data, scratch_path(spark, "two"), ["timestamp", "value"])
    after = log.seek_times(F.lit("2024-01-01 00:00:02").cast("timestamp_ntz"))
    assert rows(after.select("value", "offset")) == [("second", 1)]


def test_consume_needs_enough_records(log):
    assert log.consume("click", 5).columns == ["key", "value"]
    with pytest.raises(TooFewRecords, match="expected 5000 records but got 210"):
        log.consume("click", 5000)


def test_topic_names_are_texts(spark):
    data = spark.sql("select '007' topic, 0 partition, 1 i, 'x' value union all select 'a/b=c d', 3, 2, 'y'")
    log = publish(data, scratch_path(spark, "names"), ["i"])
    assert log.assigned() == [("007", 0), ("a/b=c d", 3)]
    assert rows(log.assign([("007", 0)]).select("topic", "value")) == [("007", "x")]


def test_send_appends_after_the_end_and_acknowledges(spark):
    schema = struct_of(
        topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(), timestamp=T.TimestampType(),
        key=T.StringType(), value=T.StringType(), i=T.IntegerType(),
    )
    log = create_log(spark, scratch_path(spark, "send"), schema, segment_rows=2)
    assert log.is_empty()
    out = "topic string, partition int, timestamp timestamp, key string, value string, i int"
    first = spark.createDataFrame(
        [("t", 0, None, None, "foo", 1), ("t", 0, None, "key", "value", 2), ("t", 0, None, None, "bar", 3)], out
    )
    assert rows(send(first, log, ["i"])) == [(0, "t", 0, n, "success", None) for n in range(3)]
    again = spark.createDataFrame([("t", 0, None, "k", "v", 1, None), ("t", 0, None, "k", None, 2, "bad value")], out + ", error string")
    acks = send(again, TopicLog.open(spark, log.path), ["i"], batch_id=1)
    assert rows(acks) == [(1, "t", 0, None, "failure", "bad value"), (1, "t", 0, 3, "success", None)]
    assert rows(log.records().select("offset", "key", "value")) == [
        (0, None, "foo"), (1, "key", "value"), (2, None, "bar"), (3, "k", "v"),
    ]
    assert rows(log.partitions_for("t")) == [("t", 0, 0, 4)]


def test_send_chooses_partitions_by_key(spark):
    records = spark.range(200).selectExpr(
        "'t' topic", "cast(null as int) partition", "cast(null as timestamp) timestamp",
        "cast(id % 20 as string) key", "cast(id as string) value", "id",
    )
    schema = T.StructType(records.schema.fields + [T.StructField("offset", T.LongType())])
    log = create_log(spark, scratch_path(spark, "keys"), schema)
    acks = send(records, log, ["id"], partitions=4)
    assert acks.count() == 200
    assert log.records().groupBy("key").agg(F.countDistinct("partition").alias("n")).filter("n > 1").isEmpty()
    assert log.partitions().count() > 1
    keyless = records.withColumn("key", F.lit(None).cast("string"))
    send(keyless, log, ["id"], partitions=4)
    assert log.records().filter("key is null").select("partition").distinct().count() == 4


@pytest.mark.parametrize("limit", [0, 256])
def test_ambiguous_offsets_are_refused_whatever_their_number(log, spark, monkeypatch, limit):
    monkeypatch.setattr(off, "LITERAL_LIMIT", limit)
    twice = off.of(spark, {("click", 0): 5}).unionByName(off.of(spark, {("click", 0): 7}))
    empty = spark.createDataFrame([("click", 0, None)], twice.schema)
    nameless = spark.createDataFrame([(None, 0, 3)], twice.schema)
    good = off.of(spark, {("click", 0): 5})
    for bad in (twice, empty, nameless):
        for read in (
            log.seek, log.resume, lambda b: log.subscribe(["click"], b) if bad is not nameless else log.seek(b),
            lambda b: log.bounded(5, b), lambda b: log.between(b, good), lambda b: log.between(good, b),
        ):
            with pytest.raises(ValueError, match="each partition once"):
                read(bad)


@pytest.mark.parametrize("limit", [0, 256])
def test_groups_of_a_commit_table_are_kept_apart(log, spark, monkeypatch, limit):
    monkeypatch.setattr(off, "LITERAL_LIMIT", limit)
    at = F.current_timestamp()
    table = off.to_commits(off.of(spark, {("click", 0): 50}), "a", at).unionByName(off.to_commits(off.of(spark, {("click", 0): 40}), "b", at))
    for group, begin in (("a", 50), ("b", 40)):
        for found in (log.subscribe(["click"], table, group_id=group), log.assign([("click", 0)], table, group_id=group), log.resume(table, "latest", group)):
            assert found.agg(F.min("offset")).first()[0] == begin
    with pytest.raises(ValueError, match="several groups"):
        log.subscribe(["click"], table)
    assert log.subscribe(["click"], table.filter("group_id = 'a'")).agg(F.min("offset")).first()[0] == 50


VALUES = struct_of(
    topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(), timestamp=T.TimestampType(),
    key=T.StringType(), value=T.StringType(),
)


def some(spark, *values):
    return spark.createDataFrame([("t", 0, None, None, v) for v in values], "topic string, partition int, timestamp timestamp, key string, value string")


def stored(log):
    return rows(log.records().select("offset", "value"))


def test_a_batch_sent_twice_is_there_once(spark):
    log = create_log(spark, scratch_path(spark, "once"), VALUES)
    first = rows(append(some(spark, "a", "b"), log, ["value"], batch_id="one"))
    assert first == [("t", 0, 0, 2)]
    assert rows(append(some(spark, "a", "b"), log, ["value"], batch_id="one")) == first
    assert rows(append(some(spark, "c"), log, ["value"], batch_id="two")) == [("t", 0, 2, 3)]
    assert stored(log) == [(0, "a"), (1, "b"), (2, "c")]


def test_transactions_on_a_log(spark):
    log = create_log(spark, scratch_path(spark, "transactions"), VALUES)
    for name, values, end in (("one", "ab", "commit"), ("two", "cd", "abort"), ("three", "e", "commit")):
        unit = LogTransaction(log, ["value"], name)
        for v in values:
            unit.send(some(spark, v))
        getattr(unit, end)()
        with pytest.raises(RuntimeError, match="has ended"):
            unit.send(some(spark, "x"))
    assert stored(log) == [(0, "a"), (1, "b"), (4, "e")]
    assert [v for _, v in stored(log.isolated("read_uncommitted"))] == list("abcde")
    assert rows(log.end_offsets()) == [("t", 0, 5)]
    assert rows(log.seek({("t", 0): 1}).select("value")) == [("b",), ("e",)]
    with pytest.raises(ValueError):
        log.isolated("serializable")
