import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from streamlog.operators import numbering
from streamlog.operators import offsets as off
from streamlog.operators.numbering import assign_offsets, range_split, with_next
from streamlog.operators.records import from_map, from_pairs, from_values

SF_DIR = "/root/testdata/sf0.001"


def plain_offset():
    window = Window.partitionBy("topic", "partition").orderBy("timestamp", "event_id")
    return (F.row_number().over(window) - 1).cast("long").alias("offset")


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(f"{SF_DIR}/events.parquet").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("ts").alias("timestamp"),
        "event_id", "user_id",
    )


def crowded(events):
    """Two thirds of one topic, a third of it at one instant, some rows without a time."""
    same = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return events.withColumns({
        "topic": F.when(F.col("event_id") % 3 > 0, "hot").otherwise(F.col("topic")),
        "partition": F.when(F.col("event_id") % 3 > 0, 0).otherwise(F.col("partition")),
        "timestamp": F.when(F.col("event_id") % 11 == 0, None)
        .when(F.col("event_id") % 3 == 1, same).otherwise(F.col("timestamp")),
    })


@pytest.mark.parametrize("bucket_rows", [1, 7, 40, 10_000])
def test_offsets_equal_row_numbers_whatever_the_bucket_size(events, bucket_rows):
    data = crowded(events)
    expected = data.select("topic", "partition", plain_offset(), "event_id")
    actual = assign_offsets(data, ["timestamp", "event_id"], bucket_rows=bucket_rows, splits=5)
    assert rows(actual.select(*expected.columns)) == rows(expected)
    assert dict(actual.dtypes)["offset"] == "bigint"


def test_more_tasks_than_the_session_has_by_default(events, monkeypatch):
    monkeypatch.setattr(numbering, "TASK_ROWS", 90)
    data = crowded(events)
    expected = data.select("event_id", plain_offset())
    for bucket_rows in (40, 10_000):
        assert rows(assign_offsets(data, ["timestamp", "event_id"], bucket_rows=bucket_rows).select("event_id", "offset")) == rows(expected)
    window = Window.partitionBy("topic").orderBy("timestamp", "event_id")
    following = with_next(data, ["topic"], ["timestamp", "event_id"], F.col("event_id"), "next").select("event_id", "next")
    assert rows(following) == rows(data.select("event_id", F.lead("event_id").over(window).alias("next")))


def test_no_records_at_all(events):
    for key in ("timestamp", "topic"):
        assert assign_offsets(events.filter("false"), [key]).isEmpty()
    assert with_next(events.filter("false"), ["topic"], ["event_id"], F.col("event_id"), "next").isEmpty()


def test_hot_bucket_is_cut_into_several_pieces(events):
    pieces = range_split(crowded(events), ["topic", "partition", "timestamp", "event_id"], splits=8)
    hot = pieces.filter("topic = 'hot'").groupBy("_split").count()
    assert hot.count() >= 4


def test_offsets_with_a_sort_key_that_is_no_number(events):
    data = events.withColumn("name", F.lpad(F.col("event_id").cast("string"), 9, "0"))
    expected = data.select("event_id", plain_offset())
    for bucket_rows in (3, 10_000):
        actual = assign_offsets(data, ["name"], bucket_rows=bucket_rows)
        assert rows(actual.select("event_id", "offset")) == rows(expected)


def test_numbering_goes_on_from_given_offsets(spark, events):
    start = off.of(spark, {("click", 0): 1000})
    plain = assign_offsets(events, ["timestamp", "event_id"])
    for bucket_rows in (3, 10_000):
        shifted = assign_offsets(events, ["timestamp", "event_id"], start, bucket_rows)
        moved = (F.col("topic") == "click") & (F.col("partition") == 0)
        expected = plain.withColumn("offset", F.col("offset") + F.when(moved, 1000).otherwise(0))
        assert rows(shifted.select("event_id", "offset")) == rows(expected.select("event_id", "offset"))


def test_a_record_without_address_is_refused(events):
    for name in ("topic", "partition"):
        broken = events.withColumn(name, F.when(F.col("event_id") != 5, F.col(name)))
        for key in ("timestamp", "user_id"):
            with pytest.raises(ValueError, match="topic and a partition"):
                assign_offsets(broken, [key, "event_id"])


def test_records_from_values_and_pairs(spark):
    values = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "i int, value string")
    log = assign_offsets(from_values(values, "sometopic", 0), ["i"])
    assert rows(log.select("topic", "partition", "offset", "key", "value")) == [
        ("sometopic", 0, 0, None, "a"), ("sometopic", 0, 1, None, "b"), ("sometopic", 0, 2, None, "c"),
    ]
    # The offsets of a batch name the next record, also for generated ones.
    assert rows(off.positions(log)) == [("sometopic", 0, 3)]
    pairs = spark.createDataFrame([(0, "foo", 1), (1, None, 2)], "i int, key string, value int")
    log = assign_offsets(from_pairs(pairs, "sometopic", 4), ["i"])
    assert rows(log.select("partition", "offset", "key", "value")) == [(4, 0, "foo", 1), (4, 1, None, 2)]


@pytest.mark.parametrize("splits", [1, 3, 16])
def test_next_row_of_the_group_across_pieces(events, splits):
    data = events.select("event_id", "timestamp", (F.col("user_id") % 2).alias("user"))
    window = Window.partitionBy("user").orderBy("timestamp", "event_id")
    expected = data.withColumn("next", F.lead("timestamp").over(window))
    actual = with_next(data, ["user"], ["timestamp", "event_id"], F.col("timestamp"), "next", splits)
    assert rows(actual) == rows(expected)


def test_records_from_a_map_of_partitions(spark):
    log = from_map(spark, {("t", 0): [("foo", 1), (None, 2)], ("t", 1): [], ("u", 3): [("bar", 3)]}, value_type="int")
    assert rows(log) == [("t", 0, 0, "foo", 1), ("t", 0, 1, None, 2), ("u", 3, 0, "bar", 3)]
    assert rows(off.positions(log)) == [("t", 0, 2), ("u", 3, 1)]
