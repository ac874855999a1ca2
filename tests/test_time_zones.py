"""Timestamps without zone must not depend on the session's time zone."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from streamlog.functions.numbers import epoch_micros, from_epoch_micros, whole_div
from streamlog.operators.numbering import assign_offsets
from streamlog.plans import fixtures as fx
from streamlog.session import scratch_path
from streamlog.sinks.log import publish
from streamlog.sources.subscriptions import ManualOffsetForTimes


@pytest.fixture
def berlin(spark):
    """A session zone that skips an hour on 2024-03-31."""
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_micros_of_both_kinds(spark, berlin):
    texts = ["2024-03-31 02:30:00.000001", "2024-03-31 03:00:00", "1969-12-31 23:59:59.5", "0001-01-01 00:00:00"]
    data = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    epoch = datetime.datetime(1970, 1, 1)
    expected = {
        t: (datetime.datetime.fromisoformat(t) - epoch) // datetime.timedelta(microseconds=1) for t in texts
    }
    found = [r[0] for r in data.select(epoch_micros("t", T.TimestampNTZType())).collect()]
    assert found == list(expected.values())
    back = data.withColumn("back", from_epoch_micros(epoch_micros("t", T.TimestampNTZType()), T.TimestampNTZType()))
    assert back.filter("t <> back or back is null").isEmpty()
    instant = spark.sql("select timestamp_micros(1234567890123456) t")
    assert instant.select(epoch_micros("t", T.TimestampType())).first()[0] == 1234567890123456


def test_whole_division_is_exact_for_large_numbers(spark):
    big = 9_007_199_254_740_993
    data = spark.createDataFrame([(big,)], "n long")
    assert data.select(whole_div("n", 1)).first()[0] == big


def test_offsets_around_the_skipped_hour(spark, berlin):
    data = spark.range(360).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "id",
        F.expr("timestamp_ntz'2024-03-31 00:00:00' + make_dt_interval(0, 0, cast(id as int))").alias("timestamp"),
    )
    for bucket_rows in (1, 10, 1000):
        found = assign_offsets(data, ["timestamp", "id"], bucket_rows=bucket_rows)
        assert found.filter("offset <> id").isEmpty()


def test_start_times_are_utc(spark, berlin):
    log = publish(fx.event_records(spark, "/root/testdata/sf0.001"), scratch_path(spark, "log"), ["timestamp", "event_id"])
    at = datetime.datetime(2024, 1, 20, 12, tzinfo=datetime.timezone.utc)
    found = ManualOffsetForTimes({("click", 0): int(at.timestamp() * 1000)}).read(log)
    expected = log.records().filter("topic = 'click' and partition = 0 and timestamp >= '2024-01-20 12:00:00'")
    assert rows(found.select("offset")) == rows(expected.select("offset"))
