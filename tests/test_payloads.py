"""Nested payloads by their exact type, reads with a time limit, repeats in streams, outcomes of batches."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from streamlog.model import struct_of
from streamlog.operators import delivery
from streamlog.operators import records as rec
from streamlog.operators.records import TooFewRecords
from streamlog.session import scratch_path
from streamlog.sinks.log import append, create_log
from streamlog.streaming import consume, dedup

WANTED = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("at", T.StructType([T.StructField("x", T.DoubleType(), False), T.StructField("y", T.DoubleType(), True)]), False),
    T.StructField("tags", T.ArrayType(T.StructType([T.StructField("name", T.StringType(), False)]), False), True),
    T.StructField("on", T.BooleanType(), False),
])
GOOD = '{"id":1,"at":{"x":1.5,"y":2},"tags":[{"name":"a"},{"name":""}],"on":true}'


@pytest.mark.parametrize("payload, fits", [
    (GOOD, True),
    ('{"on":false,"tags":[],"at":{"y":null,"x":0},"id":-7}', True),
    ('{"id":1,"at":{"x":1e3,"y":2.25},"tags":null,"on":true}', True),
    (GOOD.replace('"id":1', '"id":"1"'), False), (GOOD.replace('"id":1', '"id":1.5'), False), (GOOD.replace('"id":1', '"id":null'), False),
    (GOOD.replace('"x":1.5', '"x":null'), False), (GOOD.replace('"x":1.5,', ""), False), (GOOD.replace('"x":1.5', '"x":1.5,"z":0'), False),
    (GOOD.replace('"name":""', '"name":3'), False), (GOOD.replace('{"name":""}', "null"), False), (GOOD.replace('[{"name":"a"},{"name":""}]', '{"name":"a"}'), False),
    (GOOD.replace("true", '"true"'), False), (GOOD[:-1], False), (GOOD[:-1] + ',"more":[]}', False),
    (GOOD.replace('"at":{"x":1.5,"y":2}', '"at":[1.5,2]'), False), ("[]", False), ("null", False), ("7", False), ("", False), (None, False),
])
def test_a_payload_has_exactly_the_type(spark, payload, fits):
    frame = spark.createDataFrame([(payload, 5)], "value string, other int")
    found = rec.typed_payloads(frame, WANTED).collect()
    assert len(found) == fits
    if payload == GOOD:
        assert found[0].value.asDict(True) == {"id": 1, "at": {"x": 1.5, "y": 2.0}, "tags": [{"name": "a"}, {"name": ""}], "on": True}
        assert found[0].other == 5


def test_a_type_that_no_json_has(spark):
    with pytest.raises(TypeError):
        rec.typed_payloads(spark.createDataFrame([("1",)], "value string"), struct_of(a=T.DateType()))


VALUES = struct_of(topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(), timestamp=T.TimestampType(), key=T.StringType(), value=T.StringType())


def filled(spark, n):
    log = create_log(spark, scratch_path(spark, "until"), VALUES)
    append(spark.range(n).selectExpr("'t' topic", "0 partition", "timestamp'2024-01-01' timestamp", "'k' key", "cast(id as string) value"), log, ["value"])
    return log


def test_a_read_ends_with_the_batch_that_reaches_the_number(spark):
    log = filled(spark, 30)
    found = consume.read_until(log.stream(max_records=8), 10, 60, scratch_path(spark, "read"))
    assert rows(found.select("offset")) == [(n,) for n in range(16)]


def test_a_read_that_is_not_filled_in_time_is_an_error(spark):
    log, start = filled(spark, 5), time.monotonic()
    with pytest.raises(TooFewRecords, match="expected 6 records but got 5"):
        consume.read_until(log.stream(), 6, 8, scratch_path(spark, "read"))
    assert 8 <= time.monotonic() - start < 30


def test_repeats_across_batches_are_dropped(spark):
    path = scratch_path(spark, "sent")
    schema = "writer long, sequence long, sent_at timestamp, value string"
    for n, sent in enumerate([[(1, 1), (1, 2), (2, 1)], [(1, 2), (1, 3)], [(2, 1), (1, 1), (2, 2)]]):
        frame = spark.createDataFrame([(w, s, None, f"v{w}{s}") for w, s in sent], schema).withColumn("sent_at", F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, sequence)"))
        frame.coalesce(1).write.mode("append").parquet(f"{path}/in/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    once = dedup.sent_once(stream, ["writer", "sequence"], "sent_at", "1 hour")
    once.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    assert rows(spark.read.parquet(f"{path}/out").select("writer", "sequence", "value")) == [(1, 1, "v11"), (1, 2, "v12"), (1, 3, "v13"), (2, 1, "v21"), (2, 2, "v22")]


def test_outcomes_of_batches(spark):
    schema = "batch_no long, topic string, partition int, offset long"
    sent = spark.createDataFrame([(1, "t", 0, 5), (1, "t", 1, 6), (2, "t", 0, 9)], schema)
    back = spark.createDataFrame([(1, "t", 0, 5), (1, "t", 1, 6), (2, "t", 0, 8), (3, "t", 0, 1)], schema)
    assert rows(delivery.outcomes(sent, back)) == [(1, "confirmed"), (1, "delivered"), (2, "delivered"), (2, "ignored")]
