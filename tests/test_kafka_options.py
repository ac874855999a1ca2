"""Option maps only: there is no broker and no connector here."""

import json

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from streamlog.operators.delivery import MAX_REDELIVERIES, SCHEDULE_INTERVAL_MS, UNCONFIRMED_TIMEOUT_MS
from streamlog.sources import kafka
from streamlog.sources.subscriptions import AutoPartition


def test_consumer_defaults_and_overrides():
    conf = kafka.ConsumerConf.create("test")
    assert conf.is_auto_commit
    assert conf.props["max.poll.records"] == "500" and conf.props["auto.offset.reset"] == "latest"
    changed = conf.with_conf({"enable.auto.commit": False}).with_property("auto.offset.reset", "earliest")
    assert not changed.is_auto_commit and conf.is_auto_commit
    assert changed.props["auto.offset.reset"] == "earliest"
    assert not kafka.ConsumerConf().is_auto_commit
    named = kafka.ConsumerConf.create("test", bootstrap_servers="b:1", isolation_level="read_committed")
    assert named.props["bootstrap.servers"] == "b:1" and named.props["isolation.level"] == "read_committed"


def test_source_options_leave_out_what_spark_owns():
    options = kafka.ConsumerConf.create("g", auto_offset_reset="earliest").source_options(max_offsets_per_trigger=1000)
    assert options == {
        "kafka.bootstrap.servers": "localhost:9092",
        "kafka.group.id": "g",
        "kafka.session.timeout.ms": "10000",
        "kafka.max.partition.fetch.bytes": "1048576",
        "kafka.max.poll.interval.ms": "300000",
        "kafka.metadata.max.age.ms": "300000",
        "kafka.isolation.level": "read_uncommitted",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }


def test_producer_options():
    conf = kafka.ProducerConf.create()
    assert "retries" not in conf.props and "transactional.id" not in conf.props
    assert conf.sink_options() == {
        "kafka.bootstrap.servers": "localhost:9092", "kafka.acks": "all", "kafka.batch.size": "16384",
        "kafka.linger.ms": "1", "kafka.buffer.memory": "33554432", "kafka.enable.idempotence": "false",
    }
    assert kafka.ProducerConf.create(retries=0).props["retries"] == "0"
    assert kafka.ProducerConf.create(enable_idempotence=True).sink_options()["kafka.enable.idempotence"] == "true"
    with pytest.raises(ValueError, match="no transactions"):
        kafka.ProducerConf.create(transactional_id="t").sink_options()


def test_subscriptions():
    tps = [("t", 2), ("t", 0), ("u", 1)]
    assert kafka.subscribe(["a", "b"]) == {"subscribe": "a,b"}
    assert json.loads(kafka.assign(tps)["assign"]) == {"t": [0, 2], "u": [1]}
    sought = kafka.seek({("t", 0): 25, ("t", 1): 40})
    assert json.loads(sought["startingOffsets"]) == {"t": {"0": 25, "1": 40}}
    assert json.loads(sought["assign"]) == {"t": [0, 1]}
    timed = kafka.seek_times({("t", 0): 1704067200000}, "latest")
    assert json.loads(timed["startingOffsetsByTimestamp"]) == {"t": {"0": 1704067200000}}
    assert timed["startingOffsetsByTimestampStrategy"] == "latest"
    stored = kafka.subscribe_from_store(tps, {("t", 0): 7}, reset="earliest")
    assert stored["subscribe"] == "t,u"
    assert json.loads(stored["startingOffsets"]) == {"t": {"0": 7, "2": -2}, "u": {"1": -2}}
    latest = kafka.subscribe_from_store(tps, {})
    assert json.loads(latest["startingOffsets"])["t"]["0"] == -1


def test_delivery_options():
    conf = kafka.DeliveryConf()
    assert (conf.schedule_interval_ms, conf.unconfirmed_timeout_ms, conf.max_redeliveries) == (
        SCHEDULE_INTERVAL_MS, UNCONFIRMED_TIMEOUT_MS, MAX_REDELIVERIES
    )
    assert conf.with_conf({"unconfirmed.timeout": 5000, "other": 1}) == kafka.DeliveryConf(1000, 5000, 3)


def test_delivery_options_make_a_plan(spark):
    sent = spark.createDataFrame([(1, 100), (2, 9_001), (3, None)], "id long, delay long")
    planned = kafka.DeliveryConf(500, 2_000, 2).plan(sent, F.col("delay")).select("id", "sends", "backoffs", "longest_poll_ms")
    assert rows(planned) == [(1, 1, 0, 500), (2, 3, 2, 1500), (3, 3, None, 1500)]


def test_bounded_reads_do_not_begin_at_the_end():
    assert kafka.batch_options(AutoPartition(("a",)).kafka_options()) == {"subscribe": "a"}
    assert kafka.batch_options(kafka.seek({("a", 0): 3})) == kafka.seek({("a", 0): 3})
    with pytest.raises(ValueError, match="every partition"):
        kafka.batch_options(kafka.subscribe_from_store([("a", 0), ("a", 1)], {("a", 0): 3}))


def test_reads_and_writes_go_to_the_connector(spark):
    """Without the connector Spark names the missing source; nothing else can be seen here."""
    conf, out = kafka.ConsumerConf.create("g"), kafka.ProducerConf.create()
    for job in (
        lambda: kafka.read(spark, conf, kafka.subscribe(["t"])),
        lambda: kafka.read_stream(spark, conf, kafka.assign([("t", 0)]), 100),
        lambda: kafka.write(spark.range(0).selectExpr("'t' topic", "'v' value"), out),
    ):
        with pytest.raises(AnalysisException, match="kafka"):
            job()
