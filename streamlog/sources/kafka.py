"""Options for Spark's Kafka source and sink.

These build the option maps only; the connector itself has to be on the class
path of the cluster.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog.operators import delivery
from streamlog.operators.offsets import EARLIEST, LATEST, starting_offsets_json

# The default settings of a consumer, as property texts.
CONSUMER_DEFAULTS = {
    "bootstrap.servers": "localhost:9092",
    "enable.auto.commit": "true",
    "auto.commit.interval.ms": "1000",
    "session.timeout.ms": "10000",
    "max.partition.fetch.bytes": "1048576",
    "max.poll.records": "500",
    "max.poll.interval.ms": "300000",
    "metadata.max.age.ms": "300000",
    "auto.offset.reset": "latest",
    "isolation.level": "read_uncommitted",
}
# The default settings of a producer, as property texts.
PRODUCER_DEFAULTS = {
    "bootstrap.servers": "localhost:9092",
    "acks": "all",
    "batch.size": "16384",
    "linger.ms": "1",
    "buffer.memory": "33554432",
    "enable.idempotence": "false",
}
# Settings Spark's source decides itself.
SOURCE_OWNED = {
    "auto.offset.reset", "enable.auto.commit", "auto.commit.interval.ms", "max.poll.records",
    "key.deserializer", "value.deserializer", "interceptor.classes",
}
SINK_OWNED = {"key.serializer", "value.serializer"}


def as_text(value) -> str:
    """Property text of a Python value."""
    return str(value).lower() if isinstance(value, bool) else str(value)


def _texts(settings: Mapping) -> dict[str, str]:
    return {name: as_text(value) for name, value in settings.items()}


@dataclass(frozen=True)
class Conf:
    """Client properties; every change gives a new object, later values win."""

    props: dict[str, str] = field(default_factory=dict)

    def with_conf(self, settings: Mapping):
        return replace(self, props={**self.props, **_texts(settings)})

    def with_property(self, name: str, value):
        return self.with_conf({name: value})


@dataclass(frozen=True)
class ConsumerConf(Conf):
    @classmethod
    def create(cls, group_id: str, **settings) -> "ConsumerConf":
        """Defaults plus settings given by name, dots written as underscores."""
        named = {name.replace("_", "."): value for name, value in settings.items()}
        return cls(_texts({**CONSUMER_DEFAULTS, "group.id": group_id, **named}))

    @property
    def is_auto_commit(self) -> bool:
        return self.props.get("enable.auto.commit", "") == "true"

    def source_options(self, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
        """Options for ``format("kafka")``: client settings, reset policy, batch bound.

        Commits and deserializers are Spark's own business and left out.
        """
        options = {f"kafka.{k}": v for k, v in self.props.items() if k not in SOURCE_OWNED}
        if "auto.offset.reset" in self.props:
            options["startingOffsets"] = self.props["auto.offset.reset"]
        if max_offsets_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        return options


@dataclass(frozen=True)
class ProducerConf(Conf):
    @classmethod
    def create(cls, retries: int | None = None, transactional_id: str | None = None, **settings) -> "ProducerConf":
        """Defaults plus named settings; ``retries`` None leaves the client's own default."""
        named = {name.replace("_", "."): value for name, value in settings.items()}
        if retries is not None:
            named["retries"] = retries
        if transactional_id is not None:
            named["transactional.id"] = transactional_id
        return cls(_texts({**PRODUCER_DEFAULTS, **named}))

    def sink_options(self) -> dict[str, str]:
        """Options for writing with ``format("kafka")``."""
        if "transactional.id" in self.props:
            raise ValueError(
                "Spark's Kafka sink has no transactions; use streamlog.streaming.transactions"
            )
        return {f"kafka.{k}": v for k, v in self.props.items() if k not in SINK_OWNED}


@dataclass(frozen=True)
class DeliveryConf:
    """How often to poll and when to send an unconfirmed batch again."""

    schedule_interval_ms: int = 1_000
    unconfirmed_timeout_ms: int = 3_000
    max_redeliveries: int = 3

    def with_conf(self, settings: Mapping) -> "DeliveryConf":
        names = {
            "schedule.interval": "schedule_interval_ms",
            "unconfirmed.timeout": "unconfirmed_timeout_ms",
            "max.redeliveries": "max_redeliveries",
        }
        return replace(self, **{names[k]: int(v) for k, v in settings.items() if k in names})

    def plan(self, deliveries: DataFrame, delay_ms: Column) -> DataFrame:
        """The redelivery plan under these settings, with the longest wait before a poll."""
        planned = delivery.redelivery_plan(deliveries, delay_ms, self.unconfirmed_timeout_ms, self.max_redeliveries)
        longest = delivery.poll_interval_ms(F.col("sends") - 1, self.schedule_interval_ms)
        return planned.withColumn("longest_poll_ms", longest)


def _partitions_json(partitions: Iterable[tuple[str, int]]) -> str:
    nested: dict[str, list[int]] = {}
    for topic, partition in sorted(partitions):
        nested.setdefault(topic, []).append(partition)
    return json.dumps(nested)


def subscribe(topics: Iterable[str]) -> dict[str, str]:
    """All partitions of the topics; a restart goes on from the query's checkpoint."""
    return {"subscribe": ",".join(topics)}


def subscribe_from_store(
    partitions: Iterable[tuple[str, int]], stored: Mapping[tuple[str, int], int], reset: str = "latest"
) -> dict[str, str]:
    """Subscribe with the user's own offsets; partitions not stored follow ``reset``."""
    fallback = {"earliest": EARLIEST, "latest": LATEST}[reset]
    partitions = list(partitions)
    topics = sorted({topic for topic, _ in partitions})
    start = {tp: stored.get(tp, fallback) for tp in partitions}
    return {**subscribe(topics), "startingOffsets": starting_offsets_json(start)}


def assign(partitions: Iterable[tuple[str, int]]) -> dict[str, str]:
    return {"assign": _partitions_json(partitions)}


def seek(offsets: Mapping[tuple[str, int], int]) -> dict[str, str]:
    return {**assign(offsets), "startingOffsets": starting_offsets_json(offsets)}


def seek_times(times_ms: Mapping[tuple[str, int], int], strategy: str = "error") -> dict[str, str]:
    return {
        **assign(times_ms),
        "startingOffsetsByTimestamp": starting_offsets_json(times_ms),
        "startingOffsetsByTimestampStrategy": strategy,
    }


def batch_options(subscription: Mapping[str, str]) -> dict[str, str]:
    """Subscription options for a bounded read, which can't begin at the end: nothing would be left to read."""
    options = dict(subscription)
    if options.get("startingOffsets") == "latest":
        del options["startingOffsets"]
    elif options.get("startingOffsets", "").startswith("{"):
        given = json.loads(options["startingOffsets"])
        if any(offset == LATEST for partitions in given.values() for offset in partitions.values()):
            raise ValueError("a bounded read needs an offset for every partition, or the earliest")
    return options


def read(spark: SparkSession, conf: ConsumerConf, subscription: Mapping[str, str], **options) -> DataFrame:
    """Bounded read of what the topics hold now."""
    settings = {**conf.source_options(), "startingOffsets": "earliest", **batch_options(subscription), **_texts(options)}
    return spark.read.format("kafka").options(**settings).load()


def read_stream(
    spark: SparkSession,
    conf: ConsumerConf,
    subscription: Mapping[str, str],
    max_offsets_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Stream of the subscription. Keys and values are bytes, to be decoded by a codec."""
    settings = {**conf.source_options(max_offsets_per_trigger), **subscription, **_texts(options)}
    return spark.readStream.format("kafka").options(**settings).load()


def write(records: DataFrame, conf: ProducerConf) -> None:
    """Blocking write of output records."""
    records.write.format("kafka").options(**conf.sink_options()).save()
