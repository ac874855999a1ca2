"""Topic logs and offset tables derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog.functions.numbers import whole_div
from streamlog.model import TOPIC_PARTITION
from streamlog.operators.numbering import assign_offsets
from streamlog.session import materialize, scratch_path
from streamlog.sinks.log import LogTransaction, append, create_log, publish, write_numbered
from streamlog.sources.topic_log import TopicLog

BATCH_EVENTS = 500
TRANSACTION_EVENTS = 100

_published: dict[tuple, TopicLog] = {}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as unnumbered records: topic = type, partition = user mod 4, no key for views."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).alias("key"),
        F.col("props").alias("value"),
        "event_id",
    )


def publish_events(spark: SparkSession, sf_dir: str) -> TopicLog:
    """Write the events as a new topic log."""
    return publish(event_records(spark, sf_dir), scratch_path(spark, "events"), ["timestamp", "event_id"])


def _shared(name: str, make: Callable[[SparkSession, str], TopicLog], spark: SparkSession, sf_dir: str) -> TopicLog:
    """A log that is written once per application and input, and read by many queries."""
    # Files are known by name, size and time of change: another input under the same names is published anew.
    found = spark.read.format("binaryFile").load(f"{sf_dir}/events.parquet").select("path", "length", "modificationTime")
    files = tuple(sorted(tuple(row) for row in found.collect()))
    owner = (name, spark.sparkContext.applicationId, files)
    if owner not in _published or not _published[owner].exists():
        _published[owner] = make(spark, sf_dir)
    return _published[owner]


def event_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    """The topic log of the events.

    Records are produced once and then read by many subscribers, so the queries
    share the stored log.
    """
    return _shared("events", publish_events, spark, sf_dir)


def publish_lines(spark: SparkSession, sf_dir: str) -> TopicLog:
    """Order lines as records of 1,007 bytes: the row as JSON, padded, 16 partitions by order."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    partition = (F.col("l_orderkey") % 16).cast("int")
    records = lines.select(F.lit("lines").alias("topic"), partition.alias("partition"), "*")

    def encode(numbered: DataFrame) -> DataFrame:
        return numbered.select(
            *TOPIC_PARTITION, "offset",
            F.col("l_shipdate").alias("timestamp"),
            F.col("l_orderkey").cast("string").alias("key"),
            F.rpad(F.to_json(F.struct(*lines.columns)), 1_007, " ").alias("value"),
        )

    order_by = ["l_shipdate", "l_orderkey", "l_linenumber"]
    return publish(records, scratch_path(spark, "lines"), order_by, segment_rows=5_000, encode=encode)


def user_store(ends: DataFrame) -> DataFrame:
    """Offsets kept by a user: 20 behind the end, partition 3 missing."""
    return ends.filter(F.col("partition") < 3).select(
        *TOPIC_PARTITION, F.greatest(F.col("offset") - 20, F.lit(0).cast("long")).alias("offset")
    )


def in_batches(records: DataFrame) -> DataFrame:
    return records.withColumn("batch_no", whole_div("event_id", BATCH_EVENTS))


def in_transactions(records: DataFrame) -> DataFrame:
    return records.withColumn("transaction", whole_div("event_id", TRANSACTION_EVENTS))


def deliveries(records: DataFrame) -> DataFrame:
    """Offsets delivered with each batch, stored: they are asked for more than once."""
    reached = in_batches(records).groupBy("batch_no", *TOPIC_PARTITION)
    return materialize(reached.agg((F.max("offset") + 1).alias("offset")), "deliveries")


def confirmations(delivered: DataFrame) -> DataFrame:
    """What came back: one offset altered in every third batch, partition 3 missing in every fifth."""
    altered = (F.col("batch_no") % 3 == 0) & (F.col("partition") == 0)
    missing = (F.col("batch_no") % 5 == 1) & (F.col("partition") == 3)
    return delivered.filter(~missing).withColumn("offset", F.col("offset") + F.when(altered, 1).otherwise(0))


def asked_positions(log: TopicLog, changes: DataFrame) -> DataFrame:
    """Every partition at every batch up to the last one."""
    last = changes.agg(F.coalesce(F.max("batch_no"), F.lit(-1))).first()[0]
    batches = F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")) if last >= 0 else F.array().cast("array<long>")
    return log.partitions().select(F.explode(batches).alias("batch_no"), *TOPIC_PARTITION)


def third(spark: SparkSession, sf_dir: str, *kinds: int) -> DataFrame:
    """The events whose number leaves one of these rests by three."""
    return event_records(spark, sf_dir).filter((F.col("event_id") % 3).isin(*kinds))


ORDER = ["timestamp", "event_id"]


def mixed_log(spark: SparkSession, sf_dir: str) -> TopicLog:
    """The log of :func:`write_mixed`."""
    return _shared("mixed", write_mixed, spark, sf_dir)


def write_mixed(spark: SparkSession, sf_dir: str) -> TopicLog:
    """A log with a committed append, a broken one, an aborted transaction and a committed append."""
    log = create_log(spark, scratch_path(spark, "mixed"), event_log(spark, sf_dir).schema)
    append(third(spark, sf_dir, 0), log, ORDER)
    # Broken: the records are written, then their writer is gone.
    write_numbered(assign_offsets(third(spark, sf_dir, 2), ORDER, log.end_offsets()), log, log.book.begin())
    aborted = LogTransaction(log, ORDER, "aborted")
    aborted.send(third(spark, sf_dir, 1))
    aborted.abort()
    append(third(spark, sf_dir, 1, 2), log, ORDER)
    return log


def log_with_open_transaction(spark: SparkSession, sf_dir: str) -> TopicLog:
    """The log of :func:`write_with_open_transaction`."""
    return _shared("open", write_with_open_transaction, spark, sf_dir)


def write_with_open_transaction(spark: SparkSession, sf_dir: str) -> TopicLog:
    """A committed append, a transaction on two topics that doesn't end, and a further committed append."""
    log = create_log(spark, scratch_path(spark, "open"), event_log(spark, sf_dir).schema)
    append(third(spark, sf_dir, 0), log, ORDER)
    unit = LogTransaction(log, ORDER, "open")
    unit.send(third(spark, sf_dir, 1).filter(F.col("topic").isin("click", "view")))
    append(third(spark, sf_dir, 2), log, ORDER)
    return log
