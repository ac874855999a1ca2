"""Consume, transform, forward; the source position moves after the write is acknowledged."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog.model import ACKS_SCHEMA, TOPIC_PARTITION
from streamlog.operators.offsets import join_small, positions
from streamlog.sinks.log import LogTransaction, append
from streamlog.sources.ranges import BATCH, LogStream
from streamlog.sources.topic_log import TopicLog
from streamlog.session import read_or_empty
from streamlog.streaming import consume
from streamlog.streaming.transactions import claim, write_once


def relay(
    stream: DataFrame,
    to_output: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Forward every record once: output and source offsets are published together per batch."""

    claim(stream.sparkSession, path, checkpoint)

    def forward(batch: DataFrame, offsets: DataFrame, batch_id: int) -> None:
        write_once(to_output(batch), offsets, path, batch_id)

    return consume.start_with_offsets(stream, forward, checkpoint, interval)


def relay_to_sink(
    stream: DataFrame,
    to_output: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    sink_format: str,
    options: dict[str, str],
    interval: str | None = None,
) -> StreamingQuery:
    """Forward to any streaming sink, such as ``kafka``; at least once if that sink is.

    Batches of a log are written by the sink's batch writer.
    """
    if isinstance(stream, LogStream):
        def write(batch: DataFrame, batch_id: int) -> None:
            to_output(batch).write.format(sink_format).mode("append").options(**options).save()

        return consume.start(stream, write, checkpoint, interval)
    writer = to_output(stream).writeStream.format(sink_format).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def relay_to_log(
    stream: DataFrame,
    to_output: Callable[[DataFrame], DataFrame],
    log: TopicLog,
    order_by: list[str],
    checkpoint: str,
    partitions: int = 1,
    interval: str | None = None,
) -> StreamingQuery:
    """Forward records to a topic log, where they get the next offsets; each once.

    A batch is appended under its checkpoint and number, so one that failed
    after it was written is passed over when it is delivered again.
    """

    def forward(batch: DataFrame, batch_id: int) -> None:
        append(to_output(batch), log, order_by, partitions, f"{checkpoint}#{batch_id}", checkpoint)

    return consume.start(stream, forward, checkpoint, interval)


def relay_with_offsets(
    stream: LogStream,
    to_output: Callable[[DataFrame], DataFrame],
    log: TopicLog,
    order_by: list[str],
    group_id: str,
    checkpoint: str,
    partitions: int = 1,
    interval: str | None = None,
) -> StreamingQuery:
    """Forward records to a topic log; records and source offsets of a batch are one transaction of that log.

    Where to go on is what the target log has committed for the group, so the
    relay may be started with a new checkpoint, or elsewhere: the newer one
    fences the older, and records that were forwarded before are passed over.

    Several batches ``together`` are one transaction, and get the offsets they
    would get one by one; ``to_output`` then has to keep ``_batch``.
    """
    name = f"relay-{group_id}"
    log.book.start_writer(name)

    def forward(batch: DataFrame, number: int | range) -> None:
        reached = stream.log.offsets_table(log.committed(group_id)).withColumnRenamed("offset", "_done")
        fresh = join_small(batch, reached, "left").filter("_done IS NULL OR offset >= _done").drop("_done")
        offsets = positions(fresh)
        if offsets.isEmpty():
            return
        output, order, last = to_output(fresh), order_by, number
        if isinstance(number, range):
            if BATCH not in output.columns:
                raise ValueError(f"to_output has to keep the column {BATCH}: the batches are written one after the other")
            order, last = [BATCH, *order_by], number[-1]
        unit = LogTransaction(log, order, f"{group_id}@{checkpoint}#{last}", partitions, name)
        unit.send(output)
        unit.send_offsets(offsets, group_id)
        unit.commit()

    return consume.start(stream, forward, checkpoint, interval)


def acknowledged_writer(
    write: Callable[[DataFrame, int], None],
    acks_path: str,
    retries: int = 0,
    interval_ms: int = 0,
    failed_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch handler that writes a whole batch and replies with acknowledgement rows.

    One row per topic partition of the batch: ``success`` with its end offset
    or ``failure`` with the error. A failing write is tried ``retries`` times
    more, with a wait that grows by ``interval_ms`` each time. A batch fails as
    a whole. It then ends the query, so the source position stays and a restart
    delivers it again. With ``failed_path`` it is passed over instead, and its
    records are put there under its batch number.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        problem: Exception | None = None
        for attempt in range(retries + 1):
            try:
                write(batch, batch_id)
                problem = None
                break
            except Exception as raised:
                problem = raised
                if attempt < retries:
                    time.sleep(retry_wait_ms(attempt, interval_ms) / 1000)
        status = "success" if problem is None else "failure"
        acks = positions(batch).select(
            *TOPIC_PARTITION, "offset", F.lit(status).alias("status"),
            F.lit(None if problem is None else str(problem)).cast("string").alias("error"),
        )
        # A failure stays on record when a later attempt succeeds.
        acks.write.mode("overwrite").parquet(f"{acks_path}/batch_id={batch_id}/outcome={status}")
        if problem is not None:
            if failed_path is None:
                raise problem
            batch.write.mode("overwrite").parquet(f"{failed_path}/batch_id={batch_id}")

    return handle


def read_acks(spark: SparkSession, acks_path: str) -> DataFrame:
    """The replies so far."""
    return read_or_empty(spark, acks_path, ACKS_SCHEMA).select(*ACKS_SCHEMA.names)


def retry_wait_ms(redelivery_count: int, interval_ms: int) -> int:
    """Wait before the next attempt: one interval more per failed one."""
    return (redelivery_count + 1) * interval_ms
