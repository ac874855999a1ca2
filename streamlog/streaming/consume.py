"""Reading a log as a sequence of batches that carry their offsets."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog.model import OFFSETS_SCHEMA, TOPIC_PARTITION
from streamlog.operators.delivery import commit_upsert
from streamlog.operators.offsets import position_changes, positions
from streamlog.operators.records import TooFewRecords
from streamlog.session import folders, read_or_empty, remove
from streamlog.sources.ranges import BATCH, LogStream


def start(
    stream: DataFrame | LogStream,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Call ``handle(batch, batch_id)`` for every micro-batch.

    A batch is done, and its source position stored in the checkpoint, when
    ``handle`` returns; if it raises, a restart delivers the batch again.
    Without an ``interval`` the query reads what is there and ends. Stopping
    the query keeps the position: starting again on the same checkpoint goes on.

    A :class:`LogStream` that takes several batches ``together`` calls
    ``handle(batches, numbers)`` instead, with the range of their numbers.
    """
    if isinstance(stream, LogStream):
        return stream.start(handle, checkpoint, interval)
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def read_until(stream: DataFrame | LogStream, expected: int, seconds: float, path: str) -> DataFrame:
    """Read a stream until there are ``expected`` records or the time is up; fewer are an error.

    The batch that reaches the number is kept whole. Batches are counted while
    they are written to ``path``, so nothing is read twice.
    """
    spark, done, written, total = stream.sparkSession, threading.Event(), [], [0]

    def keep(batch: DataFrame, batch_id: int) -> None:
        if done.is_set():
            return
        seen = Observation()
        counted = batch.observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{path}/data/{batch_id}")
        written.append(f"{path}/data/{batch_id}")
        total[0] += seen.get["n"]
        if total[0] >= expected:
            done.set()

    query = start(stream, keep, f"{path}/checkpoint", interval="100 milliseconds")
    try:
        end = time.monotonic() + seconds
        while not done.wait(0.05) and time.monotonic() < end and query.isActive:
            pass
        failed = query.exception()
    finally:
        query.stop()
    if failed is not None:
        raise failed
    if not done.is_set():
        raise TooFewRecords(f"expected {expected} records but got {total[0]}")
    return spark.read.parquet(*written)


def start_with_offsets(
    stream: DataFrame | LogStream,
    handle: Callable[[DataFrame, DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    assigned: DataFrame | None = None,
    positions_path: str | None = None,
) -> StreamingQuery:
    """Like :func:`start`, with the offsets table of each batch as second argument.

    By itself a batch tells the positions of the partitions it has records of.
    With ``assigned``, an offsets table of where every assigned partition
    begins, each batch carries the positions of all of them: the last ones, moved
    on by the batch. They are kept at ``positions_path``, one small table per
    batch, so a batch that is delivered again gets the same ones.

    For several batches ``together`` the table has the positions of each, with
    its number in ``_batch``.
    """
    several = isinstance(stream, LogStream) and stream.several is not None
    if assigned is None:
        reached = partial(position_changes, batch=BATCH) if several else positions
        return start(stream, lambda batch, number: handle(batch, reached(batch), number), checkpoint, interval)
    if positions_path is None:
        raise ValueError("give positions_path, a folder to keep the positions in")
    spark = stream.sparkSession

    def carry(batch: DataFrame, batch_id: int) -> None:
        before = assigned if batch_id == 0 else read_or_empty(spark, f"{positions_path}/{batch_id - 1}", OFFSETS_SCHEMA)
        reached = commit_upsert(before, positions(batch))
        reached.coalesce(1).write.mode("overwrite").parquet(f"{positions_path}/{batch_id}")
        handle(batch, read_or_empty(spark, f"{positions_path}/{batch_id}", OFFSETS_SCHEMA), batch_id)
        # The batch before is needed once more if this one fails, the one before that is not.
        if batch_id > 1:
            remove(spark, f"{positions_path}/{batch_id - 2}")

    def carry_several(batches: DataFrame, numbers: range) -> None:
        first, last = numbers[0], numbers[-1]
        before = assigned if first == 0 else read_or_empty(spark, f"{positions_path}/{first - 1}", OFFSETS_SCHEMA)
        each = _carried(before, position_changes(batches, BATCH), numbers)
        each.coalesce(1).write.mode("overwrite").parquet(f"{positions_path}/each-{last}")
        each = read_or_empty(spark, f"{positions_path}/each-{last}", each.schema)
        each.filter(F.col(BATCH) == last).select(*OFFSETS_SCHEMA.names).coalesce(1).write.mode("overwrite").parquet(f"{positions_path}/{last}")
        handle(batches, each, numbers)
        for name in folders(spark, positions_path):
            if name not in (f"each-{last}", str(last), str(first - 1)):
                remove(spark, f"{positions_path}/{name}")

    return start(stream, carry_several if several else carry, checkpoint, interval)


def _carried(before: DataFrame, changes: DataFrame, numbers: range) -> DataFrame:
    """Positions after each batch: what it reached, else what was reached last.

    A partition that isn't in ``before`` begins with its first records.
    """
    known = before.select(F.lit(numbers[0] - 1).cast("long").alias(BATCH), *TOPIC_PARTITION, "offset")
    known = known.unionByName(changes.select(BATCH, *TOPIC_PARTITION, "offset"))
    each = F.explode(F.sequence(F.lit(numbers[0] - 1).cast("long"), F.lit(numbers[-1]).cast("long"))).alias(BATCH)
    asked = known.select(*TOPIC_PARTITION).distinct().select(*TOPIC_PARTITION, each)
    so_far = Window.partitionBy(*TOPIC_PARTITION).orderBy(BATCH)
    return (
        asked.join(known, [BATCH, *TOPIC_PARTITION], "left")
        .withColumn("offset", F.last("offset", ignorenulls=True).over(so_far))
        .filter((F.col(BATCH) >= numbers[0]) & F.col("offset").isNotNull())
        .select(BATCH, *OFFSETS_SCHEMA.names)
    )
