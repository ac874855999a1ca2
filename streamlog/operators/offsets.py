"""Offsets tables: what was read, what to keep, where to go on."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlog.functions.numbers import epoch_micros, from_epoch_micros, whole_div
from streamlog.model import OFFSETS_SCHEMA, TOPIC_PARTITION
from streamlog.session import materialize

LITERAL_LIMIT = 256
BROADCAST_LIMIT = 500_000

EARLIEST = -2
LATEST = -1


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OFFSETS_SCHEMA)


def of(spark: SparkSession, offsets: Mapping[tuple[str, int], int]) -> DataFrame:
    """An offsets table from ``{(topic, partition): offset}``."""
    return spark.createDataFrame([(t, p, o) for (t, p), o in offsets.items()], OFFSETS_SCHEMA)


def get(offsets: DataFrame, topic: str, partition: int) -> int | None:
    row = offsets.filter((F.col("topic") == topic) & (F.col("partition") == partition)).first()
    return None if row is None else row["offset"]


def is_empty(offsets: DataFrame) -> bool:
    return offsets.isEmpty()


def as_text(offsets: DataFrame) -> DataFrame:
    """Readable form, one line per partition."""
    return offsets.select(
        F.concat_ws("", "topic", F.lit("-"), "partition", F.lit(" = "), "offset").alias("text")
    )


def positions(records: DataFrame) -> DataFrame:
    """Where a reader of these records stands: last offset + 1 per partition."""
    return records.groupBy(*TOPIC_PARTITION).agg((F.max("offset") + 1).alias("offset"))


def partitions_for(records: DataFrame, topic: str) -> DataFrame:
    """Begin and end offset of each partition of a topic."""
    return (
        records.filter(F.col("topic") == topic)
        .groupBy(*TOPIC_PARTITION)
        .agg(F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset"))
    )


def topic_partitions(records: DataFrame) -> DataFrame:
    return records.select(*TOPIC_PARTITION).distinct()


def keep_only(offsets: DataFrame, partitions: DataFrame) -> DataFrame:
    return offsets.join(partitions.select(*TOPIC_PARTITION), TOPIC_PARTITION, "left_semi")


def remove(offsets: DataFrame, partitions: DataFrame) -> DataFrame:
    return offsets.join(partitions.select(*TOPIC_PARTITION), TOPIC_PARTITION, "left_anti")


def to_commits(offsets: DataFrame, group_id: str, committed_at: Column | None = None) -> DataFrame:
    """Offsets in the layout of the commit table."""
    at = F.current_timestamp() if committed_at is None else committed_at
    return offsets.select(
        F.lit(group_id).alias("group_id"), *TOPIC_PARTITION, "offset", at.alias("committed_at")
    )


def offsets_for_times(records: DataFrame, times: Column | DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """First offset whose record timestamp is at or after the asked one, NULL past the end.

    ``times`` is one instant for all partitions or a table ``topic, partition,
    timestamp``. The time filter reaches the scan; ``partitions`` lists those
    to report (default: all in ``records``).
    """
    if isinstance(times, DataFrame):
        asked = times.select(*TOPIC_PARTITION, F.col("timestamp").alias("_asked"))
        kind = times.schema["timestamp"].dataType
        # The earliest time is a literal, which reaches the scan; the exact ones are joined.
        earliest = times.agg(F.min(epoch_micros("timestamp", kind))).first()[0]
        late = records.filter(F.col("timestamp") >= from_epoch_micros(F.lit(earliest).cast("long"), kind))
        late = join_small(late, asked).filter(F.col("timestamp") >= F.col("_asked"))
        partitions = times if partitions is None else partitions
    else:
        late = records.filter(F.col("timestamp") >= times)
        partitions = topic_partitions(records) if partitions is None else partitions
    found = late.groupBy(*TOPIC_PARTITION).agg(F.min("offset").alias("offset"))
    return partitions.select(*TOPIC_PARTITION).join(found, TOPIC_PARTITION, "left")


def start_offsets(ends: DataFrame, stored: DataFrame, reset: str = "latest") -> DataFrame:
    """Stored offset of each partition, else the log's begin or end.

    ``ends`` holds one row per existing partition with its end offset.
    """
    if reset not in ("earliest", "latest"):
        raise ValueError(f"unknown reset policy {reset!r}")
    known = stored.select(*TOPIC_PARTITION, F.col("offset").alias("_stored"))
    fallback = F.lit(0).cast("long") if reset == "earliest" else F.col("offset")
    return ends.join(known, TOPIC_PARTITION, "left").select(
        *TOPIC_PARTITION, F.coalesce("_stored", fallback).alias("start_offset")
    )


def position_changes(records: DataFrame, batch: str = "batch_no") -> DataFrame:
    """The position each batch reached, for the partitions it has records of."""
    return records.groupBy(batch, *TOPIC_PARTITION).agg((F.max("offset") + 1).alias("offset"))


def positions_at(changes: DataFrame, asked: DataFrame, batch: str = "batch_no", chunk: int = 10_000) -> DataFrame:
    """Positions after the asked batches (``batch, topic, partition``), from the changes up to each.

    A partition without records up to a batch stands at 0. Batch numbers are
    integers. Rows asked for and changes are stacked; the running maximum is
    taken inside chunks of batch numbers and completed with the maximum of the
    earlier chunks, so no task holds the whole history of a partition.
    """
    asked = asked.select(batch, *TOPIC_PARTITION, F.lit(None).cast("long").alias("_next"), F.lit(True).alias("_asked"))
    reached = changes.select(batch, *TOPIC_PARTITION, F.col("offset").alias("_next"), F.lit(False).alias("_asked"))
    both = asked.unionByName(reached).groupBy(batch, *TOPIC_PARTITION).agg(
        F.max("_next").alias("_next"), F.max("_asked").alias("_asked")
    ).withColumn("_chunk", whole_div(batch, chunk))
    both = materialize(both, "positions")
    per_chunk = both.groupBy(*TOPIC_PARTITION, "_chunk").agg(F.max("_next").alias("_top"))
    before = Window.partitionBy(*TOPIC_PARTITION).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(*TOPIC_PARTITION, "_chunk", F.max("_top").over(before).alias("_carried"))
    so_far = Window.partitionBy(*TOPIC_PARTITION, "_chunk").orderBy(batch).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        both.withColumn("_running", F.max("_next").over(so_far))
        .filter("_asked")
        .join(carried, [*TOPIC_PARTITION, "_chunk"])
        .select(batch, *TOPIC_PARTITION, F.coalesce(F.greatest("_running", "_carried"), F.lit(0)).alias("offset"))
    )


def of_group(table: DataFrame, group_id: str | None = None) -> DataFrame:
    """``topic, partition, offset`` of one group of a commit table; a table of several needs the group's name."""
    if "group_id" in table.columns:
        if group_id is not None:
            table = table.filter(F.col("group_id") == group_id)
        elif len(table.select("group_id").distinct().take(2)) > 1:
            raise ValueError("the offsets are of several groups: name one")
    return table.select(*TOPIC_PARTITION, "offset")


def checked_rows(table: DataFrame, limit: int) -> list | None:
    """The rows of a small table ``topic, partition, offset, ...``, or None if it has more than ``limit``.

    Whatever its size, a table that has a partition twice, or a NULL topic,
    partition or offset, is refused: it doesn't say where to read.
    """
    begin = table.columns[2]
    rows = bounded_rows(table, limit)
    if rows is None:
        bad = (
            table.groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("_n"), F.count(begin).alias("_set"))
            .filter((F.col("_n") > 1) | (F.col("_set") == 0) | F.col("topic").isNull() | F.col("partition").isNull()).first()
        )
    else:
        seen: set = set()
        bad = next((r for r in rows if None in r[:3] or r[:2] in seen or seen.add(r[:2])), None)
    if bad is not None:
        raise ValueError(f"offsets need each partition once, without NULL: {bad['topic']}-{bad['partition']}")
    return rows


def bounded_rows(df: DataFrame, limit: int) -> list | None:
    """The rows of a small table, or None if it has more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def join_small(records: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Join a per-partition table to records: broadcast if its size is checked, else planned by Spark."""
    fits = table.limit(BROADCAST_LIMIT + 1).count() <= BROADCAST_LIMIT
    return records.join(F.broadcast(table) if fits else table, TOPIC_PARTITION, how)


def starting_offsets_json(offsets: DataFrame | Mapping[tuple[str, int], int]) -> str:
    """Offsets as the JSON text of Spark's ``startingOffsets`` option."""
    if isinstance(offsets, DataFrame):
        items = [((r["topic"], r["partition"]), r["offset"]) for r in offsets.toLocalIterator()]
    else:
        items = list(offsets.items())
    nested: dict[str, dict[str, int]] = {}
    for (topic, partition), offset in sorted(items):
        nested.setdefault(topic, {})[str(partition)] = offset
    return json.dumps(nested)
