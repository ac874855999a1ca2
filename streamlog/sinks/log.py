"""Writing records to a topic log."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from streamlog.functions.numbers import epoch_micros, whole_div
from streamlog.functions.serde import split_failed
from streamlog.model import ACKS_SCHEMA, TOPIC_PARTITION, struct_of
from streamlog.operators import offsets as off
from streamlog.operators.numbering import BUCKET_ROWS, assign_offsets
from streamlog.session import drop_named
from streamlog.sources.ledger import Fenced, SecondWriter
from streamlog.sources.topic_log import FOLDER_FIELDS, FOLDERS, SEGMENT_ROWS, TopicLog

__all__ = ["Fenced", "LogTransaction", "SecondWriter", "append", "choose_partition", "create_log", "publish", "send"]

#: Folders named one by one when a finished append is read back; beyond, its number is looked for among all.
NAMED_FOLDERS = 1_000
_RANGES_SCHEMA = struct_of(topic=T.StringType(), partition=T.IntegerType(), begin=T.LongType(), end=T.LongType())


def create_log(spark: SparkSession, path: str, schema: T.StructType, segment_rows: int = SEGMENT_ROWS) -> TopicLog:
    """An empty log whose records have the given columns."""
    fields = [field for field in schema.fields if field.name not in FOLDERS]
    log = TopicLog(spark, path, T.StructType(fields + FOLDER_FIELDS), segment_rows)
    meta = {"segment_rows": segment_rows, "fields": json.loads(log.schema.json())}
    if not log.book.store.put(f"{path}/meta", json.dumps(meta)):
        raise FileExistsError(f"there is a log at {path} already")
    return log


def publish(
    records: DataFrame,
    path: str,
    order_by: list[str],
    segment_rows: int = SEGMENT_ROWS,
    encode: Callable[[DataFrame], DataFrame] | None = None,
) -> TopicLog:
    """Write ``topic, partition, ...`` records as a new log, numbered in the given order.

    ``encode`` may build keys and values from the numbered records. It then
    runs after they were moved, so the shuffle carries the plain columns and
    not the larger encoded ones.
    """
    others = [c for c in records.columns if c not in TOPIC_PARTITION]
    numbered = records.select(*TOPIC_PARTITION, F.lit(0).cast("long").alias("offset"), *others)
    schema = (numbered if encode is None else encode(numbered)).schema
    log = create_log(records.sparkSession, path, schema, segment_rows)
    _append(records, log, order_by, "commit", encode=encode)
    return log


def write_numbered(numbered: DataFrame, log: TopicLog, append_no: int) -> None:
    """Write records that already carry their offsets under the number of an append.

    The rows are sorted by offset inside each file, so that offset and
    timestamp statistics of the row groups are narrow.
    """
    (
        numbered.withColumns({
            "segment": whole_div("offset", log.segment_rows), "append_no": F.lit(append_no).cast("long"),
        })
        .select(*log.schema.names)
        .sortWithinPartitions(*TOPIC_PARTITION, "segment", "offset")
        .write.mode("append").partitionBy(*FOLDERS).parquet(log.data_path)
    )


def _counts(records: DataFrame) -> dict[tuple[str, int], int]:
    """Records of each partition; the list of partitions is what the driver knows of a log anyway."""
    found = records.groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("n")).collect()
    if any(row["topic"] is None or row["partition"] is None for row in found):
        raise ValueError("every record needs a topic and a partition")
    return {(row["topic"], row["partition"]): row["n"] for row in found}


def _numbered(records: DataFrame, order_by: list[str], counts: dict, begins: dict, scratch: str) -> DataFrame:
    """Records with their offsets; if every partition fits a task, by one window instead of buckets."""
    start = off.of(records.sparkSession, begins) if any(begins.values()) else None
    if max(counts.values(), default=0) > BUCKET_ROWS:
        return assign_offsets(records, order_by, start, scratch=scratch)
    rank = F.row_number().over(Window.partitionBy(*TOPIC_PARTITION).orderBy(*order_by)).cast("long") - 1
    if start is None:
        return records.withColumn("offset", rank)
    start = start.withColumnRenamed("offset", "_begin")
    start = F.broadcast(start) if len(begins) <= off.BROADCAST_LIMIT else start
    return records.withColumn("offset", rank).join(start, TOPIC_PARTITION, "left").withColumn(
        "offset", F.col("offset") + F.coalesce("_begin", F.lit(0))
    ).drop("_begin")


def _read_back(log: TopicLog, number: int, ranges: list[list]) -> list[list]:
    """``topic, partition, segment, latest time`` of what an append wrote; fails if it isn't what was counted.

    A source that gives other records each time it is read is found out here.
    """
    folders = [f"{folder}/append_no={number}" for folder in log._segment_folders(ranges)]
    stored = log._in_folders(folders if len(folders) <= NAMED_FOLDERS else [""]).filter(F.col("append_no") == number)
    latest = F.lit(None).cast("long")
    if "timestamp" in log.schema.names and isinstance(log.schema["timestamp"].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        kind = log.schema["timestamp"].dataType
        latest = epoch_micros(F.max("timestamp"), kind) if not isinstance(kind, T.DateType) else F.unix_date(F.max("timestamp")).cast("long") * 86_400_000_000
    rows = stored.groupBy(*TOPIC_PARTITION, "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first"), F.max("offset").alias("last"), latest.alias("latest")
    ).collect()
    found: dict[tuple[str, int], list] = {}
    for row in rows:
        own = found.setdefault((row["topic"], row["partition"]), [0, row["first"], row["last"]])
        own[:] = own[0] + row["n"], min(own[1], row["first"]), max(own[2], row["last"])
    for topic, partition, begin, end in ranges:
        if found.get((topic, partition)) != [end - begin, begin, end - 1]:
            raise RuntimeError(f"{topic}-{partition}: other records were written than counted; the source must be the same each time it is read")
    return [[row["topic"], row["partition"], row["segment"], row["latest"]] for row in rows if row["latest"] is not None]


def _append(
    records: DataFrame, log: TopicLog, order_by: list[str], kind: str, *, writer: str | None = None, epoch: int | None = None,
    batch_id: str | None = None, unit: str | None = None, groups: dict[str, list] | None = None,
    encode: Callable[[DataFrame], DataFrame] | None = None,
) -> list[list]:
    """Write addressed records and enter them; ``topic, partition, begin, end`` of what counts for the batch.

    The source is read twice, to count and to write; a third time only if a
    partition is too large to be numbered in one task.
    """
    number = log.book.begin(writer, epoch)
    name = f"append-{uuid.uuid4().hex}"
    try:
        counts = _counts(records)
        ends = log.book.state().ends
        begins = {key: ends.get(key, 0) for key in counts}
        ranges = [[t, p, begins[t, p], begins[t, p] + n] for (t, p), n in sorted(counts.items())]
        times: list[list] = []
        if counts:
            numbered = _numbered(records, order_by, counts, begins, name)
            write_numbered(numbered if encode is None else encode(numbered), log, number)
            times = _read_back(log, number, ranges)
        return log.book.end_append(
            kind, number, ranges, times, writer=writer, epoch=epoch, batch_id=batch_id, unit=unit, groups=groups
        )
    finally:
        drop_named(records.sparkSession, name)


def choose_partition(partitions: int) -> Column:
    """Partition of an output record: the given one, else by key, else spread by content.

    This is Spark's hash, not the one of another client: the same key always
    goes to the same partition of this log, but not to the same number elsewhere.
    """
    by_key = F.pmod(F.xxhash64("key"), F.lit(partitions))
    spread = F.pmod(F.xxhash64("value", F.col("timestamp").cast("string")), F.lit(partitions))
    return F.coalesce(
        F.col("partition"), F.when(F.col("key").isNotNull(), by_key).otherwise(spread).cast("int")
    )


def _ranges_table(spark: SparkSession, ranges: list[list]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in ranges], _RANGES_SCHEMA)


def append(
    records: DataFrame,
    log: TopicLog,
    order_by: list[str],
    partitions: int = 1,
    batch_id: str | None = None,
    writer: str | None = None,
) -> DataFrame:
    """Append output records after the present end of the log.

    Returns ``topic, partition, begin, end`` of what was appended. The data are
    written first and entered last, so an append is there whole or not at all. A
    ``batch_id`` that was entered already is passed over: its ranges are returned
    and nothing is written. If someone else appends to the same partitions
    meanwhile, :class:`SecondWriter` is raised and the append doesn't count.
    ``writer`` is a name: whoever takes it last refuses the appends of all before
    (:class:`Fenced`), such as one that hung and comes back.
    """
    known = log.book.known(batch_id)
    if known is None:
        epoch = None if writer is None else log.book.start_writer(writer)
        addressed = records.withColumn("partition", choose_partition(partitions))
        known = _append(addressed, log, order_by, "commit", writer=writer, epoch=epoch, batch_id=batch_id)
    return _ranges_table(records.sparkSession, known)


class LogTransaction:
    """Records and source offsets that count together, by one entry of the ledger, or not at all.

    ``send`` writes at once: the records get their offsets, but readers of
    committed records see neither them nor what follows in their partitions
    before the transaction ends. With a ``writer`` name, a newer transaction of
    that name aborts this one and refuses its commit. A ``batch_id`` that was
    committed or aborted before is passed over.
    """

    def __init__(self, log: TopicLog, order_by: list[str], batch_id: str, partitions: int = 1, writer: str | None = None):
        self.log, self.order_by, self.batch_id, self.partitions, self.writer = log, order_by, batch_id, partitions, writer
        self._unit = uuid.uuid4().hex
        self._ranges: list[list] = []
        self._groups: dict[str, list] = {}
        self._known = log.book.known(batch_id)
        self._epoch = None if writer is None or self._known is not None else log.book.start_writer(writer)
        self.open = True

    def _require_open(self) -> None:
        if not self.open:
            raise RuntimeError(f"transaction {self.batch_id} has ended")

    def send(self, records: DataFrame) -> None:
        self._require_open()
        if self._known is None:
            addressed = records.withColumn("partition", choose_partition(self.partitions))
            self._ranges += _append(addressed, self.log, self.order_by, "open", writer=self.writer, epoch=self._epoch, unit=self._unit)

    def send_offsets(self, offsets: DataFrame, group_id: str) -> None:
        """Source offsets to be committed for a group; one row per partition."""
        self._require_open()
        rows = off.checked_rows(offsets.select(*TOPIC_PARTITION, "offset"), off.BROADCAST_LIMIT)
        if rows is None:
            raise ValueError("too many partitions for one transaction")
        self._groups[group_id] = self._groups.get(group_id, []) + [list(r) for r in rows]

    def _end(self, kind: str) -> DataFrame | None:
        self._require_open()
        self.open = False
        if self._known is None:
            if not self._ranges and not self._groups:
                return None
            self.log.book.end_unit(kind, self._unit, writer=self.writer, epoch=self._epoch, batch_id=self.batch_id, groups=self._groups)
        return _ranges_table(self.log.spark, self._ranges if self._known is None else self._known)

    def commit(self) -> DataFrame | None:
        return self._end("commit")

    def abort(self) -> DataFrame | None:
        """The records keep their offsets, but only readers of uncommitted records see them."""
        return self._end("abort")


def send(
    records: DataFrame,
    log: TopicLog,
    order_by: list[str],
    partitions: int = 1,
    batch_id: int | None = None,
    producer: str = "send",
) -> DataFrame:
    """Append output records like :func:`append`; returns one acknowledgement each.

    With a ``batch_id`` the batch of that number of this ``producer`` is written
    once, however often it is sent; each time the same acknowledgements come back.
    Rows with a non-NULL ``error`` column are not written and acknowledged as failed.
    """
    number = F.lit(batch_id or 0).cast("long").alias("batch_id")
    failed = None
    if "error" in records.columns:
        records, failed = split_failed(records)
    written = append(records, log, order_by, partitions, None if batch_id is None else f"{producer}#{batch_id}")
    # What was written is known from its begin and end.
    acks = written.filter("end > begin").select(
        number, *TOPIC_PARTITION, F.explode(F.sequence(F.col("begin"), F.col("end") - 1)).alias("offset"),
        F.lit("success").alias("status"), F.lit(None).cast("string").alias("error"),
    )
    if failed is not None:
        acks = acks.unionByName(
            failed.select(
                number, "topic", F.col("partition").cast("int"), F.lit(None).cast("long").alias("offset"),
                F.lit("failure").alias("status"), "error",
            )
        )
    return acks.select(*ACKS_SCHEMA.names)
