"""A log as a stream of offset ranges.

The stream's offsets are positions, its rows ``topic, partition, begin, end``:
no record passes through it and nothing but the ledger is looked at. Each
micro-batch takes at most ``max_records`` offsets of a partition and ends before
the first transaction that is still open. The handler's records are then read
from the folders of those ranges.

A stream may take several batches ``together`` in one trigger. Each is what it
would be alone, with its number in the column ``_batch`` of its records; the
stream's offsets count the batches beyond one a trigger.

The ledger is read here by a Python process beside the driver, with pyarrow's
file systems (local, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import copy
import json
from collections.abc import Callable, Iterator

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from streamlog.functions.numbers import whole_div
from streamlog.model import TOPIC_PARTITION
from streamlog.operators import offsets as off
from streamlog.sources.ledger import State, catch_up

#: One row without a topic tells the batches beyond one a trigger, before and after this trigger.
SCHEMA = "topic string, partition int, begin long, end long"
FORMAT = "streamlog_ranges"
#: Column with the number of a record's batch, in streams that take several together.
BATCH = "_batch"
#: Offsets of all partitions that one trigger takes, unless a single batch has more.
TRIGGER_OFFSETS = 4_000_000


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


class RangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> "RangeReader":
        return RangeReader(json.loads(self.options["spec"]))


class RangeReader(DataSourceStreamReader):
    """Positions are kept as ``[[topic, partition, offset], ...]``, sorted, so equal ones are equal texts."""

    def __init__(self, spec: dict):
        self.path, self.most, self.together = spec["path"], spec["max_records"], spec["together"]
        self.topics = None if spec["topics"] is None else set(spec["topics"])
        self.start = None if spec["begin"] is None else {(t, p): o for t, p, o in spec["begin"]}
        self.current: dict[tuple[str, int], int] | None = None
        self.extra = 0
        self.state = State()

    def _ends(self) -> dict[tuple[str, int], int]:
        files, root = _open(f"{self.path}/ledger")

        def names(folder: str) -> list[str]:
            found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            return sorted(f.base_name for f in found if f.type == fs.FileType.File and not f.base_name.startswith("."))

        def read(path: str) -> str | None:
            try:
                with files.open_input_stream(path) as stream:
                    return stream.read().decode()
            except FileNotFoundError:
                return None

        self.state = catch_up(self.state, root, names, read)
        ends = self.state.stable_ends()
        if self.topics is not None:
            ends = {k: v for k, v in ends.items() if k[0] in self.topics}
        return ends if self.start is None else {k: v for k, v in ends.items() if k in self.start}

    @staticmethod
    def _offset(positions: dict[tuple[str, int], int], extra: int = 0) -> dict:
        found = {"positions": sorted([t, p, o] for (t, p), o in positions.items())}
        return found | {"extra": extra} if extra else found

    @staticmethod
    def _positions(offset: dict) -> dict[tuple[str, int], int]:
        return {(t, p): o for t, p, o in offset["positions"]}

    def initialOffset(self) -> dict:
        return self._offset(self.start or {})

    def _batches(self, at: dict[tuple[str, int], int], ends: dict[tuple[str, int], int], first: bool) -> int:
        """How many batches a trigger takes: one at first, then about twice as many as there were, up to a bound."""
        if self.together is None or self.most is None or first:
            return 1
        behind = sum(end > at[key] for key, end in ends.items())
        return max(1, min(2 * (self.extra + 1), self.together // (self.most * max(1, behind))))

    def latestOffset(self) -> dict:
        initial = self._positions(self.initialOffset())
        current = initial if self.current is None else self.current
        reached, ends, taken = dict(current), self._ends(), 1
        at = {key: current.get(key, self.state.begins.get(key, 0)) for key in ends}
        batches = self._batches(at, ends, current == initial)
        for key, end in ends.items():
            to = end if self.most is None else min(end, at[key] + self.most * batches)
            if to > at[key] or key in current:
                reached[key] = max(at[key], to)
            if self.most is not None:
                taken = max(taken, -(-(to - at[key]) // self.most))
        self.current, self.extra = reached, self.extra + taken - 1
        return self._offset(reached, self.extra)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # Called with the last offsets when a query starts again.
        if self.current is None:
            self.current, self.extra = self._positions(end), end.get("extra", 0)
        before = self._positions(start)
        ranges = [(t, p, before.get((t, p), 0), o) for (t, p), o in self._positions(end).items() if o > before.get((t, p), 0)]
        return [InputPartition([(None, None, start.get("extra", 0), end.get("extra", 0)), *ranges])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from partition.value


class UpToNow:
    """A query that ends once it has read all there was; used like a StreamingQuery."""

    def __init__(self, query: StreamingQuery):
        self.query = query

    def awaitTermination(self, timeout: int | None = None) -> bool:
        try:
            self.query.processAllAvailable()
        finally:
            self.query.stop()
        return True

    def __getattr__(self, name: str):
        return getattr(self.query, name)


class LogStream:
    """Records of a log as a stream of batches; ``filter``, ``select`` and ``transform`` apply to each batch."""

    isStreaming = True

    def __init__(self, log, topics: list[str] | None, max_records: int | None):
        self.log, self.topics, self.max_records = log, topics, max_records
        self.begin: dict[tuple[str, int], int] | None = None
        self.several: int | None = None
        self._steps: list[Callable[[DataFrame], DataFrame]] = []

    @property
    def sparkSession(self) -> SparkSession:
        return self.log.spark

    def transform(self, step: Callable[[DataFrame], DataFrame]) -> "LogStream":
        changed = copy.copy(self)
        changed._steps = [*self._steps, step]
        return changed

    def filter(self, condition: Column | str) -> "LogStream":
        return self.transform(lambda batch: batch.filter(condition))

    where = filter

    def select(self, *columns) -> "LogStream":
        return self.transform(lambda batch: batch.select(*columns, *{BATCH}.intersection(batch.columns).difference(columns)))

    def drop(self, *columns: str) -> "LogStream":
        return self.transform(lambda batch: batch.drop(*columns))

    def withColumn(self, name: str, column: Column) -> "LogStream":
        return self.transform(lambda batch: batch.withColumn(name, column))

    def begin_at(self, offsets: dict[tuple[str, int], int]) -> "LogStream":
        """Only these partitions, from these offsets on."""
        changed = copy.copy(self)
        changed.begin = dict(offsets)
        return changed

    def together(self, offsets: int = TRIGGER_OFFSETS) -> "LogStream":
        """Several batches in one trigger, as many as hold ``offsets`` offsets of all partitions.

        The batches are those that would be delivered one by one, if the log
        isn't written meanwhile: at most ``max_records`` offsets of a partition
        each. A handler gets the records of all with their batch number in
        ``_batch``, and the range of numbers instead of one. They are done, or
        delivered again, as a whole.
        """
        if "_batch" in self.log.schema.names:
            raise ValueError("the records have a column _batch already")
        changed = copy.copy(self)
        changed.several = offsets
        return changed

    def _in_batches(self, records: DataFrame, ranges: list[tuple], numbers: range) -> DataFrame:
        """Records with the number of their batch, from their place in the range of their partition."""
        first = F.lit(numbers[0]).cast("long")
        if len(numbers) == 1:
            return records.withColumn(BATCH, first)
        begins = self.log.spark.createDataFrame([r[:3] for r in ranges], "topic string, partition int, _begin long")
        number = first + whole_div(F.col("offset") - F.col("_begin"), self.max_records)
        return off.join_small(records, begins).select(*records.columns, number.alias(BATCH))

    def batch(self, ranges: list[tuple], numbers: range) -> DataFrame:
        """The records of a trigger."""
        records = self.log.in_ranges(ranges)
        if self.several is not None:
            records = self._in_batches(records, ranges, numbers)
        for step in self._steps:
            records = step(records)
        if self.several is not None and BATCH not in records.columns:
            raise ValueError(f"keep the column {BATCH}: it tells the batches apart")
        return records

    def start(self, handle: Callable[[DataFrame, int | range], None], checkpoint: str, interval: str | None = None):
        spark = self.log.spark
        spark.dataSource.register(RangeSource)
        begin = None if self.begin is None else sorted([t, p, o] for (t, p), o in self.begin.items())
        spec = {"path": self.log.path, "topics": self.topics, "max_records": self.max_records, "begin": begin, "together": self.several}
        ranges = spark.readStream.format(FORMAT).option("spec", json.dumps(spec)).load()

        def deliver(found: DataFrame, trigger: int) -> None:
            rows = [tuple(row) for row in found.collect()]
            before, after = next(row[2:] for row in rows if row[0] is None)
            numbers = range(trigger + before, trigger + after + 1)
            batch = self.batch([row for row in rows if row[0] is not None], numbers)
            handle(batch, numbers[-1] if self.several is None else numbers)

        writer = ranges.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        query = writer.trigger(processingTime=interval or "0 seconds").start()
        return query if interval else UpToNow(query)
