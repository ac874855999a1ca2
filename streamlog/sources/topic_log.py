"""A topic log kept as Parquet, read like a subscriber reads a broker.

Layout: ``<path>/data/topic=T/partition=P/segment=S/append_no=N``, where segment
S holds the offsets from ``S * segment_rows`` on. Reads turn offsets into literal
predicates on these folders, so a seek opens only the files it needs.

``<path>/ledger`` says which appends count, see :mod:`streamlog.sources.ledger`:
ends, partitions, segments and the latest time of each segment come from it,
without a look at the data.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.functions.numbers import epoch_micros, whole_div
from streamlog.model import OFFSETS_SCHEMA, TOPIC_PARTITION, struct_of
from streamlog.operators import offsets as off
from streamlog.operators.records import expect_at_least
from streamlog.session import read_or_empty
from streamlog.sources.ledger import Ledger, State
from streamlog.sources.ranges import LogStream

SEGMENT_ROWS = 10_000_000

FOLDER_FIELDS = struct_of(
    topic=T.StringType(), partition=T.IntegerType(), segment=T.LongType(), append_no=T.LongType()
).fields
FOLDERS = [field.name for field in FOLDER_FIELDS]
_ENDS_SCHEMA = struct_of(
    topic=T.StringType(), partition=T.IntegerType(), begin_offset=T.LongType(), end_offset=T.LongType()
)


class PastTheEnd(LookupError):
    """A partition has no record at or after the asked time."""


def _any_of(conditions: Iterable[str]) -> Column:
    """OR of SQL conditions; one expression, since hundreds of Column calls take seconds to build."""
    return F.expr(" OR ".join(f"({condition})" for condition in conditions) or "false")


def _is(topic: str, partition: int) -> str:
    # Written in hex, a name needs no quoting whatever it contains.
    return f"topic = CAST(X'{topic.encode().hex()}' AS STRING) AND partition = {int(partition)}"


def _range_holds() -> Column:
    """Whether a row lies between the joined ``_begin`` and ``_end``; no end if that is NULL."""
    return (F.col("offset") >= F.col("_begin")) & (F.col("_end").isNull() | (F.col("offset") < F.col("_end")))


def _folder_key() -> Column:
    return F.concat_ws("/", "topic", "partition", "segment")


class TopicLog:
    """A stored log; every read method returns a lazy DataFrame of records."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, segment_rows: int):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.segment_rows = segment_rows
        self.isolation = "read_committed"
        self.book = Ledger(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "TopicLog":
        text = Ledger(spark, path).store.read(f"{path}/meta")
        if text is None:
            raise FileNotFoundError(f"there is no log at {path}")
        meta = json.loads(text)
        return cls(spark, path, T.StructType.fromJson(meta["fields"]), meta["segment_rows"])

    def exists(self) -> bool:
        """Whether the log is still stored."""
        return self.book.store.exists(f"{self.path}/meta")

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    def isolated(self, level: str) -> "TopicLog":
        """The same log read at an isolation level.

        ``read_committed`` gives the records of committed appends up to the
        first transaction that is still open in their partition,
        ``read_uncommitted`` also those of open and aborted ones. What a broken
        append left is never read.
        """
        if level not in ("read_committed", "read_uncommitted"):
            raise ValueError(f"unknown isolation level {level!r}")
        log = copy.copy(self)
        log.isolation = level
        return log

    def _stored(self, topics: Iterable[str] | None = None) -> DataFrame:
        """Stored rows; with ``topics`` only their folders are listed."""
        return self._in_folders([""] if topics is None else [f"topic={self._folder(t)}" for t in sorted(set(topics))])

    def _folder(self, topic: str) -> str:
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(topic)

    def _in_folders(self, folders: list[str]) -> DataFrame:
        """Stored rows of some folders; one that isn't there has none."""
        # Types are given: a topic named "007" must not be read as a number.
        reader = self.spark.read.schema(self.schema).option("basePath", self.data_path)
        try:
            return reader.parquet(*[f"{self.data_path}/{folder}".rstrip("/") for folder in folders])
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
        there = [f for f in folders if self.book.store.exists(f"{self.data_path}/{f}".rstrip("/"))]
        return self._in_folders(there) if there else self.spark.createDataFrame([], self.schema)

    def _visible(self, stored: DataFrame) -> DataFrame:
        """What the log's isolation level lets a reader see."""
        state = self.book.state()
        stored = stored.filter(F.col("append_no") <= state.version)
        hidden = state.unread(self.isolation)
        if hidden:
            stored = stored.filter(~F.col("append_no").isin(hidden))
        first = state.first_open() if self.isolation == "read_committed" else {}
        if not first:
            return stored
        if len(first) <= off.LITERAL_LIMIT:
            return stored.filter(~_any_of(f"{_is(t, p)} AND offset >= {o}" for (t, p), o in first.items()))
        limits = off.of(self.spark, first).withColumnRenamed("offset", "_limit")
        return off.join_small(stored, limits, "left").filter("_limit IS NULL OR offset < _limit").drop("_limit")

    def _source(self, topics: Iterable[str] | None = None) -> DataFrame:
        """What the subscriptions below read from."""
        return self._visible(self._stored(topics))

    def _table(self, topics: Iterable[str] | None = None) -> DataFrame:
        """The source as a table, also for a streamed log."""
        return TopicLog._source(self, topics)

    def _segment_folders(self, rows: Iterable[tuple[str, int, int, int]]) -> list[str]:
        """Folders that hold the offsets of ``topic, partition, begin, end``."""
        return [
            f"topic={self._folder(topic)}/partition={partition}/segment={segment}"
            for topic, partition, begin, end in rows if end > begin
            for segment in range(begin // self.segment_rows, (end - 1) // self.segment_rows + 1)
        ]

    def in_ranges(self, rows: list[tuple[str, int, int, int]]) -> DataFrame:
        """Visible records of ``topic, partition, begin, end``, with their folders; only those folders are listed."""
        folders = self._segment_folders(rows)
        stored = TopicLog._visible(self, self._in_folders(folders) if folders else self.spark.createDataFrame([], self.schema))
        if len(rows) <= off.LITERAL_LIMIT:
            return stored.filter(_any_of(f"{_is(t, p)} AND {self._inside(b, e)}" for t, p, b, e in rows))
        ranges = self.spark.createDataFrame(rows, "topic string, partition int, _begin long, _end long")
        return off.join_small(stored, ranges).filter(_range_holds()).select(*self.schema.names)

    def _present(self, stored: DataFrame) -> DataFrame:
        columns = [c for c in self.schema.names if c not in FOLDERS]
        return stored.select(*TOPIC_PARTITION, *columns)

    def records(self) -> DataFrame:
        """All records."""
        return self._present(self._source())

    def is_empty(self) -> bool:
        """Whether no append has ended yet."""
        return not self.book.state().ends

    def _ends(self, state: State) -> dict[tuple[str, int], int]:
        return state.stable_ends() if self.isolation == "read_committed" else state.ends

    def _bounds(self, topic: str | None = None) -> DataFrame:
        """``topic, partition, begin_offset, end_offset`` from the ledger."""
        state = self.book.state()
        rows = [(t, p, state.begins[t, p], end) for (t, p), end in self._ends(state).items() if topic in (None, t)]
        return self.spark.createDataFrame(rows, _ENDS_SCHEMA)

    def segments(self) -> DataFrame:
        """``topic, partition, segment`` of all records, from the ledger."""
        first, last = (whole_div(c, self.segment_rows) for c in (F.col("begin_offset"), F.col("end_offset") - 1))
        return self._bounds().filter("end_offset > begin_offset").select(
            *TOPIC_PARTITION, F.explode(F.sequence(first, last)).alias("segment")
        )

    def partitions(self) -> DataFrame:
        """The existing topic partitions; no record is read."""
        return self._bounds().select(*TOPIC_PARTITION)

    def assigned(self, topics: Iterable[str] | None = None) -> list[tuple[str, int]]:
        """Partitions as a list, as a consumer knows its assignment."""
        found = self.partitions()
        if topics is not None:
            found = found.filter(F.col("topic").isin(list(topics)))
        return sorted((r["topic"], r["partition"]) for r in found.toLocalIterator())

    # -- where the log begins and ends ------------------------------------

    def end_offsets(self) -> DataFrame:
        """End of every partition, from the ledger; what aborted transactions wrote counts.

        Readers of committed records end where the first open transaction begins.
        """
        return self._bounds().select(*TOPIC_PARTITION, F.col("end_offset").alias("offset"))

    def partitions_for(self, topic: str) -> DataFrame:
        """Begin and end offset of each partition of a topic, from the ledger."""
        return self._bounds(topic)

    def committed(self, group_id: str) -> DataFrame:
        """Source offsets that a group has committed together with records of this log."""
        return off.of(self.spark, self.book.state().groups.get(group_id, {}))

    def offsets_for_times(self, times: Column | DataFrame) -> DataFrame:
        """First offset at or after a time per partition, NULL past the end.

        The ledger has the latest time of each segment, so the first segment
        that is late enough is the only one of its partition to be opened.
        """
        if "timestamp" not in self.schema.names:
            raise ValueError("the records have no timestamp")
        kind = self.schema["timestamp"].dataType
        if isinstance(times, DataFrame):
            asked = times.select(*TOPIC_PARTITION, F.col("timestamp").cast(kind).alias("timestamp"))
        else:
            asked = self.partitions().withColumn("timestamp", times.cast(kind))
        micros = epoch_micros("timestamp", kind)
        wanted = asked.select(*TOPIC_PARTITION, micros.alias("at")).toLocalIterator()
        state = self.book.state()
        ends, rows = self._ends(state), []
        known = state.times if self.isolation == "read_committed" else state.all_times
        for topic, partition, at in wanted:
            latest = known.get((topic, partition), {})
            late = None if at is None else min((s for s, time in latest.items() if time >= at), default=None)
            if late is not None:
                begin = late * self.segment_rows
                rows.append((topic, partition, begin, min(begin + self.segment_rows, ends[topic, partition])))
        # A segment may be late enough only by records that are not stable yet.
        rows = [r for r in rows if r[3] > r[2]]
        return off.offsets_for_times(self._present(self.in_ranges(rows)), asked)

    # -- subscriptions ----------------------------------------------------

    def subscribe(
        self,
        topics: Iterable[str],
        committed: DataFrame | None = None,
        reset: str = "latest",
        group_id: str | None = None,
    ) -> DataFrame:
        """All partitions of the topics, from the committed offsets on.

        Without a commit table the whole topics are read. With one, partitions
        that are not in it start where ``reset`` says; a table that holds
        several groups needs ``group_id``.
        """
        topics = list(topics)
        return self._start(F.col("topic").isin(topics), topics, committed, reset, group_id)

    def assign(
        self,
        partitions: Iterable[tuple[str, int]],
        committed: DataFrame | None = None,
        reset: str = "latest",
        group_id: str | None = None,
    ) -> DataFrame:
        """Named partitions only; commits and ``reset`` as for :meth:`subscribe`."""
        partitions = list(partitions)
        mine = _any_of(_is(topic, partition) for topic, partition in partitions)
        return self._start(mine, [topic for topic, _ in partitions], committed, reset, group_id)

    def _start(
        self, mine: Column, topics: list[str], committed: DataFrame | None, reset: str, group_id: str | None
    ) -> DataFrame:
        chosen = self._source(topics).filter(mine)
        if committed is None:
            return self._present(chosen)
        return self._resume(chosen, off.of_group(committed, group_id).filter(mine), reset)

    def resume(self, stored: DataFrame, reset: str = "earliest", group_id: str | None = None) -> DataFrame:
        """All topics, from offsets of the user's own store; partitions not in it follow ``reset``."""
        return self._resume(self._source(), off.of_group(stored, group_id), reset)

    def _resume(self, chosen: DataFrame, stored: DataFrame, reset: str) -> DataFrame:
        if reset not in ("earliest", "latest"):
            raise ValueError(f"unknown reset policy {reset!r}")
        rows = off.checked_rows(stored, off.LITERAL_LIMIT)
        if rows is None:
            start = stored.select(
                *TOPIC_PARTITION, F.col("offset").alias("_begin"), F.lit(None).cast("long").alias("_end")
            )
            return self._present(self._joined(chosen, start, "left" if reset == "earliest" else "inner"))
        wanted = _any_of(f"{_is(r['topic'], r['partition'])} AND {self._inside(r['offset'])}" for r in rows)
        known = _any_of(_is(r["topic"], r["partition"]) for r in rows)
        # A partition reset to latest has nothing to read yet.
        return self._present(chosen.filter(wanted | ~known if reset == "earliest" else wanted))

    def _inside(self, begin: int, end: int | None = None) -> str:
        """Offsets from ``begin`` up to before ``end``, with the segments that can hold them."""
        inside = f"segment >= {begin // self.segment_rows} AND offset >= {begin}"
        if end is not None:
            inside += f" AND segment <= {end // self.segment_rows} AND offset < {end}"
        return inside

    def _joined(self, source: DataFrame, ranges: DataFrame, how: str) -> DataFrame:
        """Rows of ``source`` inside the ranges, for more of them than fit a predicate.

        The ranges are first joined to the folder listing, so that the log is
        joined to the folders it has to open. ``left`` keeps partitions without
        a range whole.
        """
        begin, end = F.coalesce("_begin", F.lit(0)), F.col("_end")
        folders = self.segments().distinct().join(ranges, TOPIC_PARTITION, how).filter(
            (F.col("segment") >= whole_div(begin, self.segment_rows))
            & (end.isNull() | (F.col("segment") <= whole_div(end, self.segment_rows)))
        )
        return self._in_segments(source, folders.select(*TOPIC_PARTITION, "segment", begin.alias("_begin"), "_end")).filter(
            _range_holds()
        )

    @staticmethod
    def _in_segments(source: DataFrame, folders: DataFrame) -> DataFrame:
        """Join rows to ``topic, partition, segment, ...``; other folders are skipped while running.

        One key made of all three folder names lets Spark prune by their combination.
        """
        folders = folders.withColumn("_folder", _folder_key())
        fits = folders.limit(off.BROADCAST_LIMIT + 1).count() <= off.BROADCAST_LIMIT
        # Spark prunes by a table only if it is filtered.
        folders = folders.filter("segment >= 0").drop(*TOPIC_PARTITION, "segment")
        return source.join(F.broadcast(folders) if fits else folders, _folder_key() == F.col("_folder"))

    def _ranges(self, ranges: DataFrame) -> DataFrame:
        """Records of a table ``topic, partition, _begin, _end``; no end if that is NULL."""
        rows = off.checked_rows(ranges.select(*TOPIC_PARTITION, "_begin", "_end"), off.LITERAL_LIMIT)
        if rows is None:
            return self._present(self._joined(self._source(), ranges, "inner"))
        return self._literal_ranges(rows)

    def _literal_ranges(self, rows: Iterable[tuple[str, int, int, int | None]]) -> DataFrame:
        rows = list(rows)
        wanted = _any_of(f"{_is(topic, partition)} AND {self._inside(begin, end)}" for topic, partition, begin, end in rows)
        return self._present(self._source([row[0] for row in rows]).filter(wanted))

    def _from_offsets(self, offsets: Mapping[tuple[str, int], int] | DataFrame, length: int | None) -> DataFrame:
        """Records from each offset on, at most ``length`` per partition."""
        if isinstance(offsets, Mapping) and len(offsets) <= off.LITERAL_LIMIT:
            return self._literal_ranges(
                (topic, partition, begin, None if length is None else begin + length)
                for (topic, partition), begin in offsets.items()
            )
        begin = F.col("offset")
        end = F.lit(None).cast("long") if length is None else begin + length
        table = self.offsets_table(offsets)
        return self._ranges(table.select(*TOPIC_PARTITION, begin.alias("_begin"), end.alias("_end")))

    def offsets_table(self, offsets: Mapping[tuple[str, int], int] | DataFrame) -> DataFrame:
        return offsets if isinstance(offsets, DataFrame) else off.of(self.spark, offsets)

    def seek(self, offsets: Mapping[tuple[str, int], int] | DataFrame) -> DataFrame:
        """Only the partitions in ``offsets``, each from its offset on."""
        return self._from_offsets(offsets, None)

    def seek_times(self, times: Column | DataFrame, strategy: str = "latest") -> DataFrame:
        """From the first record at or after a time; ``strategy`` tells what to do past the end."""
        found = self.offsets_for_times(times)
        self._require_found(found, strategy)
        return self.seek(found.filter(F.col("offset").isNotNull()))

    @staticmethod
    def _require_found(found: DataFrame, strategy: str) -> None:
        if strategy == "error":
            missing = found.filter(F.col("offset").isNull()).first()
            if missing is not None:
                raise PastTheEnd(f"{missing['topic']}-{missing['partition']} has no record that late")
        elif strategy != "latest":
            raise ValueError(f"unknown strategy {strategy!r}")

    def bounded(
        self, max_records: int, start: Mapping[tuple[str, int], int] | DataFrame | None = None
    ) -> DataFrame:
        """One bounded batch: at most ``max_records`` per partition from ``start`` (default 0)."""
        if start is None:
            return self._present(self._source().filter(_any_of([self._inside(0, max_records)])))
        return self._from_offsets(start, max_records)

    def between(self, begin: DataFrame, end: DataFrame) -> DataFrame:
        """Per partition the offsets from ``begin`` (0 if it is not there) up to before ``end``."""
        off.checked_rows(begin.select(*TOPIC_PARTITION, "offset"), off.LITERAL_LIMIT)
        off.checked_rows(end.select(*TOPIC_PARTITION, "offset"), off.LITERAL_LIMIT)
        first = begin.select(*TOPIC_PARTITION, F.col("offset").alias("_first"))
        ranges = end.join(first, TOPIC_PARTITION, "left")
        return self._ranges(
            ranges.select(
                *TOPIC_PARTITION, F.coalesce("_first", F.lit(0)).alias("_begin"), F.col("offset").alias("_end")
            )
        )

    def consume(self, topic: str, expected: int) -> DataFrame:
        """Bounded read of a topic as pairs; raises if it has fewer records than expected."""
        return expect_at_least(self.subscribe([topic]), expected).select("key", "value")

    def as_stream(self, max_records: int | None = None) -> "StreamedLog":
        """The same log to be read as streams, with the same subscriptions.

        One micro-batch takes at most ``max_records`` offsets of each partition.
        """
        return StreamedLog(self, max_records)

    def stream(self, max_records: int | None = None) -> LogStream:
        """All committed records as a stream."""
        return self.as_stream(max_records).records()


class StreamedLog(TopicLog):
    """A log whose subscriptions give streams; offsets are still looked up in the table.

    The start of a stream must not change when it is restarted from its
    checkpoint. ``reset="latest"`` would, so it is refused: fix the start once
    with :func:`streamlog.operators.offsets.start_offsets` and pass that table.

    A stream delivers each committed record once and in the order of offsets;
    it stops before the first transaction that is open.
    """

    def __init__(self, log: TopicLog, max_records: int | None):
        super().__init__(log.spark, log.path, log.schema, log.segment_rows)
        if log.isolation != "read_committed":
            raise ValueError("a stream reads committed records")
        self.log, self.max_records = log, max_records

    def _source(self, topics: Iterable[str] | None = None) -> LogStream:
        return LogStream(self.log, None if topics is None else sorted(set(topics)), self.max_records)

    def _joined(self, source: LogStream, ranges: DataFrame, how: str) -> LogStream:
        inside = F.col("_begin").isNull() | _range_holds()
        return source.transform(lambda batch: off.join_small(batch, ranges, how).filter(inside))

    def _literal_ranges(self, rows: Iterable[tuple[str, int, int, int | None]]) -> LogStream:
        rows = list(rows)
        stream = super()._literal_ranges(rows)
        # Earlier offsets need no batches.
        return stream.begin_at({(topic, partition): begin for topic, partition, begin, _ in rows})

    def seek_times(
        self, times: Column | DataFrame, strategy: str = "latest", start_path: str | None = None
    ) -> DataFrame:
        """As for the table; partitions past the end begin at their present end.

        Where each partition begins is stored at ``start_path`` when the stream
        is first started and read from there afterwards: looked up again after
        a restart, an end would have moved past records not read yet.
        """
        if start_path is None:
            raise ValueError("a stream needs a fixed start: give start_path, a folder to keep it in")
        stored = read_or_empty(self.spark, start_path, OFFSETS_SCHEMA)
        if stored.isEmpty():
            found = self.log.offsets_for_times(times)
            self._require_found(found, strategy)
            ends = self.log.end_offsets().withColumnRenamed("offset", "_end")
            found = found.join(ends, TOPIC_PARTITION, "left")
            start = found.select(*TOPIC_PARTITION, F.coalesce("offset", "_end", F.lit(0)).alias("offset"))
            start.coalesce(1).write.mode("overwrite").parquet(start_path)
            stored = read_or_empty(self.spark, start_path, OFFSETS_SCHEMA)
        return self.seek(stored)

    def _resume(self, chosen: DataFrame, stored: DataFrame, reset: str) -> DataFrame:
        if reset == "latest":
            raise ValueError("a stream needs a fixed start; resolve 'latest' with start_offsets")
        return super()._resume(chosen, stored, reset)
