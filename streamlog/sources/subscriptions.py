"""The ways to subscribe, independent of where the records come from.

The same subscription can be read from a stored log, as a batch or as a stream,
or turned into options of Spark's Kafka source.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.functions.numbers import from_epoch_micros
from streamlog.model import struct_of
from streamlog.operators import offsets as off
from streamlog.sources import kafka
from streamlog.sources.topic_log import TopicLog

Partition = tuple[str, int]
TIMES_SCHEMA = struct_of(topic=T.StringType(), partition=T.IntegerType(), millis=T.LongType())


@dataclass(frozen=True)
class AutoPartition:
    """All partitions of the topics, from the committed offsets."""

    topics: tuple[str, ...]

    def read(
        self, log: TopicLog, committed: DataFrame | None = None, reset: str = "latest", group_id: str | None = None
    ) -> DataFrame:
        return log.subscribe(self.topics, committed, reset, group_id)

    def kafka_options(self, reset: str = "latest") -> dict[str, str]:
        return {**kafka.subscribe(self.topics), "startingOffsets": reset}

    def advance(self, confirmed: Mapping[Partition, int] | None) -> Any:
        """The subscription to go on with after a failure: unchanged, the commits say where."""
        return self


@dataclass(frozen=True)
class AutoPartitionBasic(AutoPartition):
    """Like :class:`AutoPartition`. Spark keeps no position besides the committed one, so both read the same."""


@dataclass(frozen=True)
class AutoPartitionWithManualOffset:
    """All partitions of the topics, from offsets of the user's own store.

    ``load`` gets the assigned partitions and returns the offsets it knows;
    the others follow the commits or the reset policy.
    """

    topics: tuple[str, ...]
    load: Callable[[list[Partition]], Mapping[Partition, int]]

    def read(
        self, log: TopicLog, committed: DataFrame | None = None, reset: str = "latest", group_id: str | None = None
    ) -> DataFrame:
        stored = log.offsets_table(self.load(log.assigned(self.topics)))
        if committed is not None:
            stored = stored.unionByName(
                off.of_group(committed, group_id).join(stored, ["topic", "partition"], "left_anti")
                .select(*stored.columns)
            )
        return log.subscribe(self.topics, stored, reset)

    def kafka_options(self, partitions: list[Partition], reset: str = "latest") -> dict[str, str]:
        return kafka.subscribe_from_store(partitions, self.load(partitions), reset)

    def advance(self, confirmed: Mapping[Partition, int] | None) -> Any:
        return self


@dataclass(frozen=True)
class ManualPartition:
    """Named partitions, from the committed offsets; ``reached`` has those confirmed since."""

    partitions: tuple[Partition, ...]
    reached: Mapping[Partition, int] = field(default_factory=dict)

    def read(
        self, log: TopicLog, committed: DataFrame | None = None, reset: str = "latest", group_id: str | None = None
    ) -> DataFrame:
        if not self.reached:
            return log.assign(self.partitions, committed, reset, group_id)
        others = [p for p in self.partitions if p not in self.reached]
        return log.seek(self.reached).unionByName(log.assign(others, committed, reset, group_id))

    def kafka_options(self, reset: str = "latest") -> dict[str, str]:
        if self.reached:
            raise ValueError("Kafka options give offsets for all partitions or for none: advance with all of them")
        return {**kafka.assign(self.partitions), "startingOffsets": reset}

    def advance(self, confirmed: Mapping[Partition, int] | None) -> Any:
        """Confirmed partitions go on from their offsets, the others as before."""
        reached = {**self.reached, **(confirmed or {})}
        if not confirmed:
            return self
        return ManualOffset(reached) if set(self.partitions) <= set(reached) else replace(self, reached=reached)


@dataclass(frozen=True)
class ManualOffset:
    """Named partitions, each from a given offset."""

    offsets: Mapping[Partition, int]

    def read(self, log: TopicLog) -> DataFrame:
        return log.seek(self.offsets)

    def kafka_options(self) -> dict[str, str]:
        return kafka.seek(self.offsets)

    def advance(self, confirmed: Mapping[Partition, int] | None) -> Any:
        """Confirmed partitions move on, the others stay where they were."""
        return ManualOffset({**self.offsets, **confirmed}) if confirmed else self


@dataclass(frozen=True)
class ManualOffsetForTimes:
    """Named partitions, each from the first record at or after a time in epoch milliseconds."""

    times_ms: Mapping[Partition, int]
    strategy: str = "error"
    reached: Mapping[Partition, int] = field(default_factory=dict)

    def read(self, log: TopicLog, **start: str) -> DataFrame:
        """``start_path`` keeps the start of a stream, see :meth:`StreamedLog.seek_times`."""
        rows = [(topic, partition, ms) for (topic, partition), ms in self.times_ms.items() if (topic, partition) not in self.reached]
        times = log.spark.createDataFrame(rows, TIMES_SCHEMA)
        # A log without time zones is taken as UTC, whatever the session's zone is.
        at = from_epoch_micros(F.col("millis") * 1_000, log.schema["timestamp"].dataType)
        by_time = log.seek_times(times.select("topic", "partition", at.alias("timestamp")), self.strategy, **start)
        return log.seek(self.reached).unionByName(by_time) if self.reached else by_time

    def kafka_options(self) -> dict[str, str]:
        if self.reached:
            raise ValueError("Kafka options take times or offsets: advance with all partitions")
        return kafka.seek_times(self.times_ms, self.strategy)

    def advance(self, confirmed: Mapping[Partition, int] | None) -> Any:
        """Confirmed positions are offsets, not times; partitions without one still begin by time."""
        reached = {**self.reached, **(confirmed or {})}
        if not confirmed:
            return self
        return ManualOffset(reached) if set(self.times_ms) <= set(reached) else replace(self, reached=reached)
