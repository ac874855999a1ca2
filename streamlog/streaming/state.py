"""State and source offsets kept together in the user's own store.

A batch writes only what it adds to its own keys, as a run, and then one small
file ``current/N`` that names the runs the state consists of. A batch whose file
exists is passed over, so each is applied once. ``FAN_IN`` runs of one size are
merged to a larger one, so every update is written again a few times only, and
there are few runs to read, whatever the number of batches and keys. Rows carry a
hash bucket of their key and are sorted by it: a look-up of some keys skips the
row groups of other buckets. Runs that the last ``keep`` states use stay, so that
what was read from the store can still be read while later batches are applied.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamlog.model import TOPIC_PARTITION, struct_of
from streamlog.session import remove
from streamlog.sources.ledger import Store
from streamlog.sources.ranges import BATCH, LogStream
from streamlog.streaming import consume
from streamlog.streaming.transactions import claim

#: In an update: number of the batch a row comes from. Greater is newer; initial state has -1.
FRESH = "_fresh"
BUCKET = "_bucket"
BUCKETS = 256
#: Runs of one level that are merged to one of the next.
FAN_IN = 8


class StateStore:
    """Keyed state on a shared path, with one writer.

    ``update`` maps each state column to an aggregate over new records and the
    aggregate that merges stored ones, e.g. ``{"n": (F.count(F.lit(1)), F.sum)}``.
    The merging aggregate must give the same whatever neighbours are merged
    first; it can use the column ``_fresh``. ``initial`` is state from elsewhere:
    what it has for a key is taken over when the key first appears.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        update: Mapping[str, tuple[Column, Callable[[str], Column]]],
        keep: int = 16,
        initial: DataFrame | None = None,
    ):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.keys = keys
        self.update = dict(update)
        self.keep = keep
        self.initial = initial
        self._files = Store(spark)
        self._known: int | None = None

    def _current(self) -> int:
        """Number of the last applied batch; -1 before the first."""
        return max((int(name) for name in self._files.names(f"{self.path}/current")), default=-1)

    def _runs(self, batch_id: int) -> list[list[int]]:
        """``[level, first batch, last batch]`` of the runs after a batch, oldest first."""
        text = self._files.read(f"{self.path}/current/{batch_id}") if batch_id >= 0 else None
        return [] if text is None else json.loads(text)

    def _run_path(self, run: list[int]) -> str:
        return f"{self.path}/runs/{run[0]}-{run[1]}-{run[2]}"

    def _rows(self, runs: list[list[int]]) -> DataFrame:
        """Rows of some runs as they were written."""
        fields = [*self.schema.fields, *struct_of(**{FRESH: T.LongType(), BUCKET: T.IntegerType()}).fields]
        if not runs:
            return self.spark.createDataFrame([], T.StructType(fields))
        return self.spark.read.schema(T.StructType(fields)).parquet(*map(self._run_path, runs))

    def _merged(self, rows: DataFrame) -> DataFrame:
        merges = [merge(name).alias(name) for name, (_, merge) in self.update.items()]
        return rows.groupBy(*self.keys).agg(*merges, F.max(FRESH).alias(FRESH), F.max(BUCKET).alias(BUCKET))

    def _state(self, runs: list[list[int]]) -> DataFrame:
        rows = self._rows(runs)
        return rows if len(runs) < 2 else self._merged(rows)

    def read(self) -> DataFrame:
        """State after the last applied batch."""
        return self._state(self._runs(self._current())).select(*self.schema.names)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """State of the given keys only; buckets of none of them are skipped."""
        return self._found(self._runs(self._current()), keys).select(*self.schema.names)

    def _found(self, runs: list[list[int]], keys: DataFrame) -> DataFrame:
        wanted = keys.select(*self.keys).distinct()
        buckets = [r[0] for r in wanted.select(self._bucket()).distinct().collect()]
        rows = self._rows(runs).filter(F.col(BUCKET).isin(buckets)).join(wanted, self.keys, "left_semi")
        return self._merged(rows)

    def next_id(self) -> int:
        """A batch number no batch has had yet, for updates that may be repeated."""
        self._known = self._current() if self._known is None else self._known
        return self._known + 1

    def apply(self, records: DataFrame, batch_id: int) -> bool:
        """Merge one batch into the state; False if it had been applied before.

        Batch numbers grow, and there is one writer, so the markers are listed
        only at its start and after a failure. Records of several batches, told
        apart by ``_batch``, are applied as if one by one; ``batch_id`` is the
        number of the last.
        """
        last = self._known = self._current() if self._known is None else self._known
        if batch_id <= last:
            return False
        runs = self._runs(last)
        several = BATCH in records.columns
        if not several:
            records = records.withColumn(BATCH, F.lit(batch_id).cast("long"))
        fresh = records.groupBy(BATCH, *self.keys).agg(*[aggregate.alias(name) for name, (aggregate, _) in self.update.items()])
        fresh = fresh.select(*self.schema.names, F.col(BATCH).alias(FRESH), self._bucket().alias(BUCKET))
        if several:
            fresh = self._merged(fresh).select(*self.schema.names, FRESH, BUCKET)
        self._known = None
        if self.initial is not None:
            fresh = self._with_initial(fresh, runs)
        runs = self._write(fresh, [0, batch_id, batch_id], runs)
        while len(runs) >= FAN_IN and len({level for level, _, _ in runs[-FAN_IN:]}) == 1:
            old = runs[-FAN_IN:]
            runs = self._write(self._merged(self._rows(old)), [old[0][0] + 1, old[0][1], old[-1][2]], runs[:-FAN_IN])
        self._files.put(f"{self.path}/current/{batch_id}", json.dumps(runs))
        self._known = batch_id
        if batch_id // self.keep > last // self.keep:
            self._forget()
        return True

    def _with_initial(self, fresh: DataFrame, runs: list[list[int]]) -> DataFrame:
        """The batch with the initial state of the keys that are new."""
        new = fresh.join(self._found(runs, fresh).select(*self.keys), self.keys, "left_anti").select(*self.keys)
        found = self.initial.join(new, self.keys, "left_semi").select(
            *self.schema.names, F.lit(-1).cast("long").alias(FRESH), self._bucket().alias(BUCKET)
        )
        return self._merged(fresh.unionByName(found))

    def _write(self, rows: DataFrame, run: list[int], before: list[list[int]]) -> list[list[int]]:
        ordered = rows.select(*self.schema.names, FRESH, BUCKET).sortWithinPartitions(BUCKET)
        ordered.write.mode("overwrite").parquet(self._run_path(run))
        return [*before, run]

    def _forget(self) -> None:
        """Remove the markers older than the last ``keep``, and the runs that none of those uses."""
        known = sorted(int(name) for name in self._files.names(f"{self.path}/current"))
        old, kept = known[: -self.keep], known[-self.keep :]
        used = {tuple(run) for batch_id in kept for run in self._runs(batch_id)}
        for run in {tuple(run) for batch_id in old for run in self._runs(batch_id)} - used:
            remove(self.spark, self._run_path(list(run)))
        for batch_id in old:
            self._files.delete(f"{self.path}/current/{batch_id}")


def counts_store(spark: SparkSession, path: str, initial: DataFrame | None = None) -> StateStore:
    """Number of records and next offset per topic partition."""
    schema = struct_of(topic=T.StringType(), partition=T.IntegerType(), n=T.LongType(), offset=T.LongType())
    return StateStore(
        spark, path, schema, TOPIC_PARTITION,
        {"n": (F.count(F.lit(1)), F.sum), "offset": (F.max("offset") + 1, F.max)}, initial=initial,
    )


def run(stream: DataFrame | LogStream, store: StateStore, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Apply every micro-batch of a stream to the store; those of a log several at a time."""

    claim(stream.sparkSession, store.path, checkpoint)
    if isinstance(stream, LogStream) and BATCH not in stream.log.schema.names:
        stream = stream.together()

    def handle(batch: DataFrame, number: int | range) -> None:
        store.apply(batch, number[-1] if isinstance(number, range) else number)

    return consume.start(stream, handle, checkpoint, interval)


def load_for(state: DataFrame, partitions: DataFrame) -> DataFrame:
    """State of the partitions that are newly assigned."""
    return state.join(partitions.select(*TOPIC_PARTITION), TOPIC_PARTITION, "left_semi")
