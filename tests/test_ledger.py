"""Whole appends, open transactions, fencing, the folded ledger, the time index and streams bounded by the ledger."""

import json
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from streamlog.model import struct_of
from streamlog.operators import offsets as off
from streamlog.plans import fixtures as fx
from streamlog.session import scratch_path
from streamlog.sinks import log as sink
from streamlog.sinks.log import Fenced, LogTransaction, SecondWriter, append, create_log, publish, send
from streamlog.sources import ledger as books
from streamlog.sources.topic_log import TopicLog
from streamlog.streaming import consume, relay

SF_DIR = "/root/testdata/sf0.001"
VALUES = struct_of(
    topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(), timestamp=T.TimestampType(),
    key=T.StringType(), value=T.StringType(),
)
GIVEN = "topic string, partition int, timestamp timestamp, key string, value string"


def some(spark, *values, topic="t"):
    return spark.createDataFrame([(topic, 0, None, None, v) for v in values], GIVEN)


def fresh(spark, name="log"):
    return create_log(spark, scratch_path(spark, name), VALUES)


def stored(log):
    return rows(log.records().select("topic", "offset", "value"))


def breaking(monkeypatch, where="_read_back"):
    """Appends break off after their data were written."""
    def lost(*args, **kwargs):
        raise OSError("lost before the commit")

    monkeypatch.setattr(sink, where, lost)


def read_all(stream, checkpoint):
    """Offsets and values of each batch of a stream."""
    seen = []
    consume.start(stream, lambda b, i: seen.append(rows(b.select("topic", "partition", "offset", "value"))), checkpoint).awaitTermination()
    return seen


def test_a_broken_append_is_never_read_whatever_follows(spark):
    log = fresh(spark)
    append(some(spark, "a"), log, ["value"])
    with pytest.MonkeyPatch.context() as broken:
        breaking(broken)
        with pytest.raises(OSError):
            append(some(spark, "b").unionByName(some(spark, "never committed", topic="u")), log, ["value"], batch_id="two")
    assert stored(log) == stored(log.isolated("read_uncommitted")) == [("t", 0, "a")]
    append(some(spark, "c"), log, ["value"], batch_id="another")
    assert stored(log) == stored(log.isolated("read_uncommitted")) == [("t", 0, "a"), ("t", 1, "c")]
    assert rows(log.end_offsets()) == [("t", 0, 2)]
    append(some(spark, "b"), log, ["value"], batch_id="two")
    assert stored(log) == [("t", 0, "a"), ("t", 1, "c"), ("t", 2, "b")]


def test_a_broken_append_before_an_abort(spark):
    log = fresh(spark)
    with pytest.MonkeyPatch.context() as broken:
        breaking(broken)
        with pytest.raises(OSError):
            append(some(spark, "broken"), log, ["value"])
    unit = LogTransaction(log, ["value"], "one")
    unit.send(some(spark, "aborted"))
    unit.abort()
    assert stored(log) == []
    assert stored(log.isolated("read_uncommitted")) == [("t", 0, "aborted")]
    assert log.book.give_up() and not log.book.state().pending
    assert stored(log.isolated("read_uncommitted")) == [("t", 0, "aborted")]


def test_a_stream_gives_only_what_is_committed(spark):
    log, checkpoint = fresh(spark), scratch_path(spark, "checkpoint")
    append(some(spark, "a"), log, ["value"])
    with pytest.MonkeyPatch.context() as broken:
        breaking(broken)
        with pytest.raises(OSError):
            append(some(spark, "broken"), log, ["value"])
    unit = LogTransaction(log, ["value"], "aborted")
    unit.send(some(spark, "x"))
    assert read_all(log.stream(), checkpoint) == [[("t", 0, 0, "a")]]
    unit.abort()
    append(some(spark, "b"), log, ["value"])
    assert sum(read_all(log.stream(), checkpoint), []) == [("t", 0, 2, "b")]


def test_what_is_sent_twice_is_there_once(spark):
    log = fresh(spark)
    failed = some(spark, "bad").withColumn("error", F.lit("no")).unionByName(some(spark, "a").withColumn("error", F.lit(None).cast("string")))
    first = rows(send(failed, log, ["value"], batch_id=7))
    assert rows(send(failed, log, ["value"], batch_id=7)) == first
    assert rows(send(some(spark, "c"), log, ["value"], batch_id=7, producer="other")) == [(7, "t", 0, 1, "success", None)]
    assert stored(log) == [("t", 0, "a"), ("t", 1, "c")]


def test_a_source_that_changes_is_refused(spark):
    log = fresh(spark)
    seen = []

    def changing(batches):
        import time
        for batch in batches:
            yield batch.slice(0, 1 + int(time.time_ns() // 1000 % max(1, batch.num_rows)))

    many = spark.range(5000, numPartitions=4).selectExpr("'t' topic", "0 partition", "timestamp'2024-01-01' timestamp", "'k' key", "cast(id as string) value")
    with pytest.raises(RuntimeError, match="same each time"):
        append(many.mapInArrow(changing, many.schema), log, ["value"])
    assert stored(log) == [] and not seen


def test_a_source_is_read_twice(spark):
    log, read = fresh(spark), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = some(spark, *[f"v{i}" for i in range(40)])
    append(source.mapInArrow(counted, source.schema), log, ["value"])
    assert read.value <= 2 * 40
    assert len(stored(log)) == 40


def test_two_writers_at_once(spark, monkeypatch):
    """The one that enters second is refused; nothing is lost and nothing there twice."""
    log, waiting, go_on = fresh(spark), threading.Event(), threading.Event()
    read_back, failures = sink._read_back, []

    def slow(log, number, ranges):
        if threading.current_thread() is not threading.main_thread():
            waiting.set()
            go_on.wait(60)
        return read_back(log, number, ranges)

    monkeypatch.setattr(sink, "_read_back", slow)

    def late():
        try:
            append(some(spark, "late"), TopicLog.open(spark, log.path), ["value"])
        except SecondWriter as problem:
            failures.append(problem)

    thread = threading.Thread(target=late)
    thread.start()
    assert waiting.wait(60)
    append(some(spark, "first"), log, ["value"])
    go_on.set()
    thread.join(60)
    assert failures and stored(log) == [("t", 0, "first")]
    append(some(spark, "late", topic="u"), log, ["value"])
    assert len(stored(log)) == 2


def test_an_older_writer_is_fenced(spark):
    log = fresh(spark)
    old = LogTransaction(log, ["value"], "one", writer="w")
    old.send(some(spark, "old"))
    new = LogTransaction(log, ["value"], "two", writer="w")
    with pytest.raises(Fenced):
        old.send(some(spark, "more"))
    with pytest.raises(Fenced):
        old.commit()
    new.send(some(spark, "new"))
    new.commit()
    assert stored(log) == [("t", 1, "new")]
    assert stored(log.isolated("read_uncommitted")) == [("t", 0, "old"), ("t", 1, "new")]


def test_open_transactions_hold_back_what_follows(spark):
    log = fresh(spark)
    append(some(spark, "a"), log, ["value"])
    unit = LogTransaction(log, ["value"], "open")
    unit.send(some(spark, "b"))
    append(some(spark, "c").unionByName(some(spark, "other", topic="u")), log, ["value"])
    unit.send(some(spark, "d"))
    assert stored(log) == [("t", 0, "a"), ("u", 0, "other")]
    assert rows(log.end_offsets()) == [("t", 0, 1), ("u", 0, 1)]
    everything = log.isolated("read_uncommitted")
    assert [v for _, _, v in stored(everything)] == ["a", "b", "c", "d", "other"]
    assert rows(everything.end_offsets()) == [("t", 0, 4), ("u", 0, 1)]
    assert rows(log.seek({("t", 0): 0}).select("value")) == [("a",)]
    with pytest.MonkeyPatch.context() as few:
        few.setattr(off, "LITERAL_LIMIT", 0)
        assert stored(log) == [("t", 0, "a"), ("u", 0, "other")]
    unit.commit()
    assert [v for _, _, v in stored(log)] == ["a", "b", "c", "d", "other"]
    again = LogTransaction(log, ["value"], "open")
    again.send(some(spark, "b"))
    assert rows(again.commit()) == [("t", 0, 1, 2), ("t", 0, 3, 4)]
    assert len(stored(log)) == 5


def test_records_and_source_offsets_are_one_entry(spark):
    log = fresh(spark)
    unit = LogTransaction(log, ["value"], "one")
    unit.send(some(spark, "a"))
    unit.send_offsets(off.of(spark, {("s", 0): 5}), "g")
    assert rows(log.committed("g")) == []
    unit.commit()
    assert rows(log.committed("g")) == [("s", 0, 5)]
    lost = LogTransaction(log, ["value"], "two")
    lost.send(some(spark, "b"))
    lost.send_offsets(off.of(spark, {("s", 0): 9}), "g")
    lost.abort()
    assert rows(log.committed("g")) == [("s", 0, 5)] and rows(log.committed("h")) == []
    with pytest.raises(ValueError, match="each partition once"):
        LogTransaction(log, ["value"], "three").send_offsets(off.of(spark, {("s", 0): 9}).union(off.of(spark, {("s", 0): 8})), "g")


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_relay_goes_on_from_the_offsets_of_its_log(spark, monkeypatch, moment):
    source = publish(fx.event_records(spark, SF_DIR), scratch_path(spark, "source"), ["timestamp", "event_id"])
    target = create_log(spark, scratch_path(spark, "target"), source.schema)
    commit, broken = LogTransaction.commit, []

    def once(self):
        if not broken and self.log.path == target.path and "#1" in self.batch_id:
            broken.append(True)
            if moment == "after":
                commit(self)
            raise OSError("lost")
        return commit(self)

    monkeypatch.setattr(LogTransaction, "commit", once)

    def run(checkpoint):
        stream = source.stream(max_records=20)
        relay.relay_with_offsets(stream, lambda b: b.drop("offset"), target, ["timestamp", "event_id"], "g", checkpoint).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(scratch_path(spark, "checkpoint"))
    assert target.records().count() < 1000
    # A new checkpoint: the stream begins at the beginning, the log knows where to go on.
    run(scratch_path(spark, "checkpoint"))
    assert rows(target.records().select("topic", "partition", "event_id")) == rows(source.records().select("topic", "partition", "event_id"))
    assert rows(target.committed("g")) == rows(source.end_offsets())


@pytest.fixture(scope="module")
def log(spark):
    return publish(fx.event_records(spark, SF_DIR), scratch_path(spark, "events"), ["timestamp", "event_id"], segment_rows=10)


@pytest.mark.parametrize("bound", [7, 1000])
def test_batches_are_bounded_by_records(log, spark, bound):
    seen = read_all(log.stream(max_records=bound), scratch_path(spark, "checkpoint"))
    largest = max(log.records().groupBy("topic", "partition").count().toPandas()["count"])
    assert len([s for s in seen if s]) == -(-largest // bound)
    for batch in seen:
        for key in {r[:2] for r in batch}:
            assert len([r for r in batch if r[:2] == key]) <= bound
    assert sorted(sum(seen, [])) == rows(log.records().select("topic", "partition", "offset", "value"))


def test_a_stopped_stream_goes_on_where_it_was(log, spark):
    checkpoint, seen = scratch_path(spark, "checkpoint"), []

    def handle(batch, batch_id):
        if len(seen) in (2, 4):
            seen.append([])
            raise InterruptedError("stopped")
        seen.append(rows(batch.select("topic", "partition", "offset")))

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            consume.start(log.stream(max_records=9), handle, checkpoint).awaitTermination()
    consume.start(log.stream(max_records=9), handle, checkpoint).awaitTermination()
    assert sorted(sum(seen, [])) == rows(log.records().select("topic", "partition", "offset"))
    before = len(seen)
    consume.start(log.stream(max_records=9), handle, checkpoint).awaitTermination()
    assert not sum(seen[before:], [])


def test_a_stream_lists_only_the_folders_of_its_ranges(log, spark):
    read = []
    consume.start(log.as_stream(max_records=10).subscribe(["click"]), lambda b, i: read.append(b.inputFiles()), scratch_path(spark, "c")).awaitTermination()
    assert all("topic=click" in f for files in read for f in files)
    first = {f.split("segment=")[1].split("/")[0] for f in read[0]}
    assert first == {"0"}


def test_a_stream_that_seeks_needs_no_batches_for_earlier_offsets(log, spark):
    seen = read_all(log.as_stream(max_records=10).seek({("click", 0): 40}), scratch_path(spark, "c"))
    assert [r[2] for r in seen[0]][0] == 40
    assert len(sum(seen, [])) == log.seek({("click", 0): 40}).count()


def test_a_running_stream_sees_later_appends(spark):
    own, seen = fresh(spark), []
    append(some(spark, "a"), own, ["value"])
    query = consume.start(own.stream(), lambda b, i: seen.extend(r.value for r in b.collect()), scratch_path(spark, "c"), interval="100 milliseconds")
    try:
        query.processAllAvailable()
        append(some(spark, "b"), own, ["value"])
        query.processAllAvailable()
    finally:
        query.stop()
    assert seen == ["a", "b"]


def test_a_read_costs_the_same_after_many_appends(spark, monkeypatch):
    monkeypatch.setattr(books, "CHECKPOINT_EVERY", 8)
    own = fresh(spark)
    book = own.book

    def entered(n):
        number = book.begin()
        book.end_append("commit", number, [["t", 0, n, n + 1]], [["t", 0, 0, n]], batch_id=f"b{n}")

    for n in range(100):
        entered(n)
    files = book.store.names(f"{book.root}/entries")
    assert len(files) <= 2 * 8 + 1 and len(book.store.names(f"{book.root}/folded")) <= 3
    assert book.known("b3") == [["t", 0, 3, 4]] and book.known("b99") == [["t", 0, 99, 100]] and book.known("b100") is None

    class Counting(books.Store):
        reads = 0

        def read(self, path):
            Counting.reads += 1
            return super().read(path)

    again = TopicLog.open(spark, own.path)
    again.book.store = Counting(spark)
    state = again.book.state()
    assert (state.ends, state.times, state.pending) == ({("t", 0): 100}, {("t", 0): {0: 99}}, {})
    assert Counting.reads <= 18
    assert json.loads(state.dump()) == json.loads(books.State.load(state.dump()).dump())
    with pytest.raises(SecondWriter):
        book.end_append("commit", book.begin(), [["t", 0, 5, 6]], [])


def test_appends_leave_no_scratch(spark):
    own = fresh(spark)
    for n in range(3):
        append(some(spark, f"v{n}"), own, ["value"])
    path = spark._jvm.org.apache.hadoop.fs.Path(own.path)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    assert not [f for f in files.listStatus(path.getParent()) if f.getPath().getName().startswith("append-")]
    assert stored(own) == [("t", n, f"v{n}") for n in range(3)]
    with pytest.raises(FileExistsError):
        create_log(spark, own.path, VALUES)


def at(n):
    return f"timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, {n})"


def test_a_time_is_looked_up_in_one_segment(spark):
    own = create_log(spark, scratch_path(spark, "timed"), VALUES, segment_rows=10)
    # Timestamps go back and forth between appends.
    for first in (100, 0, 300, 200):
        append(spark.range(first, first + 25).selectExpr("'t' topic", "0 partition", f"{at('id')} timestamp", "'k' key", "cast(id as string) value"), own, ["timestamp"])
    unit = LogTransaction(own, ["timestamp"], "aborted")
    unit.send(spark.range(900, 905).selectExpr("'t' topic", "0 partition", f"{at('id')} timestamp", "'k' key", "cast(id as string) value"))
    unit.abort()
    everything = own.records().cache()
    for asked in (0, 100, 118, 125, 210, 300, 324, 325, 901):
        when = F.expr(at(asked))
        expected = everything.filter(F.col("timestamp") >= when).agg(F.min("offset")).first()[0]
        found = own.offsets_for_times(when)
        assert rows(found) == [("t", 0, expected)]
        opened = {f.split("segment=")[1].split("/")[0] for f in found.inputFiles()}
        assert len(opened) <= 1
    assert rows(own.isolated("read_uncommitted").offsets_for_times(F.expr(at(901)))) == [("t", 0, 101)]
    assert rows(own.seek_times(F.expr(at(320))).select("offset")) == [(n,) for n in range(70, 100)]
    everything.unpersist()


def test_numbering_with_and_without_buckets_is_the_same(spark, monkeypatch):
    found = []
    for bucket_rows in (2_000_000, 10):
        monkeypatch.setattr(sink, "BUCKET_ROWS", bucket_rows)
        own = create_log(spark, scratch_path(spark, "numbered"), fx.event_log(spark, SF_DIR).schema)
        source = fx.event_records(spark, SF_DIR)
        append(source.filter("event_id % 2 = 0"), own, ["timestamp", "event_id"])
        append(source.filter("event_id % 2 = 1"), own, ["timestamp", "event_id"])
        found.append(rows(own.records().select("topic", "partition", "offset", "event_id")))
    assert found[0] == found[1]
