import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from streamlog.model import struct_of
from streamlog.operators import offsets as off
from streamlog.operators import records as rec
from streamlog.plans import fixtures as fx
from streamlog.session import scratch_path
from streamlog.sinks.log import append, publish
from streamlog.streaming import commits, consume, relay, state, transactions

SF_DIR = "/root/testdata/sf0.001"
OUT = struct_of(topic=T.StringType(), key=T.StringType(), value=T.StringType())


@pytest.fixture(scope="module")
def log(spark):
    return publish(
        fx.event_records(spark, SF_DIR), scratch_path(spark, "log"), ["timestamp", "event_id"], segment_rows=25
    )


def to_output(batch):
    return rec.to_producer_records(batch, "copy")


def test_batches_carry_positions_and_a_restart_goes_on(spark, log):
    checkpoint = scratch_path(spark, "checkpoint")
    seen = []

    def handle(batch, offsets, batch_id):
        seen.append((batch_id, batch.count(), rows(offsets)))

    consume.start_with_offsets(log.stream(max_records=15), handle, checkpoint).awaitTermination()
    assert sum(n for _, n, _ in seen) == 1000
    reached = {}
    for _, _, offsets in seen:
        for t, p, o in offsets:
            reached[t, p] = max(o, reached.get((t, p), 0))
    assert rows(log.end_offsets()) == sorted((t, p, o) for (t, p), o in reached.items())
    before = len(seen)
    consume.start_with_offsets(log.stream(max_records=15), handle, checkpoint).awaitTermination()
    assert len(seen) == before


def test_a_failed_batch_is_delivered_again(spark, log):
    checkpoint = scratch_path(spark, "checkpoint")
    seen = []

    def failing(batch, batch_id):
        if batch_id == 1 and not any(b == "failed" for b in seen):
            seen.append("failed")
            raise RuntimeError("receiver is gone")
        seen.append(batch.count())

    with pytest.raises(StreamingQueryException):
        consume.start(log.stream(max_records=20), failing, checkpoint).awaitTermination()
    consume.start(log.stream(max_records=20), failing, checkpoint).awaitTermination()
    assert sum(n for n in seen if n != "failed") == 1000


@pytest.mark.parametrize("moment", ["before the manifest", "after the manifest"])
def test_relay_writes_every_record_once_despite_a_failure(spark, log, monkeypatch, moment):
    path, checkpoint = scratch_path(spark, "relay"), scratch_path(spark, "checkpoint")
    commit = transactions.Transaction.commit
    broken = []

    def breaking(self):
        if self.batch_id == 1 and not broken:
            broken.append(True)
            if moment == "after the manifest":
                commit(self)
            raise RuntimeError("lost while committing")
        commit(self)

    monkeypatch.setattr(transactions.Transaction, "commit", breaking)
    source = log.stream(max_records=20)
    place = lambda batch: batch.select("topic", "partition", "offset", "value")
    with pytest.raises(StreamingQueryException):
        relay.relay(source, place, path, checkpoint).awaitTermination()
    schema = struct_of(topic=T.StringType(), partition=T.IntegerType(), offset=T.LongType(), value=T.StringType())
    partly = transactions.read(spark, path, schema)
    everything = transactions.read(spark, path, schema, "read_uncommitted")
    if moment == "before the manifest":
        assert partly.count() < everything.count()
    relay.relay(source, place, path, checkpoint).awaitTermination()
    done = transactions.read(spark, path, schema)
    assert done.count() == 1000
    assert done.select("topic", "partition", "offset").distinct().count() == 1000
    assert rows(transactions.committed_offsets(spark, path, "")) == rows(log.end_offsets())


def test_a_path_keeps_to_its_checkpoint(spark, log):
    path, checkpoint = scratch_path(spark, "relay"), scratch_path(spark, "checkpoint")
    relay.relay(log.stream(), to_output, path, checkpoint).awaitTermination()
    with pytest.raises(ValueError, match="belongs to the checkpoint"):
        relay.relay(log.stream(), to_output, path, scratch_path(spark, "checkpoint"))
    store = state.counts_store(spark, scratch_path(spark, "state"))
    state.run(log.stream(), store, checkpoint).awaitTermination()
    with pytest.raises(ValueError, match="belongs to the checkpoint"):
        state.run(log.stream(), store, scratch_path(spark, "checkpoint"))


def test_transactions(spark):
    path = scratch_path(spark, "transactions")
    one = spark.createDataFrame([("t", "key", "value")], "topic string, key string, value string")
    assert transactions.read(spark, path, OUT).count() == 0

    unit = transactions.Transaction(spark, path, 0)
    unit.send(one)
    unit.send(one.withColumn("key", F.lit("more")))
    unit.send_offsets(off.of(spark, {("s", 0): 5}), "g")
    assert transactions.read(spark, path, OUT).count() == 0
    unit.commit()
    assert transactions.read(spark, path, OUT).count() == 2
    with pytest.raises(RuntimeError):
        unit.send(one)

    aborted = transactions.Transaction(spark, path, 1)
    aborted.send(one)
    aborted.send_offsets(off.of(spark, {("s", 0): 9}), "g")
    aborted.abort()
    assert transactions.read(spark, path, OUT).count() == 2
    assert transactions.read(spark, path, OUT, "read_uncommitted").count() == 3
    assert rows(transactions.committed_offsets(spark, path)) == [("g", "s", 0, 5)]

    # The retry has fewer parts than a failed attempt left behind.
    failed = transactions.Transaction(spark, path, 2)
    failed.send(one)
    failed.send(one)
    retried = transactions.Transaction(spark, path, 2)
    retried.send(one)
    retried.commit()
    assert transactions.read(spark, path, OUT).count() == 3
    assert not transactions.write_once(one, off.empty(spark), path, 2)
    with pytest.raises(ValueError):
        transactions.read(spark, path, OUT, "serializable")


def test_state_and_offsets_are_applied_once(spark, log, monkeypatch):
    path, checkpoint = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    store = state.counts_store(spark, path)
    assert store.read().count() == 0
    failures = []

    def handle(batch, batch_id):
        store.apply(batch, batch_id)
        if batch_id == 2 and not failures:
            failures.append(True)
            raise RuntimeError("lost after the state was written")

    with pytest.raises(StreamingQueryException):
        consume.start(log.stream(max_records=15), handle, checkpoint).awaitTermination()
    state.run(log.stream(max_records=15), store, checkpoint).awaitTermination()
    expected = log.records().groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"), (F.max("offset") + 1).alias("offset")
    )
    assert rows(store.read()) == rows(expected)
    assert not store.apply(log.records(), 0)
    some = spark.createDataFrame([("click", 1), ("view", 3)], "topic string, partition int")
    assert rows(state.load_for(store.read(), some)) == [r for r in rows(expected) if r[:2] in (("click", 1), ("view", 3))]


def test_a_crash_between_state_and_marker_leaves_the_old_state(spark, log):
    store = state.counts_store(spark, scratch_path(spark, "state"))
    clicks, views = log.subscribe(["click"]), log.subscribe(["view"])
    store.apply(clicks, 0)
    before = rows(store.read())
    # What a crash leaves: the run is written, the marker is not.
    spark.createDataFrame([], store.schema).write.mode("overwrite").parquet(store._run_path([0, 1, 1]))
    assert rows(store.read()) == before
    store.apply(views, 1)
    assert store.read().agg(F.sum("n")).first()[0] == clicks.count() + views.count()


def test_batch_writer_replies_success_or_failure(spark, log):
    acks, checkpoint = scratch_path(spark, "acks"), scratch_path(spark, "checkpoint")
    tries = []

    def write(batch, batch_id):
        tries.append(batch_id)
        if batch_id == 0 and tries.count(0) == 1:
            raise OSError("try again")
        if batch_id == 1:
            raise OSError("disk full")

    failed = scratch_path(spark, "failed")
    handler = relay.acknowledged_writer(write, acks, retries=1, failed_path=failed)
    consume.start(log.stream(max_records=20), handler, checkpoint).awaitTermination()
    assert tries.count(0) == 2 and tries.count(1) == 2
    replies = relay.read_acks(spark, acks)
    assert rows(replies.select("batch_id", "status", "error").distinct())[:2] == [
        (0, "success", None), (1, "failure", "disk full"),
    ]
    assert spark.read.parquet(failed).count() > 0
    stopping = relay.acknowledged_writer(write, scratch_path(spark, "acks"))
    with pytest.raises(OSError):
        stopping(log.records(), 1)


def test_a_failed_batch_is_written_after_a_restart(spark, log):
    acks, path, checkpoint = scratch_path(spark, "acks"), scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    broken = []

    def write(batch, batch_id):
        if batch_id == 1 and not broken:
            broken.append(True)
            raise OSError("disk full")
        batch.write.mode("overwrite").parquet(f"{path}/{batch_id}")

    handler = relay.acknowledged_writer(write, acks)
    with pytest.raises(StreamingQueryException):
        consume.start(log.stream(max_records=20), handler, checkpoint).awaitTermination()
    consume.start(log.stream(max_records=20), handler, checkpoint).awaitTermination()
    assert spark.read.parquet(f"{path}/*").count() == 1000
    assert rows(relay.read_acks(spark, acks).filter("batch_id = 1").select("status").distinct()) == [("failure",), ("success",)]


def test_a_stream_by_time_keeps_its_start(spark):
    """Partitions past the end begin at their end, and go on from there after a restart."""
    def some(partition, first, n):
        at = "timestampadd(SECOND, id, timestamp_ntz'2024-01-01 00:00:00')"
        return spark.range(first, first + n).selectExpr("'t' topic", f"{partition} partition", f"{at} timestamp", "cast(null as string) key", "cast(id as string) value")

    log = publish(some(0, 0, 20).unionByName(some(1, 100, 20)), scratch_path(spark, "timed"), ["timestamp", "value"])
    at = F.lit("2024-01-01 00:01:50").cast("timestamp_ntz")
    start, checkpoint, path = (scratch_path(spark, x) for x in ("start", "checkpoint", "out"))

    def run():
        stream = log.as_stream().seek_times(at, start_path=start)
        consume.start(stream, lambda b, i: b.write.mode("overwrite").parquet(f"{path}/{i}"), checkpoint).awaitTermination()
        return rows(spark.read.parquet(f"{path}/*").select("partition", "offset"))

    late = [(1, n) for n in range(10, 20)]
    assert run() == late
    append(some(0, 20, 10), log, ["timestamp", "value"])
    assert run() == [(0, n) for n in range(20, 30)] + late


def test_groups_of_a_relay_keep_their_own_offsets(spark):
    path = scratch_path(spark, "groups")
    one = spark.createDataFrame([("t", "key", "value")], "topic string, key string, value string")
    for batch_id, (group, offset) in enumerate([("a", 9), ("b", 5), ("a", 7)]):
        transactions.write_once(one, off.of(spark, {("s", 0): offset}), path, batch_id, group)
    assert rows(transactions.committed_offsets(spark, path)) == [("a", "s", 0, 7), ("b", "s", 0, 5)]
    assert rows(transactions.committed_offsets(spark, path, "b")) == [("s", 0, 5)]


def test_what_was_read_from_a_store_stays_readable(spark, log):
    store = state.counts_store(spark, scratch_path(spark, "state"))
    clicks = log.subscribe(["click"])
    store.apply(clicks, 0)
    early = store.read()
    expected = rows(early)
    for n in range(1, 4):
        store.apply(clicks, n)
    assert rows(early) == expected
    store.keep = 2
    store.apply(clicks, 4)
    assert store.read().agg(F.sum("n")).first()[0] == 5 * clicks.count()
    assert sorted(store._files.names(f"{store.path}/current")) == ["3", "4"]


def size(spark, path):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def counted(spark, ids):
    """A store that counts how often each id came, and its last batch's id."""
    schema = struct_of(id=T.LongType(), n=T.LongType(), last=T.LongType())
    return state.StateStore(spark, scratch_path(spark, "counted"), schema, ["id"], {
        "n": (F.count(F.lit(1)), F.sum), "last": (F.max("at"), lambda name: F.max_by(name, state.FRESH)),
    }, keep=ids)


def test_a_batch_writes_its_keys_not_the_state(spark):
    store = counted(spark, 16)
    store.apply(spark.range(200_000).selectExpr("id", "id AS at"), 0)
    before = size(spark, store.path)
    for n in range(1, 6):
        store.apply(spark.range(10).selectExpr(f"id * {n} AS id", f"{n}L AS at"), n)
    assert size(spark, store.path) - before < before / 10
    assert store.read().agg(F.sum("n"), F.count("*")).first()[:] == (200_050, 200_000)
    assert rows(store.lookup(spark.createDataFrame([(0,), (4,), (-1,)], "id long"))) == [(0, 6, 5), (4, 4, 4)]


def test_runs_are_merged_and_old_states_stay_readable(spark):
    store, seen = counted(spark, 4), {}
    for n in range(70):
        store.apply(spark.createDataFrame([(n % 5, n), (n % 7, n)], "id long, at long").coalesce(1), n)
        if n >= 66:
            seen[n] = store.read()
    for n, found in seen.items():
        ids = [i for k in range(n + 1) for i in (k % 5, k % 7)]
        last = {i: max(k for k in range(n + 1) if i in (k % 5, k % 7)) for i in set(ids)}
        assert rows(found) == sorted((i, ids.count(i), last[i]) for i in set(ids))
    runs = store._runs(69)
    assert len(runs) <= 2 * 7 and runs[0][0] >= 1 and runs[0][1] == 0 and runs[-1][2] == 69


def test_initial_state_is_taken_over_when_a_key_appears(spark, log):
    counts = log.records().groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"), (F.max("offset") + 1).alias("offset"))
    initial = counts.withColumn("n", F.lit(1000).cast("long")).filter("partition < 2")
    store = state.counts_store(spark, scratch_path(spark, "state"), initial)
    store.apply(log.subscribe(["click"]), 0)
    assert {r.topic for r in store.read().collect()} == {"click"}
    store.apply(log.subscribe(["view", "click"]), 1)
    expected = [
        (t, p, n * (2 if t == "click" else 1) + (1000 if p < 2 else 0), o) for t, p, n, o in rows(counts) if t in ("click", "view")
    ]
    assert rows(store.read()) == expected


def test_the_last_commit_wins_whatever_the_clock_says(spark):
    store = commits.commits_store(spark, scratch_path(spark, "commits"))
    for n, (offset, at) in enumerate([(9, "2024-01-02"), (5, "2024-01-01")]):
        store.apply(off.to_commits(off.of(spark, {("t", 0): offset}), "g", F.lit(at).cast("timestamp")), n)
    assert rows(commits.committed(store, "g")) == [("t", 0, 5)]


def test_relay_to_any_sink(spark, log):
    path = scratch_path(spark, "files")
    query = relay.relay_to_sink(
        log.stream(), to_output, f"{path}-checkpoint", "parquet", {"path": path}
    )
    query.awaitTermination()
    assert spark.read.parquet(path).count() == 1000
