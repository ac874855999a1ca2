"""The registered queries: one or more per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlog.functions import serde
from streamlog.functions.numbers import epoch_micros, whole_div
from streamlog.model import OFFSETS_SCHEMA, TOPIC_PARTITION, struct_of
from streamlog.operators import delivery
from streamlog.operators import offsets as off
from streamlog.operators import records as rec
from streamlog.operators.numbering import with_next
from streamlog.plans import fixtures as fx
from streamlog.session import scratch_path
from streamlog.sinks.log import LogTransaction, append, create_log, send
from streamlog.sources.kafka import DeliveryConf
from streamlog.sources.ranges import BATCH
from streamlog.streaming import commits, consume, dedup, state, transactions
from streamlog.streaming import relay as relays

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

PLACE = [*TOPIC_PARTITION, "offset"]
REDELIVERY_TIMEOUT_MS = 10_000_000
OUTPUT_SCHEMA = struct_of(topic=T.StringType(), key=T.StringType(), value=T.StringType())


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def moment(text: str) -> Column:
    """A point in time without zone, the type of the events' timestamps."""
    return F.lit(text).cast("timestamp_ntz")


# -- reading --------------------------------------------------------------


@query
def log_view(spark, sf_dir):
    return fx.event_log(spark, sf_dir).records().select(*PLACE, "timestamp", "key", "value")


@query
def subscribe_topics(spark, sf_dir):
    return fx.event_log(spark, sf_dir).subscribe(["click", "purchase"]).select(*PLACE, "key", "value")


@query
def subscribe_committed(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    return log.subscribe(["click", "purchase"], fx.user_store(log.end_offsets()), reset="latest").select(*PLACE, "value")


@query
def resume_committed(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    return log.subscribe(["click"], fx.user_store(log.end_offsets()), reset="earliest").select(*PLACE)


@query
def resume_from_offset_store(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    return (
        log.resume(fx.user_store(log.end_offsets()), reset="earliest")
        .groupBy(*TOPIC_PARTITION)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("offset").alias("first_offset"),
            (F.max("offset") + 1).alias("next_offset"),
        )
    )


@query
def assign_partitions(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    return log.assign([("click", 0), ("click", 2), ("view", 1)]).select(*PLACE, "value")


@query
def assign_committed(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    chosen = [("click", 0), ("click", 3), ("view", 1)]
    return log.assign(chosen, fx.user_store(log.end_offsets()), reset="earliest").select(*PLACE)


@query
def seek_offsets(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    return log.seek({("click", 0): 25, ("click", 1): 40}).select(*PLACE, "value")


@query
def offsets_for_times(spark, sf_dir):
    return fx.event_log(spark, sf_dir).offsets_for_times(moment("2024-01-10 00:00:00"))


@query
def seek_timestamp(spark, sf_dir):
    return fx.event_log(spark, sf_dir).seek_times(moment("2024-01-10 00:00:00")).select(*PLACE)


@query
def reset_latest(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return off.start_offsets(ends, fx.user_store(ends), reset="latest")


@query
def read_committed(spark, sf_dir):
    records = fx.in_transactions(fx.event_log(spark, sf_dir).records())
    aborted = records.filter((F.col("topic") == "error") & (F.col("event_id") % fx.TRANSACTION_EVENTS == 0))
    return rec.read_committed(records, "transaction", aborted).select(*PLACE)


@query
def bounded_batch(spark, sf_dir):
    return fx.event_log(spark, sf_dir).bounded(50).select(*PLACE)


@query
def consume_expected(spark, sf_dir):
    return fx.event_log(spark, sf_dir).consume("click", expected=1)


# -- projections and output records ---------------------------------------


@query
def records_pairs(spark, sf_dir):
    return rec.pairs(fx.event_log(spark, sf_dir).records())


@query
def records_values(spark, sf_dir):
    return rec.values(fx.event_log(spark, sf_dir).records())


@query
def records_size(spark, sf_dir):
    return rec.size(fx.event_log(spark, sf_dir).records())


@query
def to_producer_records(spark, sf_dir):
    return rec.to_producer_records(fx.event_log(spark, sf_dir).records(), "out")


@query
def values_to_producer_records(spark, sf_dir):
    return rec.values_to_producer_records(fx.event_log(spark, sf_dir).records(), "out")


@query
def values_with_key(spark, sf_dir):
    return rec.values_with_key(fx.event_log(spark, sf_dir).records(), "out", "k1")


@query
def destination_record(spark, sf_dir):
    return rec.with_destination(
        fx.event_log(spark, sf_dir).records(),
        topic=F.concat("topic", F.lit(".copy")),
        partition=F.when(F.col("key").isNull(), 0).otherwise(F.col("partition")),
        timestamp=F.col("timestamp"),
        key="key",
    )


@query
def records_with_topic(spark, sf_dir):
    topic = F.when(F.col("partition") == 0, "even").otherwise("odd")
    return rec.values_to_producer_records(fx.event_log(spark, sf_dir).records(), topic)


@query
def typed_records(spark, sf_dir):
    return rec.typed(fx.event_log(spark, sf_dir).records(), key_type="bigint").select(*PLACE, "key", "value")


@query
def mapped_records(spark, sf_dir):
    return rec.map_records(
        fx.event_log(spark, sf_dir).records(),
        F.col("topic").isin("click", "purchase") & F.col("key").isNotNull(),
        lambda taken: rec.to_producer_records(taken, F.concat(F.lit("mapped-"), "topic")),
    )


# -- codecs ---------------------------------------------------------------


@query
def serde_roundtrip(spark, sf_dir):
    text = serde.configure("string")
    upper = F.upper(text.decode(text.encode(F.col("value"))))
    return fx.event_log(spark, sf_dir).records().select(
        *PLACE, F.length("value").cast("long").alias("n_chars"), upper.alias("value")
    )


@query
def serde_long(spark, sf_dir):
    number = serde.configure("long")
    encoded = number.encode(F.col("key").try_cast("long"))
    return fx.event_log(spark, sf_dir).records().select(
        *PLACE, F.hex(encoded).alias("bytes"), number.decode(encoded).alias("key")
    )


@query
def serde_json(spark, sf_dir):
    schema = struct_of(k=T.LongType())
    opened = serde.json_codec(schema).decode(F.encode("value", "UTF-8"))
    return fx.event_log(spark, sf_dir).records().select(*PLACE, opened["k"].alias("k"))


@query
def serde_function(spark, sf_dir):
    codec = serde.function_codec(
        lambda text: text[::-1].encode(), lambda data: data.decode().upper(), T.StringType()
    )
    return fx.event_log(spark, sf_dir).records().select(
        *PLACE, codec.decode(codec.encode(F.col("value"))).alias("value")
    )


@query
def encode_failures(spark, sf_dir):
    broken = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string")))
    records = fx.event_log(spark, sf_dir).records().withColumn(
        "value", F.coalesce(broken, F.col("event_id").cast("string"))
    )
    return serde.cast_or_error(records, "value", "bigint").select(*PLACE, "value", "error")


# -- offsets --------------------------------------------------------------


@query
def positions(spark, sf_dir):
    return off.positions(fx.event_log(spark, sf_dir).records())


@query
def end_offsets(spark, sf_dir):
    return fx.event_log(spark, sf_dir).end_offsets()


@query
def offsets_text(spark, sf_dir):
    return off.as_text(fx.event_log(spark, sf_dir).end_offsets())


@query
def offsets_keep_only(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return off.keep_only(ends, fx.user_store(ends))


@query
def offsets_remove(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return off.remove(ends, fx.user_store(ends))


@query
def topic_partitions(spark, sf_dir):
    return fx.event_log(spark, sf_dir).partitions()


@query
def partitions_for(spark, sf_dir):
    return fx.event_log(spark, sf_dir).partitions_for("click")


@query
def batch_positions(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    changes = off.position_changes(fx.in_batches(log.records()))
    return off.positions_at(changes, fx.asked_positions(log, changes))


@query
def commit_map(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return off.to_commits(ends, "group-1", moment("2024-02-01 00:00:00"))


# -- confirmation, commit, redelivery -------------------------------------


@query
def confirm_match(spark, sf_dir):
    delivered = fx.deliveries(fx.event_log(spark, sf_dir).records())
    return delivery.confirm_match(delivered, fx.confirmations(delivered))


@query
def tracked_batches(spark, sf_dir):
    delivered = fx.deliveries(fx.event_log(spark, sf_dir).records())
    return delivery.outcomes(delivered, fx.confirmations(delivered)).select(
        F.lit("group-1").alias("group_id"), "batch_no", "event", F.lit(0).alias("redelivery_count")
    )


@query
def commit_clip(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return delivery.commit_clip(ends, fx.user_store(ends))


@query
def commit_upsert(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return delivery.commit_upsert(fx.user_store(ends), ends.filter(F.col("topic") != "error"))


@query
def commit_confirmed(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    delivered = fx.deliveries(log.records())
    stored = fx.user_store(log.end_offsets()).withColumn("offset", F.lit(0).cast("long"))
    return delivery.commit_confirmed(stored, delivered, fx.confirmations(delivered))


def _paired(spark, sf_dir):
    """Every event as a delivery that the same user's next event confirms, and the delay in milliseconds."""
    sent = fx.events(spark, sf_dir).select("event_id", "user_id", "ts")
    paired = with_next(sent, ["user_id"], ["ts", "event_id"], F.col("ts"), "next_ts")
    millis = {name: whole_div(epoch_micros(name, sent.schema["ts"].dataType), 1_000) for name in ("ts", "next_ts")}
    return paired.select("event_id", "ts", "next_ts"), millis["next_ts"] - millis["ts"]


def _redeliveries(spark, sf_dir):
    paired, delay = _paired(spark, sf_dir)
    return delivery.redelivery_plan(paired, delay, REDELIVERY_TIMEOUT_MS)


@query
def redelivery_plan(spark, sf_dir):
    return _redeliveries(spark, sf_dir).select("event_id", "delay_ms", "sends", "backoffs")


@query
def redelivery_timeline(spark, sf_dir):
    return delivery.redelivery_timeline(_redeliveries(spark, sf_dir), REDELIVERY_TIMEOUT_MS).select(
        "event_id", "attempt", "after_ms", "poll_interval_ms"
    )


@query
def resume_plan_group(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return delivery.resume_plan("auto_partition", ends, committed=fx.user_store(ends))


@query
def resume_plan_manual(spark, sf_dir):
    ends = fx.event_log(spark, sf_dir).end_offsets()
    return delivery.resume_plan("manual_offset", ends, confirmed=fx.user_store(ends))


# -- writing --------------------------------------------------------------


@query
def relay(spark, sf_dir):
    return rec.to_producer_records(fx.event_log(spark, sf_dir).records(), "topic2").withColumn("value", F.concat("value", F.lit(".")))


@query
def relay_stream(spark, sf_dir):
    path = scratch_path(spark, "relay")

    def to_output(batch: DataFrame) -> DataFrame:
        return rec.to_producer_records(batch, "topic2").withColumn("value", F.concat("value", F.lit(".")))

    relays.relay(fx.event_log(spark, sf_dir).stream(), to_output, path, f"{path}/checkpoint").awaitTermination()
    return transactions.read(spark, path, OUTPUT_SCHEMA)


@query
def relay_log(spark, sf_dir):
    source = fx.event_log(spark, sf_dir)
    target = create_log(spark, scratch_path(spark, "relayed"), source.schema)

    def to_output(batch: DataFrame) -> DataFrame:
        return batch.drop("offset").withColumns({
            "topic": F.concat("topic", F.lit("2")), "value": F.concat("value", F.lit(".")),
        })

    path = scratch_path(spark, "checkpoint")
    relays.relay_to_log(source.stream(), to_output, target, ["timestamp", "event_id"], path).awaitTermination()
    return target.records().select(*PLACE, "key", "value")


def _topics(log):
    return sorted({topic for topic, _ in log.assigned()})


@query
def send_acks(spark, sf_dir):
    source = fx.event_log(spark, sf_dir)
    target = create_log(spark, scratch_path(spark, "sent"), source.schema)
    replies = [
        send(
            source.subscribe([topic]).withColumn("topic", F.lit("out")).drop("offset"),
            target, ["timestamp", "event_id"], batch_id=batch_id,
        )
        for batch_id, topic in enumerate(_topics(source))
    ]
    return reduce(DataFrame.unionByName, replies)


@query
def transactional_write(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    log = fx.event_log(spark, sf_dir)
    for batch_id, topic in enumerate(_topics(log)):
        records = log.subscribe([topic])
        unit = transactions.Transaction(spark, path, batch_id)
        unit.send(records.select("topic", "key", "value"))
        unit.send_offsets(off.positions(records), "group-1")
        if topic == "error":
            unit.abort()
        else:
            unit.commit()
    return transactions.read(spark, path, OUTPUT_SCHEMA)


def _units(spark, sf_dir):
    """A log with a transaction for each topic; that of the errors is aborted, the last one sent twice."""
    source = fx.event_log(spark, sf_dir)
    target = create_log(spark, scratch_path(spark, "units"), source.schema)
    topics = _topics(source)
    for topic in [*topics, topics[-1]]:
        unit = LogTransaction(target, ["timestamp", "event_id"], topic)
        unit.send(source.subscribe([topic]).drop("offset").withColumn("topic", F.lit("out")))
        unit.abort() if topic == "error" else unit.commit()
    return target


@query
def isolated_committed(spark, sf_dir):
    return _units(spark, sf_dir).records().select(*PLACE, "key", "value")


@query
def isolated_uncommitted(spark, sf_dir):
    return _units(spark, sf_dir).isolated("read_uncommitted").records().select(*PLACE, "key", "value")


@query
def relay_log_restarted(spark, sf_dir):
    """A relay to a log that breaks off just after a write and starts again: every record once."""
    source = fx.event_log(spark, sf_dir)
    target = create_log(spark, scratch_path(spark, "restarted"), source.schema)
    path, written = scratch_path(spark, "checkpoint"), []

    def forward(batch: DataFrame, batch_id: int) -> None:
        append(batch.drop("offset"), target, ["timestamp", "event_id"], batch_id=f"{path}#{batch_id}", writer=path)
        written.append(batch_id)
        if len(written) == 1:
            raise OSError("lost after the write")

    for _ in range(2):
        _until_broken(consume.start(source.stream(), forward, path))
    return target.records().select(*PLACE, "key", "value")


@query
def dedup_records(spark, sf_dir):
    records = fx.event_log(spark, sf_dir).records()
    return rec.dedup(records.unionByName(records.filter(F.col("partition") == 1)), PLACE)


@query
def stateful_counts(spark, sf_dir):
    return fx.event_log(spark, sf_dir).records().groupBy(*TOPIC_PARTITION).agg(
        F.count(F.lit(1)).alias("n"), (F.max("offset") + 1).alias("offset")
    )


@query
def stateful_counts_stream(spark, sf_dir):
    path = scratch_path(spark, "state")
    store = state.counts_store(spark, path)
    state.run(fx.event_log(spark, sf_dir).stream(max_records=1000), store, f"{path}/checkpoint").awaitTermination()
    return store.read()


@query
def committed_stream(spark, sf_dir):
    path = scratch_path(spark, "commits")
    store = commits.commits_store(spark, path)
    stream = fx.event_log(spark, sf_dir).stream()
    commits.start(stream, lambda batch, offsets, batch_id: True, store, "group-1", f"{path}/checkpoint").awaitTermination()
    return store.read().select("group_id", *PLACE)


@query
def acknowledged_stream(spark, sf_dir):
    path = scratch_path(spark, "acknowledged")

    def write(batch: DataFrame, batch_id: int) -> None:
        rec.to_producer_records(batch, "copy").write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    handler = relays.acknowledged_writer(write, f"{path}/acks")
    consume.start(fx.event_log(spark, sf_dir).stream(), handler, f"{path}/checkpoint").awaitTermination()
    return relays.read_acks(spark, f"{path}/acks")


def _until_broken(query) -> None:
    try:
        query.awaitTermination()
    except StreamingQueryException:
        pass


@query
def retried_stream(spark, sf_dir):
    """The first attempt fails and ends the stream; started again it succeeds. Both are on record."""
    path = scratch_path(spark, "retried")
    attempts = []

    def write(batch: DataFrame, batch_id: int) -> None:
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise OSError("receiver is gone")
        rec.to_producer_records(batch, "copy").write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    handler = relays.acknowledged_writer(write, f"{path}/acks")
    for _ in range(2):
        _until_broken(consume.start(fx.event_log(spark, sf_dir).stream(), handler, f"{path}/checkpoint"))
    return relays.read_acks(spark, f"{path}/acks")


@query
def stopped_stream(spark, sf_dir):
    """A stream that stops after its first batch and is started again: every record once, with its position."""
    path = scratch_path(spark, "stopped")
    log = fx.event_log(spark, sf_dir)
    seen = []

    def keep(batches: DataFrame, offsets: DataFrame, numbers: range) -> None:
        seen.append(numbers)
        if len(seen) == 2:
            raise InterruptedError("stopped")
        batches.join(offsets.withColumnRenamed("offset", "next_offset"), [BATCH, *TOPIC_PARTITION]).select(
            *PLACE, BATCH, (F.col("next_offset") > F.col("offset")).alias("covered")
        ).write.mode("overwrite").parquet(f"{path}/data/last={numbers[-1]}")

    begin = log.partitions().withColumn("offset", F.lit(0).cast("long"))
    for _ in range(2):
        _until_broken(consume.start_with_offsets(
            log.stream(max_records=400).together(), keep, f"{path}/checkpoint", assigned=begin, positions_path=f"{path}/positions",
        ))
    return spark.read.parquet(f"{path}/data").select(*PLACE, "covered")


@query
def carried_positions(spark, sf_dir):
    """Where a stream of one topic stands at its end: all assigned partitions, also those without records."""
    path = scratch_path(spark, "carried")
    log = fx.event_log(spark, sf_dir)
    last = []

    def note(batches: DataFrame, offsets: DataFrame, numbers: range) -> None:
        offsets.write.mode("overwrite").parquet(f"{path}/last/{numbers[-1]}")
        last.append(numbers[-1])

    begin = log.partitions().withColumn("offset", F.lit(0).cast("long"))
    purchases = log.stream(max_records=1000).filter("topic = 'purchase'").together()
    consume.start_with_offsets(
        purchases, note, f"{path}/checkpoint", assigned=begin, positions_path=f"{path}/positions",
    ).awaitTermination()
    found = spark.read.schema(T.StructType([T.StructField(BATCH, T.LongType()), *OFFSETS_SCHEMA.fields]))
    return found.parquet(f"{path}/last/{max(last)}").filter(F.col(BATCH) == max(last)).select(*OFFSETS_SCHEMA.names)


@query
def resume_of_groups(spark, sf_dir):
    """Two groups in one commit table, each resumed from its own offsets."""
    log = fx.event_log(spark, sf_dir)
    ends = log.end_offsets()
    behind = fx.user_store(ends)
    table = off.to_commits(ends, "group-1", moment("2024-02-01 00:00:00")).unionByName(
        off.to_commits(behind, "group-2", moment("2024-02-01 00:00:00"))
    )
    found = [
        log.resume(table, "earliest", group).groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(group).alias("group_id"), *TOPIC_PARTITION, "n") for group in ("group-1", "group-2")
    ]
    return found[0].unionByName(found[1])


@query
def serde_nullable_long(spark, sf_dir):
    """Integers beyond 2^53, some NULL, through a codec of Python functions, and bytes of a wrong length."""
    records = fx.event_log(spark, sf_dir).records()
    number = F.when(F.col("event_id") % 5 != 0, F.col("event_id") + 9007199254740993)
    codec = serde.function_codec(lambda n: str(n).encode(), lambda data: int(data.decode()), T.LongType())
    number = codec.decode(codec.encode(number))
    cut = F.when(F.col("event_id") % 3 == 0, F.lit(b"1234")).otherwise(serde.long_codec().encode(F.col("event_id")))
    decode = serde.fixed_length_or_error(serde.long_codec().decode, 8)
    return serde.encode_or_error(records.withColumn("value", cut), "value", decode).select(
        *PLACE, number.cast("string").alias("number"), "value", "error"
    )


@query
def partition_state(spark, sf_dir):
    log = fx.event_log(spark, sf_dir)
    counts = stateful_counts(spark, sf_dir)
    return state.load_for(counts, log.partitions().filter(F.col("partition") == 2))


# -- isolation, bounds and times of a log that is written meanwhile --------


@query
def bounded_stream(spark, sf_dir):
    """Batches of at most 500 offsets a partition, stopped once and started again: only what is committed."""
    log, path, seen = fx.mixed_log(spark, sf_dir), scratch_path(spark, "bounded"), []

    def keep(batches: DataFrame, numbers: range) -> None:
        if 1 in numbers and not seen:
            seen.append(numbers)
            raise InterruptedError("stopped")
        batches.select(*PLACE, "event_id", F.col(BATCH).alias("batch_no")).write.mode("overwrite").parquet(f"{path}/data/last={numbers[-1]}")

    for _ in range(2):
        _until_broken(consume.start(log.stream(max_records=500).together(), keep, f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/data").select(*PLACE, "event_id", "batch_no")


@query
def committed_of_mixed(spark, sf_dir):
    return fx.mixed_log(spark, sf_dir).records().select(*PLACE, "event_id")


@query
def uncommitted_of_mixed(spark, sf_dir):
    return fx.mixed_log(spark, sf_dir).isolated("read_uncommitted").records().select(*PLACE, "event_id")


@query
def pending_unit_committed(spark, sf_dir):
    return fx.log_with_open_transaction(spark, sf_dir).records().select(*PLACE, "event_id")


@query
def pending_unit_uncommitted(spark, sf_dir):
    return fx.log_with_open_transaction(spark, sf_dir).isolated("read_uncommitted").records().select(*PLACE, "event_id")


@query
def pending_unit_ends(spark, sf_dir):
    """End offsets for readers of committed records stop before the open transaction."""
    log = fx.log_with_open_transaction(spark, sf_dir)
    ends = log.isolated("read_uncommitted").end_offsets().withColumnRenamed("offset", "log_end")
    return log.end_offsets().withColumnRenamed("offset", "stable_end").join(ends, TOPIC_PARTITION)


@query
def times_out_of_order(spark, sf_dir):
    """First committed offset at or after a time, in a log whose times go back with every append."""
    return fx.mixed_log(spark, sf_dir).offsets_for_times(moment("2024-01-20 00:00:00"))


@query
def relay_offsets(spark, sf_dir):
    """A relay that is started twice, each time with a new checkpoint; source offsets and records are one entry."""
    source = fx.event_log(spark, sf_dir)
    target = create_log(spark, scratch_path(spark, "relayed"), source.schema)
    written = []

    def to_output(batch: DataFrame) -> DataFrame:
        written.append(batch)
        if len(written) == 2:
            raise OSError("lost before the second commit")
        return batch.drop("offset")

    for _ in range(2):
        _until_broken(relays.relay_with_offsets(
            source.stream(max_records=1000).together(), to_output, target, ["timestamp", "event_id"], "group-1", scratch_path(spark, "checkpoint"),
        ))
    counts = target.records().groupBy(*TOPIC_PARTITION).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_events"))
    return target.committed("group-1").join(counts, TOPIC_PARTITION)


@query
def stateful_counts_initial(spark, sf_dir):
    """Counts go on from a user's store for the partitions it has."""
    log, path = fx.event_log(spark, sf_dir), scratch_path(spark, "state")
    initial = fx.user_store(log.end_offsets()).withColumn("n", F.lit(1000).cast("long"))
    store = state.counts_store(spark, path, initial)
    state.run(log.stream(max_records=1000), store, f"{path}/checkpoint").awaitTermination()
    return store.read()


@query
def dedup_stream(spark, sf_dir):
    """Every event once although half of them are sent again in later files."""
    path = scratch_path(spark, "sent")
    sent = fx.events(spark, sf_dir).select((F.col("user_id") % 8).alias("writer"), F.col("event_id").alias("sequence"), F.col("ts").cast("timestamp").alias("sent_at"))
    again = sent.filter(F.col("sequence") % 2 == 0)
    sent.write.parquet(f"{path}/in/1")
    again.unionByName(sent.filter(F.col("sequence") % 5 == 0)).write.parquet(f"{path}/in/2")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
    once = dedup.sent_once(stream, ["writer", "sequence"], "sent_at", "60 days")
    writer = once.select("writer", "sequence").writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start(f"{path}/out").awaitTermination()
    return spark.read.parquet(f"{path}/out")


PAYLOAD = T.StructType([
    T.StructField("user", T.StructType([
        T.StructField("id", T.LongType(), False), T.StructField("tags", T.ArrayType(T.StringType(), False), False),
    ]), False),
    T.StructField("k", T.DoubleType(), True),
])


@query
def typed_payloads(spark, sf_dir):
    """Nested payloads of exactly the wanted type; others are of a wrong type, lack a field, have one more or are not JSON."""
    user, tags, k = F.col("key").cast("string"), F.lit('["a","b"]'), F.lit("1.5")
    kind = F.col("event_id") % 7
    user = F.when(kind == 1, F.concat(F.lit('"'), F.col("event_id"), F.lit('"'))).otherwise(F.col("event_id").cast("string"))
    tags = F.when(kind == 2, F.lit('["a",2]')).when(kind == 3, F.lit("[]")).otherwise(tags)
    k = F.when(kind == 3, F.lit("null")).otherwise(k)
    last = F.when(kind == 4, F.lit("")).when(kind == 5, F.concat(F.lit(',"k":'), k, F.lit(',"more":{}'))).otherwise(F.concat(F.lit(',"k":'), k))
    text = F.concat(F.lit('{"user":{"id":'), user, F.lit(',"tags":'), tags, F.lit("}"), last, F.when(kind == 6, F.lit("")).otherwise(F.lit("}")))
    records = fx.event_log(spark, sf_dir).records().withColumn("value", text)
    return rec.typed_payloads(records, PAYLOAD).select(
        *PLACE, F.col("value.user.id").alias("id"), F.size("value.user.tags").cast("long").alias("n_tags"), F.col("value.k").isNull().alias("no_k")
    )


@query
def consume_until(spark, sf_dir):
    """A bounded read of a stream that ends with the batch that reaches the number."""
    stream = fx.event_log(spark, sf_dir).as_stream().subscribe(["click"])
    return consume.read_until(stream, 1, 60, scratch_path(spark, "until")).select("key", "value")


@query
def retried_write(spark, sf_dir):
    """A write that fails once and succeeds when it is tried again in the same batch."""
    path, attempts = scratch_path(spark, "retried"), []

    def write(batch: DataFrame, batch_id: int) -> None:
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise OSError("receiver is gone")
        rec.to_producer_records(batch, "copy").write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")

    handler = relays.acknowledged_writer(write, f"{path}/acks", retries=1)
    consume.start(fx.event_log(spark, sf_dir).stream(), handler, f"{path}/checkpoint").awaitTermination()
    return relays.read_acks(spark, f"{path}/acks")


@query
def delivery_settings(spark, sf_dir):
    """Sends and longest wait of every delivery under given settings."""
    conf = DeliveryConf().with_conf({"unconfirmed.timeout": REDELIVERY_TIMEOUT_MS, "max.redeliveries": 2, "schedule.interval": 500})
    paired, delay = _paired(spark, sf_dir)
    return conf.plan(paired, delay).select("event_id", "sends", "longest_poll_ms")
