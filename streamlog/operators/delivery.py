"""Confirmation, commit and redelivery as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog.functions.numbers import whole_div
from streamlog.model import TOPIC_PARTITION
from streamlog.operators import offsets as off

UNCONFIRMED_TIMEOUT_MS = 3_000
MAX_REDELIVERIES = 3
SCHEDULE_INTERVAL_MS = 1_000


def confirm_match(delivered: DataFrame, confirmed: DataFrame, batch: str = "batch_no") -> DataFrame:
    """Whether each delivered batch was confirmed with exactly its own offsets.

    A missing, an extra or a differing partition makes it false. Both tables
    are ``batch, topic, partition, offset``; they are stacked and folded, which
    combines rows before the shuffle and needs no sort for a join.
    """
    sides = delivered.select(
        batch, *TOPIC_PARTITION, F.col("offset").alias("_sent"), F.lit(None).cast("long").alias("_back")
    ).unionByName(
        confirmed.select(
            batch, *TOPIC_PARTITION, F.lit(None).cast("long").alias("_sent"), F.col("offset").alias("_back")
        )
    )
    per_partition = sides.groupBy(batch, *TOPIC_PARTITION).agg(
        F.max("_sent").alias("_sent"), F.min("_back").alias("_low"), F.max("_back").alias("_high")
    )
    equal = F.col("_sent").isNotNull() & (F.col("_sent") == F.col("_low")) & (F.col("_sent") == F.col("_high"))
    return (
        per_partition.groupBy(batch)
        .agg(
            F.bool_and(F.coalesce(equal, F.lit(False))).alias("confirmed"),
            F.bool_or(F.col("_sent").isNotNull()).alias("_delivered"),
        )
        .filter("_delivered")
        .select(batch, "confirmed")
    )


def outcomes(delivered: DataFrame, confirmed: DataFrame, batch: str = "batch_no") -> DataFrame:
    """What became of each batch: it was ``delivered``, then ``confirmed`` if its own offsets came back, else ``ignored``."""
    matched = confirm_match(delivered, confirmed, batch)
    came_back = F.when(F.col("confirmed"), "confirmed").otherwise("ignored")
    return matched.select(batch, F.explode(F.array(F.lit("delivered"), came_back)).alias("event"))


def commit_clip(offsets: DataFrame, assigned: DataFrame) -> DataFrame:
    """Mark which offsets may be committed: those of currently assigned partitions."""
    mine = assigned.select(*TOPIC_PARTITION).distinct().withColumn("_mine", F.lit(True))
    return offsets.join(mine, TOPIC_PARTITION, "left").select(
        *TOPIC_PARTITION, "offset", F.coalesce("_mine", F.lit(False)).alias("committed")
    )


def commit_upsert(committed: DataFrame, new: DataFrame) -> DataFrame:
    """The commit table after a commit: new offsets win, other partitions stay."""
    fresh = new.select(*TOPIC_PARTITION, F.col("offset").alias("_new"))
    return committed.select(*TOPIC_PARTITION, "offset").join(fresh, TOPIC_PARTITION, "full").select(
        *TOPIC_PARTITION, F.coalesce("_new", "offset").alias("offset")
    )


def commit_confirmed(
    committed: DataFrame, delivered: DataFrame, confirmed: DataFrame, batch: str = "batch_no"
) -> DataFrame:
    """Commit table after all confirmations: per partition the offset of the last confirmed batch."""
    good = confirm_match(delivered, confirmed, batch).filter("confirmed").select(batch)
    reached = (
        delivered.join(good, batch, "left_semi")
        .groupBy(*TOPIC_PARTITION)
        .agg(F.max_by("offset", batch).alias("offset"))
    )
    return commit_upsert(committed, reached)


def redelivery_plan(
    deliveries: DataFrame,
    delay_ms: Column,
    timeout_ms: int = UNCONFIRMED_TIMEOUT_MS,
    max_redeliveries: int = MAX_REDELIVERIES,
) -> DataFrame:
    """How often each delivery is sent and how often the sender backs off.

    ``delay_ms`` is the time to confirmation, NULL if it never came. A time-out
    fires once for every full ``timeout_ms`` that passes *before* the
    confirmation. Never confirmed means all redeliveries and no end of
    back-offs (NULL). ``timeout_ms`` 0 turns redelivery off.
    """
    result = deliveries.withColumn("delay_ms", delay_ms)
    if timeout_ms <= 0:
        return result.withColumns({"sends": F.lit(1).cast("long"), "backoffs": F.lit(0).cast("long")})
    fired = F.when(F.col("delay_ms") <= 0, 0).otherwise(whole_div(F.col("delay_ms") - 1, timeout_ms))
    most = F.lit(max_redeliveries).cast("long")
    return (
        result.withColumn("_fired", F.when(F.col("delay_ms").isNotNull(), fired))
        .withColumns({
            "sends": F.lit(1) + F.when(F.col("_fired").isNull(), most).otherwise(F.least("_fired", most)),
            "backoffs": F.when(
                F.col("_fired").isNotNull(), F.greatest(F.col("_fired") - most, F.lit(0).cast("long"))
            ),
        })
        .drop("_fired")
    )


def poll_interval_ms(redelivery_count: Column, interval_ms: int = SCHEDULE_INTERVAL_MS) -> Column:
    """Wait before the next poll: grows by one interval per redelivery."""
    return (redelivery_count + 1) * F.lit(interval_ms)


def redelivery_timeline(
    plan: DataFrame, timeout_ms: int = UNCONFIRMED_TIMEOUT_MS, interval_ms: int = SCHEDULE_INTERVAL_MS
) -> DataFrame:
    """One row per send of a redelivery plan: which attempt, how long after the first, next poll.

    At most ``1 + max_redeliveries`` rows come from one delivery.
    """
    attempt = F.col("attempt").cast("long")
    return plan.withColumn("attempt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sends") - 1))).withColumns({
        "after_ms": attempt * F.lit(timeout_ms),
        "poll_interval_ms": poll_interval_ms(attempt, interval_ms),
    })


GROUP_MODES = ("auto_partition", "auto_partition_basic")
STORE_MODES = ("auto_partition_with_manual_offset",)
MANUAL_MODES = ("manual_partition", "manual_offset", "manual_offset_for_times")


def resume_plan(
    mode: str,
    subscribed: DataFrame,
    confirmed: DataFrame | None = None,
    committed: DataFrame | None = None,
    store: DataFrame | None = None,
) -> DataFrame:
    """Offsets to go on from after a failure.

    Group modes keep their subscription and use the committed offsets, the
    store mode asks the user's store, and partition modes go on from the last
    confirmed offsets. Whatever has no such offset starts as subscribed, so
    every subscribed partition is in the plan. In timestamp mode the confirmed
    offsets are used as offsets.
    """
    if mode in GROUP_MODES:
        known = committed
    elif mode in STORE_MODES:
        known = store
    elif mode in MANUAL_MODES:
        known = confirmed
    else:
        raise ValueError(f"unknown subscription mode {mode!r}")
    start = subscribed.select(*TOPIC_PARTITION, "offset")
    if known is None:
        return start
    found = known.select(*TOPIC_PARTITION, F.col("offset").alias("_known"))
    return start.join(found, TOPIC_PARTITION, "left").select(
        *TOPIC_PARTITION, F.coalesce("_known", "offset").alias("offset")
    )
