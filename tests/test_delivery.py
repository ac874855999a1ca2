import pytest
from pyspark.sql import functions as F

from conftest import rows
from streamlog.operators import delivery
from streamlog.operators import offsets as off

BATCH = "batch_no long, topic string, partition int, offset long"


@pytest.fixture(scope="module")
def delivered(spark):
    return spark.createDataFrame(
        [(b, "t", p, 10 * b + p) for b in range(1, 7) for p in range(2)], BATCH
    )


def test_confirmation_needs_exactly_the_delivered_offsets(spark, delivered):
    confirmed = spark.createDataFrame(
        [
            (1, "t", 0, 10), (1, "t", 1, 11),                    # equal
            (2, "t", 0, 20),                                      # one missing
            (3, "t", 0, 30), (3, "t", 1, 31), (3, "t", 2, 1),     # one too many
            (4, "t", 0, 40), (4, "t", 1, 40),                     # one differs
            (5, "t", 0, 50), (5, "t", 1, 51), (5, "t", 1, 50),    # two answers, one wrong
            (99, "t", 0, 1),                                      # never delivered
        ],
        BATCH,
    )
    found = delivery.confirm_match(delivered, confirmed)
    assert rows(found) == [(1, True), (2, False), (3, False), (4, False), (5, False), (6, False)]


def test_commit_point_moves_to_the_last_confirmed_batch(spark, delivered):
    confirmed = delivered.filter("batch_no in (1, 3)").unionByName(delivered.filter("batch_no = 5 and partition = 0"))
    committed = off.of(spark, {("t", 0): 1, ("t", 7): 70})
    found = delivery.commit_confirmed(committed, delivered, confirmed)
    assert rows(found) == [("t", 0, 30), ("t", 1, 31), ("t", 7, 70)]


def test_commit_clip_and_upsert(spark):
    offsets = off.of(spark, {("t", 0): 5, ("t", 1): 6})
    assigned = off.of(spark, {("t", 1): 0, ("t", 2): 0})
    assert rows(delivery.commit_clip(offsets, assigned)) == [("t", 0, 5, False), ("t", 1, 6, True)]
    before = off.of(spark, {("t", 1): 2, ("u", 0): 3})
    assert rows(delivery.commit_upsert(before, offsets)) == [("t", 0, 5), ("t", 1, 6), ("u", 0, 3)]


def simulated(delay, timeout, most):
    """Count time-outs one by one: they fire strictly before the confirmation."""
    sends, backoffs, count, at = 1, 0, 0, timeout
    while at < delay:
        if count < most:
            sends += 1
        else:
            backoffs += 1
        count += 1
        at += timeout
    return sends, backoffs


@pytest.mark.parametrize("timeout, most", [(3000, 3), (1000, 0), (7, 2)])
def test_redelivery_plan_equals_a_step_by_step_count(spark, timeout, most):
    delays = [-5, 0, 1, timeout - 1, timeout, timeout + 1, 3 * timeout, 3 * timeout + 1, 4 * timeout + 1, 9 * timeout]
    data = spark.createDataFrame([(d,) for d in delays], "d long")
    plan = delivery.redelivery_plan(data, F.col("d"), timeout, most)
    assert {r["d"]: (r["sends"], r["backoffs"]) for r in plan.collect()} == {
        d: simulated(d, timeout, most) for d in delays
    }


def test_redelivery_without_confirmation_or_time_out(spark):
    data = spark.createDataFrame([(None,), (10**6,)], "d long")
    plan = delivery.redelivery_plan(data, F.col("d"), 3000, 3).select("d", "sends", "backoffs")
    assert rows(plan) == [(None, 4, None), (10**6, 4, 330)]
    off_plan = delivery.redelivery_plan(data, F.col("d"), 0, 3).select("sends", "backoffs")
    assert rows(off_plan) == [(1, 0), (1, 0)]


def test_poll_interval_grows_with_the_new_count(spark):
    plan = delivery.redelivery_plan(spark.createDataFrame([(9_001,)], "d long"), F.col("d"))
    timeline = delivery.redelivery_timeline(plan).select("attempt", "after_ms", "poll_interval_ms")
    assert rows(timeline) == [(0, 0, 1000), (1, 3000, 2000), (2, 6000, 3000), (3, 9000, 4000)]


def test_resume_plans(spark):
    subscribed = off.of(spark, {("t", 0): 0, ("t", 1): 0})
    confirmed = off.of(spark, {("t", 0): 5, ("t", 1): 6})
    committed = off.of(spark, {("t", 0): 3})
    store = off.of(spark, {("t", 1): 4})
    for mode in ("auto_partition", "auto_partition_basic"):
        assert rows(delivery.resume_plan(mode, subscribed, confirmed, committed, store)) == [("t", 0, 3), ("t", 1, 0)]
    manual = delivery.resume_plan("auto_partition_with_manual_offset", subscribed, confirmed, committed, store)
    assert rows(manual) == [("t", 0, 0), ("t", 1, 4)]
    for mode in ("manual_partition", "manual_offset", "manual_offset_for_times"):
        assert rows(delivery.resume_plan(mode, subscribed, confirmed, committed, store)) == [("t", 0, 5), ("t", 1, 6)]
        for nothing in (None, off.empty(spark)):
            assert rows(delivery.resume_plan(mode, subscribed, nothing, committed)) == [("t", 0, 0), ("t", 1, 0)]
        some = off.of(spark, {("t", 1): 9})
        assert rows(delivery.resume_plan(mode, subscribed, some)) == [("t", 0, 0), ("t", 1, 9)]
    assert rows(delivery.resume_plan("auto_partition", subscribed)) == rows(subscribed)
    with pytest.raises(ValueError):
        delivery.resume_plan("sometimes", subscribed)
