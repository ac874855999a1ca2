"""A stored commit table: how far each group has confirmed and committed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlog.model import COMMITS_SCHEMA, OFFSETS_SCHEMA, TOPIC_PARTITION
from streamlog.operators.offsets import to_commits
from streamlog.streaming import consume
from streamlog.streaming.state import FRESH, StateStore


def commits_store(spark: SparkSession, path: str) -> StateStore:
    """Commit table on a shared path with one writer; the last batch's commit wins, also a lower one
    and whatever the clock says."""
    return StateStore(
        spark, path, COMMITS_SCHEMA, ["group_id", *TOPIC_PARTITION],
        {
            "offset": (F.max_by("offset", "committed_at"), lambda name: F.max_by(name, FRESH)),
            "committed_at": (F.max("committed_at"), lambda name: F.max_by(name, FRESH)),
        },
    )


def committed(store: StateStore, group_id: str) -> DataFrame:
    """Committed offsets of one group."""
    return store.read().filter(F.col("group_id") == group_id).select(*OFFSETS_SCHEMA.names)


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, DataFrame, int], bool],
    store: StateStore,
    group_id: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Hand over batches with their offsets and commit those that are confirmed.

    ``handle(batch, offsets, batch_id)`` returns True to commit the offsets of
    the batch; anything else confirms it without a commit. If it raises, the
    batch is delivered again after a restart.
    """

    def confirm(batch: DataFrame, offsets: DataFrame, batch_id: int) -> None:
        if handle(batch, offsets, batch_id) is True:
            # Committing twice does no harm, so the batch number need not be kept.
            store.apply(to_commits(offsets, group_id), store.next_id())

    return consume.start_with_offsets(stream, confirm, checkpoint, interval)
