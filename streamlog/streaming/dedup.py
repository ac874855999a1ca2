"""Records that were sent more than once, dropped while they stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sent_once(stream: DataFrame, keys: list[str], sent_at: str, within: str) -> DataFrame:
    """The first record of each key, such as (writer, sequence), across micro-batches.

    A record that is sent again within the given time of ``sent_at``, a timestamp,
    is dropped. State of older keys is let go, so it is as large as what is sent
    in that time; a record that comes later than that is dropped as too late.
    """
    return stream.withWatermark(sent_at, within).dropDuplicatesWithinWatermark(keys)
