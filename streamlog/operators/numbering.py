"""Offsets and neighbours over sorted data without a task per group.

A window over (topic, partition) sorts each partition of the log in one task,
which breaks when one of them holds a large share of all rows. Offsets are
therefore counted in time buckets of about equal size, and whatever still does
not fit a bucket (a burst, or one timestamp shared by very many rows) is cut by
range on the full sort key. Both ways give the same, exact numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from streamlog.functions.numbers import epoch_micros
from streamlog.model import TOPIC_PARTITION
from streamlog.operators.offsets import BROADCAST_LIMIT
from streamlog.session import materialize

BUCKET_ROWS = 2_000_000
HOT_FACTOR = 4
# About as many rows as one task should sort.
TASK_ROWS = 2_000_000

SPLIT = "_split"
POSITION = "_position"


def _tasks_beyond_default(df: DataFrame, rows: int) -> int | None:
    """Tasks needed for that many rows, None if the session's shuffle partitions are enough."""
    needed = -(-rows // TASK_ROWS)
    return needed if needed > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def range_split(df: DataFrame, sort_by: list[str], splits: int | None = None, scratch: str = "split") -> DataFrame:
    """Sort ``df`` globally and tag each row with its piece and its position.

    ``sort_by`` must identify a row, or the order among equal rows is open. The
    result is written out: range bounds come from a sample, so a second
    evaluation could cut elsewhere.
    """
    keys = [F.col(name) for name in sort_by]
    ranged = df.repartitionByRange(splits, *keys) if splits else df.repartitionByRange(*keys)
    tagged = ranged.sortWithinPartitions(*keys).select(
        "*",
        F.spark_partition_id().alias(SPLIT),
        F.monotonically_increasing_id().alias(POSITION),
    )
    return materialize(tagged, scratch)


def _as_number(df: DataFrame, name: str) -> Column | None:
    """A column as a number that never sorts the other way round, None if there is no such form."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(name, kind).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    return F.col(name).cast("double") if isinstance(kind, T.IntegralType) else None


def _summary(table: DataFrame, *aggregates: Column) -> list:
    """Aggregates over a small table of groups.

    Fails if a record has no topic or no partition; a join would silently lose it.
    """
    unaddressed = F.col("topic").isNull() | F.col("partition").isNull()
    lost, *found = table.agg(F.count_if(unaddressed), *aggregates).first()
    if lost:
        raise ValueError("every record needs a topic and a partition")
    return found


def _before(*groups: str, order: str) -> WindowSpec:
    return Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _in_buckets(df: DataFrame, order_by: str, bucket_rows: int, scratch: str) -> DataFrame:
    """Tag rows with a bucket that grows with the sort key, about ``bucket_rows`` rows each.

    Every partition gets its own bucket width from its row count and span.
    The tag depends on the row alone, so counting and numbering may run apart.
    """
    at = _as_number(df, order_by)
    if at is None:
        return df.withColumn("_bucket", F.lit(0).cast("long"))
    spans = df.groupBy(*TOPIC_PARTITION).agg(
        F.min(at).alias("_low"), F.max(at).alias("_high"), F.count(F.lit(1)).alias("_rows")
    )
    width = (F.col("_high") - F.col("_low") + 1) * F.lit(float(bucket_rows)) / F.col("_rows")
    spans = materialize(spans.select(*TOPIC_PARTITION, "_low", width.alias("_width")), scratch)
    [groups] = _summary(spans, F.count(F.lit(1)))
    # NULL sorts before everything else, hence a bucket of its own in front.
    bucket = F.coalesce(F.floor((at - F.col("_low")) / F.col("_width")), F.lit(-1))
    spans = F.broadcast(spans) if groups <= BROADCAST_LIMIT else spans
    return df.join(spans, TOPIC_PARTITION).withColumn("_bucket", bucket.cast("long")).drop("_low", "_width")


def assign_offsets(
    df: DataFrame,
    order_by: list[str],
    start: DataFrame | None = None,
    bucket_rows: int = BUCKET_ROWS,
    splits: int | None = None,
    scratch: str = "numbering",
) -> DataFrame:
    """Add ``offset``: 0, 1, 2, ... per (topic, partition) in the given order.

    ``order_by`` must identify a row within its partition. ``start`` is an
    offsets table; its partitions are continued from there. ``scratch`` names
    the tables written meanwhile, for a caller that removes them afterwards.

    Only the sort columns are read to count the buckets. The records then move
    once, by (topic, partition, bucket), and are numbered from the bucket's base.
    """
    rows = _in_buckets(df, order_by[0], bucket_rows, scratch)
    groups = [*TOPIC_PARTITION, "_bucket"]
    counts = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    base = F.coalesce(F.sum("_n").over(_before(*TOPIC_PARTITION, order="_bucket")), F.lit(0))
    bases = counts.select(*groups, "_n", base.alias("_base"))
    if start is not None:
        begin = start.select(*TOPIC_PARTITION, F.col("offset").alias("_start"))
        bases = bases.join(begin, TOPIC_PARTITION, "left").select(
            *groups, "_n", (F.col("_base") + F.coalesce("_start", F.lit(0))).alias("_base")
        )
    bases = materialize(bases, scratch)
    too_large = F.col("_n") > HOT_FACTOR * bucket_rows
    hot = bases.filter(too_large).select(*groups, "_base")
    total, crowded = _summary(bases, F.sum("_n"), F.sum(F.when(too_large, F.col("_n"))))

    tasks = _tasks_beyond_default(df, (total or 0) - (crowded or 0))
    if not crowded:
        numbered = _number_in_window(rows, bases, groups, order_by, tasks)
    else:
        cold = _number_in_window(rows.join(hot, groups, "left_anti"), bases, groups, order_by, tasks)
        splits = splits or _tasks_beyond_default(df, crowded)
        numbered = cold.unionByName(
            _number_by_range(rows.join(hot, groups, "left_semi"), hot, groups, order_by, splits, scratch)
        )
    return numbered.select(*TOPIC_PARTITION, "offset", *[c for c in df.columns if c not in TOPIC_PARTITION])


def _number_in_window(
    rows: DataFrame, bases: DataFrame, groups: list[str], order_by: list[str], tasks: int | None
) -> DataFrame:
    """Number rows whose groups are small enough to be sorted in one task."""
    rows = rows.repartition(tasks, *groups) if tasks else rows
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order_by))
    ranked = rows.withColumn("_rank", rank)
    return ranked.join(bases.select(*groups, "_base"), groups).withColumn(
        "offset", F.col("_base") + F.col("_rank") - 1
    ).drop("_rank", "_base")


def _number_by_range(
    rows: DataFrame, bases: DataFrame, groups: list[str], order_by: list[str], splits: int | None, scratch: str
) -> DataFrame:
    """Number rows of groups of any size: count each piece of a global sort, sum up the earlier ones.

    Spark broadcasts the table of pieces only if its written size is below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    sorted_rows = range_split(rows, [*groups, *order_by], splits, scratch)
    pieces = sorted_rows.groupBy(SPLIT, *groups).agg(
        F.min(POSITION).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    earlier = F.coalesce(F.sum("_n").over(_before(*groups, order=SPLIT)), F.lit(0))
    pieces = pieces.select(SPLIT, *groups, "_first", earlier.alias("_earlier")).join(bases, groups)
    pieces = materialize(
        pieces.select(SPLIT, *groups, (F.col("_base") + F.col("_earlier") - F.col("_first")).alias("_shift")),
        scratch,
    )
    return sorted_rows.join(pieces, [SPLIT, *groups]).withColumn(
        "offset", F.col(POSITION) + F.col("_shift")
    ).drop(SPLIT, POSITION, "_shift")


def with_next(
    df: DataFrame,
    group_by: list[str],
    order_by: list[str],
    value: Column,
    name: str,
    splits: int | None = None,
) -> DataFrame:
    """Add ``value`` of the next row of the same group, NULL on its last row.

    The same as ``lead(value) OVER (PARTITION BY group_by ORDER BY order_by)``,
    for groups of any size: neighbours are looked up inside a piece, and the
    last row of a piece takes the first row of the following one.
    """
    splits = splits or _tasks_beyond_default(df, df.count())
    head = F.struct(*group_by, value.alias("_value"))
    rows = range_split(df, [*group_by, *order_by], splits).withColumn("_head", head)
    firsts = rows.groupBy(SPLIT).agg(F.min_by("_head", POSITION).alias("_head"))
    # One row per piece, so the window below is as small as the number of pieces.
    edges = materialize(
        firsts.select(SPLIT, F.lead("_head").over(Window.orderBy(SPLIT)).alias("_edge")), "edge"
    )
    rows = rows.repartition(splits, SPLIT) if splits else rows
    within = Window.partitionBy(SPLIT).orderBy(POSITION)
    following = F.coalesce(F.lead("_head").over(within), F.col("_edge"))
    same_group = [F.col(f"_next.{g}").eqNullSafe(F.col(g)) for g in group_by]
    matches = same_group[0]
    for condition in same_group[1:]:
        matches = matches & condition
    return (
        rows.join(edges, SPLIT)
        .withColumn("_next", following)
        .select(*df.columns, F.when(matches, F.col("_next._value")).alias(name))
    )
