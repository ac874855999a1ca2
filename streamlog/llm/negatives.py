"""Hard negatives for every anchor, found with segment summaries of the vectors.

A vector is cut into segments; of each its mean and deviation are stored. For a
segment of d components ``x . y`` lies within ``d * (mx * my +- sx * sy)``, since
what is left after the means is bounded by the product of the deviations. Sums
over all segments bound the score of a pair. Bounds of few long segments come
first; pairs that they leave open are bounded again with more, shorter segments
(``LEVELS``), and only what is still open is scored exactly, in integers. No pair
is dropped but those whose bounds prove that they are not wanted.

Anchors are a query set that meets all rows, in blocks: rows are dealt to slots
and anchors to groups of bounded size, and each (slot, group) is one task that
keeps the best rows of each anchor. The lists of all slots are then merged.

Rows without label or vector, and those with a component that is null, NaN or
infinite, take no part. Rows are told apart by themselves, not by their vec_id:
of repeated rows each counts. Equal scores come in the order of vec_id, null
last. Only vectors of one length meet; an empty vector scores 0. Components and
scores have to fit 53 bits, else the job ends with an OverflowError. Other
columns may have any name. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlog.session import materialize

#: Segments of a vector, from coarse to fine; a level that doesn't divide the length is left out.
LEVELS = (1, 8, 32)
#: Bytes of components in a slot of rows or a group of anchors: what a task holds of each.
SLOT_BYTES = 32 << 20
#: Rows and anchors whose pairs are bounded at a time.
ROWS, ANCHORS = 2048, 512
#: Least rows in a slot when there are fewer slots than tasks.
LEAST_ROWS = 2048
#: Share of open pairs below which they are taken one by one rather than as a whole matrix.
SPARSE = 0.1
#: Pairs taken one by one at a time.
PAIRS = 1 << 16
#: No score: below every real one.
NONE = -(1 << 62)

_ROW = "key long, vec_id long, label int, n int, vec array<int>, means array<double>, devs array<double>"


def summaries(values: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row."""
    cut = values.reshape(len(values), segments, -1).astype(np.float64)
    return cut.mean(axis=2), cut.std(axis=2)


def coarser(means: np.ndarray, devs: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of longer segments from those of the shorter ones they consist of."""
    m = means.reshape(len(means), segments, -1)
    s = devs.reshape(len(devs), segments, -1)
    mean = m.mean(axis=2)
    square = (s**2 + m**2).mean(axis=2) - mean**2
    return mean, np.sqrt(np.maximum(square, 0))


def levels_of(length: int, levels: Sequence[int] = LEVELS) -> list[int]:
    """The levels that cut a vector of this length into equal segments, each dividing the next."""
    found: list[int] = []
    for level in sorted(levels):
        if length and length % level == 0 and (not found or level % found[-1] == 0):
            found.append(level)
    return found


def prepare(vectors: DataFrame, label: Column, scale: float, levels: Sequence[int], id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """Integer vectors with their finest segment summaries, written to the shared folder, each row with a key of its own."""
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("_vec")
            lengths = values.value_lengths().to_numpy(zero_copy_only=False)
            flat = np.floor(scale * values.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(flat) and np.abs(flat).max() > np.iinfo(np.int32).max:
                raise OverflowError("a component does not fit 32 bits")
            bounds = np.concatenate(([0], np.cumsum(lengths)))
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                own = flat[(bounds[at][:, None] + np.arange(n)[None, :]).astype(np.int64)].astype(np.int32)
                used = levels_of(n, levels)
                mean, dev = summaries(own, used[-1]) if used else (np.zeros((len(at), 0)),) * 2
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    batch.column("_key").take(take), batch.column("_id").take(take), batch.column("_label").take(take),
                    pa.array(np.full(len(at), n, np.int32)), _lists(own), _lists(mean), _lists(dev),
                ], names=["key", "vec_id", "label", "n", "vec", "means", "devs"])

    vector = F.col(f"`{vector_col}`")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    usable = vectors.filter(F.col(f"`{label_col}`").isNotNull() & vector.isNotNull()).filter(fine)
    narrow = usable.select(
        F.monotonically_increasing_id().alias("_key"), F.col(f"`{id_col}`").cast("long").alias("_id"), label.cast("int").alias("_label"),
        vector.cast("array<double>").alias("_vec"),
    )
    return materialize(narrow.mapInArrow(summarise, _ROW), "vectors")


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(matrix).reshape(-1)))


class _Side:
    """Vectors of one length, by label."""

    def __init__(self, table: pa.Table, n: int):
        at = np.flatnonzero(table.column("n").to_numpy() == n)
        label = table.column("label").to_numpy()[at]
        at = at[np.argsort(label, kind="stable")]
        part = table.take(pa.array(at))
        self.key = part.column("key").to_numpy()
        ids = part.column("vec_id").combine_chunks()
        # A null vec_id comes after all others.
        self.ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.nameless = ids.is_null().to_numpy(zero_copy_only=False)
        self.label = part.column("label").to_numpy()
        self.vec = _matrix(part.column("vec"), len(at)).astype(np.float64)
        if len(at) and np.abs(self.vec).max(initial=0) ** 2 * n >= 1 << 53:
            raise OverflowError("a score may not fit 53 bits")
        finest = _matrix(part.column("means"), len(at)), _matrix(part.column("devs"), len(at))
        self.levels = {finest[0].shape[1]: finest} if finest[0].shape[1] else {}
        self.part = part

    def at_level(self, segments: int) -> tuple[np.ndarray, np.ndarray]:
        if segments not in self.levels:
            self.levels[segments] = coarser(*self.levels[max(self.levels)], segments)
        return self.levels[segments]


def _matrix(lists: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, -1) if n and len(flat) else np.zeros((n, 0))


def _open_pairs(rows: _Side, r: slice, anchors: _Side, a: slice, levels: list[int], alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of the pairs of a tile whose score lies in [low, high] of its anchor.

    ``alive`` marks the pairs asked for. Each level closes those whose bounds
    miss the range; the rest are scored.
    """
    width = rows.vec.shape[1]
    x, y = rows.vec[r], anchors.vec[a]
    # Room for the rounding of the bounds.
    slack = 1e-9 * np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :] + 1e-3
    i, j = None, None
    for level in levels:
        (mx, sx), (my, sy) = (rows.at_level(level), anchors.at_level(level))
        mx, sx, my, sy, d = mx[r], sx[r], my[a], sy[a], width // level
        if i is None:
            means, spread = d * (mx @ my.T), d * (sx @ sy.T) + slack
            alive &= (means + spread >= low[None, :]) & (means - spread <= high[None, :])
            if alive.mean() < SPARSE:
                i, j = np.nonzero(alive)
        else:
            keep = np.zeros(len(i), dtype=bool)
            for c in range(0, len(i), PAIRS):
                p, q = i[c : c + PAIRS], j[c : c + PAIRS]
                means, spread = d * (mx[p] * my[q]).sum(axis=1), d * (sx[p] * sy[q]).sum(axis=1) + slack[p, q]
                keep[c : c + PAIRS] = (means + spread >= low[q]) & (means - spread <= high[q])
            i, j = i[keep], j[keep]
    if i is None:
        score = x @ y.T
        i, j = np.nonzero(alive & (score >= low[None, :]) & (score <= high[None, :]))
        return i, j, score[i, j].astype(np.int64)
    score = np.concatenate([np.zeros(0), *[(x[i[c : c + PAIRS]] * y[j[c : c + PAIRS]]).sum(axis=1) for c in range(0, len(i), PAIRS)]])
    keep = (score >= low[j]) & (score <= high[j])
    return i[keep], j[keep], score[keep].astype(np.int64)


class _Best:
    """The first ``most`` (score, vec_id, key) of each of n lists."""

    def __init__(self, n: int, most: int):
        self.score = np.full((n, most), NONE, dtype=np.int64)
        self.ids = np.full((n, most), np.iinfo(np.int64).max)
        self.row = np.full((n, most), -1, dtype=np.int64)

    def add(self, target: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        """Take in rows for lists ``target``."""
        if not len(target):
            return
        n, most = self.score.shape
        lists = np.unique(target)
        old = np.repeat(lists, most)
        target = np.concatenate((old, target))
        score = np.concatenate((self.score[lists].reshape(-1), score))
        ids = np.concatenate((self.ids[lists].reshape(-1), ids))
        row = np.concatenate((self.row[lists].reshape(-1), row))
        order = np.lexsort((row, ids, -score, target))
        target, score, ids, row = target[order], score[order], ids[order], row[order]
        first = np.searchsorted(target, target)
        place = np.arange(len(target)) - first
        keep = place < most
        at = target[keep], place[keep]
        self.score[at], self.ids[at], self.row[at] = score[keep], ids[keep], row[keep]

    def least(self) -> np.ndarray:
        """Score that a row needs at least to enter each list."""
        return self.score[:, -1]


def _tiles(n: int, size: int) -> list[slice]:
    return [slice(c, min(n, c + size)) for c in range(0, n, size)]


def _lengths(rows: pa.Table, anchors: pa.Table) -> list[int]:
    return sorted(set(rows.column("n").to_pylist()) & set(anchors.column("n").to_pylist()))


def _deal(rows: DataFrame, anchors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors with the (slot, group) of the task in which they meet; each pair meets in one."""
    spark = rows.sparkSession
    n_rows, row_values = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_anchors, anchor_values = anchors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = max(1, math.ceil(4 * anchor_values / SLOT_BYTES))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(1, math.ceil(4 * row_values / SLOT_BYTES), min(math.ceil(tasks / groups), math.ceil(n_rows / LEAST_ROWS)))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    own_slot, own_group = (F.pmod("key", F.lit(n)).cast("int") for n in (slots, groups))
    return (
        rows.select("*", own_slot.alias("slot"), every(groups).alias("grp")),
        anchors.select("*", own_group.alias("grp"), every(slots).alias("slot")),
    )


def _meet(rows: DataFrame, anchors: DataFrame, work, schema: str) -> DataFrame:
    x, y = _deal(rows, anchors)
    return x.groupBy("slot", "grp").cogroup(y.groupBy("slot", "grp")).applyInArrow(work, schema)


def positives(rows: DataFrame, anchors: DataFrame, most: int = 5, levels: Sequence[int] = LEVELS) -> DataFrame:
    """(anchor, rank, positive_id, score): the first rows of the anchor's label, without the anchor's own row."""
    levels = tuple(levels)

    def best(x: pa.Table, y: pa.Table) -> pa.Table:
        out = []
        for n in _lengths(x, y):
            every, asked = _Side(x, n), _Side(y, n)
            used = levels_of(n, levels)
            found = _Best(len(asked.key), most)
            for a in _tiles(len(asked.key), ANCHORS):
                for label in np.unique(asked.label[a]).tolist():
                    b = slice(a.start + int(np.searchsorted(asked.label[a], label)), a.start + int(np.searchsorted(asked.label[a], label, "right")))
                    first, last = np.searchsorted(every.label, label), np.searchsorted(every.label, label, "right")
                    for r in _tiles(last - first, ROWS):
                        r = slice(first + r.start, first + r.stop)
                        alive = every.key[r][:, None] != asked.key[b][None, :]
                        i, j, score = _open_pairs(every, r, asked, b, used, alive, found.least()[b].astype(np.float64), np.full(b.stop - b.start, np.inf))
                        found.add(b.start + j, score, every.ids[r][i], r.start + i)
            i, k = np.nonzero(found.row >= 0)
            row = found.row[i, k]
            out.append(pa.table({
                "anchor": asked.key[i], "positive": every.key[row], "positive_id": pa.array(every.ids[row], mask=every.nameless[row]), "score": found.score[i, k],
            }, schema=_POSITIVE))
        return pa.concat_tables(out) if out else _POSITIVE.empty_table()

    # An anchor's row is told by its key.
    near = _meet(rows, anchors, best, "anchor long, positive long, positive_id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"), "positive")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("anchor", "rank", "positive_id", "score")


_POSITIVE = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])
_NEGATIVE = pa.schema([("anchor", pa.int64()), ("rank", pa.int32()), ("negative", pa.int64()), ("negative_id", pa.int64()), ("score", pa.int64())])


def negatives(
    rows: DataFrame, wanted: DataFrame, most: int = 3, least_percent: int = 50, most_percent: int = 95, levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """(anchor, rank, place, negative_id, score): the first rows of other labels in the range of each positive.

    ``wanted`` are anchors with ``found``, an array of (rank, score) of their positives.
    """
    levels = tuple(levels)

    def best(x: pa.Table, y: pa.Table) -> pa.Table:
        out = []
        for n in _lengths(x, y):
            every, asked = _Side(x, n), _Side(y, n)
            used = levels_of(n, levels)
            ranges = [[(f["rank"], f["score"]) for f in fs] for fs in asked.part.column("found").to_pylist()]
            owner = np.repeat(np.arange(len(ranges)), [len(f) for f in ranges])
            rank = np.array([f[0] for fs in ranges for f in fs], dtype=np.int32)
            score = np.array([f[1] for fs in ranges for f in fs], dtype=np.int64)
            # 100 * s >= low * p and 100 * s <= high * p, in whole numbers.
            low, high = -((-least_percent * score) // 100), (most_percent * score) // 100
            begin = np.searchsorted(owner, np.arange(len(ranges) + 1))
            found = _Best(len(owner), most)
            for a in _tiles(len(asked.key), ANCHORS):
                own = slice(begin[a.start], begin[a.stop])
                for r in _tiles(len(every.key), ROWS):
                    # A pair is open if one of the anchor's ranges may still take it.
                    need = np.where(low[own] <= high[own], np.maximum(low[own], found.least()[own]), np.inf)
                    least, top = np.full(a.stop - a.start, np.inf), np.full(a.stop - a.start, -np.inf)
                    np.minimum.at(least, owner[own] - a.start, need)
                    np.maximum.at(top, owner[own] - a.start, np.where(low[own] <= high[own], high[own], -np.inf))
                    alive = every.label[r][:, None] != asked.label[a][None, :]
                    i, j, s = _open_pairs(every, r, asked, a, used, alive, least, top)
                    # Each pair for each of its anchor's ranges.
                    per = begin[a.start + j + 1] - begin[a.start + j]
                    pair = np.repeat(np.arange(len(j)), per)
                    target = begin[a.start + j][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(per) - per, per)
                    inside = (s[pair] >= low[target]) & (s[pair] <= high[target]) & (s[pair] >= found.least()[target])
                    pair, target = pair[inside], target[inside]
                    found.add(target, s[pair], every.ids[r][i[pair]], r.start + i[pair])
            i, k = np.nonzero(found.row >= 0)
            row = found.row[i, k]
            out.append(pa.table({
                "anchor": asked.key[owner[i]], "rank": rank[i], "negative": every.key[row],
                "negative_id": pa.array(every.ids[row], mask=every.nameless[row]), "score": found.score[i, k],
            }, schema=_NEGATIVE))
        return pa.concat_tables(out) if out else _NEGATIVE.empty_table()

    near = _meet(rows, wanted, best, "anchor long, rank int, negative long, negative_id long, score long")
    order = Window.partitionBy("anchor", "rank").orderBy(F.desc("score"), F.asc_nulls_last("negative_id"), "negative")
    return near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).select("anchor", "rank", "place", "negative_id", "score")


def mine(
    vectors: DataFrame, is_anchor: Column, *, label: Column | None = None, scale: float = 256.0, n_positives: int = 5,
    n_negatives: int = 3, least_percent: int = 50, most_percent: int = 95, levels: Sequence[int] = LEVELS,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components are ``floor(scale * x)``; a score is their integer inner product.
    ``is_anchor`` is a condition on the column ``vec_id``, ``label`` an expression that
    replaces the label column. For each anchor and each of its first ``n_positives``
    rows of the same label: the first ``n_negatives`` rows of other labels whose
    score is between the two percentages of the positive's.
    """
    own = F.col(f"`{label_col}`") if label is None else label
    rows = prepare(vectors, own, scale, levels, id_col, label_col, vector_col)
    anchors = rows.filter(is_anchor)
    good = materialize(positives(rows, anchors, n_positives, levels), "positives")
    found = good.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found"))
    wanted = materialize(anchors.join(found, anchors["key"] == found["anchor"]).drop("anchor"), "wanted")
    bad = negatives(rows, wanted, n_negatives, least_percent, most_percent, levels)
    names = anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = bad.withColumnRenamed("score", "negative_score").join(good.withColumnRenamed("score", "positive_score"), ["anchor", "rank"])
    return pairs.join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
