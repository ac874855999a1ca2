"""What a set of filters removes in every order of applying them: min-plus removal ranks.

Each document gets a mask of the filters it fails. Documents of one part and
one mask behave alike in every order, so only their numbers are kept: a table of
at most ``parts * 2**filters`` weights, whatever the size of the corpus. With a
mask matrix (0 where a filter fails, else infinite) and a matrix of the position
of each filter in each order (the inverse permutation), the product in the
(min, +) semiring is the step at which documents of a mask go; the weights are
then added up at those steps.

Texts are whole, null is empty. Words are maximal runs of bytes that are not
white space. Identical texts are told by their SHA-256; the earliest doc_id
stays, rows that repeat it stay with it, and a null doc_id comes after every
other. A null part is the empty string. Label rows of one document are joined by
"any of them"; a document without labels, or without doc_id, has none. Extra
columns of either table are not looked at. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog.llm import text as tx
from streamlog.session import materialize

_CAPITALS = bytes(range(65, 91))
_LATER_BYTES = bytes(range(128, 192))
_SYMBOLS = b"#$%&*|"


class Facts(NamedTuple):
    """Counts of each text of a batch."""

    words: np.ndarray
    distinct: np.ndarray
    capitals: np.ndarray
    points: np.ndarray
    symbols: np.ndarray


#: Failure conditions by the letter of their filter.
RULES: dict[str, Callable[[Facts], np.ndarray]] = {
    "A": lambda f: f.words < 50,
    "B": lambda f: 100 * f.distinct < 65 * f.words,
    "C": lambda f: 100 * f.capitals > 5 * f.points,
    "D": lambda f: f.symbols > 0,
}
#: Letter of the filter that removes later copies of a text.
COPIES = "E"
#: Orders grow with the factorial of the filters.
MOST_FILTERS = 7

_NARROW = "part string, digest binary, mask int"
_AUDIT = "part string, filter_order string, step int, " + ", ".join(
    f"{c} long" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
)


def facts(texts: list[bytes]) -> Facts:
    rows = np.zeros((5, len(texts)), dtype=np.int64)
    for i, body in enumerate(texts):
        # Without arguments, split() cuts bytes at exactly the six ASCII white-space characters.
        found = body.split()
        n = len(body)
        rows[:, i] = (
            len(found), len(set(found)), n - len(body.translate(None, _CAPITALS)), len(body.translate(None, _LATER_BYTES)),
            n - len(body.translate(None, _SYMBOLS)),
        )
    return Facts(*rows)


def failures(
    docs: DataFrame, rules: Mapping[str, Callable[[Facts], np.ndarray]] = RULES, *, part_col: str = "source",
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, part, digest, mask) of every document; bit i of the mask is set if the i-th rule fails."""
    checks = list(rules.values())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, bounds = tx.buffers(batch.column("_text"))
            for a, b in tx.slices(bounds, 4 << 20):
                texts = [t or b"" for t in batch.column("_text").slice(a, b - a).cast(pa.large_binary()).to_pylist()]
                counted = facts(texts)
                mask = sum((check(counted).astype(np.int32) << i for i, check in enumerate(checks)), np.zeros(len(texts), np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a), batch.column("_part").slice(a, b - a),
                    pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array(mask),
                ], names=["doc_id", "part", "digest", "mask"])

    narrow = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("_part"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
    )
    return narrow.mapInArrow(judge, f"doc_id {dict(docs.dtypes)[id_col]}, {_NARROW}")


def _labelled(failed: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """Rows of one document and text as one, with their number and how many are good and toxic."""
    def any_one(column: str) -> Column:
        return F.max(F.coalesce((F.col(f"`{column}`") == 1).cast("long"), F.lit(0).cast("long")))

    known = labels.filter(F.col(f"`{id_col}`").isNotNull()).groupBy(F.col(f"`{id_col}`").cast("string").alias("_key")).agg(
        any_one("quality").alias("good"), any_one("toxic").alias("toxic")
    )
    # Rows without doc_id are dealt by their text: they match no label.
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("\n"), F.hex("digest")))
    rows = failed.withColumn("_key", key).join(known, "_key", "left")
    zero = F.lit(0).cast("long")
    return rows.groupBy("_key", "doc_id", "part", "digest", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", zero)).alias("good"), F.sum(F.coalesce("toxic", zero)).alias("toxic")
    ).drop("_key")


def weights(failed: DataFrame, labels: DataFrame, copies_bit: int, *, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, later copies with the bit of their filter.

    All rows count as copies first; those of the earliest doc_id of each text are
    then moved. Copies are counted before they are shuffled, and rows meet their
    text's earliest doc_id by both keys, so no task gets all copies of a text.
    """
    rows = materialize(_labelled(failed, labels, id_col), "failures")
    earliest = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"))
    same = rows["digest"].eqNullSafe(earliest["digest"]) & rows["doc_id"].eqNullSafe(earliest["_first"])
    first = rows.join(earliest, same, "left_semi")

    def summed(df: DataFrame, sign: int, bit: int) -> DataFrame:
        total = [(sign * F.sum(c)).alias(c) for c in ("n", "good", "toxic")]
        return df.groupBy("part", F.col("mask").bitwiseOR(F.lit(bit)).alias("mask")).agg(*total)

    bit = 1 << copies_bit
    moved = summed(rows, 1, bit).union(summed(first, -1, bit)).union(summed(first, 1, 0))
    return moved.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).filter("n > 0")


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Step at which each mask (rows: masks x filters) goes in each order (orders x filters); filters + 1 if it stays.

    The (min, +) product of the two matrices.
    """
    never = positions.shape[1] + 1
    cost = np.where(masks, 0, never).astype(np.int64)
    return np.minimum((cost[:, None, :] + positions[None, :, :]).min(axis=2), never)


class _Orders:
    """All orders of the filters and what each of the masks meets in them."""

    def __init__(self, letters: str):
        self.k = k = len(letters)
        self.names = ["".join(o) for o in permutations(letters)]
        self.orders = np.array(list(permutations(range(k))))
        self.positions = np.argsort(self.orders, axis=1) + 1
        self.masks = (np.arange(1 << k)[:, None] >> np.arange(k)[None, :] & 1).astype(bool)
        self.steps = removal_steps(self.masks, self.positions)
        # [mask, order, filter]: fails the filter, but has gone before its turn.
        self.wasted = self.masks[:, None, :] & (self.steps[:, :, None] < self.positions[None, :, :])

    def audit(self, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Counts by order and step from (masks x 3) weights: all, good and toxic documents."""
        k, n_orders = self.k, len(self.names)
        gone = np.zeros((n_orders, k + 2, 3), dtype=np.int64)
        np.add.at(gone, (np.arange(n_orders)[None, :], self.steps), weight[:, None, :])
        removed = gone[:, 1 : k + 1]
        kept = weight[:, 0].sum() - np.cumsum(removed[:, :, 0], axis=1)
        redundant = np.einsum("mof,m->of", self.wasted.astype(np.int64), weight[:, 0])
        # By filter first, then in the place the order gives it.
        by_filter = np.take_along_axis(removed[:, :, 0], self.positions - 1, axis=1).sum(axis=0)
        alone = weight[1 << np.arange(k), 0]
        return {
            "kept": kept, "removed": removed[:, :, 0], "redundant": np.take_along_axis(redundant, self.orders, axis=1),
            "unique_fails": alone[self.orders], "good_lost": removed[:, :, 1], "toxic_lost": removed[:, :, 2], "shapley": by_filter[self.orders],
        }


def removal_audit(weight: DataFrame, letters: str) -> DataFrame:
    """(part, filter_order, step, kept, removed, ...) for every order and step, from the table of ``weights``.

    ``letters`` names the filters from the lowest bit of the mask on.
    """
    if not 0 < len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"1 to {MOST_FILTERS} filters with different letters, not {letters!r}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = _Orders(letters)
        k, n_orders = every.k, len(every.names)
        order = pa.array(np.repeat(np.array(every.names), k))
        step = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n_orders))
        for batch in batches:
            for row in batch.to_pylist():
                own = np.zeros((1 << k, 3), dtype=np.int64)
                for w in row["weights"]:
                    own[w["mask"]] = w["n"], w["good"], w["toxic"]
                counts = every.audit(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * (n_orders * k), pa.string()), order, step, *[pa.array(c.reshape(-1)) for c in counts.values()]],
                    names=["part", "filter_order", "step", *counts],
                )

    gathered = weight.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("weights"))
    return gathered.mapInArrow(count, _AUDIT)


def audit_filters(
    docs: DataFrame, labels: DataFrame, rules: Mapping[str, Callable[[Facts], np.ndarray]] = RULES, *, copies: str = COPIES,
    part_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per part, order of filters and step: what the filter of that step removes, wastes and costs.

    ``kept`` documents are left after the step, ``removed`` go in it,
    ``redundant`` ones fail its filter but went earlier, ``unique_fails`` fail
    that filter only, ``good_lost`` and ``toxic_lost`` are removed with quality 1
    and toxic 1, ``shapley`` is all that the filter removes, summed over all orders.
    """
    failed = failures(docs, rules, part_col=part_col, id_col=id_col, text_col=text_col)
    return removal_audit(weights(failed, labels, len(rules), id_col=id_col), "".join(rules) + copies)
