"""Pack documents into training sequences of several permitted lengths: variable-capacity best fit.

A sequence of length c costs ``overhead + c + c * c / span``: what it takes
anyway, its positions, padding included, and attention, which grows with the
square. Long sequences cost more a token but can hold what short ones can't,
short ones leave less room, and the overhead speaks against very short ones.

Documents longer than the longest permitted length are cut into full pieces
and a rest. Pieces are dealt by row to groups of about ``GROUP_DOCS`` documents,
and each group is packed by itself. The longest piece left opens the next bin.
For every permitted length that holds it, the bin is filled by best fit: the
largest piece left that fits the room, again and again. Of these bins, each cut
down to the smallest length that holds its contents, the one that costs least
for each of its tokens is opened; so what the other pieces can still fill
decides on the length. A group leaves about one badly filled bin.

A text without tokens (also null) gets one row without a bin. Rows that repeat
a document are packed like any other, rows without id too. Columns other than
doc_id and the length may have any name. No documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog.session import materialize

LENGTHS = (512, 1024, 2048, 4096)
#: What a sequence costs besides its tokens, and the length at which attention costs as much as the rest.
OVERHEAD, SPAN = 64, 16_384
GROUP_DOCS = 20_000


def cost(length: int, overhead: int = OVERHEAD, span: int = SPAN) -> float:
    """What a sequence of this length costs."""
    return overhead + length + length * length / span


def _filled(room: int, count: dict[int, int], sizes: int) -> list[tuple[int, int]]:
    """(size, number) of the pieces that best fit puts into a room; bit n of ``sizes`` is set if there are pieces of n tokens."""
    found = []
    while True:
        fitting = sizes & ((1 << (room + 1)) - 1)
        if not fitting:
            return found
        n = fitting.bit_length() - 1
        times = min(count[n], room // n)
        found.append((n, times))
        room -= n * times
        sizes &= ~(1 << n)


def pack(
    pieces: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, span: int = SPAN,
) -> tuple[list[int], list[int], list[int]]:
    """Bin and place of each piece, and the length of each bin. Pieces are longest first and fit the longest length."""
    left: dict[int, list[int]] = {}
    for i, n in enumerate(pieces):
        left.setdefault(n, []).append(i)
    count = {n: len(of) for n, of in left.items()}
    sizes = sum(1 << n for n in left)
    bins, places, opened = [-1] * len(pieces), [0] * len(pieces), []

    def take(n: int, times: int, at: int) -> int:
        nonlocal sizes
        for _ in range(times):
            i = left[n].pop()
            bins[i], places[i] = len(opened), at
            at += n
        count[n] -= times
        if not count[n]:
            sizes &= ~(1 << n)
        return at

    while sizes:
        first = sizes.bit_length() - 1
        at = take(first, 1, 0)
        best = None
        for c in lengths:
            if c < first:
                continue
            found = _filled(c - first, count, sizes)
            used = first + sum(n * times for n, times in found)
            length = min(x for x in lengths if x >= used)
            price = cost(length, overhead, span) / used
            if best is None or price < best[0]:
                best = price, length, found
        for n, times in best[2]:
            at = take(n, times, at)
        opened.append(best[1])
    return bins, places, opened


def pack_documents(
    counted: DataFrame, *, lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD, span: int = SPAN, id_col: str = "doc_id",
    length_col: str = "n_tokens",
) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bin_id, bin_length, place): where each piece of a document stands.

    ``start`` is the piece's first token in its document, ``place`` its first in the bin.
    """
    lengths = sorted(set(lengths))
    longest, id_type = lengths[-1], dict(counted.dtypes)[id_col]
    length = F.coalesce(F.col(f"`{length_col}`").cast("long"), F.lit(0))
    narrow = counted.select(F.col(f"`{id_col}`").alias("doc_id"), length.alias("n"), F.monotonically_increasing_id().alias("row"))
    narrow = materialize(narrow, "lengths")
    groups = max(1, -(-narrow.count() // GROUP_DOCS))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "descending"), ("doc_id", "ascending"), ("row", "ascending")])
        n = table.column("n").to_numpy()
        count = np.maximum(1, -(-n // longest))
        doc = np.repeat(np.arange(len(n)), count)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        size = np.minimum(longest, n[doc] - piece * longest)
        order = np.lexsort((piece, doc, -size))
        order = order[size[order] > 0]
        bins, places, capacity = pack(size[order].tolist(), lengths, overhead, span)
        bin_id, place, room = np.full(len(doc), -1), np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        bin_id[order], place[order] = bins, places
        room[order] = np.array(capacity, dtype=np.int64)[bins] if bins else 0
        none = bin_id < 0
        group = table.column("grp")[0].as_py()
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece), "start": pa.array(piece * longest), "n_tokens": pa.array(size),
            "bin_id": pa.array(group * (1 << 32) + bin_id, mask=none), "bin_length": pa.array(room, mask=none), "place": pa.array(place, mask=none),
        })

    grouped = narrow.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return grouped.groupBy("grp").applyInArrow(
        fill, f"doc_id {id_type}, piece long, start long, n_tokens long, bin_id long, bin_length long, place long",
    )


def byte_pair_counts(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) by a byte-pair vocabulary in rank-file form."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            n = [len(encode(t.as_py() or "")) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    return narrow.mapInArrow(count, f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long")
