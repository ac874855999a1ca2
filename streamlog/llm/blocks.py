"""Documents in compressed blocks, and which of their keys occur in more than one block.

Repeats of windows are found in two exchanges. First every block sends the
sorted distinct filter keys of its windows, cut into ranges, and learns by a
bitmap which of them another block has too. The filter keys have
``log2(keys of the corpus) + FILTER_BITS`` bits, so at any size about one key in
2**FILTER_BITS passes by chance; they never decide anything. Only what passes
is then exchanged in full.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog.llm import text as tx
from streamlog.session import materialize

#: Bytes of text in a block. A task holds some 40 bytes for each byte of one block at a time.
BLOCK_BYTES = 4 << 20
#: Blocks whose keys of one range meet in one group.
BLOCKS_PER_RANGE = 2
FILTER_BITS = 12
#: A null doc_id ranks after every other.
NULL_RANK = np.iinfo(np.int64).max

BLOCK_SCHEMA = "block long, n_rows long, n_bytes long, ids binary, bounds binary, body binary, rest binary"
_RANGE_SCHEMA = "part int, block long, bits int, n long, keys binary"


def pack(array: np.ndarray) -> bytes:
    """Compress integers: like bytes of all values stand together."""
    planes = np.ascontiguousarray(array.view(np.uint8).reshape(len(array), -1).T) if len(array) else array
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, n).T).view(dtype).reshape(n) if n else np.zeros(0, dtype)


def pack_sorted(values: np.ndarray) -> bytes:
    """Compress ascending unsigned integers by their differences."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(blob, np.uint64, n), dtype=np.uint64)


def pack_bits(mask: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(mask).tobytes())


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), count=n).astype(bool)


class Block:
    """One block's documents: rank and bytes of each, and their other columns."""

    def __init__(self, row: dict):
        unzip = zstandard.ZstdDecompressor().decompress
        self.number, n = row["block"], row["n_rows"]
        self.ids = unpack(row["ids"], np.int64, n)
        self.bounds = unpack(row["bounds"], np.int64, n + 1)
        self.data = np.frombuffer(unzip(row["body"]), dtype=np.uint8)
        self._rest = row["rest"]

    def rest(self) -> pa.RecordBatch:
        """The columns besides the text, in their order."""
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self._rest)) as reader:
            return reader.read_next_batch()

    def doc_ids(self, id_col: str = "doc_id") -> pa.Array:
        return self.rest().column(id_col)


def write_blocks(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Write the documents as blocks to the shared folder; ``carry`` keeps all other columns."""
    rest = [c for c in docs.columns if c != text_col] if carry else [id_col]
    own_text, own_rank = tx.fresh(rest, "_text"), tx.fresh(rest, "_rank")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pressed, number = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId() << 32
        for batch in batches:
            data, bounds = tx.buffers(batch.column(own_text))
            ids = batch.column(own_rank).fill_null(NULL_RANK).to_numpy()
            for a, b in tx.slices(bounds, block_bytes):
                others = batch.select(rest).slice(a, b - a)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, others.schema) as writer:
                    writer.write_batch(others)
                yield pa.RecordBatch.from_pylist([{
                    "block": number, "n_rows": b - a, "n_bytes": int(bounds[b] - bounds[a]),
                    "ids": pack(ids[a:b]), "bounds": pack(bounds[a : b + 1] - bounds[a]),
                    "body": pressed.compress(data[bounds[a] : bounds[b]].tobytes()),
                    "rest": pressed.compress(sink.getvalue().to_pybytes()),
                }], schema=_BLOCK_ARROW)
                number += 1

    columns = [F.col(f"`{c}`") for c in rest]
    narrow = docs.select(*columns, F.col(f"`{id_col}`").cast("long").alias(own_rank), F.col(f"`{text_col}`").cast("string").alias(own_text))
    return materialize(narrow.mapInArrow(cut, BLOCK_SCHEMA), "blocks")


_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("n_rows", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()),
    ("bounds", pa.binary()), ("body", pa.binary()), ("rest", pa.binary()),
])


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, so that only one block is unpacked."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]
            tx.give_back()


def ranges(values: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Bounds of each part's values among ascending values of ``bits`` bits: ``parts + 1`` places."""
    edges = [(p << bits) // parts for p in range(1, parts)]
    return np.concatenate(([0], np.searchsorted(values, np.array(edges, dtype=np.uint64)), [len(values)])).astype(np.int64)


def n_parts(n_blocks: int) -> int:
    return max(1, math.ceil(n_blocks / BLOCKS_PER_RANGE))


def shared_keys(blocks: DataFrame, keys: Callable[[Block], np.ndarray], n_keys: int, n_blocks: int) -> DataFrame:
    """Per block, the bitmaps over its distinct filter keys that tell which of them other blocks have.

    ``keys`` gives the 64-bit keys of a block. Returns (block, bits, parts:
    array of (part, n, mask)); see ``shared_mask`` for reading them.
    """
    bits = min(64, max(1, math.ceil(math.log2(max(2, n_keys)))) + FILTER_BITS)
    parts = n_parts(n_blocks)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            own = filter_keys(keys(Block(row)), bits)
            at = ranges(own, bits, parts)
            yield pa.RecordBatch.from_pylist([
                {"part": p, "block": row["block"], "bits": bits, "n": int(b - a), "keys": pack_sorted(own[a:b])}
                for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))
            ], schema=_RANGE_ARROW)

    def meet(table: pa.Table) -> pa.Table:
        messages = table.to_pylist()
        sets = [unpack_sorted(m["keys"], m["n"]) for m in messages]
        every = np.sort(np.concatenate(sets))
        twice = every[1:][every[1:] == every[:-1]]
        return pa.Table.from_pylist([
            {"part": m["part"], "block": m["block"], "n": m["n"], "mask": pack_bits(among(own, twice))}
            for m, own in zip(messages, sets, strict=True)
        ], schema=_MASK_ARROW)

    sent = blocks.mapInArrow(send, _RANGE_SCHEMA)
    told = sent.groupBy("part").applyInArrow(meet, "part int, block long, n long, mask binary")
    return told.groupBy("block").agg(F.collect_list(F.struct("part", "n", "mask")).alias("parts")).withColumn("bits", F.lit(bits))


_RANGE_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("bits", pa.int32()), ("n", pa.int64()), ("keys", pa.binary())])
_MASK_ARROW = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("mask", pa.binary())])


def among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are in ``ascending``."""
    if not len(ascending) or not len(values):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values


def changes(values: np.ndarray) -> np.ndarray:
    """Which values differ from the one before; the first does."""
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


def filter_keys(keys: np.ndarray, bits: int) -> np.ndarray:
    # np.unique would hash the values first, at several times the cost of this sort.
    values = np.sort(keys >> np.uint64(64 - bits))
    return values[changes(values)]


def told_masks(parts: list[dict]) -> np.ndarray:
    """The masks of all parts, in the order in which the values were sent."""
    found = [unpack_bits(p["mask"], p["n"]) for p in sorted(parts, key=lambda p: p["part"])]
    return np.concatenate(found) if found else np.zeros(0, dtype=bool)


def shared_mask(keys: np.ndarray, bits: int, parts: list[dict]) -> np.ndarray:
    """Which of a block's keys another block may have too."""
    distinct = filter_keys(keys, bits)
    return among(keys >> np.uint64(64 - bits), distinct[told_masks(parts)])
