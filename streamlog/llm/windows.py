"""Remove repeated runs of words: fixed-length word windows, hashed and counted over the whole corpus.

Words are ``[^\\x20\\x09-\\x0D]+``. A window is ``size`` consecutive words of
one document. A word goes if a window over it has the same words as a window
that starts earlier: in a document with a smaller doc_id, or before it in the
same document. Windows are judged on the input.

1. Rabin-Karp hashes of all windows, from prefix sums, are exchanged as sorted
   filter keys (``blocks.shared_keys``): which occur in another block as well?
2. Windows that occur elsewhere, or twice in their block, are exchanged with a
   128-bit digest of their words and their place; the smallest place of each
   digest stays. A block sends each digest once, so a passage that a third of
   all documents hold costs one row for each block, not one for each document.
3. Each block merges the windows that are not the first into maximal intervals
   and cuts them out.

Null or empty texts have no words. Rows that share a doc_id count as one
document whose windows are ordered by their start. A null doc_id ranks last; ids
are numbers, a text id that is none ends the job with an error. Windows are told
apart by a 128-bit digest that isn't cryptographic. Columns other than doc_id and
text may have any name. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog.llm import blocks as bl
from streamlog.llm import text as tx

WINDOW_WORDS = 20


class _Words:
    """Words and windows of one block."""

    def __init__(self, block: bl.Block, size: int):
        self.block, self.size = block, size
        self.starts, self.ends, self.doc = tx.words(block.data, block.bounds)
        self.hashes = tx.rolling(tx.hash_words(block.data, self.starts, self.ends), size)
        self.hashes = self.hashes[self.valid()]

    def valid(self) -> np.ndarray:
        """Word numbers at which a window starts."""
        n = max(0, len(self.doc) - self.size + 1)
        return np.flatnonzero(self.doc[:n] == self.doc[self.size - 1 :][:n])

    def candidates(self, bits: int, parts: list[dict]) -> np.ndarray:
        """Word numbers of windows that another block may have, or this block has twice."""
        elsewhere = bl.shared_mask(self.hashes, bits, parts)
        ordered = np.sort(self.hashes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        return self.valid()[elsewhere | bl.among(self.hashes, twice)]

    def first_in_block(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct digests (high, low, ascending) of the windows at ``at``, the rank and start of the
        first of each, and for each window the number of its digest, or -1 if it starts later than the first."""
        body, place = tx.joined(self.block.data, self.starts, self.ends)
        end = place + (self.ends - self.starts)
        view, digest = memoryview(body), xxhash.xxh3_128_digest
        raw = b"".join([digest(view[a:b]) for a, b in zip(place[at].tolist(), end[at + self.size - 1].tolist(), strict=True)])
        pair = np.frombuffer(raw, dtype=">u8").astype(np.uint64).reshape(-1, 2)
        rank = self.block.ids[self.doc[at]]
        first_word = np.searchsorted(self.doc, np.arange(len(self.block.ids)))
        start = at - first_word[self.doc[at]]
        order = np.lexsort((at, start, rank, pair[:, 1], pair[:, 0]))
        ordered = pair[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
        head, group = order[new], np.cumsum(new) - 1
        as_first = (rank[order] == rank[head][group]) & (start[order] == start[head][group])
        number = np.empty(len(at), dtype=np.int64)
        number[order] = np.where(as_first, group, -1)
        return pair[head, 0], pair[head, 1], rank[head], start[head], number


_SENT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("rank", pa.binary()), ("start", pa.binary())])
_SENT_DDL = "part int, block long, n long, high binary, low binary, rank binary, start binary"


def repeated_windows(blocks: DataFrame, size: int) -> DataFrame:
    """The blocks, each with what it needs to know its windows that are not the first of their words."""
    # A window starts at a word and a word takes two bytes, its separator included.
    n_blocks, n_bytes = blocks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    parts = bl.n_parts(n_blocks)
    shared = bl.materialize(
        bl.shared_keys(blocks, lambda block: _Words(block, size).hashes, max(2, n_bytes // 2), n_blocks), "shared",
    )
    known = blocks.join(shared, "block")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows(batches):
            own = _Words(bl.Block(row), size)
            high, low, rank, start, _ = own.first_in_block(own.candidates(row["bits"], row["parts"]))
            at = bl.ranges(high, 64, parts)
            yield pa.RecordBatch.from_pylist([
                {
                    "part": p, "block": row["block"], "n": int(b - a), "high": bl.pack_sorted(high[a:b]),
                    "low": bl.pack(low[a:b]), "rank": bl.pack(rank[a:b]), "start": bl.pack(start[a:b]),
                }
                for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))
            ], schema=_SENT)

    def judge(table: pa.Table) -> pa.Table:
        messages = table.to_pylist()
        sizes = [m["n"] for m in messages]
        high = np.concatenate([bl.unpack_sorted(m["high"], m["n"]) for m in messages])
        low = np.concatenate([bl.unpack(m["low"], np.uint64, m["n"]) for m in messages])
        rank = np.concatenate([bl.unpack(m["rank"], np.int64, m["n"]) for m in messages])
        start = np.concatenate([bl.unpack(m["start"], np.int64, m["n"]) for m in messages])
        order = np.lexsort((start, rank, low, high))
        same = np.zeros(len(order), dtype=bool)
        same[1:] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
        later = np.zeros(len(order), dtype=bool)
        # Equal places only if rows share a doc_id: neither is earlier, so the verdict is the first one's.
        tie = same.copy()
        tie[1:] &= (rank[order[1:]] == rank[order[:-1]]) & (start[order[1:]] == start[order[:-1]])
        head = np.maximum.accumulate(np.where(~tie, np.arange(len(order)), 0))
        later[order] = same[head]
        bounds = np.cumsum([0, *sizes])
        return pa.Table.from_pylist([
            {"part": m["part"], "block": m["block"], "n": m["n"], "mask": bl.pack_bits(later[a:b])}
            for m, a, b in zip(messages, bounds[:-1], bounds[1:], strict=True)
        ], schema=bl._MASK_ARROW)

    sent = known.mapInArrow(send, _SENT_DDL)
    told = sent.groupBy("part").applyInArrow(judge, "part int, block long, n long, mask binary")
    later = told.groupBy("block").agg(F.collect_list(F.struct("part", "n", "mask")).alias("later"))
    return blocks.join(shared.join(later, "block"), "block")


def _removed(row: dict, size: int) -> tuple[_Words, np.ndarray]:
    """The block's words and which of them go."""
    own = _Words(bl.Block(row), size)
    at = own.candidates(row["bits"], row["parts"])
    number = own.first_in_block(at)[-1]
    first = number >= 0
    goes = ~first
    goes[first] = bl.told_masks(row["later"])[number[first]]
    return own, tx.covered(at[goes], size, len(own.starts))


def substring_dedup(docs: DataFrame, *, size: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) of every document.

    ``kept`` has the remaining words joined by one space, ``kept_sha256`` its
    lower-case SHA-256 in hex.
    """
    blocks = bl.write_blocks(docs, id_col=id_col, text_col=text_col)
    known = repeated_windows(blocks, size)
    id_type = dict(docs.dtypes)[id_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows(batches):
            own, gone = _removed(row, size)
            n_docs = len(own.block.ids)
            stays = ~gone
            body, place = tx.joined(own.block.data, own.starts[stays], own.ends[stays])
            doc = own.doc[stays]
            # Where each document's kept words begin and end in the joined bytes.
            a, b = np.searchsorted(doc, np.arange(n_docs)), np.searchsorted(doc, np.arange(n_docs), "right")
            place = np.append(place, len(body) + 1)
            kept = [body[place[i] : place[j] - 1] if j > i else b"" for i, j in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([
                own.block.doc_ids(id_col),
                pa.array(np.bincount(own.doc, minlength=n_docs).astype(np.int64)),
                pa.array(np.bincount(own.doc[gone], minlength=n_docs).astype(np.int64)),
                pa.array([k.decode() for k in kept], pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ], names=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return known.mapInArrow(cut, f"doc_id {id_type}, n_words long, n_removed long, kept string, kept_sha256 string")
