"""Remove byte strings that an earlier document has: suffixes sorted by hash comparison.

A byte goes if a string of ``size`` bytes over it also starts in a document
with a smaller doc_id. Strings never cross documents and are judged on the
input.

1. Each ``size``-byte string has an anchor: the place in it whose ``ANCHOR``
   bytes hash lowest, the leftmost of equals. Equal strings have equal anchors
   at equal places, so only strings whose anchor another document has can
   repeat. Consecutive strings with one anchor form a segment. The anchors'
   filter keys are exchanged first (``blocks.shared_keys``).
2. Segments with shared anchors are sent to the group of their anchor, equal
   segments of a block once, with the smallest doc_id. A group sorts the
   suffixes at which a whole string starts: a bottom-up mergesort whose
   comparison finds the common extension of two suffixes by binary search on
   prefix polynomial hashes. Neighbours that agree on ``size`` bytes are then
   compared byte by byte, so a hash collision can't merge different strings.
   A string goes wherever its document isn't the first of its neighbours'.
   Anchors of more than ``HOT_SEGMENTS`` segments (a phrase in ever different
   surroundings) are not sorted in one group: their strings are aggregated by
   all their bytes, once per block, to the smallest doc_id that has them.
3. Each block merges what goes into maximal spans.

Null or empty texts have no bytes. Rows that share a doc_id don't remove
anything from each other. A null doc_id ranks last; ids are numbers, a text id
that is none ends the job with an error. Columns other than doc_id and text may
have any name. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog.llm import blocks as bl
from streamlog.llm import text as tx

SIZE = 50
ANCHOR = 24
#: Segments sorted at a time; bounds the arrays of a group.
SORT_SEGMENTS = 1 << 13
#: Segments of one anchor, equal ones of a block counted once, that meet in one group at most.
HOT_SEGMENTS = 1 << 13
#: Strings whose anchors are found at a time: the arrays of a piece stay in a processor's cache.
PIECE = 1 << 16
_PLACE = np.uint64((1 << 21) - 1)
_ANCHORS, _CONTENTS, _RUNS = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    rest = width - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class _Segments:
    """Segments of one block: first string, number of strings, anchor's place, its hash, document."""

    def __init__(self, block: bl.Block, size: int):
        self.block, self.size = block, size
        data, bounds = block.data, block.bounds
        anchor = min(ANCHOR, size)
        width = size - anchor + 1
        total = max(0, len(data) - size + 1)
        long_enough = bounds[1:] - bounds[:-1] >= size
        begins, ends = bounds[:-1][long_enough], bounds[1:][long_enough] - size + 1
        edges = np.sort(np.concatenate((begins, ends)))
        found = []
        for a in range(0, total, PIECE):
            b = min(total, a + PIECE)
            hashes = tx.rolling(tx.BYTE_VALUES[data[a : b + size - 1]], anchor)
            low = hashes & ~_PLACE
            low |= np.arange(len(hashes), dtype=np.uint64)
            low = _lowest(low, width)
            new = np.ones(b - a, dtype=bool)
            np.not_equal(low[1:], low[:-1], out=new[1:])
            new[edges[np.searchsorted(edges, a) : np.searchsorted(edges, b)] - a] = True
            head = np.flatnonzero(new)
            place = (low[head] & _PLACE).astype(np.int64)
            # The lowest hashes crowd at the low end; mixed again they deal out evenly.
            found.append((head + a, np.diff(head, append=b - a), place - head, tx.mix(hashes[place] ^ _ANCHORS)))
        first, strings, offset, hashed = (
            (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
        )
        # Strings that cross documents lie behind the end of one and before the begin of the next.
        low, high = np.searchsorted(first, begins), np.searchsorted(first, ends)
        inside = _spread(low, high - low)
        self.first, self.strings, self.offset, self.anchor = first[inside], strings[inside], offset[inside], hashed[inside]
        self.rank = np.repeat(block.ids[long_enough], high - low)

    def candidates(self, bits: int, parts: list[dict]) -> np.ndarray:
        """Segments whose anchor another block may have, or another document of this block has."""
        order = np.argsort(self.anchor)
        hashes, rank = self.anchor[order], self.rank[order]
        found = np.zeros(len(order), dtype=bool)
        if not len(order):
            return np.flatnonzero(found)
        new = bl.changes(hashes)
        head = np.flatnonzero(new)
        several = np.minimum.reduceat(rank, head) != np.maximum.reduceat(rank, head)
        # In this order the filter keys ascend too, as they were sent.
        key = np.cumsum(bl.changes(hashes[head] >> np.uint64(64 - bits))) - 1
        found[order] = np.repeat(several | bl.told_masks(parts)[key], np.diff(head, append=len(order)))
        return np.flatnonzero(found)

    def distinct(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One segment, of the smallest rank, for each content among ``at``, ordered by anchor; and
        for each of ``at`` the number of its content."""
        view, digest, reach = memoryview(self.block.data), xxhash.xxh3_128_digest, self.size - 1
        anchor = self.anchor[at]
        by = np.argsort(anchor)
        ordered = anchor[by]
        # An anchor that comes once tells its content; of the others the digest does.
        again = np.zeros(len(at), dtype=bool)
        same = ordered[1:] == ordered[:-1]
        again[by[1:][same]] = again[by[:-1][same]] = True
        some = at[again]
        raw = b"".join([digest(view[a:b]) for a, b in zip(self.first[some].tolist(), (self.first[some] + self.strings[some] + reach).tolist(), strict=True)])
        pair = np.zeros((len(at), 2), dtype=np.uint64)
        pair[again] = np.frombuffer(raw, dtype=">u8").reshape(-1, 2)
        # Equal contents have equal anchors and digests; one key brings them together, all of them tell them apart.
        order = np.argsort(tx.mix(anchor ^ _CONTENTS) ^ pair[:, 0])
        new = np.ones(len(order), dtype=bool)
        new[1:] = (pair[order[1:]] != pair[order[:-1]]).any(axis=1) | (anchor[order[1:]] != anchor[order[:-1]])
        group, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        if not len(begin):
            return at, np.zeros(0, dtype=np.int64)
        rank = self.rank[at][order]
        first = rank == np.minimum.reduceat(rank, begin)[group]
        head = np.minimum.reduceat(np.where(first, at[order], np.iinfo(np.int64).max), begin)
        by_anchor = np.lexsort((head, self.anchor[head]))
        place = np.empty(len(head), dtype=np.int64)
        place[by_anchor] = np.arange(len(head))
        number = np.empty(len(at), dtype=np.int64)
        number[order] = place[group]
        return head[by_anchor], number


class Suffixes:
    """Suffixes of a buffer, compared on at most ``limit`` bytes by hashed common extensions."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit, self.hashes = data, limit, tx.PrefixHashes(data)
        # Most suffixes compared are equal on the whole limit: one look tells.
        self.whole = self.hashes.of(np.arange(len(data) - limit + 1), limit)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes i and j, up to the limit."""
        length = np.where(self.whole[i] == self.whole[j], self.limit, 0)
        rest = np.flatnonzero(length == 0)
        i, j, found = i[rest], j[rest], np.zeros(len(rest), dtype=np.int64)
        step = 1 << (self.limit.bit_length() - 1)
        while step:
            fits = found + step <= self.limit
            a, b = (i + found)[fits], (j + found)[fits]
            fits[fits] = self.hashes.of(a, step) == self.hashes.of(b, step)
            found[fits] += step
            step >>= 1
        length[rest] = found
        return length

    def before(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix i comes before suffix j (where ``or_equal``: or is the same)."""
        length = self.common(i, j)
        same = length == self.limit
        length[same] = 0
        return np.where(same, or_equal, self.data[i + length] < self.data[j + length])

    def merge_sort(self, starts: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """Sort ``starts`` inside each of the runs that ``runs`` bounds; returns the order.

        All runs are merged together, level by level; the place of a suffix in
        the other half is found by binary search.
        """
        order = np.arange(len(starts))
        size = np.diff(runs)
        place, begin, end = order, np.repeat(runs[:-1], size), np.repeat(runs[1:], size)
        width = 1
        while True:
            # Runs of no more than this are sorted.
            open_ = end - begin > width
            place, begin, end = place[open_], begin[open_], end[open_]
            if not len(place):
                return order
            left = begin + (place - begin) // (2 * width) * (2 * width)
            middle, stop = np.minimum(left + width, end), np.minimum(left + 2 * width, end)
            both = np.flatnonzero(middle < stop)
            at, left, middle, stop = place[both], left[both], middle[both], stop[both]
            right = at >= middle
            low = np.where(right, left, middle)
            high = np.where(right, middle, stop)
            base, suffix = low.copy(), starts[order[at]]
            open_ = np.arange(len(at))
            while len(open_):
                probe = (low[open_] + high[open_]) // 2
                go = self.before(starts[order[probe]], suffix[open_], right[open_])
                low[open_[go]] = probe[go] + 1
                high[open_[~go]] = probe[~go]
                open_ = open_[low[open_] < high[open_]]
            own = at - np.where(right, middle, left)
            order[left + own + low - base] = order[at]
            width *= 2

    def groups(self, starts: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """A number for each start: equal exactly if two of one run agree on ``limit`` bytes."""
        run = np.repeat(np.arange(len(runs) - 1), np.diff(runs))
        # Suffixes of a run whose hashes agree on the limit are sorted once, by the first of them.
        hashes = self.whole[starts]
        by = np.argsort(tx.mix(run.astype(np.uint64) ^ _RUNS) ^ hashes)
        new = bl.changes(hashes[by]) | bl.changes(run[by])
        single = np.zeros(len(starts), dtype=bool)
        single[by[new]] = True
        heads = np.flatnonzero(single)
        copy = np.empty(len(starts), dtype=np.int64)
        copy[by] = (np.cumsum(single) - 1)[by[new]][np.cumsum(new) - 1]
        order = self.merge_sort(starts[heads], np.searchsorted(heads, runs))
        ordered = heads[order]
        new = bl.changes(run[ordered])
        at = np.flatnonzero(~new)
        new[at] = self.common(starts[ordered[at - 1]], starts[ordered[at]]) < self.limit
        same, others = np.flatnonzero(~new), np.flatnonzero(~single)
        if self._differ(starts[ordered[same - 1]], starts[ordered[same]]) or self._differ(starts[heads[copy[others]]], starts[others]):
            number, seen = np.empty(len(starts), dtype=np.int64), {}
            for n, (r, s) in enumerate(zip(run.tolist(), starts.tolist(), strict=True)):
                number[n] = seen.setdefault((r, self.data[s : s + self.limit].tobytes()), len(seen))
            return number
        number = np.empty(len(heads), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        return number[copy]

    def _differ(self, one: np.ndarray, other: np.ndarray) -> bool:
        """Whether some of the pairs of suffixes, equal by their hashes, differ in their bytes."""
        strings = np.lib.stride_tricks.sliding_window_view(self.data, self.limit)
        return any((strings[one[a : a + (1 << 17)]] != strings[other[a : a + (1 << 17)]]).any() for a in range(0, len(one), 1 << 17))


_SENT = pa.schema([
    ("part", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("anchor", pa.binary()), ("rank", pa.binary()),
    ("strings", pa.binary()), ("offset", pa.binary()), ("body", pa.binary()),
])
_SENT_DDL = "part int, block long, n long, anchor binary, rank binary, strings binary, offset binary, body binary"


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return data[_spread(starts, lengths)]


def _judge(anchor, rank, strings, offset, data, size):
    """For each string of the segments, in order: does a smaller rank have it?"""
    total = np.concatenate(([0], np.cumsum(strings)))
    goes = np.zeros(int(total[-1]), dtype=bool)
    body_at = np.concatenate(([0], np.cumsum(strings + size - 1)))[:-1]
    order = np.argsort(anchor, kind="stable")
    hashes = anchor[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    count = np.diff(np.flatnonzero(new), append=len(order))
    order = order[np.repeat(count > 1, count)]
    count = count[count > 1]
    ends = np.cumsum(count)
    a = 0
    while a < len(count):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SORT_SEGMENTS, "right")))
        some = order[(ends[a - 1] if a else 0) : ends[b - 1]]
        n = strings[some]
        body = _gather(data, body_at[some], n + size - 1)
        within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        starts = np.repeat(np.cumsum(n + size - 1) - (n + size - 1), n) + within
        # Equal strings have their anchor at the same place: sort by anchor and place, then by suffix.
        key = np.repeat(np.repeat(np.arange(b - a), count[a:b]), n) * size + np.repeat(offset[some], n) - within
        by_key = np.argsort(key, kind="stable")
        key_new = np.ones(len(key), dtype=bool)
        key_new[1:] = key[by_key][1:] != key[by_key][:-1]
        runs = np.append(np.flatnonzero(key_new), len(key))
        group = Suffixes(body, size).groups(starts[by_key], runs)
        owner = np.repeat(rank[some], n)[by_key]
        first = np.full(len(key), bl.NULL_RANK, dtype=np.int64)
        np.minimum.at(first, group, owner)
        goes[(np.repeat(total[some], n) + within)[by_key]] = owner > first[group]
        a = b
    return goes


def _hot_anchors(sent: DataFrame) -> np.ndarray:
    """The anchors of more than ``HOT_SEGMENTS`` segments, ascending. All segments of an anchor are sent to one part."""
    most = HOT_SEGMENTS

    def count(table: pa.Table) -> pa.Table:
        anchors, n = np.unique(np.concatenate([bl.unpack_sorted(m["anchor"], m["n"]) for m in table.to_pylist()]), return_counts=True)
        return pa.table({"anchor": anchors[n > most].view(np.int64)})

    found = sent.select("part", "n", "anchor").groupBy("part").applyInArrow(count, "anchor long").toArrow()
    return np.sort(found.column("anchor").to_numpy().astype(np.int64).view(np.uint64))


def _message(m: dict) -> tuple[np.ndarray, ...]:
    """Anchor, rank, number of strings and anchor's place of each segment of a message, and their bytes."""
    return (
        bl.unpack_sorted(m["anchor"], m["n"]), *(bl.unpack(m[c], np.int64, m["n"]) for c in ("rank", "strings", "offset")),
        np.frombuffer(zstandard.ZstdDecompressor().decompress(m["body"]), np.uint8),
    )


def _without(sent: DataFrame, hot: np.ndarray, size: int) -> DataFrame:
    """The messages without the segments of hot anchors."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in bl.rows(batches):
            out = bl.among(bl.unpack_sorted(m["anchor"], m["n"]), hot)
            if out.any():
                anchor, rank, strings, offset, data = _message(m)
                starts = np.cumsum(strings + size - 1) - (strings + size - 1)
                n = strings[~out]
                m |= {
                    "n": len(n), "anchor": bl.pack_sorted(anchor[~out]), "rank": bl.pack(rank[~out]), "strings": bl.pack(n),
                    "offset": bl.pack(offset[~out]),
                    "body": zstandard.ZstdCompressor(level=3).compress(_gather(data, starts[~out], n + size - 1).tobytes()),
                }
            yield pa.RecordBatch.from_pylist([m], schema=_SENT)

    return sent.mapInArrow(cut, _SENT_DDL)


def _strings(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The strings at these places as values that compare by their bytes."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, size)[starts]).view(f"V{size}").ravel()


def _hot_strings(sent: DataFrame, hot: np.ndarray, size: int) -> DataFrame:
    """(block, hot): the strings of hot anchors that go from some document of the block, and the smallest rank of each."""
    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in bl.rows(batches):
            own = bl.among(bl.unpack_sorted(m["anchor"], m["n"]), hot)
            if not own.any():
                continue
            _, rank, strings, _, data = _message(m)
            at = np.flatnonzero(own)
            first = (np.cumsum(strings + size - 1) - (strings + size - 1))[at]
            for a in range(0, len(at), SORT_SEGMENTS):
                n = strings[at[a : a + SORT_SEGMENTS]]
                starts = np.repeat(first[a : a + SORT_SEGMENTS], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                values, number = np.unique(_strings(data, starts, size), return_inverse=True)
                owner = np.repeat(rank[at[a : a + SORT_SEGMENTS]], n)
                low = np.full(len(values), bl.NULL_RANK, dtype=np.int64)
                high = np.full(len(values), np.iinfo(np.int64).min, dtype=np.int64)
                np.minimum.at(low, number, owner)
                np.maximum.at(high, number, owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), m["block"])), pa.array(values.tolist(), pa.binary()), pa.array(low), pa.array(high)],
                    names=["block", "string", "low", "high"],
                )

    known = bl.materialize(sent.mapInArrow(single, "block long, string binary, low long, high long"), "hot-strings")
    least = known.groupBy("string").agg(F.min("low").alias("least"), F.max("high").alias("last")).filter("least < last").drop("last")
    goes = known.join(least, "string").filter("high > least").select("block", "string", "least").distinct()
    return goes.groupBy("block").agg(F.collect_list(F.struct("string", "least")).alias("hot"))


def repeated_strings(blocks: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """The blocks, each with what it needs to know its strings that smaller documents have, and the hot anchors."""
    n_blocks, n_bytes = blocks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    parts = bl.n_parts(n_blocks)
    n_anchors = max(2, 2 * n_bytes // (size - min(ANCHOR, size) + 2))
    shared = bl.materialize(
        bl.shared_keys(blocks, lambda block: _Segments(block, size).anchor, n_anchors, n_blocks), "anchors",
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pressed = zstandard.ZstdCompressor(level=3)
        for row in bl.rows(batches):
            own = _Segments(bl.Block(row), size)
            head, _ = own.distinct(own.candidates(row["bits"], row["parts"]))
            at = bl.ranges(own.anchor[head], 64, parts)
            sent = []
            for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
                some = head[a:b]
                n = own.strings[some]
                sent.append({
                    "part": p, "block": row["block"], "n": len(some), "anchor": bl.pack_sorted(own.anchor[some]),
                    "rank": bl.pack(own.rank[some]), "strings": bl.pack(n), "offset": bl.pack(own.offset[some]),
                    "body": pressed.compress(_gather(own.block.data, own.first[some], n + size - 1).tobytes()),
                })
            yield pa.RecordBatch.from_pylist(sent, schema=_SENT)

    def judge(table: pa.Table) -> pa.Table:
        tx.give_back()
        unzip = zstandard.ZstdDecompressor().decompress
        messages = table.drop_columns(["body"]).to_pylist()
        columns = [
            np.concatenate([f(m) for m in messages]) for f in (
                lambda m: bl.unpack_sorted(m["anchor"], m["n"]), lambda m: bl.unpack(m["rank"], np.int64, m["n"]),
                lambda m: bl.unpack(m["strings"], np.int64, m["n"]), lambda m: bl.unpack(m["offset"], np.int64, m["n"]),
            )
        ]
        data = np.concatenate([np.frombuffer(unzip(x.as_py()), np.uint8) for x in table.column("body")])
        goes = _judge(*columns, data, size)
        ends = np.concatenate(([0], np.cumsum(columns[2])))[np.cumsum([0, *(m["n"] for m in messages)])]
        return pa.Table.from_pylist([
            {"part": m["part"], "block": m["block"], "n": int(b - a), "mask": bl.pack_bits(goes[a:b])}
            for m, a, b in zip(messages, ends[:-1], ends[1:], strict=True)
        ], schema=bl._MASK_ARROW)

    sent = bl.materialize(blocks.join(shared, "block").mapInArrow(send, _SENT_DDL), "segments")
    hot = _hot_anchors(sent)
    told = (_without(sent, hot, size) if len(hot) else sent).groupBy("part").applyInArrow(judge, "part int, block long, n long, mask binary")
    later = told.groupBy("block").agg(F.collect_list(F.struct("part", "n", "mask")).alias("later"))
    known = blocks.join(shared.join(later, "block"), "block")
    return (known.join(_hot_strings(sent, hot, size), "block", "left") if len(hot) else known), hot


def _removed(row: dict, size: int, hot: np.ndarray) -> tuple[bl.Block, np.ndarray]:
    """The block and which of its bytes go."""
    own = _Segments(bl.Block(row), size)
    at = own.candidates(row["bits"], row["parts"])
    head, number = own.distinct(at)
    # Of hot anchors nothing was sorted: their strings are looked up below.
    sorted_ = ~bl.among(own.anchor[head], hot)
    goes = np.zeros(int(own.strings[head].sum()), dtype=bool)
    goes[np.repeat(sorted_, own.strings[head])] = bl.told_masks(row["later"])
    begin = np.cumsum(own.strings[head]) - own.strings[head]
    n = own.strings[at]
    verdict = goes[_spread(begin[number], n)]
    verdict |= np.repeat(own.rank[at] > own.rank[head][number], n)
    least = {x["string"]: x["least"] for x in row.get("hot") or ()}
    if least:
        some, ends = np.flatnonzero(bl.among(own.anchor[at], hot)), np.cumsum(n)
        for a in range(0, len(some), SORT_SEGMENTS):
            part = some[a : a + SORT_SEGMENTS]
            place = _spread((ends - n)[part], n[part])
            strings = _strings(own.block.data, _spread(own.first[at[part]], n[part]), size).tolist()
            low = np.array([least.get(x, bl.NULL_RANK) for x in strings], dtype=np.int64)
            verdict[place] |= np.repeat(own.rank[at[part]], n[part]) > low
    return own.block, tx.covered(_spread(own.first[at], n)[verdict], size, len(own.block.data))


def suffix_dedup(docs: DataFrame, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept, kept_sha256) of every document.

    ``kept`` has the remaining bytes, which may cut through a character;
    ``kept_sha256`` is its lower-case SHA-256 in hex.
    """
    known, hot = repeated_strings(bl.write_blocks(docs, id_col=id_col, text_col=text_col), size)
    id_type = dict(docs.dtypes)[id_col]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows(batches):
            block, gone = _removed(row, size, hot)
            bounds = block.bounds
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = bounds[:-1][bounds[:-1] < bounds[1:]]
            begins[edge] = gone[edge]
            count, spans = (np.searchsorted(np.flatnonzero(x), bounds) for x in (gone, begins))
            body, at = block.data[~gone].tobytes(), bounds - count
            kept = [body[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([
                block.doc_ids(id_col), pa.array(np.diff(bounds)), pa.array(np.diff(count)), pa.array(np.diff(spans)),
                pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return known.mapInArrow(cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def cut_repeats(docs: DataFrame, *, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, repeated strings cut out of the text.

    A character goes only if all its bytes go, so texts stay valid. A null text stays null.
    """
    no_text = tx.fresh(docs.columns, "_no_text")
    marked = docs.withColumn(no_text, F.col(f"`{text_col}`").isNull())
    known, hot = repeated_strings(bl.write_blocks(marked, id_col=id_col, text_col=text_col, carry=True), size)
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows(batches):
            block, gone = _removed(row, size, hot)
            chars = np.flatnonzero((block.data & 0xC0) != 0x80)
            if len(chars):
                gone = np.repeat(np.logical_and.reduceat(gone, chars), np.diff(chars, append=len(gone)))
            count = np.searchsorted(np.flatnonzero(gone), block.bounds)
            body, at = block.data[~gone].tobytes(), block.bounds - count
            rest = block.rest()
            empty = rest.column(no_text).to_pylist()
            texts = pa.array([None if e else body[a:b].decode() for e, a, b in zip(empty, at[:-1], at[1:], strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if c == text_col else rest.column(c) for c in names], names=names)

    return known.mapInArrow(cut, docs.schema)
