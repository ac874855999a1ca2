"""Near-duplicates by SimHash, found with covering locality-sensitive hashing.

A table of the index keeps the bits that its mask selects. The masks come from
a random-looking vector of RADIUS + 1 bits for each bit position: the mask of a
vector v has the positions whose vectors have an odd product with v. For any
RADIUS positions some v other than zero is orthogonal to all their vectors, so
two fingerprints that differ in at most RADIUS bits agree on that mask: every
such pair collides in one of the ``2**(RADIUS + 1) - 1`` tables. None is missed.

``fingerprint_components`` links fingerprints that differ in at most two bits.
``drop_near_duplicates`` makes groups of texts whose five-word shingles have a
Jaccard similarity of 0.8 or more. Fingerprints within two bits, from the
covering tables, make first groups. Texts at a similarity of 0.8 differ in about
ten bits of 64, far more than covering masks can serve, so further groups come
from shingles: two similar sets share one of the first fifth of their shingles
in any common order. A member of a group is compared with the representatives of
that group first, on the full sets; these comparisons grow with the memberships.
Representatives are central members: those with the smallest share of shingles
that nobody else has. Members of a group that links don't connect by then are
compared with each other, so that no similar pair is left unconnected.

A text is worked on as a whole, however long. Columns other than the id and the
text may have any name. No documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog.llm import blocks as bl
from streamlog.llm import text as tx
from streamlog.llm.blocks import unpack_sorted
from streamlog.llm.components import components
from streamlog.session import materialize

RADIUS = 2
SEED = 42
#: Bytes of text worked on at a time in a task.
SLICE = 2 << 20
#: Slots that estimate how frequent a shingle is; one array of them is broadcast.
SLOTS = 1 << 20
#: Representatives of each group: the most central member and others by chance.
REPRESENTATIVES = 3
#: Members of a group that meet as many others in one task.
CHUNK = 2000
#: Longs of the sketch that rules pairs out before their sets are compared.
SKETCH = 32


def masks(radius: int = RADIUS) -> list[int]:
    """The covering masks over 64 bits, as signed longs."""
    n = (1 << (radius + 1)) - 1
    found = []
    for v in range(1, n + 1):
        bits = sum(1 << i for i in range(64) if bin((1 + i % n) & v).count("1") % 2)
        found.append(bits - (1 << 64) if bits >> 63 else bits)
    return found


def _majority(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """For each document the bits that more than half of its hashes have set. ``doc`` ascends.

    Four 16-bit counters are added in one 64-bit lane, over runs short enough not to overflow.
    """
    if not len(hashes):
        return np.zeros(n_docs, dtype=np.uint64)
    run = 65535
    first = np.searchsorted(doc, np.arange(n_docs))
    total = np.bincount(doc, minlength=n_docs)
    within = np.arange(len(doc)) - first[doc]
    cuts = np.flatnonzero(within % run == 0)
    owner = doc[cuts]
    result = np.zeros(n_docs, dtype=np.uint64)
    for shift in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(shift)) & np.uint64(0x0001000100010001), cuts)
        for k in range(4):
            part = ((sums >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(np.float64)
            more = 2 * np.bincount(owner, part, n_docs).astype(np.int64) > total
            result |= more.astype(np.uint64) << np.uint64(shift + 16 * k)
    return result


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))


def _lowered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(ids, bytes, word starts, word ends, word's document) of bounded slices, A-Z lower-cased."""
    for batch in batches:
        data, bounds = tx.buffers(batch.column("_text"))
        for a, b in tx.slices(bounds, SLICE):
            low = tx.lower_ascii(data[bounds[a] : bounds[b]])
            yield (batch.column("doc_id").slice(a, b - a), low, *tx.words(low, bounds[a : b + 1] - bounds[a]))


def fingerprints(docs: DataFrame, *, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, bits long): SimHash of every text's word shingles, repeats included.

    A bit is set if more than half the shingles' XXH64 have it set. Fewer words
    than a shingle make one shingle of all words; no words (also null) give zero.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for ids, data, starts, ends, doc in _lowered(batches):
            body, place = tx.joined(data, starts, ends)
            stop, view = place + (ends - starts), memoryview(body)
            n = max(0, len(doc) - shingle + 1)
            full = np.flatnonzero(doc[:n] == doc[shingle - 1 :][:n])
            first = np.searchsorted(doc, np.arange(len(ids)))
            count = np.bincount(doc, minlength=len(ids))
            short = np.flatnonzero((count > 0) & (count < shingle))
            begin = np.concatenate((full, first[short]))
            last = np.concatenate((full + shingle - 1, first[short] + count[short] - 1))
            order = np.argsort(begin, kind="stable")
            begin, last = begin[order], last[order]
            hashes = np.array([digest(view[a:b], SEED) for a, b in zip(place[begin].tolist(), stop[last].tolist(), strict=True)], dtype=np.uint64)
            bits = _majority(hashes, doc[begin], len(ids))
            yield pa.RecordBatch.from_arrays([ids, pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return _texts(docs, id_col, text_col).mapInArrow(sketch, f"doc_id {dict(docs.dtypes)[id_col]}, bits long")


def _tables(bits: Column) -> Column:
    """(table, key) of a fingerprint in every table of the covering index."""
    return F.array(*[F.struct(F.lit(t).alias("t"), bits.bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks())])


def fingerprint_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column bits) differing in at most two bits.

    Buckets of two are compared. The members of larger buckets name all values
    within one bit of themselves: members that name one value are within two
    bits of each other, and two members within two bits share such a value. A
    link from each to the smallest keeps them connected; no pairs within a
    bucket are made, so the work grows with its members.
    """
    keyed = distinct.select("bits", F.explode(_tables(F.col("bits"))).alias("x")).select("bits", "x.t", "x.key")
    buckets = materialize(
        keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b")).filter("n > 1"),
        "buckets",
    )
    pairs = buckets.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS).select("a", "b")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(64)])
    near = (
        keyed.join(buckets.filter("n > 2").select("t", "key"), ["t", "key"], "left_semi")
        .select("bits").distinct()
        .select("bits", F.explode(flips).alias("flip"))
        .select("bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("centre"))
    )
    least = near.groupBy("centre").agg(F.min("bits").alias("a"), F.count("*").alias("n")).filter("n > 1").drop("n")
    stars = near.join(least, "centre").filter("bits <> a").select("a", F.col("bits").alias("b"))
    return pairs.union(stars).distinct()


def fingerprint_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): fingerprints within two bits are linked.

    ``component_id`` is the smallest doc_id that links reach. Empty and null
    texts have fingerprint zero and are linked like any other. Rows without
    doc_id are linked too, but name no component; it is null if no row has one.
    """
    found = materialize(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = found.groupBy("bits").agg(F.min("doc_id").alias("least"))
    labels = components(fingerprint_links(distinct.select("bits")))
    rooted = distinct.join(labels, distinct["bits"] == labels["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root"),
    )
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("bits", "component_id")
    return found.join(named, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def _spans(doc: np.ndarray, n_docs: int) -> list[tuple[int, int]]:
    """First and last (exclusive) word of every document."""
    docs = np.arange(n_docs)
    return list(zip(np.searchsorted(doc, docs).tolist(), np.searchsorted(doc, docs, "right").tolist(), strict=True))


class _Shingles:
    """Distinct shingles of one block: 48-bit hashes, ascending in each document, and the document of each."""

    def __init__(self, block: bl.Block, shingle: int):
        self.data, self.n_docs = tx.lower_ascii(block.data), len(block.ids)
        self.starts, self.ends, self.doc = tx.words(self.data, block.bounds)
        hashes = tx.mix(tx.rolling(tx.hash_words(self.data, self.starts, self.ends), shingle)) >> np.uint64(16)
        n = len(hashes)
        at = np.flatnonzero(self.doc[:n] == self.doc[shingle - 1 :][:n]) if n else np.zeros(0, np.int64)
        hashes, owner = hashes[at], self.doc[at]
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.tokens, self.owner = hashes[new], owner[new]

    def keys(self) -> np.ndarray:
        return self.tokens << np.uint64(16)

    def shared(self, bits: int, parts: list[dict]) -> np.ndarray:
        """Which tokens another document of this block has, or another block may have."""
        ordered = np.sort(self.tokens)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        return bl.among(self.tokens, twice) | bl.shared_mask(self.keys(), bits, parts)

    def digests(self) -> list[bytes]:
        """Of the word sequence of each document."""
        body, place = tx.joined(self.data, self.starts, self.ends)
        stop, view = place + (self.ends - self.starts), memoryview(body)
        return [xxhash.xxh3_128_digest(view[place[i] : stop[j - 1]] if j > i else b"") for i, j in _spans(self.doc, self.n_docs)]


def _prefix_length(size: int, similarity: float) -> int:
    """Two sets this similar share one of the first so many of their tokens in any common order of all tokens."""
    return size - math.ceil(similarity * size - 1e-9) + 1


_CANDIDATE = "whole binary, bits long, size int, packed binary, shared binary"


#: An odd multiplier that spreads 48-bit shingle hashes over 64 bits.
_SPREAD = 0x9E3779B97F4A7C15


def _candidates(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """(doc_id, whole, bits, size, packed, shared) of the documents that can have a near-duplicate.

    Shingles of one document alone come first in the order of tokens. A document
    whose prefix they fill shares no prefix token with any other and goes.
    ``whole`` is the digest of the word sequence, ``bits`` the fingerprint of the
    shingles, ``packed`` their set, ``shared`` the mask of those that others may have.
    """
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.lit(0).cast("long").alias("_rank0"),
    ).filter("doc_id IS NOT NULL")
    blocks = bl.write_blocks(narrow, id_col="_rank0", carry=True)
    n_blocks, n_bytes = blocks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    shared = materialize(bl.shared_keys(blocks, lambda block: _Shingles(block, shingle).keys(), max(2, n_bytes // 4), n_blocks), "shingles")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows(batches):
            block = bl.Block(row)
            own = _Shingles(block, shingle)
            mask = own.shared(row["bits"], row["parts"])
            size = np.bincount(own.owner, minlength=own.n_docs)
            alone = size - np.bincount(own.owner[mask], minlength=own.n_docs)
            keep = [d for d in range(own.n_docs) if alone[d] < _prefix_length(int(size[d]), similarity)]
            whole, end = own.digests(), np.cumsum(size)
            bits = _majority(tx.mix(own.tokens * np.uint64(_SPREAD)), own.owner, own.n_docs).view(np.int64)
            span = [slice(int(end[d] - size[d]), int(end[d])) for d in keep]
            yield pa.RecordBatch.from_arrays([
                block.doc_ids("doc_id").take(pa.array(keep, pa.int64())), pa.array([whole[d] for d in keep], pa.binary()),
                pa.array(bits[keep], pa.int64()), pa.array([int(size[d]) for d in keep], pa.int32()), pa.array([bl.pack_sorted(own.tokens[x]) for x in span], pa.binary()),
                pa.array([bl.pack_bits(mask[x]) for x in span], pa.binary()),
            ], names=["doc_id", "whole", "bits", "size", "packed", "shared"])

    return materialize(blocks.join(shared, "block").mapInArrow(choose, f"doc_id {dict(docs.dtypes)[id_col]}, {_CANDIDATE}"), "candidates")


def _frequency(sets: DataFrame) -> np.ndarray:
    """How many shared tokens of all sets fall into each of ``SLOTS`` slots."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                tokens = unpack_sorted(r["packed"], r["size"])[bl.unpack_bits(r["shared"], r["size"])]
                np.add.at(total, (tokens % np.uint64(SLOTS)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        for a in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[a : a + (1 << 16)]), pa.array(total[at[a : a + (1 << 16)]])], names=["slot", "n"])

    rows = sets.select("size", "packed", "shared").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(SLOTS, dtype=np.int64)
    total[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return total


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(bucket, node, own, size, place): the shared tokens in the prefix of each set, and their place in its order.

    Tokens of one document come first, then those of seldom used slots: any order
    is right if it is the same for all sets, this one keeps the buckets small.
    """
    counts = sets.sparkSession.sparkContext.broadcast(_frequency(sets))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, places, nodes, sizes, owns = [], [], [], [], []
            for r in batch.to_pylist():
                n = r["size"]
                tokens, mask = unpack_sorted(r["packed"], n), bl.unpack_bits(r["shared"], n)
                alone, tokens = n - int(mask.sum()), tokens[mask]
                order = np.lexsort((tokens, counts.value[(tokens % np.uint64(SLOTS)).astype(np.int64)]))
                tokens = tokens[order[: max(0, _prefix_length(n, similarity) - alone)]]
                buckets.append(tokens.astype(np.int64))
                places.append(np.arange(alone, alone + len(tokens), dtype=np.int32))
                nodes += [r["node"]] * len(tokens)
                sizes += [n] * len(tokens)
                owns += [1000 * alone // n] * len(tokens)
            if nodes:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(buckets)), pa.array(nodes, pa.binary()), pa.array(owns, pa.int32()), pa.array(sizes, pa.int32()),
                    pa.array(np.concatenate(places)),
                ], names=["bucket", "node", "own", "size", "place"])

    keyed = materialize(sets.select("node", "size", "packed", "shared").mapInArrow(cut, "bucket long, node binary, own int, size int, place int"), "prefixes")
    crowded = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    return materialize(keyed.join(crowded, "bucket", "left_semi"), "pool")


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets of shingles have at least this Jaccard similarity."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r in batch.select(["a_size", "a_packed", "b_size", "b_packed"]).to_pylist():
                a, b = (unpack_sorted(r[f"{x}_packed"], r[f"{x}_size"]) for x in "ab")
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(bool(common) and common >= similarity * (len(a) + len(b) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a, b = (sets.select(F.col("node").alias(x), F.col("size").alias(f"{x}_size"), F.col("packed").alias(f"{x}_packed")) for x in "ab")
    return materialize(pairs.join(b, "b").join(a, "a").mapInArrow(check, "a binary, b binary"), "similar")


def _possible(similarity: float) -> Column:
    """Whether the sizes, and the tokens from the places x and y on, leave room for this similarity.

    At the first common token of two sets what follows holds all else they share,
    so a similar pair passes in at least one of its buckets.
    """
    x, y = F.col("x.size"), F.col("y.size")
    rest = F.least(x - F.col("x.place"), y - F.col("y.place"))
    return (F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9) & (rest >= similarity * (x + y - rest) - 1e-9)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _several(pool: DataFrame, links: DataFrame) -> DataFrame:
    """The buckets of the pool that hold more than one component; the others have nothing left to compare."""
    labels = components(links)
    rooted = pool.drop("root").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rooted.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("bucket")
    return materialize(rooted.join(open_, "bucket", "left_semi"), "open")


def _sketches(sets: DataFrame) -> DataFrame:
    """(node, sketch): for each of the slots whether an odd number of the set's tokens falls into it."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r in batch.select(["size", "packed"]).to_pylist():
                slot = tx.mix(unpack_sorted(r["packed"], r["size"]) * np.uint64(_SPREAD)) % np.uint64(64 * SKETCH)
                odd = np.bincount(slot.astype(np.int64), minlength=64 * SKETCH) & 1
                found.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(found, pa.list_(pa.int64()))], names=["node", "sketch"])

    return sets.select("node", "size", "packed").mapInArrow(fold, "node binary, sketch array<long>")


def _rest(left: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): members of one bucket that links don't connect and whose sizes, places and sketches allow this similarity.

    Two sets differ in at least as many tokens as their sketches in slots. The
    members of a bucket are dealt to chunks; a task gets two chunks of a bucket.
    """
    chunks = left.groupBy("bucket").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    sketches = materialize(_sketches(sets.join(left.select("node").distinct(), "node", "left_semi")), "sketches")
    dealt = materialize(
        left.join(chunks, "bucket").join(sketches, "node")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .select("bucket", "chunk", "chunks", F.struct("node", "root", "size", "place", "sketch").alias("x")), "dealt",
    )
    x = dealt.select("bucket", F.col("chunk").alias("i"), F.explode(F.sequence("chunk", F.col("chunks") - 1)).alias("j"), "x")
    y = dealt.select("bucket", F.explode(F.sequence(F.lit(0), "chunk")).alias("i"), F.col("chunk").alias("j"), F.col("x").alias("y"))
    apart = sum((F.bit_count(F.col("x.sketch")[n].bitwiseXOR(F.col("y.sketch")[n])) for n in range(1, SKETCH)), F.bit_count(F.col("x.sketch")[0].bitwiseXOR(F.col("y.sketch")[0])))
    most = (F.col("x.size") + F.col("y.size")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    once = (F.col("i") < F.col("j")) | (F.col("x.node") < F.col("y.node"))
    return _ordered(x.join(y, ["bucket", "i", "j"]).filter(once & (F.col("x.root") != F.col("y.root")) & _possible(similarity)).filter(apart <= most))


def _leader(k: int) -> Column:
    """What the k-th representative of a bucket is least in: its share of shingles of its own, then a hash."""
    first = F.col("own") if k == 0 else F.xxhash64("node", F.lit(k))
    return F.struct(first.alias("by"), "node", "size", "place")


def _fingerprint_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): each text of a group of close fingerprints with the smallest one of the group."""
    distinct = sets.select("bits").distinct()
    labels = components(fingerprint_links(distinct))
    rooted = materialize(
        sets.join(labels, sets["bits"] == labels["node"], "left").select(sets["node"], F.coalesce("root", "bits").alias("root")), "close",
    )
    least = rooted.groupBy("root").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").select("root", "a")
    return rooted.join(least, "root").filter("node <> a").select("a", F.col("node").alias("b"))


def near_duplicate_links(
    docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Links (a, b) between documents with the same words or similar enough sets of shingles.

    Texts with the same word sequence are linked to the smallest doc_id that has
    it, and only one of them is compared further. Groups are those of close
    fingerprints and, for each token of a prefix (see ``_prefix_length``), the sets
    that share it. Every member of a group is compared with its representatives:
    one for the fingerprints, ``REPRESENTATIVES`` for a token, unless earlier links
    connect the group already. What these links leave apart in the group of a
    token is compared pair by pair, see ``_rest``: every similar pair is connected.
    """
    found = _candidates(docs, id_col, text_col, shingle, similarity)
    sets = materialize(
        found.groupBy("whole").agg(F.min("doc_id").alias("doc_id"), F.first(F.struct("bits", "size", "packed", "shared")).alias("s"))
        .select(F.col("whole").alias("node"), "doc_id", "s.*"), "sets",
    )
    copies = found.select("doc_id", F.col("whole").alias("node")).join(sets.select("node", F.col("doc_id").alias("a")), "node")
    copies = copies.filter("doc_id <> a").select("a", F.col("doc_id").alias("b"))
    # Texts shorter than a shingle are similar to nothing but their copies.
    full = sets.filter("size > 0")
    links = _similar(_fingerprint_pairs(full), sets, similarity)
    pool = _prefixes(full, similarity)
    left = _several(pool, links)
    for k in range(REPRESENTATIVES):
        led = left.groupBy("bucket").agg(F.min(_leader(k)).alias("x"))
        y = left.select("bucket", F.struct("node", "size", "place").alias("y"))
        pairs = _ordered(led.join(y, "bucket").filter("x.node <> y.node").filter(_possible(similarity)))
        links = links.union(_similar(pairs, sets, similarity))
        left = _several(left, links)
    links = links.union(_similar(_rest(left, sets, similarity), sets, similarity))
    a, b = (sets.select(F.col("node").alias(x), F.col("doc_id").alias(f"{x}_id")) for x in "ab")
    return copies.union(links.join(a, "a").join(b, "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))


def drop_near_duplicates(
    docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents with all their columns; of each group of near-duplicates the smallest doc_id stays.

    Rows that share a doc_id stay or go together; rows without doc_id stay.
    """
    links = near_duplicate_links(docs, shingle=shingle, similarity=similarity, id_col=id_col, text_col=text_col)
    gone = components(links).filter("node <> root").select(F.col("node").alias(id_col))
    return docs.join(gone, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
