"""Pack documents with their lexical neighbours into training sequences.

Texts are token ids, each document ending with ``END``. Full windows of a long
document are sequences by themselves. The rests, all shorter than a window, are
dealt to shards of at most ``SHARD_DOCS``; each shard is an inverted index with
BM25 weights over the token ids. How many documents have an id, and how long
documents are, is counted over the whole corpus: one number for each id of the
vocabulary, so the size of that table is bounded. An id that over half of the
documents have weighs nothing and has no postings.

A window begins with a seed, the first document not used yet. The index returns
its unused neighbours, best first, and they fill the window greedily; the one
that doesn't fit is cut, and its rest is the seed of the next window. Documents
that share nothing with the seed come only after all that do: the next unused
one is then a further seed for the same window. The last window of a shard is cut
into sequences whose lengths are powers of two, which need no padding.

A text that is null or empty is the end id alone. Rows that repeat a document
are packed like any other; a null doc_id is kept. A very long text is encoded in
pieces, cut only where no token can cross. No documents give no rows. Other
columns may have any name.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlog.session import materialize

WINDOW = 2048
END = 1
SHARD_DOCS = 2048
K1, B = 1.2, 0.75
#: Characters encoded at a time.
PIECE_CHARS = 1 << 18

_ENCODED = "key long, doc_id {}, n long, crcs binary, rest binary"
_PIECE = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def byte_pair_encoder(path: str):
    """``encode(text) -> list of ids`` and the size of the vocabulary of a byte-level byte-pair tokenizer file.

    The vocabulary's order is that of its merges, so a faster library gives the
    same ids; which files this holds for is checked on the file's settings, and
    any other file is encoded by the library it is made for. Strings of special
    tokens inside a text become their ids, the file's default.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        text = file.read()
    made = json.loads(text)
    vocabulary, special = made["model"]["vocab"], {t["content"]: t["id"] for t in made.get("added_tokens", [])}
    size = max([*vocabulary.values(), *special.values()]) + 1
    slow = Tokenizer.from_str(text)

    def plainly(said: str) -> list[int]:
        return slow.encode(said, add_special_tokens=False).ids

    before = made.get("pre_tokenizer") or {}
    known = (
        made["model"].get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space") and made.get("normalizer") is None
        and not any(t.get(flag) for t in made.get("added_tokens", []) for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    ranks = _ranks(made) if known else None
    if ranks is None:
        return plainly, size
    own = tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(said: str) -> list[int]:
        return own.encode(said, allowed_special="all", disallowed_special=())

    return encode, size


#: How byte-level vocabularies of this kind cut a text before merging (fixed value).
_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranks(made: dict) -> dict[bytes, int] | None:
    """Bytes of each token with its id, None if ids don't ascend in the order of the merges."""
    special = {t["content"] for t in made.get("added_tokens", [])}
    vocabulary = {k: v for k, v in made["model"]["vocab"].items() if k not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in made["model"]["merges"]]
    ids = [vocabulary["".join(m)] for m in merges]
    if any(b <= a for a, b in zip(ids, ids[1:], strict=False)) or len(vocabulary) != 256 + len(set(ids)):
        return None
    # Visible stand-ins: printable bytes for themselves, the others from code point 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {bytes(stand_in[c] for c in token): number for token, number in vocabulary.items()}


_BEFORE_BLANK = re.compile(r"\w ")


def pieces(said: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text before a blank that follows a letter or digit: no token crosses that place."""
    a = 0
    while len(said) - a > most:
        b = next((m.start() + 1 for m in _BEFORE_BLANK.finditer(said, a + most)), len(said))
        yield said[a:b]
        a = b
    if a < len(said):
        yield said[a:]


def encode_documents(docs: DataFrame, path: str, *, end: int = END, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, doc_id, n, crcs, rest), written: the CRC-32 of each full window and the ids of what is left."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = byte_pair_encoder(path)
        pressed = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                lengths, crcs, rests = [], [], []
                for said in part.column("_text"):
                    found = [np.array(encoder(x), dtype="<u4") for x in pieces(said.as_py() or "")]
                    ids = np.concatenate([*found, np.array([end], dtype="<u4")])
                    full = len(ids) // window * window
                    lengths.append(len(ids))
                    crcs.append(np.array([zlib.crc32(ids[c : c + window].tobytes()) for c in range(0, full, window)], dtype="<u4").tobytes())
                    rests.append(pressed.compress(ids[full:].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))
                yield pa.RecordBatch.from_arrays([
                    part.column("_key"), part.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(crcs, pa.binary()), pa.array(rests, pa.binary()),
                ], names=["key", "doc_id", "n", "crcs", "rest"])

    narrow = docs.select(
        F.monotonically_increasing_id().alias("_key"), F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text")
    )
    return materialize(narrow.mapInArrow(encode, _ENCODED.format(dict(docs.dtypes)[id_col])), "encoded")


def _rest(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)


def document_frequencies(encoded: DataFrame, size: int) -> tuple[np.ndarray, int, float]:
    """How many rests have each id, how many rests there are and their mean length; one number for each id of the vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, dtype=np.int64)
        lengths = 0
        for batch in batches:
            for blob in batch.column("rest"):
                ids = _rest(blob.as_py())[:-1]
                total[np.unique(ids)] += 1
                lengths += len(ids)
                total[size] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], lengths))], names=["id", "n"])

    rows = encoded.select("rest").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(size + 2, dtype=np.int64)
    found[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    docs, tokens = int(found[size]), int(found[-1])
    return found[:size], docs, tokens / max(1, docs)


class ShardIndex:
    """Inverted index of a shard's documents with BM25 weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(docs)
        lengths = np.array([len(d) for d in docs], dtype=np.int64)
        doc = np.repeat(np.arange(self.n), lengths)
        terms = np.concatenate([np.zeros(0, np.int64), *docs]).astype(np.int64)
        weighs = idf[terms] > 0
        pair, tf = np.unique(terms[weighs] * self.n + doc[weighs], return_counts=True)
        term, self.doc = pair // max(1, self.n), (pair % max(1, self.n)).astype(np.int64)
        norm = K1 * (1 - B + B * lengths / max(mean_length, 1e-9))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.doc])
        self.first = np.flatnonzero(np.diff(term, prepend=-1)) if len(term) else np.zeros(0, np.int64)
        self.last = np.append(self.first[1:], len(term))
        # Postings lists of each document, from the same pairs ordered by document.
        slot = np.repeat(np.arange(len(self.first)), self.last - self.first)
        order = np.argsort(self.doc, kind="stable")
        self._slots, self._bounds = slot[order], np.searchsorted(self.doc[order], np.arange(self.n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Of every document for the terms of one."""
        lists = self._slots[self._bounds[seed] : self._bounds[seed + 1]]
        if not len(lists):
            return np.zeros(self.n)
        span = self.last[lists] - self.first[lists]
        at = np.repeat(self.first[lists] - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
        return np.bincount(self.doc[at], self.weight[at], self.n)


def fill_windows(lengths: np.ndarray, index: ShardIndex, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); all but the last are full."""
    used = np.zeros(len(lengths), dtype=bool)
    windows: list[list[tuple[int, int, int]]] = [[]]
    room, next_seed, cut = window, 0, None

    def put(d: int, start: int) -> tuple[int, int] | None:
        """Put a document from ``start`` on; what doesn't fit, as (document, start)."""
        nonlocal room
        n = min(room, int(lengths[d]) - start)
        windows[-1].append((d, start, n))
        used[d] = True
        room -= n
        if not room:
            windows.append([])
            room = window
        return (d, start + n) if start + n < lengths[d] else None

    while True:
        if cut is not None:
            seed, cut = cut[0], put(*cut)
        else:
            while next_seed < len(lengths) and used[next_seed]:
                next_seed += 1
            if next_seed == len(lengths):
                break
            seed, cut = next_seed, put(next_seed, 0)
        if cut is not None or room == window:
            continue
        scores = index.scores(seed)
        scores[used] = 0
        while cut is None and room < window:
            best = int(np.argmax(scores))
            if scores[best] <= 0:
                break
            scores[best] = 0
            cut = put(best, 0)
    return [w for w in windows if w]


def at_powers(pieces_: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut a window into sequences whose lengths are powers of two, longest first."""
    left = sum(n for _, _, n in pieces_)
    out: list[list[tuple[int, int, int]]] = []
    todo = list(reversed(pieces_))
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out.append([])
        while room:
            d, start, n = todo.pop()
            take = min(n, room)
            out[-1].append((d, start, take))
            room -= take
            if take < n:
                todo.append((d, start + take, n - take))
    return out


def pack_with_neighbours(
    docs: DataFrame, path: str, *, window: int = WINDOW, end: int = END, shard_docs: int = SHARD_DOCS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): each piece of each document and its place."""
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark: SparkSession = docs.sparkSession
    id_type = dict(docs.dtypes)[id_col]
    encoded = encode_documents(docs, path, end=end, window=window, id_col=id_col, text_col=text_col)
    _, size = byte_pair_encoder(path)
    having, n_docs, mean_length = document_frequencies(encoded, max(size, end + 1))
    # The classical weight; from half of all documents on it would be negative and is none.
    idf = np.maximum(0, np.log((n_docs - having + 0.5) / (having + 0.5)))
    weights = spark.sparkContext.broadcast(idf)
    shards = max(1, math.ceil(n_docs / shard_docs))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        n = table.column("n").to_numpy()
        full = n // window
        rests = [_rest(blob.as_py()) for blob in table.column("rest")]
        some = [d for d, ids in enumerate(rests) if len(ids)]
        # The end id is no term.
        index = ShardIndex([rests[d][:-1] for d in some], weights.value, mean_length)
        packed = fill_windows(np.array([len(rests[d]) for d in some], dtype=np.int64), index, window)
        if packed and sum(p[2] for p in packed[-1]) < window:
            packed[-1:] = at_powers(packed[-1])
        doc, start, length, crc, sequence, offset, number = [], [], [], [], [], [], 0
        for d in np.flatnonzero(full).tolist():
            for w, code in enumerate(np.frombuffer(table.column("crcs")[d].as_py(), dtype="<u4").tolist()):
                doc.append(d), start.append(w * window), length.append(window), crc.append(code), sequence.append(number), offset.append(0)
                number += 1
        for found in packed:
            at = 0
            for i, begin, size_ in found:
                d = some[i]
                doc.append(d), start.append(int(full[d]) * window + begin), length.append(size_)
                crc.append(zlib.crc32(rests[d][begin : begin + size_].tobytes()))
                sequence.append(number), offset.append(at)
                at += size_
            number += 1
        shard = table.column("shard")[0].as_py()
        take = pa.array(doc, pa.int64())
        return pa.table({
            "doc_id": table.column("doc_id").take(take), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
            "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(n).take(take),
            "sequence_id": pa.array(np.array(sequence, dtype=np.int64) + (shard << 32)), "offset": pa.array(offset, pa.int64()),
        })

    dealt = encoded.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(fill, _PIECE.format(id_type))
