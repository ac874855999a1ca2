"""Token counts of documents of any length: overlapping chunks spliced where their tokens agree.

The tokenizer is a SentencePiece BPE model. A text of more than two chunks is
cut into overlapping chunks, which are dealt out as rows of their own, so one
huge document doesn't fill one task. Each chunk is encoded with the offsets of
its tokens. Two neighbours are spliced at a place in their overlap that both
have as a token boundary and that is provably stable: between a character other
than a space and a space. No piece of the model has a space after another
character (``Tokenizer`` checks the vocabulary), so no merge crosses such a
place, and what stands on one side can't change the tokens of the other. Texts
whose chunks find no common stable place are cut again with chunks and overlaps
``WIDEN`` times as long, in the end as a whole.

Null and empty texts have no tokens. Every row is counted by itself, so ties,
repeated rows and null ids don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlog.session import materialize

#: Bytes of a chunk and of its overlap on either side.
CHUNK, OVERLAP, WIDEN = 1 << 15, 256, 8
LIMIT = 4096
#: Characters handed to the library in one call.
CALL = 1 << 20


class Tokenizer:
    """A SentencePiece model, with the proof that splices need."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splices = not any("\u2581" in p.lstrip("\u2581") for p in pieces)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)]

    def begins(self, text: str) -> list[int]:
        """Where each token begins, in UTF-8 bytes of the text."""
        return [p.begin for p in self.model.encode(text, return_type="proto").pieces]


@lru_cache(maxsize=4)
def tokenizer(model_path: str) -> Tokenizer:
    return Tokenizer(model_path)


def stable_places(data: bytes, begins: list[int]) -> dict[int, int]:
    """Token boundaries that nothing can cross, each with the number of tokens before it."""
    return {at: n for n, at in enumerate(begins) if n and 0 < at < len(data) and data[at] == 32 and data[at - 1] != 32}


def chunks(data: bytes, chunk: int, overlap: int) -> Iterator[tuple[int, bytes]]:
    """Overlapping chunks, cut between characters, with the place where each begins."""
    def whole(at: int) -> int:
        while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return max(at, 0)

    for a in range(0, max(1, len(data) - overlap), chunk):
        low = whole(a - overlap)
        yield low, data[low : whole(min(len(data), a + chunk + overlap))]


def splice(parts: list[dict]) -> int | None:
    """Tokens of a whole text from its chunks in order; None if two neighbours have no common place.

    Each chunk has ``total`` and the stable ``places`` near its ends with the ``before`` counts.
    """
    total, cut = 0, 0
    for this, after in zip(parts, [*parts[1:], None], strict=True):
        if after is None:
            return total + this["total"] - cut
        mine = dict(zip(this["places"], this["before"], strict=True))
        theirs = dict(zip(after["places"], after["before"], strict=True))
        common = [p for p in mine if p in theirs and mine[p] >= cut]
        if not common:
            return None
        place = common[len(common) // 2]
        total += mine[place] - cut
        cut = theirs[place]
    return total


def _count_long(long: DataFrame, model_path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens, n_chunks) of long texts (key, _text); n_tokens is null where no splice was found."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = not tokenizer(model_path).splices
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                data = text.encode()
                found = [(0, data)] if whole else list(chunks(data, chunk, overlap))
                for a in range(0, len(found), 64):
                    some = found[a : a + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([key] * len(some), pa.int64()), pa.array([low for low, _ in some], pa.int64()), pa.array([t.decode() for _, t in some], pa.string()),
                    ], names=["key", "low", "part"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(model_path)
        for batch in batches:
            found = []
            for key, low, part in zip(*(batch.column(c).to_pylist() for c in ("key", "low", "part")), strict=True):
                begins, data = own.begins(part), part.encode()
                near = {low + p: n for p, n in stable_places(data, begins).items() if p < 2 * overlap or p >= len(data) - 2 * overlap}
                found.append({"key": key, "low": low, "total": len(begins), "places": list(near), "before": list(near.values())})
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    def join(table: pa.Table) -> pa.Table:
        parts = sorted(table.to_pylist(), key=lambda p: p["low"])
        return pa.table({"key": pa.array([parts[0]["key"]], pa.int64()), "n_tokens": pa.array([splice(parts)], pa.int64()), "n_chunks": pa.array([len(parts)], pa.int64())})

    schema = pa.schema([("key", pa.int64()), ("low", pa.int64()), ("total", pa.int64()), ("places", pa.list_(pa.int64())), ("before", pa.list_(pa.int64()))])
    return (
        long.mapInArrow(cut, "key long, low long, part string").repartition("key", "low")
        .mapInArrow(encode, "key long, low long, total long, places array<long>, before array<long>")
        .groupBy("key").applyInArrow(join, "key long, n_tokens long, n_chunks long")
    )


def token_counts(
    docs: DataFrame, model_path: str, *, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, n_chunks) of every document."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(model_path)
        for batch in batches:
            texts, totals, a = batch.column("_text"), [], 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size < CALL):
                    size += len(texts[b].as_py())
                    b += 1
                totals += own.counts(texts.slice(a, b - a).to_pylist())
                a = b
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    id_type = dict(docs.dtypes)[id_col]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    is_long = F.col("n_bytes") > 2 * chunk
    short = narrow.filter(~is_long).mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long").withColumn("n_chunks", F.lit(1).cast("long"))
    # Long texts are written once, under a key of their own, so that every round cuts the same rows.
    long = materialize(narrow.filter(is_long).withColumn("key", F.monotonically_increasing_id()), "long-texts")
    found, todo = [], long.select("key", "_text")
    while not todo.isEmpty():
        counted = materialize(_count_long(todo, model_path, chunk, overlap), "long-counts")
        found.append(counted.filter("n_tokens IS NOT NULL"))
        todo = todo.join(counted.filter("n_tokens IS NULL"), "key", "left_semi")
        chunk, overlap = WIDEN * chunk, WIDEN * overlap
    for more in found:
        short = short.union(long.join(more, "key").select("doc_id", "n_bytes", "n_tokens", "n_chunks"))
    return short.withColumn("over_limit", F.col("n_tokens") > limit).select("doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks")
