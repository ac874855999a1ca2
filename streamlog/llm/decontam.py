"""Find benchmark items in training documents: BM25 over an inverted index, block-max WAND, then overlap.

The items are indexed by the BM25 weights of their words, each weight over the
item's score for itself, so that 1 is an exact match. Every document is cut
into passages that overlap by half and are long enough for any item to lie
whole in one of them, and every passage queries the index for all items that
score ``THRESHOLD`` or more.

A task evaluates the passages of a slice together. Words whose largest weights
sum up to less than ``SLACK`` can't lift a passage over the threshold alone and
are left for later. For the other words each block of ``BLOCK_ITEMS`` items has
an upper bound per word; only where the bounds of a passage's words reach the
threshold less ``SLACK`` are the items of the block scored. That prunes without
losing any hit. Hits are then verified: enough word runs of both the item's
question and its answer must stand in the passage.

The index is cut into shards of at most ``SHARD_BYTES`` of item text; documents
are read once for each shard, with one shard broadcast to
the tasks of each pass. Words are lower-cased runs of letters, digits and non-ASCII
characters. Null and empty texts have no passages, items without words match
nothing; rows that repeat a document or an item give one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streamlog.llm import text as tx
from streamlog.session import materialize

THRESHOLD, SLACK = 0.5, 0.15
K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
SHARD_BYTES = 4 << 20
#: Least words from one passage to the next; a passage has twice as many.
STRIDE = 64
#: Words of a run, and the share of an item's runs that a passage must have.
RUN, OVERLAP = 4, 0.6
SLICE = 1 << 20

#: ASCII bytes that end a word.
_MARKS = np.array([not (chr(b).isalnum() or b > 127) for b in range(256)])


def _hashed_words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and text number of every word."""
    data, bounds = tx.buffers(texts)
    low = tx.lower_ascii(data)
    low[_MARKS[low]] = 32
    starts, ends, doc = tx.words(low, bounds)
    return tx.hash_words(low, starts, ends), doc, len(bounds) - 1


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the first sentence or line and the rest; the halves of a single one."""
    for i, c in enumerate(text):
        if c in ".?!\n" and text[i + 1 :].strip() and text[:i].strip():
            return text[: i + 1], text[i + 1 :]
    words = text.split()
    return " ".join(words[: len(words) // 2]), " ".join(words[len(words) // 2 :])


class Index(NamedTuple):
    """One shard. Postings are sorted by word; ``*_at`` bounds the postings of each word."""

    items: list  # item ids
    vocabulary: np.ndarray  # word hashes, ascending
    essential: np.ndarray  # whether a word takes part in the first pass
    slack: float  # largest sum of the weights of all other words
    item_at: np.ndarray
    item_of: np.ndarray
    weight: np.ndarray
    block_at: np.ndarray
    block_of: np.ndarray
    bound: np.ndarray
    runs: list  # of each item: distinct runs of question and answer, and the words of a run
    stride: int


def build_index(items: list[tuple], df: dict[int, int], n_items: int, mean_words: float) -> Index | None:
    """Index items (id, text) with corpus-wide document frequencies."""
    hashes, doc, n = _hashed_words(pa.array([t for _, t in items], pa.string()))
    key = np.unique(np.stack((doc.astype(np.uint64), hashes)), axis=1, return_counts=True)
    (owner, word), tf = (key[0][0].astype(np.int64), key[0][1]), key[1]
    if not len(owner):
        return None
    length = np.bincount(doc, minlength=n)
    frequency = np.array([df[int(w)] for w in word.view(np.int64)], dtype=float)
    idf = np.log1p((n_items - frequency + 0.5) / (frequency + 0.5))
    weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[owner] / mean_words))
    weight /= np.bincount(owner, weight, n)[owner]
    vocabulary, term = np.unique(word, return_inverse=True)
    order = np.lexsort((owner, term))
    term, owner, weight = term[order], owner[order], weight[order]
    item_at = np.searchsorted(term, np.arange(len(vocabulary) + 1))
    largest = np.maximum.reduceat(weight, item_at[:-1])
    # Words in order of their largest weight: as many as stay within the slack wait for the second pass.
    by_weight = np.argsort(largest, kind="stable")
    light = by_weight[np.cumsum(largest[by_weight]) < SLACK]
    essential = np.ones(len(vocabulary), dtype=bool)
    essential[light] = False
    block = owner // BLOCK_ITEMS
    new = np.ones(len(term), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
    head = np.flatnonzero(new)
    runs = []
    for _, text in items:
        parts = [_hashed_words(pa.array([p], pa.string()))[0] for p in split_item(text or "")]
        runs.append([(np.unique(tx.rolling(p, min(RUN, len(p)))), min(RUN, len(p))) for p in parts if len(p)])
    return Index(
        [i for i, _ in items], vocabulary, essential, float(largest[light].sum()), item_at, owner, weight,
        np.searchsorted(term[head], np.arange(len(vocabulary) + 1)), block[head], np.maximum.reduceat(weight, head), runs,
        max(STRIDE, int(length.max())),
    )


def _expand(at: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the postings of each term, and the place in ``terms`` each comes from."""
    n = at[terms + 1] - at[terms]
    source = np.repeat(np.arange(len(terms)), n)
    return np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n) + at[terms][source], source


def _sums(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(key, return_inverse=True)
    return keys, np.bincount(place, value, len(keys))


def search(index: Index, hashes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """(document, item, score, first word, last word) of every passage and item at or above the threshold."""
    stride, n_items = index.stride, len(index.items)
    first = np.searchsorted(doc, doc)
    within = np.arange(len(doc)) - first
    # A passage begins at every multiple of the stride; a word lies in two. Numbers are unique over the slice.
    number = first + within // stride
    at = np.searchsorted(index.vocabulary, hashes)
    at[at == len(index.vocabulary)] = 0
    known = np.flatnonzero(index.vocabulary[at] == hashes)
    term, own, back = at[known], number[known], within[known] >= stride
    size = len(index.vocabulary)
    pairs = np.unique(np.concatenate((own * size + term, (own[back] - 1) * size + term[back])))
    passage, term = pairs // size, pairs % size
    heavy = index.essential[term]
    posting, source = _expand(index.block_at, term[heavy])
    n_blocks = -(-n_items // BLOCK_ITEMS)
    keys, bound = _sums(passage[heavy][source] * n_blocks + index.block_of[posting], index.bound[posting])
    reached = keys[bound + index.slack >= THRESHOLD - 1e-9]
    if not len(reached):
        return
    again = np.isin(passage, reached // n_blocks)
    passage, term = passage[again], term[again]
    posting, source = _expand(index.item_at, term)
    item = index.item_of[posting]
    wanted = np.isin(passage[source] * n_blocks + item // BLOCK_ITEMS, reached)
    keys, score = _sums((passage[source] * n_items + item)[wanted], index.weight[posting][wanted])
    for k, s in zip(keys[score >= THRESHOLD], score[score >= THRESHOLD], strict=True):
        p = int(k) // n_items
        # The passage's number less its document's first word is how many strides it is in.
        d = int(doc[p])
        begin = int(first[p]) + (p - int(first[p])) * stride
        end = min(begin + 2 * stride, int(np.searchsorted(doc, d, "right")))
        yield d, int(k) % n_items, float(s), begin, end


def contaminations(index: Index, texts: pa.Array) -> dict[tuple[int, int], tuple[float, float, float]]:
    """Verified hits: (document, item) with the best score and the overlaps of question and answer."""
    hashes, doc, _ = _hashed_words(texts)
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for d, i, score, a, b in search(index, hashes, doc):
        have = {n: np.unique(tx.rolling(hashes[a:b], n)) for n in range(1, RUN + 1)}
        shares = []
        for part, n in index.runs[i]:
            own = have[n]
            at = np.searchsorted(own, part)
            at[at == len(own)] = 0
            shares.append(float((own[at] == part).mean()) if len(own) else 0.0)
        if shares and min(shares) >= OVERLAP:
            found[d, i] = max(found.get((d, i), (0.0, 0.0, 0.0)), (score, shares[0], shares[-1]))
    return found


def shards(items: DataFrame, *, id_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes of all items, in shards whose size is checked; frequencies are counted over all items."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, doc, _ = _hashed_words(batch.column("_text"))
            words, n = np.unique(np.unique(np.stack((doc.astype(np.uint64), hashes)), axis=1)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n), pa.array(np.zeros(len(n), np.int64))], names=["word", "df", "words"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([len(np.unique(doc))]), pa.array([len(doc)])], names=["word", "df", "words"])

    own = materialize(items.select(F.col(f"`{id_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("_text")), "items")
    counted = materialize(own.mapInArrow(count, "word long, df long, words long").groupBy("word").agg(F.sum("df").alias("df"), F.sum("words").alias("words")), "item-words")
    n_items, n_words = (counted.filter("word IS NULL").select("df", "words").first() or (0, 0))
    if not n_words:
        return
    size = own.agg(F.sum(F.octet_length("_text"))).first()[0]
    n_shards = max(1, -(-size // SHARD_BYTES))
    for shard in range(n_shards):
        # About SHARD_BYTES of text each, dealt by a hash of the item.
        mine = own.filter(F.pmod(F.xxhash64("item_id", "_text"), F.lit(n_shards)) == shard).filter("_text IS NOT NULL")
        rows = [tuple(r) for r in mine.orderBy("item_id", "_text").collect()]
        words = np.unique(_hashed_words(pa.array([t for _, t in rows], pa.string()))[0]).view(np.int64)
        if len(words):
            asked = items.sparkSession.createDataFrame(pa.table({"word": words}))
            df = {r["word"]: r["df"] for r in counted.join(asked, "word").select("word", "df").collect()}
            yield build_index(rows, df, n_items, n_words / n_items)


def find_contamination(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of every verified hit."""
    id_type, item_type = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_col]
    schema = f"doc_id {id_type}, item_id {item_type}, score double, question_overlap double, answer_overlap double"
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    item_arrow = to_arrow_type(items.schema[item_col].dataType)
    found = docs.sparkSession.createDataFrame([], schema)
    for index in shards(items, id_col=item_col, text_col=item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id")
                for a, hits in _sliced(shared.value, batch.column("_text")):
                    if hits:
                        yield pa.RecordBatch.from_arrays([
                            ids.take(pa.array([a + d for d, _ in hits])), pa.array([shared.value.items[i] for _, i in hits], item_arrow),
                            *(pa.array([h[k] for h in hits.values()], pa.float64()) for k in range(3)),
                        ], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        found = found.union(narrow.mapInArrow(match, schema))
    return found


def _sliced(index: Index, texts: pa.Array) -> Iterator[tuple[int, dict]]:
    _, bounds = tx.buffers(texts)
    for a, b in tx.slices(bounds, SLICE):
        yield a, contaminations(index, texts.slice(a, b - a))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without a verified hit, with all their columns."""
    names, own_text = docs.columns, tx.fresh(docs.columns, "_text")
    for index in shards(items, id_col=item_col, text_col=item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stays = np.ones(batch.num_rows, dtype=bool)
                for a, hits in _sliced(shared.value, batch.column(own_text)):
                    stays[[a + d for d, _ in hits]] = False
                yield batch.select(names).filter(pa.array(stays))

        docs = docs.withColumn(own_text, F.col(f"`{text_col}`").cast("string")).mapInArrow(keep, docs.schema)
    return docs
