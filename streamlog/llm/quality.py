"""Quality rules: counts of every text, and how far its histograms are from its language's.

Words are ``[^\\x20\\x09-\\x0D]+``. Two histograms of a text are compared with
references by the Jensen-Shannon distance (square root of the divergence in
bits, from 0 to 1): its bytes by class (letters, digits, ...) and its common
words (a fixed number of words per language, all others as one class). The
references are the summed histograms of all texts of the language, counted in
Spark; texts without language share the language ''.

A text is rejected if ``base_failed``, or if it is long enough for a
comparison (``MIN_CHARS``, ``MIN_WORDS``) and further from its reference than
``MAX_CLASS_DISTANCE`` or ``MAX_WORD_DISTANCE``. Shorter texts aren't compared.
Null and empty texts have no words and fail the base rules. Rows are judged
one by one, so repeated rows, null ids and clashing columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlog.llm import text as tx
from streamlog.session import materialize

MIN_WORDS_KEPT, MAX_REPEATED_PERCENT, REPEAT_WORDS = 10, 20, 5
MIN_CHARS, MIN_WORDS = 200, 40
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.55
#: Common words compared per language.
COMMON_WORDS = 64
SLICE = 2 << 20
SYMBOLS = b"#*$%&|<>"

#: Byte classes: separators, lower case, upper case, digits, sentence marks, other marks, control, beyond ASCII.
N_CLASSES = 8
CLASSES = np.full(256, 5, dtype=np.int64)
CLASSES[:32] = CLASSES[127] = 6
CLASSES[tx.SPACE] = 0
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[128:] = 1, 2, 3, 7
CLASSES[[ord(c) for c in ".,;:!?'\"()-"]] = 4


class Reference(NamedTuple):
    """A language: share of each byte class; hashes of its common words, ascending; their shares and that of all others."""

    classes: np.ndarray
    words: np.ndarray
    word_shares: np.ndarray

    def pack(self) -> bytes:
        return b"".join(x.tobytes() for x in self)

    @classmethod
    def unpack(cls, blob: bytes) -> "Reference":
        n = (len(blob) // 8 - N_CLASSES - 1) // 2
        words = np.frombuffer(blob, np.int64, n, 8 * N_CLASSES)
        return cls(np.frombuffer(blob, np.float64, N_CLASSES), words, np.frombuffer(blob, np.float64, n + 1, 8 * (N_CLASSES + n)))


def _per_doc(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))[bounds])


def _class_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    return np.bincount(doc * N_CLASSES + CLASSES[data], minlength=n * N_CLASSES).reshape(n, N_CLASSES)


def _duplicate_lines(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    body = data.tobytes()
    found = np.zeros(len(bounds) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        lines = [x for x in body[a:b].split(b"\n") if x.strip(b" \t\v\f\r")]
        found[i] = len(lines) - len(set(lines))
    return found


def _repeated_words(data, starts, ends, doc, n_docs, size) -> np.ndarray:
    """Words under windows of ``size`` words whose words stand twice or more in the text."""
    n = max(0, len(doc) - size + 1)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :][:n])
    if not len(at):
        return np.zeros(n_docs, dtype=np.int64)
    hashes = tx.rolling(tx.hash_words(data, starts, ends), size)[at]
    owner = doc[at]
    order = np.lexsort((hashes, owner))
    same = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.bincount(doc[tx.covered(at[twice], size, len(doc))], minlength=n_docs)


def _measure(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of every text in a slice, its classes and its words."""
    n = len(bounds) - 1
    starts, ends, doc = tx.words(data, bounds)
    points = (data & 0xC0) != 0x80
    n_words = np.bincount(doc, minlength=n)
    repeated = _repeated_words(data, starts, ends, doc, n, REPEAT_WORDS)
    symbols = np.zeros(256, dtype=bool)
    symbols[list(SYMBOLS)] = True
    return {
        "n_words": n_words, "word_chars": _per_doc(points & ~tx.SPACE[data], bounds),
        "n_symbols": _per_doc(symbols[data], bounds), "n_dup_lines": _duplicate_lines(data, bounds),
        "n_repeat_words": repeated, "n_chars": _per_doc(points, bounds),
        "base_failed": (n_words < MIN_WORDS_KEPT) | (100 * repeated > MAX_REPEATED_PERCENT * n_words),
        "classes": _class_counts(data, bounds), "words": (tx.hash_words(tx.lower_ascii(data), starts, ends), doc),
    }


def _narrow(docs: DataFrame, text_col: str, lang_col: str | None) -> tuple[Column, Column]:
    """Text and language."""
    lang = F.col(f"`{lang_col}`").cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    return F.col(f"`{text_col}`").cast("string"), F.coalesce(lang, F.lit(""))


def references(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, reference): histograms of every language over all its texts, a row of about a kilobyte for each.

    Classes and words are counted in each task first; word counts are summed
    and the ``COMMON_WORDS`` most frequent of each language (ties: the smaller
    hash) kept. A language without a word has no reference.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tx.give_back()
            data, bounds = tx.buffers(batch.column(0))
            names, number = np.unique(np.array(batch.column(1).to_pylist(), dtype=str), return_inverse=True)
            for a, b in tx.slices(bounds, SLICE):
                part, edge = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                starts, ends, doc = tx.words(part, edge)
                own = number[a:b]
                classes = _class_counts(part, edge)
                hashes = tx.hash_words(tx.lower_ascii(part), starts, ends).view(np.int64)
                order = np.argsort(own[doc], kind="stable")
                cuts = np.searchsorted(own[doc][order], np.arange(len(names) + 1))
                for k in np.unique(own):
                    values, counts = np.unique(hashes[order[cuts[k] : cuts[k + 1]]], return_counts=True)
                    sums = classes[own == k].sum(axis=0)
                    n = len(values) + N_CLASSES
                    yield pa.RecordBatch.from_arrays([
                        pa.array([str(names[k])] * n, pa.string()), pa.array(np.repeat([True, False], [N_CLASSES, len(values)])),
                        pa.array(np.concatenate((np.arange(N_CLASSES), values))), pa.array(np.concatenate((sums, counts))),
                    ], names=["lang", "is_class", "item", "n"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for row in batch.to_pylist():
                top = sorted((x["item"], x["n"]) for x in row["top"])
                by_class = np.zeros(N_CLASSES)
                for x in row["classes"]:
                    by_class[x["item"]] = x["n"]
                by_word = np.array([n for _, n in top] + [row["total"] - sum(n for _, n in top)], dtype=float)
                words = np.array([w for w, _ in top], dtype=np.int64)
                blobs.append(Reference(by_class / by_class.sum(), words, by_word / by_word.sum()).pack())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(blobs, pa.binary())], names=["lang", "reference"])

    text, lang = _narrow(docs, text_col, lang_col)
    counted = materialize(
        docs.select(text.alias("text"), lang.alias("lang")).mapInArrow(count, "lang string, is_class boolean, item long, n long")
        .groupBy("lang", "is_class", "item").agg(F.sum("n").alias("n")),
        "histograms",
    )
    listed = F.collect_list(F.struct("item", "n"))
    words = counted.filter("NOT is_class")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    place = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    top = words.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= COMMON_WORDS).groupBy("lang").agg(listed.alias("top"))
    classes = counted.filter("is_class").groupBy("lang").agg(listed.alias("classes"))
    return materialize(totals.join(top, "lang").join(classes, "lang").mapInArrow(build, "lang string, reference binary"), "references")


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts from the reference; 0 for a row without counts."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    middle = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        right = np.where(reference > 0, reference * np.log2(reference / middle), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((left + right) / 2, 0, 1)), 0)


def _distances(measured: dict, number: np.ndarray, refs: list[Reference | None]) -> tuple[np.ndarray, np.ndarray]:
    """Of each text from the reference that its number names."""
    n = len(number)
    hashes, doc = measured["words"]
    hashes = hashes.view(np.int64)
    of_classes, of_words = np.zeros(n), np.zeros(n)
    order = np.argsort(number[doc], kind="stable")
    cuts = np.searchsorted(number[doc][order], np.arange(len(refs) + 1))
    for k in np.unique(number).tolist():
        own, ref = np.flatnonzero(number == k), refs[k]
        if ref is None:
            continue
        of_classes[own] = distance(measured["classes"][own], ref.classes)
        row = np.full(n, -1)
        row[own] = np.arange(len(own))
        mine = order[cuts[k] : cuts[k + 1]]
        at = np.searchsorted(ref.words, hashes[mine])
        at[at == len(ref.words)] = 0
        at = np.where(ref.words[at] == hashes[mine], at, len(ref.words))
        width = len(ref.words) + 1
        counts = np.bincount(row[doc[mine]] * width + at, minlength=len(own) * width).reshape(-1, width)
        of_words[own] = distance(counts, ref.word_shares)
    return of_classes, of_words


_JUDGED = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "class_distance": "double", "word_distance": "double", "kept": "boolean",
}


def _judge(batch: pa.RecordBatch) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """Rows [a, b) of the batch, whose first columns are text and reference, with their counts and verdicts."""
    data, bounds = tx.buffers(batch.column(0))
    coded = batch.column(1).dictionary_encode()
    refs: list[Reference | None] = [Reference.unpack(x) for x in coded.dictionary.to_pylist()]
    number = coded.indices.fill_null(len(refs)).to_numpy()
    refs.append(None)
    for a, b in tx.slices(bounds, SLICE):
        found = _measure(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
        found["class_distance"], found["word_distance"] = _distances(found, number[a:b], refs)
        far = (found["n_chars"] >= MIN_CHARS) & (found["class_distance"] > MAX_CLASS_DISTANCE)
        far |= (found["n_words"] >= MIN_WORDS) & (found["word_distance"] > MAX_WORD_DISTANCE)
        found["kept"] = ~found["base_failed"] & ~far
        yield a, b, found
    tx.give_back()


def _referenced(docs: DataFrame, columns: list[Column], text_col: str, lang_col: str) -> DataFrame:
    """Text, reference of its language and the given columns.

    The references are stored, so Spark knows their size: it broadcasts them
    only if they are small.
    """
    refs = references(docs, text_col=text_col, lang_col=lang_col)
    text, lang = _narrow(docs, text_col, lang_col)
    own_text, own_lang, own_ref = (tx.fresh(docs.columns, x) for x in ("_text", "_lang", "_reference"))
    narrow = docs.select(text.alias(own_text), lang.alias(own_lang), *columns)
    names = [c for c in narrow.columns if c not in (own_text, own_lang)]
    joined = narrow.join(refs.select(F.col("lang").alias(own_lang), F.col("reference").alias(own_ref)), own_lang, "left")
    return joined.select(*[F.col(f"`{c}`") for c in (own_text, own_ref, *names)])


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance, word_distance, kept)."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, found in _judge(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(a, b - a), *(pa.array(found[c]) for c in _JUDGED)], names=["doc_id", *_JUDGED],
                )

    narrow = _referenced(docs, [F.col(f"`{id_col}`").alias("doc_id")], text_col, lang_col)
    return narrow.mapInArrow(judge, f"doc_id {dict(docs.dtypes)[id_col]}, " + ", ".join(f"{c} {t}" for c, t in _JUDGED.items()))


def keep_good(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that pass, with all their columns."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [found["kept"] for _, _, found in _judge(batch)]
            if kept:
                yield batch.select(range(2, batch.num_columns)).filter(pa.array(np.concatenate(kept)))

    return _referenced(docs, [F.col(f"`{c}`") for c in docs.columns], text_col, lang_col).mapInArrow(keep, docs.schema)
