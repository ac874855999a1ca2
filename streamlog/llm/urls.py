"""Judge urls: host rules first, then words of host and path scored by naive Bayes.

Concatenated names (``freebets``) are split by a unigram model: Viterbi over the
word counts of the page texts, of the parts of hyphenated names, and the seed
words. All substrings of a name that are words are found by one join with the
counts, so the vocabulary is neither broadcast nor cut. A multinomial naive
Bayes model over the segmented words of host and path is trained on all urls:
those with a seed word are examples to block, all others to allow. It judges
the urls that no rule fits, also those that have only words which stand beside
seed words elsewhere.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. Null urls and urls
without ``://`` have neither and are allowed: without words there is no
evidence. Every row is judged; rows with one url get one verdict. Null ids and
repeated rows are kept, other columns are not looked at. No pages give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlog.session import materialize

#: Longest word of the unigram model; Viterbi looks at no longer piece.
LONGEST = 20


class Rule(NamedTuple):
    """``host/path``: fits the host and its subdomains if the url's path starts with ``path``."""

    host: str
    path: str
    verdict: str


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

#: Words whose urls are examples to block.
SEEDS = ("ads", "adult", "bet", "bets", "casino", "gambling", "jackpot", "loans", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx")

#: Log odds of block before a word is seen.
PRIOR = -1.0
#: Words of all urls that each class is given besides its own.
BACKGROUND = 200

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame, url: Column) -> DataFrame:
    """The pages with ``host`` and ``path``."""
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    })


def with_rule(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Urls (host, path, ...) with ``rule`` and ``rule_verdict`` of the longest rule that fits, else null.

    Each distinct host is joined with the rules of its suffixes, so the rules may be many.
    """
    spark = urls.sparkSession
    listed = spark.createDataFrame([tuple(r) for r in rules], "suffix string, rule_path string, rule_verdict string")
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_host = (
        urls.filter("host <> ''").select("host").distinct().select("host", F.explode(suffixes).alias("suffix")).join(listed, "suffix")
        .groupBy("host").agg(F.collect_list(F.struct(
            (F.length("suffix") + F.length("rule_path")).alias("size"), F.concat("suffix", "rule_path").alias("rule"), "rule_path", "rule_verdict",
        )).alias("rules"))
    )
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    return urls.join(by_host, "host", "left").withColumn("best", best).withColumns({
        "rule": F.col("best.rule"), "rule_verdict": F.col("best.rule_verdict"),
    }).drop("rules", "best")


def word_counts(html: DataFrame, column: str) -> DataFrame:
    """(word, n) over the text between the tags, lower-cased, letters only."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(column).cast("string"), F.lit(""))), r"<[^>]*>", " ")
    return html.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word")).filter(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))


def viterbi(name: str, known: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """The likeliest split of a name. ``known`` has the log probability of the words at (start, length);
    any other piece costs ``unknown`` for each character."""
    best, came = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
    for end in range(1, len(name) + 1):
        for start in range(max(0, end - LONGEST), end):
            cost = known.get((start, end - start), unknown * (end - start))
            if best[start] + cost > best[end] + 1e-9:
                best[end], came[end] = best[start] + cost, start
    words, end = [], len(name)
    while end:
        words.append(name[came[end] : end])
        end = came[end]
    return words[::-1]


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of distinct names by unigram Viterbi."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    starts = F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start")
    sizes = F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("start") + 1))).alias("size")
    pieces = names.select("name", starts).select("name", "start", sizes).withColumn("word", F.expr("substring(name, start, size)"))
    found = pieces.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("start", "size", "n")).alias("known"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A character outside all words is rarer than any word that was seen once.
        unknown = -math.log(total) - math.log(10)
        for batch in batches:
            rows = batch.to_pylist()
            words = [viterbi(r["name"], {(k["start"] - 1, k["size"]): math.log(k["n"] / total) for k in r["known"] or ()}, unknown) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(words, pa.list_(pa.string()))], names=["name", "words"])

    return names.join(found, "name", "left").mapInArrow(split, "name string, words array<string>")


def _names(host: Column, path: Column) -> Column:
    """Names of a url to segment: labels of the host and alphabetic tokens of the path; numbers are one token."""
    tokens = F.split(F.concat_ws("/", host, F.translate(path, _UPPER, _LOWER)), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(tokens, lambda t: t != ""), lambda t: F.when(t.rlike(r"^\p{N}+$"), F.lit("0")).otherwise(t))


def naive_bayes(counted: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """(word, weight): log odds of block against allow, from rows (words, label, n).

    Each class is smoothed by ``background`` words that have their shares in all
    urls: little evidence moves a verdict little. A class without words says nothing.
    """
    by_word = counted.select(F.explode("words").alias("word"), "label", "n").groupBy("word").agg(
        *[F.sum(F.when(F.col("label") == x, F.col("n")).otherwise(0)).alias(x) for x in ("block", "allow")],
    )
    by_word = materialize(by_word, "word-labels")
    block, allow = by_word.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in ("block", "allow")]).first()
    every = (F.col("block") + F.col("allow")) / F.lit(float(max(1, block + allow)))

    def share(name: str, total: int) -> Column:
        return (F.col(name) + F.lit(float(background)) * every) / F.lit(float(total + background))

    return by_word.select("word", F.log(share("block", block) / share("allow", allow)).alias("weight"))


def judge_urls(
    pages: DataFrame, *, rules: Sequence[Rule] = RULES, seeds: Sequence[str] = SEEDS, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html", prior: float = PRIOR,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every page.

    Urls that differ only in their numbers have the same words, so they are
    scored once: a host that has a third of all pages isn't scored page by page.
    ``score`` is the log odds of block; null where a rule decides.
    """
    own = with_parts(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("_url")), F.col("_url")).drop("_url")
    ruled = materialize(with_rule(own, rules).withColumn("names", _names(F.col("host"), F.col("path"))), "urls")
    shapes = materialize(ruled.groupBy("names").agg(F.count("*").alias("n")).withColumn("shape", F.monotonically_increasing_id()), "shapes")
    parts = ruled.select("host").distinct().select(F.explode(F.split("host", r"\.")).alias("label")).filter(F.contains("label", F.lit("-")))
    parts = parts.select(F.explode(F.split("label", r"[^\p{L}]+")).alias("word")).filter(F.length("word").between(1, LONGEST))
    known = word_counts(pages, html_col).union(parts.groupBy("word").agg(F.count("*").alias("n")))
    known = known.union(pages.sparkSession.createDataFrame([(s, 1) for s in seeds], "word string, n long"))
    counts = materialize(known.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    placed = shapes.select("shape", F.posexplode("names").alias("i", "name"))
    segments = materialize(segment(placed.select("name").distinct(), counts), "segments")
    worded = materialize(
        placed.join(segments, "name").groupBy("shape").agg(F.flatten(F.collect_list("words")).alias("words")), "words",
    )
    seeded = F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds])) if seeds else F.lit(False)
    labelled = worded.withColumn("label", F.when(seeded, "block").otherwise("allow")).join(shapes.select("shape", "n"), "shape")
    weights = naive_bayes(labelled)
    scores = worded.select("shape", F.explode("words").alias("word")).join(weights, "word").groupBy("shape").agg(F.sum("weight").alias("score"))
    scored = shapes.join(scores, "shape").select("names", (F.col("score") + prior).alias("score"))
    method = F.when(F.coalesce(F.col("score"), F.lit(0.0)) > 0, "block").otherwise("allow")
    return ruled.join(scored, "names", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("score")).alias("score"),
    )
