"""Quality rules, token counts, packing and decontamination."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import rows

from streamlog.llm import decontam, packing, quality, tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = r"[^\x20\x09-\x0D]+"


def counts_by_hand(text):
    text = text or ""
    words, seen, repeated_lines = re.findall(WORD, text), set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            repeated_lines += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[j : j + 5]) for j in range(len(words) - 4))
    under = {k for j in range(len(words) - 4) if windows[tuple(words[j : j + 5])] > 1 for k in range(j, j + 5)}
    failed = len(words) < 10 or 100 * len(under) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeated_lines, len(under), failed


def test_quality_counts(spark, odd_docs, no_docs):
    pick = random.Random(1)
    texts = [" ".join(pick.choice(["a", "b", "été", "#x|", "\n", "$"]) for _ in range(pick.randint(0, 60))) for _ in range(80)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'en' AS lang")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert rows(quality.quality(frame).select("doc_id", *base)) == [(i, *counts_by_hand(t)) for i, t in enumerate(texts)]
    got = rows(quality.quality(odd_docs).select("doc_id", *base))
    assert got == sorted(((r.doc_id, *counts_by_hand(r.text)) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r))
    assert not quality.quality(odd_docs).filter("base_failed AND kept").count()
    assert quality.quality(no_docs).count() == 0 and quality.keep_good(no_docs).schema == no_docs.schema


def test_quality_parts_prose_from_noise(spark):
    pick = random.Random(2)
    vocabulary = ["".join(pick.choice("etaoinshr") for _ in range(pick.randint(1, 8))) for _ in range(300)]
    prose = [" ".join(pick.choices(vocabulary, [1 / (k + 1) for k in range(300)], k=pick.randint(60, 300))).capitalize() + "." for _ in range(60)]
    noise = [" ".join(pick.choice("#$%&*") * pick.randint(1, 3) + str(pick.random()) for _ in range(80)) for _ in range(3)]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + noise)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.quality(frame).filter("kept").collect()}
    assert kept == set(range(60))
    assert {r.doc_id for r in quality.keep_good(frame).collect()} == kept
    assert {r.doc_id for r in quality.keep_good(frame.drop("lang")).collect()} == kept


def byte_class(c):
    if c in (9, 10, 11, 12, 13, 32):
        return "separator"
    if c < 32 or c == 127:
        return "control"
    if c >= 128:
        return "beyond"
    if chr(c).isalpha():
        return "lower" if chr(c).islower() else "upper"
    if chr(c).isdigit():
        return "digit"
    return "sentence" if chr(c) in ".,;:!?'\"()-" else "mark"


def js_distance(p, q):
    keys, total_p, total_q = set(p) | set(q), sum(p.values()), sum(q.values())
    if not total_p:
        return 0
    out = 0
    for k in keys:
        a, b = p.get(k, 0) / total_p, q.get(k, 0) / total_q
        out += sum(x * math.log2(x / ((a + b) / 2)) for x in (a, b) if x) / 2
    return math.sqrt(max(0, min(1, out)))


def judged_by_hand(docs):
    """(class distance, word distance, kept) of each (text, lang), without any vectors."""
    classes, words = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)

    def of(text):
        return collections.Counter(map(byte_class, text.encode())), collections.Counter(lowered(w) for w in re.findall(WORD, text))

    def lowered(w):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)

    for text, lang in docs:
        a, b = of(text)
        classes[lang] += a
        words[lang] += b
    common = {lang: dict(words[lang].most_common(quality.COMMON_WORDS)) for lang in words}
    out = []
    for text, lang in docs:
        a, b = of(text)
        top = common.get(lang)
        if not top:
            out.append((0, 0, not counts_by_hand(text)[-1]))
            continue
        own = collections.Counter({None: 0})
        for w, n in b.items():
            own[w if w in top else None] += n
        reference = top | {None: sum(words[lang].values()) - sum(top.values())}
        dc, dw = js_distance(a, classes[lang]), js_distance(own, reference)
        far = len(text) >= quality.MIN_CHARS and dc > quality.MAX_CLASS_DISTANCE
        far |= sum(b.values()) >= quality.MIN_WORDS and dw > quality.MAX_WORD_DISTANCE
        out.append((dc, dw, not counts_by_hand(text)[-1] and not far))
    return out


@pytest.mark.parametrize("n_langs", [3, 1100])
def test_quality_verdicts_by_hand(spark, n_langs):
    """Also with more languages than anyone would keep in one place."""
    pick, docs = random.Random(3), []
    # Fewer than 64 words a language: no ties at the end of the common ones.
    weights = [1 / (k + 1) ** 1.3 for k in range(40)]
    for i in range(max(120, n_langs)):
        lang = f"l{i % n_langs}"
        vocabulary = [f"{lang}{'abcdefgh'[k % 8]}{k}é" for k in range(40)]
        text = " ".join(pick.choices(vocabulary, weights, k=pick.randint(5, 120)))
        if i % 7 == 0:
            text = " ".join(pick.choice("#$%&*") * pick.randint(1, 4) for _ in range(60))
        docs.append((text, lang))
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, text string, lang string").repartition(4)
    found = sorted(quality.quality(frame).select("doc_id", "class_distance", "word_distance", "kept").collect())
    expected = judged_by_hand(docs)
    for r, (dc, dw, kept) in zip(found, expected, strict=True):
        assert (r.class_distance, r.word_distance) == (pytest.approx(dc, abs=1e-9), pytest.approx(dw, abs=1e-9)) and r.kept == kept
    assert {e[2] for e in expected} == {True, False}


def test_distance_is_a_distance():
    reference = np.array([0.5, 0.25, 0.25])
    got = quality.distance(np.array([[2, 1, 1], [0, 0, 0], [4, 0, 0]]), reference)
    assert got[0] == pytest.approx(0) and got[1] == 0 and 0 < got[2] < 1
    assert quality.distance(np.array([[1, 0]]), np.array([0.0, 1.0]))[0] == pytest.approx(1)


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 256), (200, 16), (90, 4)])
def test_token_counts(spark, odd_docs, no_docs, chunk, overlap):
    own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = tokens.token_counts(odd_docs, MODEL, chunk=chunk, overlap=overlap)
    expected = [(r.doc_id, len((r.text or "").encode()), len(own.encode(r.text or ""))) for r in odd_docs.collect()]
    assert rows(found.select("doc_id", "n_bytes", "n_tokens")) == sorted(expected, key=lambda r: (r[0] is not None, r))
    assert found.filter("over_limit <> (n_tokens > 4096)").count() == 0
    assert tokens.token_counts(no_docs, MODEL).count() == 0


def test_splices_agree_with_the_whole_text():
    own, pick = tokens.tokenizer(MODEL), random.Random(6)
    assert own.splices
    spliced = 0
    for _ in range(200):
        text = "".join(pick.choice(["the", "of", " ", "  ", "\n", "été", "日本", "\t", "x" * 30, ". ", "🙂", "</s>"]) + pick.choice(["", " "]) for _ in range(300))
        parts = []
        for low, part in tokens.chunks(text.encode(), 200, 40):
            begins = own.begins(part.decode())
            places = tokens.stable_places(part, begins)
            parts.append({"total": len(begins), "places": [low + p for p in places], "before": list(places.values())})
        total = tokens.splice(parts)
        spliced += total is not None
        assert total in (None, own.counts([text])[0])
    assert spliced > 50


def check_packing(counted, found, lengths):
    by_doc, bins = collections.defaultdict(list), collections.defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        if r.n_tokens:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.bin_length is None
    assert {d: sum(r.n_tokens for r in rs) for d, rs in by_doc.items()} == counted
    for rs in by_doc.values():
        rs.sort(key=lambda r: r.piece)
        assert [r.start for r in rs] == [lengths[-1] * k for k in range(len(rs))]
    for rs in bins.values():
        rs.sort(key=lambda r: r.place)
        assert all(a.place + a.n_tokens == b.place for a, b in zip(rs[:-1], rs[1:], strict=True)) and rs[0].place == 0
        used = sum(r.n_tokens for r in rs)
        assert {r.bin_length for r in rs} == {min(c for c in lengths if c >= used)}
    return bins


def test_packing(spark, no_docs, monkeypatch):
    pick = random.Random(7)
    counted = {i: pick.choice([0, 1, 3, 100, 511, 512, 513, 4096, 4097, 9000, pick.randint(1, 3000)]) for i in range(900)}
    frame = spark.createDataFrame([(i, n, 1) for i, n in counted.items()], "doc_id long, n_tokens long, grp long")
    bins = check_packing(counted, packing.pack_documents(frame).collect(), packing.LENGTHS)
    room = sum(rs[0].bin_length for rs in bins.values())
    assert sum(counted.values()) >= 0.97 * room
    monkeypatch.setattr(packing, "GROUP_DOCS", 100)
    check_packing(counted, packing.pack_documents(frame).collect(), packing.LENGTHS)
    assert packing.pack_documents(no_docs).count() == 0


def plainly_packed(pieces, lengths, overhead, span):
    """The same by looking through all pieces: sizes of each bin and its length."""
    left, out = sorted(pieces, reverse=True), []
    while left:
        first, tried = left[0], []
        for c in lengths:
            if c >= first:
                rest, room, own = left[1:], c - first, [first]
                while any(n <= room for n in rest):
                    n = max(n for n in rest if n <= room)
                    rest.remove(n)
                    own.append(n)
                    room -= n
                length = min(x for x in lengths if x >= sum(own))
                tried.append(((overhead + length + length**2 / span) / sum(own), len(tried), length, own, rest))
        _, _, length, own, left = min(tried)
        out.append((length, own))
    return out


def test_best_fit_is_what_a_search_finds():
    pick = random.Random(8)
    for lengths, overhead, span in (((16, 32, 64), 4, 200), ((64,), 0, 10**9), ((10, 64), 30, 50)):
        pieces = sorted((pick.randint(1, 60) for _ in range(200)), reverse=True)
        bins, places, opened = packing.pack(pieces, lengths, overhead, span)
        expected = plainly_packed(pieces, lengths, overhead, span)
        assert opened == [length for length, _ in expected]
        for k, (_, own) in enumerate(expected):
            mine = sorted((places[i], n) for i, n in enumerate(pieces) if bins[i] == k)
            assert [n for _, n in mine] == own and [at for at, _ in mine] == [sum(own[:j]) for j in range(len(own))]
    assert packing.pack([], (16,), 1) == ([], [], [])


def test_several_lengths_cost_less_than_any_single_one():
    pick = random.Random(9)
    pieces = sorted((min(4096, int(pick.lognormvariate(5.8, 1.1)) + 1) for _ in range(3000)), reverse=True)

    def price(lengths):
        return sum(packing.cost(c) for c in packing.pack(pieces, lengths)[2])

    opened = collections.Counter(packing.pack(pieces)[2])
    assert set(opened) == set(packing.LENGTHS) and sorted(opened.values())[1] > 100
    joint = price(packing.LENGTHS)
    assert joint < 0.95 * price((4096,))
    for longest in (512, 1024, 2048):
        # One shorter length needs all longer pieces cut.
        cut = sorted((n for p in pieces for n in [longest] * (p // longest) + ([p % longest] if p % longest else [])), reverse=True)
        single = sum(packing.cost(c) for c in packing.pack(cut, (longest,))[2])
        several = sum(packing.cost(c) for c in packing.pack(cut, [c for c in packing.LENGTHS if c <= longest])[2])
        assert several <= single


def test_rows_without_id_are_dealt_to_groups_too(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_DOCS", 100)
    frame = spark.range(1000).selectExpr("CAST(NULL AS long) doc_id", "id % 700 n_tokens").repartition(4)
    packed = packing.pack_documents(frame).filter("bin_id IS NOT NULL")
    assert packed.selectExpr("bin_id >> 32").distinct().count() > 5
    assert packed.count() == frame.filter("n_tokens > 0").count()


def test_byte_pair_counts(odd_docs):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = [(r.doc_id, len(own.encode_ordinary(r.text or ""))) for r in odd_docs.collect()]
    assert rows(packing.byte_pair_counts(odd_docs, path, public_tokenizers.PATTERN)) == sorted(expected, key=lambda r: (r[0] is not None, r))


def scores_by_hand(items, passage):
    """BM25 of a passage's distinct words against every item, over the item's score for itself."""
    split = {i: re.findall(r"\w+", t.lower()) for i, t in items.items()}
    mean = sum(map(len, split.values())) / len(split)
    df = collections.Counter(w for words in split.values() for w in set(words))
    out = {}
    for i, words in split.items():
        tf = collections.Counter(words)
        weight = {
            w: np.log1p((len(items) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words) / mean)) for w, n in tf.items()
        }
        out[i] = sum(weight.get(w, 0) for w in set(passage)) / sum(weight.values())
    return out


def test_search_returns_exactly_what_scores_enough(spark):
    pick = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)]
    items = {i: " ".join(pick.choices(vocabulary, [1 / (k + 1) for k in range(400)], k=pick.randint(10, 40))) for i in range(50)}
    frame = spark.createDataFrame(list(items.items()), "item_id long, text string")
    (index,) = decontam.shards(frame)
    assert index.slack > 0 and not index.essential.all()
    hits = 0
    for n in range(60):
        words = pick.choices(vocabulary, [1 / (k + 1) for k in range(400)], k=pick.randint(1, 500))
        if n % 2:
            at, some = pick.randrange(len(words)), items[pick.randrange(50)].split()
            words[at:at] = some[: pick.randint(5, len(some))]
        import pyarrow as pa

        hashes, doc, _ = decontam._hashed_words(pa.array(["filler text", " ".join(words)]))
        got = {(a, i): s for d, i, s, a, b in decontam.search(index, hashes, doc) if d == 1}
        expected = {}
        for a in range(0, len(words), index.stride):
            for i, s in scores_by_hand(items, words[a : a + 2 * index.stride]).items():
                if s >= decontam.THRESHOLD:
                    expected[2 + a, index.items.index(i)] = s
        assert got.keys() == expected.keys()
        assert all(got[k] == pytest.approx(expected[k]) for k in got)
        hits += len(got)
    assert hits > 20


def test_contamination(spark, odd_docs, no_docs, monkeypatch):
    pick = random.Random(10)
    vocabulary = ["".join(pick.choice("abcdefgh") for _ in range(6)) for _ in range(2000)]

    def prose(n):
        return " ".join(pick.choices(vocabulary, k=n))

    items = [(i, f"{prose(12)}. {prose(20)}") for i in range(30)] + [(30, None), (31, ""), (32, items_repeat := prose(20)), (32, items_repeat)]
    docs = [(i, prose(pick.randint(1, 600))) for i in range(100)]
    for i in range(0, 60, 3):
        docs[i] = (i, f"{docs[i][1]} {items[i % 30][1].upper()} {prose(5)}")
    docs[99] = (99, items[5][1].split(".")[0])  # the question without the answer
    docs += [(200, None), (201, ""), (None, items[1][1])]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = {(i, i % 30) for i in range(0, 60, 3)} | {(None, 1)}
    assert {(r.doc_id, r.item_id) for r in decontam.find_contamination(frame, bench).collect()} == expected
    kept = decontam.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in expected}
    monkeypatch.setattr(decontam, "SHARD_BYTES", 1000)
    assert {(r.doc_id, r.item_id) for r in decontam.find_contamination(frame, bench).collect()} == expected
    assert decontam.find_contamination(frame, bench.limit(0)).count() == 0
    assert decontam.find_contamination(no_docs, bench).count() == 0
    assert decontam.drop_contaminated(odd_docs, bench).schema == odd_docs.schema
    assert decontam.drop_contaminated(odd_docs, bench).count() == odd_docs.count()
