"""Packing with lexical neighbours: round trips, the index, the encoder."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from streamlog.llm import retrieval as rt
from test_catalogue import SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")


def round_trip(docs, packed, window=rt.WINDOW):
    """Every id of every document lies in one piece, and pieces stand in their sequence without a gap."""
    slow = Tokenizer.from_file(PATH)
    expected = defaultdict(int)
    for r in docs.collect():
        ids = [*slow.encode(r.text or "", add_special_tokens=False).ids, 1]
        expected[r.doc_id, tuple(ids)] += 1
    rows = packed.collect()
    sequences = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= window
        sequences[r.sequence_id].append((r.offset, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= window
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == {d for d, _ in expected}
    for (doc_id, ids), times in expected.items():
        ids = np.array(ids, dtype="<u4")
        mine = [r for r in by_doc[doc_id] if r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())]
        covered = np.zeros(len(ids), dtype=int)
        for r in mine:
            covered[r.start : r.start + r.length] += 1
        assert (covered == times).all()
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in expected.items())
    return sequences


def padding(sequences, window=rt.WINDOW):
    total = [sum(n for _, n in found) for found in sequences.values()]
    return sum(0 if n & (n - 1) == 0 else window - n for n in total), sum(total)


def test_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    packed = rt.pack_with_neighbours(docs, PATH).cache()
    assert dict(packed.dtypes) == {"doc_id": "bigint", **dict.fromkeys(("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), "bigint")}
    sequences = round_trip(docs, packed)
    assert padding(sequences)[0] == 0
    full = sum(sum(n for _, n in found) == rt.WINDOW for found in sequences.values())
    assert full > 0.95 * len(sequences)


@pytest.mark.parametrize("shard_docs", [3, 2048])
def test_odd_documents(spark, odd_docs, shard_docs):
    sequences = round_trip(odd_docs, rt.pack_with_neighbours(odd_docs, PATH, window=256, shard_docs=shard_docs), 256)
    assert padding(sequences, 256)[0] == 0


def test_no_documents_and_a_wrong_window(spark, no_docs):
    assert rt.pack_with_neighbours(no_docs, PATH).count() == 0
    with pytest.raises(ValueError):
        rt.pack_with_neighbours(no_docs, PATH, window=1000)


def test_only_empty_documents(spark):
    docs = spark.createDataFrame([(i, None if i % 2 else "") for i in range(7)], "doc_id long, text string")
    sequences = round_trip(docs, rt.pack_with_neighbours(docs, PATH))
    assert sorted(sum(n for _, n in s) for s in sequences.values()) == [1, 2, 4]


def test_neighbours_share_a_window(spark):
    """Documents on one subject come together although others lie between them."""
    draw = np.random.default_rng(1)
    subjects = [[f"{a}{b}" for b in ("stone", "water", "garden", "engine", "letter", "summer")] for a in ("red", "old", "north", "silver", "wild", "paper", "iron", "glass")]
    docs = [(i, " ".join(draw.choice(subjects[i % 8], 40))) for i in range(160)]
    packed = rt.pack_with_neighbours(spark.createDataFrame(docs, "doc_id long, text string"), PATH, window=512).collect()
    together = defaultdict(set)
    for r in packed:
        together[r.sequence_id].add(r.doc_id)
    same = np.mean([len({d % 8 for d in found}) <= 2 for found in together.values()])
    assert same > 0.9


def test_scores_are_those_of_bm25():
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, 40, draw.integers(1, 60)).astype("<u4") for _ in range(50)]
    having = np.array([sum(t in d for d in docs) for t in range(40)])
    idf, mean = np.maximum(0, np.log((50 - having + 0.5) / (having + 0.5))), np.mean([len(d) for d in docs])
    index = rt.ShardIndex(docs, idf, mean)
    for seed in range(50):
        expected = np.zeros(50)
        for i, d in enumerate(docs):
            for term in np.unique(docs[seed]):
                tf = (d == term).sum()
                expected[i] += idf[term] * tf * (rt.K1 + 1) / (tf + rt.K1 * (1 - rt.B + rt.B * len(d) / mean))
        assert np.allclose(index.scores(seed), expected)


def test_best_unused_neighbour_comes_next():
    docs = [np.array(x, dtype="<u4") for x in ([1, 2, 3], [9, 9, 8], [1, 2, 4], [1, 5, 6], [9, 8, 7])]
    idf = np.ones(10)
    windows = rt.fill_windows(np.full(5, 4), rt.ShardIndex(docs, idf, 3.0), window=16)
    assert [[d for d, _, _ in w] for w in windows] == [[0, 2, 3, 1], [4]]


def test_counts_are_of_the_whole_corpus(spark, odd_docs):
    encoded = rt.encode_documents(odd_docs, PATH)
    having, n, mean = rt.document_frequencies(encoded, 50_257)
    rests = [rt._rest(r.rest)[:-1] for r in encoded.collect()]
    assert n == len(rests) and mean == pytest.approx(np.mean([len(r) for r in rests]))
    assert having.sum() == sum(len(np.unique(r)) for r in rests)


def test_powers_of_two():
    found = rt.at_powers([(0, 5, 700), (1, 0, 301), (2, 0, 2)])
    assert [sum(n for _, _, n in w) for w in found] == [512, 256, 128, 64, 32, 8, 2, 1]
    assert [p for w in found for p in w][:3] == [(0, 5, 512), (0, 517, 188), (1, 0, 68)]


def test_every_character_is_encoded_as_by_the_library():
    """The faster encoder agrees on every code point, between letters, digits, blanks and signs."""
    encode, size = rt.byte_pair_encoder(PATH)
    assert size == 50_257
    slow = Tokenizer.from_file(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(points), 20_000):
        said = "".join(f"a{c}b 1{c} {c}{c}. " for c in points[a : a + 20_000])
        assert encode(said) == slow.encode(said, add_special_tokens=False).ids


def test_special_strings_blanks_and_long_words():
    encode, _ = rt.byte_pair_encoder(PATH)
    slow = Tokenizer.from_file(PATH)
    for said in ("a<|endoftext|>b <|endoftext|>", "it's we'LL they'd  \n\n  x\t\ty   ", " " * 3000 + "x", "x" * 20_000 + " y" * 10, "\n" * 500 + "é日本🙂"):
        assert encode(said) == slow.encode(said, add_special_tokens=False).ids


def test_pieces_meet_where_no_token_crosses():
    encode, _ = rt.byte_pair_encoder(PATH)
    draw = np.random.default_rng(3)
    said = "".join(draw.choice(list("ab1é日 \n\t.'<|s"), 30_000))
    found = list(rt.pieces(said, 500))
    assert "".join(found) == said and len(found) > 20
    assert sum((encode(p) for p in found), []) == encode(said)


def test_another_kind_of_tokenizer_is_encoded_by_its_own_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encode, _ = rt.byte_pair_encoder(path)
    assert encode("Hello  world") == Tokenizer.from_file(path).encode("Hello  world", add_special_tokens=False).ids
