"""SimHash fingerprints, covering tables, components and near-duplicates, against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from conftest import rows

from streamlog.llm import components, simhash


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def fingerprint(text):
    w = split(text)
    shingles = [" ".join(w[j : j + 3]) for j in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(nodes, near):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for k, a in enumerate(nodes):
        for b in nodes[:k]:
            if near(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_every_pair_within_the_radius_shares_a_mask():
    for radius in (1, 2, 3):
        masks = [m & (1 << 64) - 1 for m in simhash.masks(radius)]
        assert len(masks) == 2 ** (radius + 1) - 1
        pick = random.Random(radius)
        sets = [pick.sample(range(64), radius) for _ in range(3000)]
        if radius == 2:
            sets = [(i, j) for i in range(64) for j in range(64)]
        for places in sets:
            difference = sum(1 << i for i in set(places))
            assert any(not m & difference for m in masks)


@pytest.mark.parametrize("seed", [1, 2])
def test_links_connect_what_brute_force_connects(spark, seed):
    pick = random.Random(seed)
    values = set()
    for _ in range(12):
        value = pick.getrandbits(64)
        for _ in range(pick.choice([1, 2, 3, 40])):
            values.add(value - (1 << 64) if value >> 63 else value)
            for _ in range(pick.randint(1, 3)):
                value ^= 1 << pick.randrange(64)
    nodes = sorted(values)
    expected = linked(nodes, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    found = components.components(simhash.fingerprint_links(spark.createDataFrame([(v,) for v in nodes], "bits long")))
    got = {n: n for n in nodes} | {r.node: r.root for r in found.collect()}
    assert got == expected


def test_components_of_a_long_chain(spark):
    pick = random.Random(3)
    order = pick.sample(range(500), 200)
    links = list(zip(order[:-1], order[1:], strict=True)) + [(900, 901), (5000, 5000)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    assert rows(found) == sorted([(n, min(order)) for n in order] + [(900, 900), (901, 900)])
    assert rows(components.components(spark.createDataFrame([], "a long, b long"))) == []


def test_fingerprint_components(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    bits = [fingerprint(t) for _, t in docs]
    number = linked(list(range(len(docs))), lambda a, b: (bits[a] ^ bits[b]).bit_count() <= 2)
    least = {r: min((docs[k][0] for k in number if number[k] == r and docs[k][0] is not None), default=None) for r in set(number.values())}
    expected = [(docs[k][0], f"{bits[k]:016x}", least[number[k]]) for k in number]
    assert rows(simhash.fingerprint_components(odd_docs)) == sorted(expected, key=lambda r: (r[0] is not None, r))
    assert rows(simhash.fingerprint_components(no_docs)) == []


def jaccard(a, b):
    def shingles(text):
        w = split(text)
        return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}

    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 0


def test_near_duplicates_go_and_others_stay(spark):
    pick = random.Random(4)
    vocabulary = ["".join(pick.choice("abcdefghijklmno") for _ in range(pick.randint(2, 9))) for _ in range(800)]
    docs = {i: [pick.choice(vocabulary) for _ in range(pick.randint(60, 400))] for i in range(120)}
    changed = {}
    for i in range(60):
        copy = list(docs[i])
        for _ in range(max(1, len(copy) // 100)):
            copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
        changed[1000 + i] = copy
    texts = {i: " ".join(w) for i, w in (docs | changed).items()} | {2000: "Short one", 2001: "short  ONE", 2002: "short two", 2003: None, 2004: ""}
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, node string")
    kept = {r.doc_id for r in simhash.drop_near_duplicates(frame).collect()}
    near = {i for i in changed if jaccard(texts[i], texts[i - 1000]) >= 0.8}
    assert len(near) > 40
    assert len(near - kept) >= 0.95 * len(near)
    assert set(docs) <= kept and {2000, 2002, 2003} <= kept and 2001 not in kept and 2004 not in kept
    assert {i for i in changed if i not in kept} <= near
    assert simhash.drop_near_duplicates(frame).columns == frame.columns


def test_near_duplicates_of_odd_documents(odd_docs, no_docs):
    kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(odd_docs).collect() if r.doc_id is not None)
    # 5 and 12 repeat 1, 16 is 1 in capitals, 3 and 4 are empty like 2, 14 has the same shingles as 11.
    assert kept == [1, 2, 6, 7, 8, 10, 11, 13, 14, 15] or kept == [1, 2, 6, 7, 8, 9, 10, 11, 13, 14, 15]
    assert simhash.drop_near_duplicates(odd_docs).filter("doc_id IS NULL").count() == 2
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_majority_over_many_hashes():
    pick = np.random.default_rng(1)
    hashes = pick.integers(0, 2**64, 20_000, dtype=np.uint64)
    doc = np.sort(pick.integers(0, 5, 20_000))
    got = simhash._majority(hashes, doc, 6)
    for d in range(6):
        mine = hashes[doc == d]
        assert int(got[d]) == sum(1 << b for b in range(64) if 2 * int(((mine >> np.uint64(b)) & np.uint64(1)).sum()) > len(mine))


def kept_by_brute_force(texts):
    number = linked(sorted(texts), lambda a, b: split(texts[a]) == split(texts[b]) or jaccard(texts[a], texts[b]) >= 0.8)
    return {i for i, r in number.items() if i == r}


def kept_by_stage(spark, texts):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    return {r.doc_id for r in simhash.drop_near_duplicates(frame).collect()}


def test_no_round_ends_the_search_early(spark):
    # One hot group of copies brings nearly all links, a few far smaller groups the rest.
    pick = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    hot = [pick.choice(words) for _ in range(200)]
    texts = {}
    for i in range(260):
        copy = list(hot)
        copy[pick.randrange(200)] = pick.choice(words)
        copy[pick.randrange(200)] = pick.choice(words)
        texts[i] = " ".join(copy)
    for g in range(3):
        base = [pick.choice(words) for _ in range(150)]
        # The smallest member of the group is like the largest only.
        for k in range(3):
            copy = list(base)
            for j in range(k * 2):
                copy[10 + 12 * j] = f"x{g}"
            texts[1000 + 10 * g + k] = " ".join(copy)
    assert kept_by_stage(spark, texts) == kept_by_brute_force(texts)


def test_a_bridge_joins_documents_that_are_unlike(spark):
    pick = random.Random(6)
    texts = {}
    for g in range(12):
        base = [f"g{g}w{pick.randrange(10**6)}" for _ in range(200)]
        # 3 is similar to 1 and to 2, which differ from it at other places.
        for k, places in ((1, (10, 40, 70)), (2, (110, 140, 170)), (3, ())):
            copy = list(base)
            for j in places:
                copy[j] = f"c{k}"
            texts[10 * g + k] = " ".join(copy)
        assert jaccard(texts[10 * g + 1], texts[10 * g + 2]) < 0.8 <= min(jaccard(texts[10 * g + k], texts[10 * g + 3]) for k in (1, 2))
    assert kept_by_stage(spark, texts) == {10 * g + 1 for g in range(12)}


def test_appended_and_truncated_copies_are_found(spark):
    pick = random.Random(7)
    words = [f"w{i}" for i in range(4000)]
    texts = {}
    for g in range(40):
        base = [pick.choice(words) for _ in range(pick.randint(150, 300))]
        texts[g] = " ".join(base)
        texts[100 + g] = " ".join(base + [pick.choice(words) for _ in range(int(len(base) * 0.23))])
        texts[200 + g] = " ".join(base[: int(len(base) * 0.82)])
    assert kept_by_stage(spark, texts) == kept_by_brute_force(texts) == set(range(40))


def near_copies(pick, n, original):
    words = [f"w{i}" for i in range(5000)]
    base = [pick.choice(words) for _ in range(200)]
    texts = {i: list(base) for i in range(n)}
    for i in texts if not original else list(texts)[: n // 2] + list(texts)[n // 2 + 1 :]:
        for place in pick.sample(range(200), 3):
            texts[i][place] = pick.choice(words)
    return {i: " ".join(w) for i, w in texts.items()}


@pytest.mark.parametrize("original", [False, True])
def test_comparisons_grow_in_proportion_to_a_group(spark, monkeypatch, original):
    """Copies that differ from their original, if there is one, and more from each other."""
    compared, similar = [], simhash._similar

    def counting(pairs, sets, similarity):
        compared[-1] += pairs.count()
        return similar(pairs, sets, similarity)

    monkeypatch.setattr(simhash, "_similar", counting)
    for n in (100, 200, 400):
        texts = near_copies(random.Random(n), n, original)
        compared.append(0)
        kept = kept_by_stage(spark, texts)
        if original:
            assert kept == {0}
    assert max(compared) <= 400 * 60 and compared[2] <= 2.5 * compared[1] <= 6.25 * compared[0]


@pytest.mark.parametrize("kind", ["scattered", "appended", "truncated"])
def test_recall_of_each_kind_of_copy(spark, kind):
    """Of pairs with a similarity of 0.8 or more, 95 in 100 are connected."""
    pick = random.Random(kind)
    words = [f"w{int(pick.paretovariate(0.7))}" for _ in range(20_000)]
    texts = {}
    for g in range(60):
        base = [pick.choice(words) for _ in range(pick.randint(80, 300))]
        for k in range(pick.choice([2, 3, 6])):
            copy, share = list(base), pick.uniform(0, 0.16)
            if kind == "scattered":
                for place in pick.sample(range(len(base)), int(len(base) * share / 7)):
                    copy[place] = pick.choice(words)
            elif kind == "appended":
                copy += [pick.choice(words) for _ in range(int(len(base) * share))]
            else:
                copy = copy[: int(len(base) * (1 - share))]
            texts[10 * g + k] = " ".join(copy)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    root = {r.node: r.root for r in components.components(simhash.near_duplicate_links(frame)).collect()}
    near = [(a, b) for a in texts for b in texts if a < b and a // 10 == b // 10 and jaccard(texts[a], texts[b]) >= 0.8]
    assert len(near) > 100
    joined = sum(root.get(a, a) == root.get(b, b) for a, b in near)
    assert joined >= 0.95 * len(near)


def test_pairs_that_no_representative_has_are_found(spark):
    """Texts of common passages, each with one near copy: many share every group, few are representatives."""
    pick = random.Random(5)
    passages = [" ".join(f"p{u}w{i}" for i in range(40)) for u in range(24)]
    texts = []
    for _ in range(40):
        units = sorted(pick.sample(range(24), 12))
        other = list(units)
        other[pick.randrange(12)] = pick.choice([u for u in range(24) if u not in units])
        texts += [" ".join(passages[u] for u in chosen) for chosen in (units, other)]
    texts = dict(enumerate(texts))
    assert kept_by_stage(spark, texts) == kept_by_brute_force(texts)
