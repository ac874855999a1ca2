"""Removal ranks against applying the filters one after the other."""

import itertools

import numpy as np
import pytest

from streamlog.llm import audit

DOCS = "doc_id long, text string, source string, mask string, n long, digest string, part string"
LABELS = "doc_id long, quality int, toxic int, n int"
LONG = " ".join(f"w{i}" for i in range(60))


def step_by_step(docs, labels):
    """The contract, document by document."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    last = float("inf")
    first = {}
    for i, text, _ in docs:
        first[text or ""] = min(first.get(text or "", last), last if i is None else i)
    judged = []
    for i, text, source in docs:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": first[text] < (last if i is None else i),
        }
        judged.append((source or "", fails, i in good, i in toxic))
    out = {}
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    for part in {j[0] for j in judged}:
        mine, removed_by = [j for j in judged if j[0] == part], dict.fromkeys("ABCDE", 0)
        for order in orders:
            left, gone = list(mine), []
            for step, letter in enumerate(order, 1):
                now = [j for j in left if j[1][letter]]
                redundant = sum(j[1][letter] for j in gone)
                left = [j for j in left if not j[1][letter]]
                gone += now
                removed_by[letter] += len(now)
                alone = sum(j[1][letter] and sum(j[1].values()) == 1 for j in mine)
                out[part, order, step] = [len(left), len(now), redundant, alone, sum(j[2] for j in now), sum(j[3] for j in now)]
        for order in orders:
            for step, letter in enumerate(order, 1):
                out[part, order, step].append(removed_by[letter])
    return out


def audited(spark, docs, labels):
    table = spark.createDataFrame([(i, t, s, "m", 1, "d", "p") for i, t, s in docs], DOCS)
    told = spark.createDataFrame([(*r, 5) for r in labels], LABELS)
    rows = audit.audit_filters(table, told).collect()
    assert len({r[:3] for r in rows}) == len(rows)
    return {tuple(r[:3]): list(r[3:]) for r in rows}


def test_odd_documents_as_step_by_step(spark):
    docs = [
        (1, LONG, "a"), (2, LONG, "a"), (3, LONG, "b"), (4, None, "a"), (5, "", None), (6, "  \t\x0b", ""), (7, "HELLO WORLD", "a"),
        (8, "x # y", "b"), (9, "same " * 70, "a"), (10, "same " * 70, "c"), (None, LONG, "a"), (None, "only null id", "a"), (None, "only null id", "c"),
        (11, LONG + " é日本 " * 3, "b"), (11, LONG + " é日本 " * 3, "b"), (12, LONG + " é日本 " * 3, None), (13, "v" * 200_000, "d"),
        (14, "UPPER " + LONG, "a"), (14, "other text of one id", "e"), (15, LONG.replace("w", "é"), "a"), (16, "a b " * 40, "a"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, None, None), (7, 0, 1), (8, 1, None), (None, 1, 1), (11, 1, 0), (14, 1, 0), (99, 1, 1)]
    assert audited(spark, docs, labels) == step_by_step(docs, labels)


def test_random_documents_as_step_by_step(spark):
    draw = np.random.default_rng(5)
    texts = [LONG, "Aa " * 80, "b", "c & d", " ".join(f"v{i % 30}" for i in range(60)), LONG + " #", "Q" * 50, None]
    docs = [(int(draw.integers(0, 150)), texts[draw.integers(0, len(texts))], f"s{draw.integers(0, 4)}") for _ in range(400)]
    labels = [(i, int(draw.integers(0, 2)), int(draw.integers(0, 2))) for i in range(0, 150, 2)]
    assert audited(spark, docs, labels) == step_by_step(docs, labels)


def test_a_text_that_most_documents_have(spark):
    docs = [(i, LONG, f"s{i % 3}") for i in range(3000)] + [(3000 + i, f"{LONG} {i}", "s0") for i in range(50)]
    found = audited(spark, docs, [(0, 1, 1), (1, 1, 0)])
    assert found["s0", "EABCD", 1][:2] == [51, 999]
    assert found["s1", "EABCD", 1][:2] == [0, 1000]
    assert found["s1", "EABCD", 1][4] == 1 and found["s0", "EABCD", 1][4] == 0


def test_steps_are_the_least_position_of_a_failed_filter():
    every = audit._Orders("ABC")
    for m, mask in enumerate(every.masks):
        for o, name in enumerate(every.names):
            places = [name.index(letter) + 1 for letter, fails in zip("ABC", mask, strict=True) if fails]
            assert every.steps[m, o] == min(places, default=4)


def test_shapley_sums_to_all_removals_of_all_orders(spark):
    docs = [(i, LONG if i % 3 else "x", "a") for i in range(30)]
    found = audited(spark, docs, [])
    by_letter = {key[1][key[2] - 1]: row[6] for key, row in found.items()}
    gone = next(row for key, row in found.items() if key[2] == 5)
    assert sum(by_letter.values()) == 120 * (30 - gone[0])


def test_no_documents_and_too_many_filters(spark, no_docs):
    labels = spark.createDataFrame([], LABELS)
    assert audit.audit_filters(no_docs.withColumnRenamed("lang", "source"), labels).count() == 0
    with pytest.raises(ValueError):
        audit.removal_audit(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), "ABCDEFGH")


def test_own_rules(spark, odd_docs):
    rules = {"x": lambda f: f.words < 3, "y": lambda f: f.points > 1000}
    labels = spark.createDataFrame([], LABELS)
    found = audit.audit_filters(odd_docs, labels, rules, copies="z", part_col="lang").collect()
    assert {r.filter_order for r in found} == {"".join(o) for o in itertools.permutations("xyz")}
    assert sum(r.kept + r.removed for r in found if r.step == 1 and r.filter_order == "xyz") == odd_docs.count()
