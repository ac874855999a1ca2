"""Hard negatives against scoring every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from streamlog.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int, key string, n string, slot int, vec string, score long, anchor long, rank int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", "n", 3, "v", 9, 8, 7) for r in rows], SCHEMA)


def brute(rows, every=5, n_positives=5, n_negatives=3):
    own = []
    for i, v, label in rows:
        if v is not None and label is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            own.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    last = float("inf")
    out = []
    for k, (i, v, label) in enumerate(own):
        if i is None or i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), last if j is None else j, j, m) for t, (j, w, m) in enumerate(own) if t != k and len(w) == len(v)]
        scored.sort(key=lambda s: s[:2])
        for p in [s for s in scored if s[3] == label][:n_positives]:
            inside = [s for s in scored if s[3] != label and 50 * -p[0] <= 100 * -s[0] <= 95 * -p[0]]
            out += [(i, p[2], rank, s[2], -p[0], -s[0]) for rank, s in enumerate(inside[:n_negatives], 1)]
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    found = ng.mine(table(spark, rows), F.col("vec_id") % 5 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert [t for _, t in found.dtypes] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def clustered(draw, n, width, labels=4, noise=0.6):
    centres = draw.normal(size=(labels, width))
    label = draw.integers(0, labels, n)
    return [(i, [float(x) for x in 0.3 * centres[label[i]] + noise * draw.normal(size=width) / 3], int(label[i])) for i in range(n)]


@pytest.mark.parametrize("width", [64, 8, 5])
def test_as_every_pair(spark, width):
    rows = clustered(np.random.default_rng(width), 300, width)
    expected = brute(rows)
    assert expected and mined(spark, rows) == expected


def test_small_tiles_and_many_slots(spark, monkeypatch):
    rows = clustered(np.random.default_rng(1), 400, 16)
    monkeypatch.setattr(ng, "LEAST_ROWS", 20)
    monkeypatch.setattr(ng, "SLOT_BYTES", 1500)
    assert mined(spark, rows) == brute(rows)


def test_ties_and_equal_vectors(spark):
    draw = np.random.default_rng(2)
    rows = clustered(draw, 60, 8)
    common = rows[0][1]
    rows += [(100 + i, common, i % 3) for i in range(80)]
    rows += [(200 + i, [0.0] * 8, i % 2) for i in range(10)] + [(300 + i, [-x for x in common], i % 3) for i in range(10)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = clustered(np.random.default_rng(3), 60, 4)
    rows += [
        (None, rows[0][1], 1), (400, None, 1), (405, [1.0, None, 0.0, 0.0], 1), (410, [1.0, float("nan"), 0.0, 0.0], 1), (415, [float("inf"), 0.0, 0.0, 0.0], 1),
        (420, rows[1][1], None), (425, [], 1), (430, [], 2), (431, [], 1), (435, [1.0, 2.0], 1), (436, [1.0, 2.0], 1), (437, [0.5, 1.5], 2),
    ]
    assert mined(spark, rows) == brute(rows)


def test_no_rows_no_anchors_one_row(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [0.8, 1.5], 1)]) == []
    assert mined(spark, [(5, [1.0, 2.0], 0)]) == []


def test_bounds_hold_and_coarser_ones_follow_from_finer():
    draw = np.random.default_rng(4)
    x, y = draw.integers(-200, 200, (50, 64)).astype(float), draw.integers(-200, 200, (40, 64)).astype(float)
    exact = x @ y.T
    finest = ng.summaries(x, 32), ng.summaries(y, 32)
    previous = None
    for level in (32, 8, 1):
        (mx, sx), (my, sy) = (ng.coarser(*f, level) for f in finest)
        assert np.allclose(mx, ng.summaries(x, level)[0]) and np.allclose(sx, ng.summaries(x, level)[1])
        middle, spread = 64 // level * (mx @ my.T), 64 // level * (sx @ sy.T)
        assert (exact <= middle + spread + 1e-6).all() and (exact >= middle - spread - 1e-6).all()
        if previous is not None:
            assert (middle + spread >= previous - 1e-6).all()
        previous = middle + spread


def test_levels_divide_each_other():
    assert ng.levels_of(64) == [1, 8, 32]
    assert ng.levels_of(48, (1, 8, 12)) == [1, 8]
    assert ng.levels_of(0) == [] and ng.levels_of(5) == [1]


def test_far_rows_are_closed_by_their_bounds():
    """With clear clusters most pairs are settled before they are scored."""
    x = np.zeros((400, 8))
    x[:200, :4], x[200:, 4:] = 100, -100
    draw = np.random.default_rng(0)
    x = np.floor(x + draw.normal(size=x.shape))
    means, devs = ng.summaries(x, 2)
    upper = 4 * (means @ means.T + devs @ devs.T)
    assert (upper[:200, 200:] < 30_000).all() and (upper[:200, :200] > 30_000).all()


def test_scores_too_large_are_an_error(spark):
    from pyspark.errors import PythonException

    with pytest.raises(PythonException, match="32 bits"):
        mined(spark, [(5, [1e30, 0.0], 0), (6, [1.0, 1.0], 0)])
