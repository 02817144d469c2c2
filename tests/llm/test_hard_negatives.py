"""Hard negatives against all pairs, and the bounds along the tree."""

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("foliar.llm")

from pyspark.sql import functions as F  # noqa: E402

from foliar.llm import hard_negatives as hard  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, row long, score string"


def plain(rows, every=10, k=5):
    """All pairs, by row position so that repeated ids stay apart."""
    ok = [(i, [int(np.floor(256 * x)) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    late = lambda i: (i is None, i or 0)
    out = []
    for n, (i, v, label) in enumerate(ok):
        if i is None or i % every:
            continue
        scored = sorted((-dot(v, w), late(j), j, other) for m, (j, w, other) in enumerate(ok) if m != n)
        for s, _, p, other in [x for x in scored if x[3] == label][:k]:
            hits = [(q, -t) for t, _, q, l in scored if l != label and 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(i, p, rank, q, -s, t) for rank, (q, t) in enumerate(hits, 1)]
    return sorted(out, key=str)


def got(spark, rows, every=10):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in hard.mine(df, F.col("id") % every == 0).collect()), key=str)


@pytest.mark.parametrize("spread", [0.3, 0.02])
def test_equals_all_pairs(spark, spread):
    rng = np.random.default_rng(3)
    middle = rng.normal(0, 0.2, (4, 6))
    rows = [(i, (middle[i % 4] + rng.normal(0, spread, 6)).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    assert got(spark, rows) == plain(rows)


def test_small_blocks_and_chunks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.2, 5).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    want = plain(rows, every=3)
    monkeypatch.setattr(hard, "BLOCK", 16)
    monkeypatch.setattr(hard, "CHUNK", 32)
    assert got(spark, rows, every=3) == want


def test_missing_and_odd_values_ties_repeated_ids_and_unlike_lengths(spark):
    v = [0.5, 0.25]
    rows = [(0, v, 1), (1, v, 1), (1, v, 1), (2, v, 2), (2, v, 2), (None, v, 2), (None, v, 1), (10, [0.5], 2), (20, v, None), (3, None, 1), (4, [None, 1.0], 2), (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 2), (7, [], 2), (0, [0.5, 0.25, 0.125], 1)]
    assert got(spark, rows) == plain(rows)


def test_a_third_of_all_rows_in_one_vector(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [0.3, 0.1, 0.2] if i % 3 == 0 else rng.normal(0, 0.2, 3).tolist(), i % 5 if i % 3 else i % 2) for i in range(600)]
    assert got(spark, rows) == plain(rows)


def test_empty_tables_and_scores_beyond_exact_floats(spark):
    assert got(spark, []) == [] and got(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == [] and got(spark, [(0, [1.0], 1), (2, [1.0], 1)]) == []
    rows = [(i, [5e5 + i / 256, 2e5 - 3 * i / 256, 1.5], i % 2) for i in range(40)]
    assert got(spark, rows) == plain(rows)


def test_tree_spans_and_bounds_hold():
    rng = np.random.default_rng(1)
    points = np.floor(rng.normal(0, 40, (50, 8)))
    parent, edge, depth = hard.plant(points)
    assert (parent < 0).sum() == 1 and all(depth[i] == depth[p] + 1 for i, p in enumerate(parent) if p >= 0)
    assert np.allclose([np.linalg.norm(points[i] - points[p]) for i, p in enumerate(parent) if p >= 0], edge[parent >= 0])
    rows = np.floor(rng.normal(0, 40, (30, 8)))
    truth = points @ rows.T

    def wanted(at, low, high):
        assert (low <= truth[at]).all() and (truth[at] <= high).all()
        return rng.random(low.shape) < 0.3

    seen = 0
    for at, need, scores in hard.Scorer(points, rows).walk(parent, edge, depth, wanted):
        assert (scores[need] == truth[at][need]).all()
        seen += len(at)
    assert seen == len(points)


def test_near_anchors_leave_most_pairs_unscored():
    rng = np.random.default_rng(2)
    frame = lambda v, labels, first: pd.DataFrame({"vec": list(v), "label": labels, "row": np.arange(first, first + len(v)), "id": np.arange(first, first + len(v))})
    anchors = frame(rng.normal(0, 0.02, (40, 8)) + 0.3, [0] * 40, 0)
    anchors["parent"], anchors["edge"], anchors["depth"] = hard.plant(hard.quantised(anchors["vec"], 256))
    rows = frame(rng.normal(0, 0.3, (4000, 8)), rng.integers(0, 2, 4000), 100)
    best, scored = hard.find_positives(rows, anchors, 5, 256)
    assert len(best.key) == 200 and scored < 0.5 * 40 * 4000
