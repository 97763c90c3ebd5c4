"""Hard negatives against a plain search over all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlens.llm import cover_negatives as cn

SCHEMA = "vec_id long, label int, embedding array<double>"


def by_force(rows, is_anchor, positives=5, negatives=10):
    """Sorted result rows; ``rows``: (id, label, vector) that all take part."""
    d = len(rows[0][2])
    limit = math.isqrt(2**58 // d)
    rows = [(i, lab, [max(-limit, min(limit, math.floor(256 * x))) for x in v]) for i, lab, v in rows]
    out = []
    for a, label, v in {(i, lab, tuple(v)) for i, lab, v in rows if is_anchor(i)}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in rows if i != a)
        for p, pid, _ in [r for r in scored if r[2] == label][:positives]:
            held = [r for r in scored if r[2] != label and 30 * -p <= 100 * -r[0] <= 90 * -p][:negatives]
            out += [(a, pid, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(held)]
    return sorted(out)


def mined(spark, rows, is_anchor, schema=SCHEMA, **more):
    out = cn.hard_negatives(spark.createDataFrame(rows, schema).repartition(3), is_anchor, **more)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("tree_rows", [4096, 40])
def test_mined_rows_equal_brute_force(spark, tree_rows):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(6, 4))
    rows = [(int(i), int(rng.integers(3)), (middles[i % 6] + 0.3 * rng.normal(size=4)).tolist()) for i in range(700)]
    assert mined(spark, rows, F.col("vec_id") % 20 == 0, tree_rows=tree_rows) == by_force(rows, lambda i: i % 20 == 0)


def test_copies_ties_and_shared_ids(spark):
    far = [(1000 + i, 1, [1.0 + i % 3, 0.5]) for i in range(60)]  # many equal scores
    copies = [(i, 0, [2.0, 1.0]) for i in range(0, 300, 3)]  # one vector, many ids
    repeated = [(500, 0, [3.0, 0.0])] * 30 + [(501, 1, [1.5, 0.5])] * 30
    shared = [(0, 1, [1.0, 0.2]), (0, 0, [2.5, 0.0]), (0, 2, [1.2, 0.2]), (3, 2, [1.2, 0.2])]  # an anchor's id on other rows
    rows = far + copies + repeated + shared
    want = by_force(rows, lambda i: i % 100 == 0)
    assert mined(spark, rows, F.col("vec_id") % 100 == 0) == want
    assert mined(spark, rows, F.col("vec_id") % 100 == 0, tree_rows=16) == want


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 2, [float(x) for x in rng.integers(1, 2**20, 3)]) for i in range(60)] + [(60, 0, [1e300, 1.0, 0.0]), (61, 1, [-1e300, 1e9, 5.0])]
    assert mined(spark, rows, F.col("vec_id") % 20 == 0) == by_force(rows, lambda i: i % 20 == 0)


def test_awkward_rows(spark):
    schema = "vec_id long, label int, embedding array<double>, bucket string, entry int, score double, anchor int"
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.0]), (1, 1, [2.0, 0.0]), (2, 2, [1.0, 0.0]), (3, 2, [0.9, 5.0]), (4, 2, [0.0, 0.0]), (100, 1, [0.0, 0.0]), (200, 5, [1.0, 1.0]), (300, 1, [-1.0, 0.0])]
    bad = [(None, 1, [1.0, 0.0]), (5, None, [1.0, 0.0]), (6, 2, None), (7, 2, []), (8, 2, [nan, 1.0]), (9, 2, [inf, 1.0]), (10, 2, [None, 1.0]), (11, 2, [1.0])]
    wide = [(*r, "b", 1, 0.5, 3) for r in good + bad]
    want = by_force(good, lambda i: i % 100 == 0)
    assert mined(spark, wide, F.col("vec_id") % 100 == 0, schema) == want and want
    assert mined(spark, [], F.col("vec_id") % 100 == 0, schema) == []
    assert mined(spark, wide[len(good) :][:7], F.col("vec_id") % 100 == 0, schema) == []
    assert mined(spark, wide[:3], F.col("vec_id") % 100 == 99, schema) == []


def tree_of(x, labels):
    order, nodes = cn.build_tree(x, labels)
    row = {k: v.tobytes() for k, v in nodes.items()} | {"type": "<i8", "vectors": x[order].astype("<i8").tobytes()}
    ids = np.arange(len(x))[order].astype("<i8")
    return order, nodes, row | {"labels": labels[order].astype("<i8").tobytes(), "entries": ids.tobytes(), "firsts": ids.tobytes(), "seconds": np.full(len(x), cn.NONE).astype("<i8").tobytes()}


def test_tree_covers_every_row_once_and_bounds_hold():
    rng = np.random.default_rng(7)
    x = rng.integers(-300, 300, (900, 3))
    order, nodes, _ = tree_of(x, rng.integers(0, 4, 900))
    assert sorted(order) == list(range(900)) and nodes["point_to"][-1] == 900 and len(nodes["radii"]) > 20
    z = cn.lifted(x, float((x * x).sum(axis=1).max()))[order]
    below = {i: set(range(nodes["point_from"][i], nodes["point_to"][i])) for i in range(len(nodes["radii"]))}
    for i in reversed(range(len(below))):
        for child in range(nodes["child_from"][i], nodes["child_to"][i]):
            below[i] |= below[child]
            assert nodes["radii"][child] <= nodes["radii"][i] / cn.BASE * (1 + 1e-6)  # level by level
        far = np.sqrt(((z[list(below[i])] - z[nodes["centres"][i]]) ** 2).sum(axis=1).max())
        assert math.isclose(far, nodes["radii"][i], rel_tol=1e-9, abs_tol=1e-9)
    assert below[0] == set(range(900))


def test_descent_leaves_out_nodes_beyond_its_windows():
    rng = np.random.default_rng(8)
    x = np.rint(2000 * rng.normal(size=(40, 3)))[rng.integers(0, 40, 4000)].astype(np.int64) + rng.integers(-20, 20, (4000, 3))
    labels = rng.integers(0, 2, 4000)
    *_, row = tree_of(x, labels)
    anchors = x[:1]
    scores = x @ x[0]
    order = np.lexsort((np.arange(4000), -scores))
    order = [i for i in order if i and labels[i] == labels[0]]
    best = cn.Best(np.array([0]), np.array([[cn.NONE + 1]]), np.array([[-cn.NONE]]), 5)
    verified = cn.descend(row, 3, anchors, labels[:1], True, best)
    assert best.entry[0, 0].tolist() == order[:5] and verified < 1500
    mid = int(np.median(scores))
    best = cn.Best(np.array([0]), np.array([[mid - 500]]), np.array([[mid]]), 10)
    verified = cn.descend(row, 3, anchors, labels[:1], False, best)
    held = [i for i in np.lexsort((np.arange(4000), -scores)) if labels[i] != labels[0] and mid - 500 <= scores[i] <= mid]
    assert [e for e, s in zip(best.entry[0, 0].tolist(), best.score[0, 0]) if s > cn.NONE] == held[:10] and verified < 2500
