"""K-means with one answer, against plain Python."""

from __future__ import annotations

import hashlib
import math
import random

from roadlens.operators import fixed_clusters as fx

SCHEMA = "Latitude double, Longitude double"


def units(v):
    return math.floor((v + 1000.0) * 1e6 + 0.5)


def model_centers(rows, k, seed, steps):
    points = {}
    for r in rows:
        if None not in r:
            p = tuple(units(v) for v in r)
            points[p] = points.get(p, 0) + 1
    centers = sorted(points, key=lambda p: (hashlib.md5(f"{seed}:{p[0]}:{p[1]}".encode()).hexdigest(), p))[:k]
    for _ in range(steps):
        groups = {}
        for p, n in points.items():
            groups.setdefault(nearest(p, centers), []).append((p, n))
        centers = [
            tuple(sum(p[d] * n for p, n in groups[i]) // sum(n for _, n in groups[i]) for d in (0, 1)) if i in groups else c
            for i, c in enumerate(centers)
        ]
    return centers, points


def nearest(p, centers):
    return min(range(len(centers)), key=lambda i: (sum((a - b) ** 2 for a, b in zip(p, centers[i])), i))


def test_one_answer_whatever_the_layout(spark):
    rng = random.Random(4)
    rows = [(round(rng.gauss(m, 9), 4), round(rng.gauss(-m, 9), 4)) for m in (0, 30, -40, 60) for _ in range(60)]
    rows += rows[:50] * 3 + [(None, 1.0), (2.0, None)]
    centers, points = model_centers(rows, 5, 42, 20)
    for parts in (1, 3, 8):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        held = fx.unit_points(df)
        model = fx.fit(held, 5, 42)
        assert list(model.centers) == centers
        sizes = {r.cluster: r.violation_count for r in fx.counts(model, held).collect()}
        want = {}
        for p, n in points.items():
            want[nearest(p, centers)] = want.get(nearest(p, centers), 0) + n
        assert sizes == want
        assert all(r.cluster == nearest((units(r.Latitude), units(r.Longitude)), centers) for r in fx.rows(model, df).collect())


def test_ties_go_to_the_lower_number_and_empty_clusters_stay(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 2.0), (0.0, 1.0)], SCHEMA)
    model = fx.FixedClusters(fx.DEFAULT_COLS, ((units(0), units(0)), (units(0), units(2)), (units(50), units(50))))
    assert {r.Longitude: r.cluster for r in fx.rows(model, df).collect()} == {0.0: 0, 1.0: 0, 2.0: 1}
    got = fx.fit(fx.unit_points(df), k=3, seed=1, max_iter=3)
    assert sorted(got.centers) == sorted((units(0), units(x)) for x in (0, 1, 2))


def test_few_or_no_points(spark):
    few = spark.createDataFrame([(1.0, 1.0)] * 4 + [(2.0, 2.0)], SCHEMA)
    model = fx.fit(fx.unit_points(few), k=5)
    assert len(model.centers) == 2 and fx.centers_table(spark, model).count() == 2
    none = spark.createDataFrame([(None, 1.0)], SCHEMA)
    model = fx.fit(fx.unit_points(none), k=5)
    assert model.centers == () and fx.counts(model, fx.unit_points(none)).collect() == [] and fx.rows(model, none).collect() == []
