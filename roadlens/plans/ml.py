"""K-means keys.

Spark ML's results depend on partitioning even with a fixed seed, so its keys are
rows-only and pytest checks invariants. The ``fixed_cluster`` keys have one
answer, which a recursive DuckDB query gives as well.
"""

from __future__ import annotations

from roadlens.operators import clusters as ck
from roadlens.operators import fixed_clusters as fx
from roadlens.plans import violations as pv
from roadlens.plans.oracle import with_views
from roadlens.session import cut_lineage

# Fixed values that must equal the reference's behaviour: five clusters, seed 42.
K = 5
SEED = 42


STEPS = 20


def _model(s, d):
    return ck.fit_clusters(pv.located(s, d), k=K, seed=SEED)


def _counts(s, d):
    points = cut_lineage(ck.weighted_points(pv.located(s, d)))  # made once, for the fit and the sizes
    return ck.weighted_cluster_counts(ck.fit_weighted(points, K, SEED), points)


def _fixed(s, d):
    points = fx.unit_points(pv.located(s, d))
    return fx.fit(points, K, SEED, max_iter=STEPS), points


def _fixed_counts(s, d):
    return fx.counts(*_fixed(s, d))


SPARK = {
    "cluster_counts": _counts,
    "cluster_centers": lambda s, d: ck.cluster_centers(s, _model(s, d)),
    "cluster_rows": lambda s, d: ck.cluster_rows(_model(s, d), pv.located(s, d)).select(
        "Violation_ID", "Latitude", "Longitude", "cluster"
    ),
    # the same K-means over the driver's embeddings table (array<float> vectors)
    "embedding_cluster_counts": lambda s, d: ck.array_cluster_counts(
        s.read.parquet(f"{d.rstrip('/')}/embeddings.parquet"), "embedding", k=K, seed=SEED
    ),
    "fixed_cluster_centers": lambda s, d: fx.centers_table(s, _fixed(s, d)[0]),
    "fixed_cluster_counts": _fixed_counts,
    "fixed_cluster_rows": lambda s, d: fx.rows(_fixed(s, d)[0], pv.located(s, d)).select(
        "Violation_ID", "Latitude", "Longitude", "cluster"
    ),
}

_UNITS = {c: f"floor(({c} + {float(fx.OFFSET)}) * {float(fx.SCALE)} + 0.5)::BIGINT" for c in fx.DEFAULT_COLS}
POINTS = f"""
SELECT {_UNITS['Latitude']} AS y, {_UNITS['Longitude']} AS x, count(*) AS weight
FROM loc WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL GROUP BY ALL
"""
# One row a Lloyd step: its centres, in order of their numbers.
LLOYD = f"""
SELECT 0 AS step, (SELECT list({{'y': y, 'x': x}} ORDER BY h, y, x) FROM (
  SELECT *, md5(concat_ws(':', '{SEED}', y, x)) AS h FROM points ORDER BY h, y, x LIMIT {K})) AS centers
UNION ALL
SELECT step + 1, list(CASE WHEN n IS NULL THEN old ELSE {{'y': (sy // n)::BIGINT, 'x': (sx // n)::BIGINT}} END ORDER BY i)
FROM (
  SELECT c.step, c.i, any_value(c.old) AS old, sum(p.weight) AS n, sum(p.weight::HUGEINT * p.y) AS sy, sum(p.weight::HUGEINT * p.x) AS sx
  FROM (SELECT step, unnest(range(1, len(centers) + 1)) AS i, unnest(centers) AS old FROM lloyd WHERE step < {STEPS}) c
  LEFT JOIN (
    SELECT y, x, weight, list_sort(list_transform(centers, lambda c, j: {{'far': (y - c.y) * (y - c.y) + (x - c.x) * (x - c.x), 'j': j}}))[1].j AS j
    FROM points, lloyd) p ON p.j = c.i
  GROUP BY c.step, c.i)
GROUP BY step
"""
FINAL = f"SELECT centers FROM lloyd WHERE step = {STEPS}"
NEAREST = "list_sort(list_transform(centers, lambda c, j: {'far': (y - c.y) * (y - c.y) + (x - c.x) * (x - c.x), 'j': j}))[1].j::INTEGER - 1"


def _lloyd(body: str) -> str:
    text = with_views(body, **pv._base(points=POINTS, lloyd=LLOYD, final=FINAL))
    return text.replace("points AS (", "points AS MATERIALIZED (", 1).replace("WITH ", "WITH RECURSIVE ", 1)


SQL: dict[str, str] = {
    "fixed_cluster_centers": _lloyd(
        f"SELECT (j - 1)::INTEGER AS cluster, round(c.y / {fx.SCALE} - {fx.OFFSET}, 6) AS center_Latitude, "
        f"round(c.x / {fx.SCALE} - {fx.OFFSET}, 6) AS center_Longitude "
        "FROM (SELECT unnest(range(1, len(centers) + 1)) AS j, unnest(centers) AS c FROM final)"
    ),
    "fixed_cluster_counts": _lloyd(
        f"SELECT {NEAREST} AS cluster, sum(weight)::BIGINT AS violation_count FROM points, final GROUP BY 1"
    ),
    "fixed_cluster_rows": _lloyd(
        f"SELECT Violation_ID, Latitude, Longitude, {NEAREST} AS cluster "
        f"FROM (SELECT *, {_UNITS['Latitude']} AS y, {_UNITS['Longitude']} AS x FROM loc "
        "WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL), final"
    ),
}
