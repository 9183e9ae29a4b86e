"""Clustering over Walsh-Hadamard coefficients against plain Python and SQL."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentidero.llm import hadamard
from mentidero.llm.oracles import ORACLES
from mentidero.llm.queries import op13_hadamard_clusters
from oracle_check import compare, connect

DDL = "vec_id long, embedding array<double>"


def brute(rows, k=40, rounds=5):
    """Sorted (vec_id, cluster, distance, cluster_inertia, inertia, digest) by whole numbers only."""
    kept = [(i, e) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    kept = [(i, [math.floor(256 * Fraction(x)) for x in e]) for i, e in kept]
    coefficients = lambda v: hadamard.transform(np.array([v], dtype=object))[0].tolist()
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), coefficients(r[1])))
    centroids = [list(v) for _, v in order[:k]]

    def placed():
        out = []
        for _, v in kept:
            away = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((away.index(min(away)), min(away)))
        return out

    for _ in range(rounds):
        at = placed()
        for c in range(len(centroids)):
            own = [v for (_, v), (found, _) in zip(kept, at) if found == c]
            if own:
                centroids[c] = [sum(column) // len(own) for column in zip(*own)]
    at = placed()
    fits = lambda n: n if n < 1 << 63 else None
    sums = {}
    for c, d in at:
        sums[c] = sums.get(c, 0) + d
    known = all(d < 1 << 63 for _, d in at)
    of = {c: fits(s) if all(d < 1 << 63 for f, d in at if f == c) else None for c, s in sums.items()}
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
    out = [(i, c, fits(d), of[c], fits(sum(sums.values())) if known else None, digest(c)) for (i, _), (c, d) in zip(kept, at)]
    return sorted(out, key=repr)


def clusters(spark, rows, **more):
    df = spark.createDataFrame(rows, DDL).withColumns({"CLUSTER": F.lit(1), "distance": F.lit("x"), "coefficients": F.lit(2)})
    return sorted((tuple(r) for r in hadamard.cluster_vectors(df, **more).collect()), key=repr)


def test_transform_is_exact_and_coarse_to_fine():
    x = np.random.default_rng(3).integers(-(1 << 20), 1 << 20, (50, 64))
    t = hadamard.transform(x)
    assert (hadamard.inverse(t) == x).all() and ((t**2).sum(1) == 64 * (x**2).sum(1)).all()
    waves = hadamard.transform(np.eye(64, dtype=int)).T
    assert [(w[1:] != w[:-1]).sum() for w in waves] == list(range(64))


@pytest.mark.parametrize("dtype", [np.int64, object])
def test_search_keeps_ties(dtype):
    draw = np.random.default_rng(4)
    x, c = draw.integers(-400, 400, (200, 64)), draw.integers(-400, 400, (40, 64))
    c[[9, 30]] = c[3]
    x[:40] = c
    away = ((x[:, None] - c[None]) ** 2).sum(2)
    number, distance = hadamard.nearest(hadamard.transform(x).astype(dtype), hadamard.transform(c).astype(dtype))
    assert (number == away.argmin(1)).all() and (distance == away.min(1)).all()


def test_clusters_equal_brute_force_with_odd_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(i, (draw.normal(0, 2, 64) + i % 9).tolist()) for i in range(130)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (3, rows[3][1]), (None, [0.5] * 64), (None, [-0.001] * 64)]
    rows += [(300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65), (304, [None] + [1.0] * 63), (305, [math.nan] + [1.0] * 63)]
    rows += [(306, [math.inf] + [1.0] * 63), (307, [-math.inf] * 64)]
    assert clusters(spark, rows) == brute(rows)


def test_hot_vector_and_few_vectors(spark):
    rows = [(i, [1.25] * 64) for i in range(60)] + [(100, [2.0] * 64)]
    assert clusters(spark, rows) == brute(rows)
    assert clusters(spark, rows[:3]) == brute(rows[:3])
    assert clusters(spark, []) == [] and clusters(spark, [(1, None)]) == []


def test_huge_components_are_exact(spark):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.normal(0, 10.0 ** (i % 60), 64)).tolist()) for i in range(70)] + [(90, [1e300] * 64), (91, [-1.7e308] * 64), (92, [4095.999] * 64)]
    assert clusters(spark, rows, k=8) == brute(rows, k=8)


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(connect(sf_dir), op13_hadamard_clusters(spark, sf_dir), ORACLES["op13_hadamard_clusters"]) is None
