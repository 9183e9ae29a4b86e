"""Exact quantiles of columns and groups against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentidero.operators import quantiles
from mentidero.operators.profile import box_stats_by, quartile_bucket
from mentidero.operators.quantiles import exact_quantiles, exact_quantiles_by

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def samples():
    rng = np.random.default_rng(7)
    return {
        "uniform": rng.uniform(-1e6, 1e6, 20_000),
        "heavy_ties": np.repeat([1.0, 2.0, 2.0, 3.0, 7.5], 4_000),
        "one_value": np.full(5_000, 42.0),
        "hot_middle": np.concatenate([rng.normal(size=8_000), np.zeros(8_000)]),
        "long_tail": np.floor(rng.pareto(0.5, 20_000)),
        "powers": np.concatenate([2.0 ** np.arange(-1070, 1020), -(3.0 ** np.arange(-600, 600))]),
        "neighbours": 1.0 + np.arange(3_000) * np.finfo(float).eps,
        "largest": np.array([-1.7e308, -1.6e308, -1.0, 0.0, 5e-324, 1e-323, 1.0, 1.7e308] * 50),
        "few": np.array([3.0, 1.0]),
    }


def test_columns_match_numpy(spark):
    """All columns in shared scans, of different lengths, with nulls and NaN."""
    data = samples()
    long = [(k, float(v)) for k, vs in data.items() for v in vs] + [(k, math.nan) for k in data]
    df = spark.createDataFrame(long, "k STRING, x DOUBLE").repartition(6)
    wide = df.select(*[F.when(F.col("k") == k, F.col("x")).alias(k) for k in data])
    got = exact_quantiles(wide, {k: PROBS for k in data})
    for k, vs in data.items():
        with np.errstate(over="ignore"):
            expected = np.quantile(vs, PROBS)
        if k == "largest":
            at = [round(p * (len(vs) - 1), 9) for p in PROBS]
            expected = [sorted(vs)[int(a)] if a == int(a) or sorted(vs)[int(a)] == sorted(vs)[int(a) + 1] else None for a in at]
            assert all(e is None or e == g for e, g in zip(expected, got[k]))
        else:
            assert np.allclose(got[k], expected, rtol=1e-12, atol=0 if k == "neighbours" else 1e-300), k


def test_columns_with_different_ranks(spark):
    data = samples()
    a, b = data["uniform"], data["long_tail"]
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a DOUBLE, b DOUBLE")
    got = exact_quantiles(df, {"a": (0.5,), "b": (0.25, 0.9)})
    assert np.allclose(got["a"], np.quantile(a, 0.5)) and np.allclose(got["b"], np.quantile(b, (0.25, 0.9)))


def test_no_values(spark):
    assert exact_quantiles(spark.createDataFrame([], "x DOUBLE"), {"x": (0.5,)}) == {"x": [None]}
    assert exact_quantiles_by(spark.createDataFrame([("a", None)], "g STRING, x DOUBLE"), "g", "x", (0.5,)).count() == 0


def test_infinite_values_are_values(spark):
    df = spark.createDataFrame([(v,) for v in [-math.inf, 1.0, 2.0, math.inf, math.inf]], "x DOUBLE")
    assert exact_quantiles(df, {"x": (0.0, 0.25, 0.5, 0.75, 1.0)})["x"] == [-math.inf, 1.0, 2.0, math.inf, math.inf]


def test_every_rank_with_few_cells(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "CELLS", 3)
    data = np.random.default_rng(1).integers(0, 50, 401).astype(float)
    df = spark.createDataFrame([(float(v),) for v in data], "x DOUBLE")
    probs = [r / 400 for r in range(0, 401, 40)]
    assert exact_quantiles(df, {"x": probs})["x"] == np.quantile(data, probs).tolist()


@pytest.mark.parametrize("cells", [16, 1024])
def test_groups_with_one_hot_group(spark, monkeypatch, cells):
    monkeypatch.setattr(quantiles, "CELLS", cells)
    rng = np.random.default_rng(3)
    rows = [("hot", float(v)) for v in rng.normal(size=6_000)] + [(None, float(v)) for v in rng.normal(size=500)]
    rows += [(f"g{i % 200}", float(v)) for i, v in enumerate(rng.normal(size=6_000))] + [("one", 1.5), ("none", None)]
    df = spark.createDataFrame(rows, "g STRING, x DOUBLE")
    got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles_by(df, "g", "x", (0.25, 0.5)).collect()}
    assert len(got) == 203
    for g, (n, q) in got.items():
        mine = [x for name, x in rows if name == g]
        assert n == len(mine) and np.allclose(q, np.quantile(mine, (0.25, 0.5)), rtol=1e-12)


def test_ten_thousand_groups_in_few_rounds(spark, monkeypatch):
    df = spark.range(400_000).select((F.col("id") % 10_000).alias("g"), F.rand(5).alias("x"))
    rounds, plain = [], quantiles._narrow
    monkeypatch.setattr(quantiles, "_narrow", lambda *a, **k: rounds.append(1) or plain(*a, **k))
    got = exact_quantiles_by(df, "g", "x", (0.25, 0.5, 0.75))
    expected = df.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("e"))
    joined = got.join(expected, "g")
    worst = F.max(F.aggregate(F.zip_with("q", "e", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: F.greatest(a, b)))
    assert joined.count() == 10_000 and joined.agg(worst).first()[0] < 1e-12 and len(rounds) <= 6


def test_box_by_group(spark):
    rng = np.random.default_rng(4)
    data = [(bool(i % 3), float(v)) for i, v in enumerate(rng.pareto(1.0, 3_000))]
    df = spark.createDataFrame(data + [(None, 1.0), (True, None), (True, math.nan)], "g BOOLEAN, x DOUBLE")
    for r in box_stats_by(df, "g", "x").collect():
        mine = np.array([x for g, x in data if g == r["g"]])
        q1, q2, q3 = np.quantile(mine, (0.25, 0.5, 0.75))
        inside = mine[(mine >= q1 - 1.5 * (q3 - q1)) & (mine <= q3 + 1.5 * (q3 - q1))]
        expected = [len(mine), mine.min(), q1, q2, q3, mine.max(), inside.min(), inside.max(), len(mine) - len(inside)]
        assert np.allclose([*r[1:]], expected)


def test_quartile_bucket_keeps_ties_together(spark):
    df = spark.createDataFrame([(v,) for v in [1, 1, 1, 2, 3, 4, 5, 6, None]], "x BIGINT")
    rows = quartile_bucket(df, "x").collect()
    assert {r["x"]: r["bucket"] for r in rows} == {1: "Q1", 2: "Q2", 3: "Q3", 4: "Q3", 5: "Q4", 6: "Q4", None: None}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_values_stay_where_they_are(spark):
    """Intervals and quartiles of few keys are copied to the values, whatever Spark takes their size for."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = spark.range(1000).select((F.col("id") % 3).cast("int").alias("key"), F.col("id").cast("double").alias("x"))
        rows = [(k, 0.0, 999.0, 0, [100]) for k in range(3)]
        state = spark.createDataFrame(rows, "key int, lo double, hi double, below bigint, ranks array<bigint>")
        assert "BroadcastHashJoin" in plan_of(quantiles._narrow(values, state, False, 3))
        boxes = box_stats_by(values, "key", "x")
        assert "BroadcastHashJoin" in plan_of(boxes) and "SortMergeJoin" not in plan_of(boxes)
        assert sorted((r["key"], r["n"], r["median"]) for r in boxes.collect()) == [(0, 334, 499.5), (1, 333, 499.0), (2, 333, 500.0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
