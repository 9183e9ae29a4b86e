import numpy as np
import pytest
from pyspark.sql import functions as F

from mentidero.operators import profile
from mentidero.operators.once import compute_once
from mentidero.operators.wrangle import Tails, drop_tombstones, label, winsorize, wrangle_features
from mentidero.plans.profiling import inspect_split, profile_comments

COMMENTS = "comment_id STRING, body STRING, author STRING, created_utc DOUBLE, score BIGINT, is_submitter BOOLEAN"


def comments(spark):
    bodies = ["Hello there!", "why?", "[deleted]", "[removed]", None, "ok", "...", "plain text", "again? yes!"]
    rows = [(f"c{i}", bodies[i % 9], None if i % 7 == 0 else f"u{i % 3}", float(i), i - 20, i % 2 == 0) for i in range(180)]
    return spark.createDataFrame(rows, COMMENTS)


def test_all_profile_tables(spark):
    out = profile_comments(comments(spark))
    nulls = {r["column"]: r["nulls"] for r in out["null_profile"].collect()}
    assert nulls["body"] == 20 and nulls["author"] == 26 and nulls["score"] == 0
    rates = {r["feature"]: r["proportion"] for r in out["tombstone_rates"].collect()}
    assert np.isclose(rates["deleted_rate"], 20 / 180) and np.isclose(rates["removed_rate"], 20 / 180)
    assert tuple(out["retention"].first()) == (180, 120, 120 / 180)
    marks = {r["feature"]: r["proportion"] for r in out["mark_rates"].collect()}
    assert np.isclose(marks["has_exclamation"], 40 / 120)
    assert out["duplicates"].count() == 0
    assert out["negative_example"].first()["score"] == -20
    assert out["positive_example"].count() == 0  # fewer than 111 positives
    for name, table in out.items():
        assert table.columns and table.count() >= 0, name


def test_split_inspection(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0, 3, 0), ("b", 2.0, 2.0, 4, 1), ("c", 3.0, 9.0, 5, 1)],
        "comment_id STRING, score_clipped DOUBLE, text_len_clipped DOUBLE, word_count INT, sentiment INT",
    )
    out = inspect_split(df)
    shares = {r["sentiment"]: r["share"] for r in out["class_distribution"].collect()}
    assert np.isclose(shares[1], 2 / 3) and [r["comment_id"] for r in out["head"].collect()] == ["a", "b", "c"]


def test_histogram_closes_the_last_bin_and_survives_one_value(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)] + [(None,)], "x DOUBLE")
    assert [(r["bin"], r["n"]) for r in profile.histogram(df, "x", 5).orderBy("bin").collect()] == [(0, 2), (1, 1), (4, 1)]
    one = spark.createDataFrame([(3.0,), (3.0,)], "x DOUBLE")
    assert [(r["bin"], r["n"]) for r in profile.histogram(one, "x", 5).collect()] == [(0, 2)]


def test_describe_categorical_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b", True), ("a", None), ("b", True), ("a", False), (None, None)], "s STRING, f BOOLEAN")
    got = {r["column"]: tuple(r)[1:] for r in profile.describe_categorical(df, ["s", "f"]).collect()}
    assert got == {"s": (4, 2, "a", 2), "f": (3, 2, "true", 2)}


def test_describe_categorical_counts_long_values_by_digest(spark):
    long = ["x" * 100, "x" * 100, "y" * 65, "short"]
    df = spark.createDataFrame([(t, None) for t in long], "t STRING, empty STRING")
    got = {r["column"]: tuple(r)[1:] for r in profile.describe_categorical(df, ["t", "empty"]).collect()}
    assert got == {"t": (4, 3, "x" * 100, 2), "empty": (0, 0, None, None)}


def test_tombstones_and_null_bodies(spark):
    df = comments(spark)
    assert drop_tombstones(df).count() == 140 and drop_tombstones(df).where("body = 'None'").count() == 20
    assert drop_tombstones(df, null_text=None).count() == 120
    assert wrangle_features(df).where("text_len <= 2").count() == 0 and wrangle_features(df).count() == 120
    assert wrangle_features(df, null_text=None).count() == 100


def test_winsorize_and_label_with_missing_scores(spark):
    df = spark.createDataFrame([(-9, 5), (3, 50), (99, 500), (None, 5)], "score BIGINT, text_len INT")
    out = label(winsorize(df, Tails(-1.0, 10.5, 100.0)), 3.0).collect()
    assert [(r["score_clipped"], r["text_len_clipped"], r["sentiment"]) for r in out] == [
        (-1.0, 5.0, 0), (3.0, 50.0, 1), (10.5, 100.0, 1), (None, 5.0, 0),
    ]


def test_costly_column_is_evaluated_once(spark):
    df = spark.createDataFrame([("a",), (None,), ("ccc",)], "t STRING")
    out = compute_once(df, "u", F.md5("t")).where(F.length("u") > 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1 and out.count() == 2
    replaced = compute_once(df, "t", F.upper("t"))
    assert replaced.columns == ["t"] and replaced.count() == 3


def test_correlation_is_symmetric(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a DOUBLE, b DOUBLE")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.corr_matrix(df, ["a", "b"]).collect()}
    expected = np.corrcoef(a, b)[0, 1]
    assert np.isclose(got["a", "b"], expected) and np.isclose(got["b", "a"], expected) and np.isclose(got["a", "a"], 1)


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 7.0), (float("nan"), 1.0), (None, 5.0)], "x DOUBLE, y DOUBLE")
    row = profile.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["mean"], row["max"], row["p50"]) == (3, 2.0, 3.0, 2.0)
    assert profile.box_stats(df, "x").first()["n"] == 3 and profile.box_stats(df, "x").first()["outliers"] == 0
    assert sum(r["n"] for r in profile.histogram(df, "x", 2).collect()) == 3
    corr = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.corr_matrix(df, ["x", "y"]).collect()}
    assert corr["x", "y"] == pytest.approx(0.9933992677987828)
