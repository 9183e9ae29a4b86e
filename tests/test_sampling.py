import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentidero.operators.sampling import allocate, boundaries, sample_exact, split_sizes, stratified_split


def labelled(spark, counts):
    rows = [(f"{label}-{i}", label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "id STRING, y INT")


def sizes(df):
    return {(r["split"], r["y"]): r["n"] for r in df.groupBy("split", "y").agg(F.count("*").alias("n")).collect()}


@given(st.dictionaries(st.integers(0, 8), st.integers(1, 500), min_size=1))
@settings(max_examples=200)
def test_split_sizes_add_up(counts):
    out = split_sizes(counts)
    n = sum(counts.values())
    assert all(sum(out[k]) == counts[k] and min(out[k]) >= 0 for k in counts)
    held = math.ceil(0.3 * n)
    test = math.ceil(0.5 * held)
    assert [sum(v[i] for v in out.values()) for i in range(3)] == [n - held, held - test, test]


@given(st.dictionaries(st.integers(0, 8), st.integers(1, 500), min_size=1), st.floats(0, 1))
@settings(max_examples=200)
def test_allocation_is_proportional(counts, part):
    total = int(sum(counts.values()) * part)
    out = allocate(counts, total)
    assert sum(out.values()) == total
    assert all(abs(out[k] - counts[k] * total / sum(counts.values())) < 1 for k in counts)


def test_known_totals(spark):
    split = stratified_split(labelled(spark, {1: 64, 0: 48}), "id", "y")
    totals = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert totals == {"train": 78, "val": 17, "test": 17}


def test_split_equals_sorting_by_hash(spark):
    """The boundary method marks the same rows as a full sort would, also with very few hash bits."""
    df = labelled(spark, {0: 301, 1: 99, 2: 1})
    split = {r["id"]: r["split"] for r in stratified_split(df, "id", "y").collect()}
    import hashlib

    for label, n in {0: 301, 1: 99, 2: 1}.items():
        _, val, test = split_sizes({0: 301, 1: 99, 2: 1})[label]
        order = sorted((hashlib.md5(f"42|{label}-{i}".encode()).hexdigest()[:15], f"{label}-{i}") for i in range(n))
        expected = ["test"] * test + ["val"] * val + ["train"] * (n - test - val)
        assert [split[i] for _, i in order] == expected


@pytest.mark.parametrize("bits,ranked", [(2, 1), (12, 4096), (60, 1)])
def test_rounds_end_at_the_same_cut(spark, bits, ranked):
    import hashlib

    df = labelled(spark, {0: 500})
    order = sorted((hashlib.md5(f"42|0-{i}".encode()).hexdigest()[:15], f"0-{i}") for i in range(500))
    got = boundaries(df, "id", 42, {None: [123, 0, 500, 1]}, bits=bits, ranked=ranked).collect()
    assert {r["cut"]: (r["rank"], r["row_id"]) for r in got} == {c: (int(order[k - 1][0], 16), order[k - 1][1]) for c, k in ((0, 123), (2, 500), (3, 1))}


def test_five_thousand_strata_split_exactly(spark):
    df = spark.range(60_000).select(F.col("id").alias("row"), (F.col("id") * F.col("id") % 5_003).alias("y"))
    counts = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    got = sizes(stratified_split(df, "row", "y"))
    for y, (train, val, test) in split_sizes(dict(sorted(counts.items(), key=lambda kv: str(kv[0])))).items():
        assert [got.get((name, y), 0) for name in ("train", "val", "test")] == [train, val, test]


@pytest.mark.parametrize("fraction,size", [(0.0, 0), (0.37, 148), (0.999, 399), (1.0, 400), (2.0, 400)])
def test_sample_is_exact(spark, fraction, size):
    out = sample_exact(labelled(spark, {0: 150, 1: 250}), "id", fraction)
    assert out.count() == size and out.distinct().count() == size


def test_seed_changes_members_not_size(spark):
    df = labelled(spark, {0: 400})
    one, two, again = (sample_exact(df, "id", 0.5, s) for s in (1, 2, 1))
    assert one.count() == two.count() == 200
    assert one.exceptAll(again).count() == 0 and one.exceptAll(two).count() > 0


def test_null_stratum_is_its_own(spark):
    df = labelled(spark, {0: 20}).withColumn("y", F.when(F.col("id") < "0-15", F.col("y")))
    out = sizes(stratified_split(df, "id", "y"))
    assert sum(out.values()) == 20 and {y for _, y in out} == {0, None}


def test_marking_shuffles_no_row(spark):
    plan = stratified_split(labelled(spark, {0: 50, 1: 50}), "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
