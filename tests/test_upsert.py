import pytest
from pyspark.sql import functions as F

from mentidero.operators.joins import parent_join
from mentidero.operators.silver import dedupe_latest, orphans, with_reference_flag
from mentidero.operators.upsert import insert_ignore, one_per_key, replace_rows, split_rejects
from mentidero.sources.lake import write_batch, write_by_date
from mentidero.sources.store import KeyedTable

SCHEMA = "k STRING, v INT, w STRING"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replace_takes_nulls_too(spark):
    target, incoming = frame(spark, ("a", 1, "x"), ("b", 2, "y")), frame(spark, ("b", None, None), ("c", 3, "z"))
    once = replace_rows(target, incoming, "k")
    assert values(once) == [("a", 1, "x"), ("b", None, None), ("c", 3, "z")]
    assert values(replace_rows(once, incoming, "k")) == values(once)
    assert values(replace_rows(target, incoming.limit(0), "k")) == values(target)


def test_insert_ignore_keeps_the_present_row(spark):
    target, incoming = frame(spark, ("a", 1, "x")), frame(spark, ("a", 9, "q"), ("b", 2, "y"), ("b", 2, "y"), (None, 1, ""))
    assert values(insert_ignore(target, incoming, "k")) == [("a", 1, "x"), ("b", 2, "y")]


def test_rejects(spark):
    good, bad = split_rejects(frame(spark, ("a", 1, ""), (None, 2, "")), "k")
    assert good.count() == 1 and bad.count() == 1


def test_newest_batch_wins_then_time_then_row(spark):
    df = spark.createDataFrame(
        [("a", "b1", 9.0, 1), ("a", "b2", 1.0, 2), ("a", "b2", None, 3), ("c", "b1", 5.0, 4), ("c", "b1", 5.0, 5)],
        "k STRING, batch_ts STRING, created_utc DOUBLE, v INT",
    )
    got = {r["k"]: r["v"] for r in dedupe_latest(df, "k").collect()}
    assert got == {"a": 2, "c": 5}


def test_dedupe_combines_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    plan = one_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


@pytest.fixture
def store(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), frame(spark, ("a", 1, "")).schema, "k", buckets=4)


def test_store_before_the_first_write(store):
    assert store.read().count() == 0


def test_store_upserts(spark, store):
    store.upsert(frame(spark, *[(f"k{i}", i, "old") for i in range(50)], (None, 0, "lost")))
    store.upsert(frame(spark, ("k3", None, "new"), ("k99", 99, "new")))
    got = {r["k"]: (r["v"], r["w"]) for r in store.read().collect()}
    assert len(got) == 51 and got["k3"] == (None, "new") and got["k4"] == (4, "old") and got["k99"] == (99, "new")


def test_store_empty_batch_is_no_version(spark, store):
    store.upsert(frame(spark, ("a", 1, "")))
    before = store.parts()
    store.upsert(frame(spark, ("a", 1, "")).limit(0))
    store.insert_ignore(frame(spark, (None, 5, "")))
    assert store.parts() == before and values(store.read()) == [("a", 1, "")]


def files_of(df):
    return sorted(df.inputFiles())


def test_store_upsert_writes_the_batch_only(spark, store):
    store.upsert(frame(spark, *[(f"k{i}", i, "") for i in range(50)]))
    before = files_of(store.read())
    store.upsert(frame(spark, ("k1", -1, "")))
    added = set(files_of(store.read())) - set(before)
    assert set(before) < set(files_of(store.read())) and len(added) == 1
    assert spark.read.parquet(*added).count() == 1


def test_store_insert_only_appends(spark, store):
    store.insert_ignore(frame(spark, *[(f"k{i}", i, "") for i in range(50)]))
    store.insert_ignore(frame(spark, ("k1", -1, "other"), ("new", 1, "")))
    assert len(store.parts()) == 2 and store.read().count() == 51
    assert values(store.read().where("k = 'k1'")) == [("k1", 1, "")]


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_store_reads_and_compacts_without_a_shuffle(spark, store):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        store.upsert(frame(spark, *[(f"k{i}", i, "") for i in range(500)]), order=["v"])
        for n in range(3):
            store.upsert(frame(spark, *[(f"k{i}", i + n % 2, f"batch {n}") for i in range(0, 500, n + 2)]), order=["v"])
        whole = values(store.read())
        plan = plan_of(store.read())
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        store.compact()
        assert len(store.parts()) == 1 and values(store.read()) == whole
        assert "Join" not in plan_of(store.read()) and len(files_of(store.read())) == 4  # a file per bucket
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_store_kinds_of_batches_mix(spark, store):
    """Which row stays is settled in the order of the batches."""
    store.upsert(frame(spark, ("a", 5, "first"), ("b", 1, "first")))
    store.insert_ignore(frame(spark, ("a", 9, "ignored"), ("c", 1, "new")))
    store.upsert(frame(spark, ("a", 7, "newer"), ("b", 0, "older")), order=["v"])
    store.upsert(frame(spark, ("a", 7, "newest"), ("b", None, "null is oldest")), order=["v"])
    assert values(store.read()) == [("a", 7, "newest"), ("b", 1, "first"), ("c", 1, "new")]
    store.upsert(frame(spark, ("b", None, "")))
    assert values(store.read()) == [("a", 7, "newest"), ("b", None, ""), ("c", 1, "new")]


def test_unpublished_part_is_invisible(spark, store):
    """What a run leaves behind when it dies between writing and publishing."""
    store.upsert(frame(spark, ("a", 1, "")))
    store._write(frame(spark, ("a", 7, "half")), "replace")
    assert values(store.read()) == [("a", 1, "")]
    store.upsert(frame(spark, ("a", 2, "")))
    assert values(store.read()) == [("a", 2, "")]


def test_catalog_shows_the_newest_version_and_old_readers_go_on(spark, tmp_path):
    schema = frame(spark, ("a", 1, "")).schema
    spark.sql("CREATE DATABASE IF NOT EXISTS store_test")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, "k", 4, "store_test.t")
    table.publish_view()
    assert spark.table("store_test.t").count() == 0
    table.upsert(frame(spark, ("a", 1, ""), ("b", 2, "")))
    old = spark.table("store_test.t")
    table.upsert(frame(spark, ("a", 3, "")))
    table.compact()
    assert values(spark.table("store_test.t")) == [("a", 3, ""), ("b", 2, "")] and values(old) == [("a", 1, ""), ("b", 2, "")]
    again = KeyedTable(spark.newSession(), str(tmp_path / "t"), schema, "k")  # another session, buckets from the list
    assert values(again.read()) == [("a", 3, ""), ("b", 2, "")] and again.buckets == 4
    spark.sql("DROP DATABASE store_test CASCADE")


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_parent_join_equals_plain_join(spark, threshold):
    left = spark.range(3000).select(
        F.col("id").alias("pk"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
    )
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), (None, 4)], "k STRING, r INT")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for how in ("left", "inner", "left_anti", "left_semi"):
            got = parent_join(left, right, "k", how)
            plain = left.join(right, "k", how)
            cols = sorted(plain.columns)
            assert values(got.select(*cols)) == values(plain.select(*cols))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_key_reaches_many_tasks(spark):
    left = spark.range(20000).select(F.col("id").alias("pk"), F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot",)], "k STRING")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = with_reference_flag(left, right, "k", "pk", "found")
        tasks = joined.groupBy(F.spark_partition_id()).count().count()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert tasks >= 4


def test_orphans_ignore_null_parents(spark):
    facts = spark.createDataFrame([("1", "a"), ("2", None), ("3", "z")], "id STRING, p STRING")
    assert values(orphans(facts, facts.select("p").where("p = 'a'"), "p", "id")) == [("3", "z")]


def test_an_older_row_never_replaces_a_newer_one(spark, store):
    store.upsert(frame(spark, ("a", 100, "new"), ("b", 1, "")), order=["v"])
    store.upsert(frame(spark, ("a", 50, "old"), ("b", 2, "newer"), ("c", 3, "")), order=["v"])
    assert values(store.read()) == [("a", 100, "new"), ("b", 2, "newer"), ("c", 3, "")]


def test_a_smaller_batch_replaces_the_whole_slice(spark, tmp_path):
    df = spark.createDataFrame([("b1", "x", 0.0), ("b1", "y", 86400.0 * 3), ("b2", "z", 0.0)], "batch_ts STRING, k STRING, created_utc DOUBLE")
    root = str(tmp_path / "dated")
    write_by_date(df, root, "created_utc")
    write_by_date(df.where("k = 'x'"), root, "created_utc")
    assert sorted(r.k for r in spark.read.parquet(root).collect()) == ["x", "z"]


def test_an_empty_run_of_a_batch_leaves_no_rows(spark, tmp_path):
    df = spark.createDataFrame([("b1", "x", 0.0), ("b2", "z", 0.0)], "batch_ts STRING, k STRING, created_utc DOUBLE")
    for write, root in ((lambda d, r, b=(): write_by_date(d, r, "created_utc", b), "dated"), (write_batch, "plain")):
        path = str(tmp_path / root)
        write(df, path)
        write(df.limit(0), path, ["b1"])
        assert [r.k for r in spark.read.schema("k STRING, batch_ts STRING").parquet(path).collect()] == ["z"]


def test_rows_that_are_unique_already_move_once(spark, tmp_path):
    from mentidero.sources.store import KeyedTable

    rows = spark.range(50).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    plain, unique = (KeyedTable(spark, f"{tmp_path}/{n}", rows.schema, "k", buckets=2) for n in ("plain", "unique"))
    assert "Exchange" not in unique._prepare(rows, ["v"], True)._jdf.queryExecution().executedPlan().toString()
    for part in (rows, rows.where("v < 40").withColumn("v", F.col("v") + 1)):
        plain.upsert(part, order=["v"])
        unique.upsert(part, order=["v"], unique=True)
    assert sorted(map(tuple, unique.read().collect())) == sorted(map(tuple, plain.read().collect()))
