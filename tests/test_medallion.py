import pytest
from fixtures import write_lines, write_tree
from pyspark.sql import functions as F

from mentidero.operators import silver
from mentidero.operators.bronze import rejected_lines, to_bronze
from mentidero.operators.discover import discover_popular, discover_ranked, sample_limit, top_per_group, within
from mentidero.plans.medallion import build_bronze, discover, first_posts, read_bronze, run_medallion
from mentidero.schemas import BRONZE, RAW, STORE, bronze_schema, raw_schema, store_schema
from mentidero.sources import lake, ndjson
from mentidero.sources.store import ensure_tables, list_tables, store_table


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    return write_tree(str(tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def run(spark, tree, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, run_medallion(spark, tree, out, "v1")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_column_counts(spark):
    assert [len(raw_schema(e).fields) for e in RAW] == [19, 9, 5, 4, 4]
    assert [len(BRONZE[e]) for e in BRONZE] == [16, 9, 5, 4, 4]
    assert [len(store_schema(t).fields) for t in STORE] == [5, 1, 16, 9]


def test_bronze_keeps_drifting_and_broken_rows(spark, tree, run):
    out, _ = run
    posts = read_bronze(spark, f"{out}/bronze", "posts")
    # 3 + 3 + one broken line (all null) + 2
    assert posts.count() == 9 and posts.where("post_id IS NULL").count() == 1
    assert rows(posts.where("post_id = 'p2'"), "score", "batch_ts") == [(12, "20250101_0000")]
    assert rows(posts.where("post_id = 'p7'"), "locked", "YYYY", "MM", "DD") == [(None, 2025, 1, 4)]
    assert rows(posts.where("post_id = 'p6'"), "YYYY", "created_utc") == [(None, None)]
    raw = ndjson.read_raw_batches(spark, f"{tree}/posts", "posts").cache()
    assert [r[0] for r in rejected_lines(raw).collect()] == ["{broken"]


def test_bronze_run_again_changes_nothing(spark, tree, run):
    out, _ = run
    before = read_bronze(spark, f"{out}/bronze", "posts").count()
    build_bronze(spark, tree, f"{out}/bronze", batch_ts="20250101_0000")
    assert read_bronze(spark, f"{out}/bronze", "posts").count() == before


def test_missing_entity_is_an_empty_typed_table(spark, run):
    out, _ = run
    usersubs = read_bronze(spark, f"{out}/bronze", "usersubs")
    assert usersubs.count() == 0 and usersubs.columns[:4] == bronze_schema("usersubs").fieldNames()


def test_missing_columns_become_typed_nulls(spark):
    df = to_bronze(spark.createDataFrame([("a",)], "comment_id STRING"), "comments")
    assert df.schema.simpleString() == bronze_schema("comments").simpleString()
    assert df.first()["score"] is None


def test_silver(spark, run):
    _, paths = run
    dim = spark.read.parquet(paths["dim_subreddit"])
    assert rows(dim, "subreddit", "subscribers", "description") == [("ART", 11, None), ("MAPS", 0, "m")]
    posts = spark.read.parquet(paths["fact_posts"])
    assert rows(posts.where("post_id IS NOT NULL"), "post_id", "subreddit", "score", "has_dim") == sorted([
        ("p1", "ART", 100, True), ("p2", "ART", 12, True), ("p3", "ART", 3, True), ("p4", "MAPS", 4, True),
        ("p5", "MAPS", 5, True), ("p6", "LOST", 6, False), ("p7", "ART", 7, True),
    ], key=repr)
    comments = spark.read.parquet(paths["fact_comments"])
    assert comments.count() == 40
    assert rows(comments.where("NOT has_post"), "comment_id") == [("c41",), ("c7",)]
    assert rows(comments.where("comment_id = 'c1'"), "body", "score") == [("First, edited", 50)]
    assert rows(comments.where("comment_id = 'c7'"), "is_submitter") == [(True,)]
    authors = {r[0] for r in rows(spark.read.parquet(paths["dim_author"]), "author_name")}
    assert authors == {f"user{i}" for i in range(5)}
    orphan = silver.orphans(comments, posts, "post_id", "comment_id")
    assert rows(orphan, "comment_id") == [("c7",)]


def test_store_has_no_null_keys_and_survives_a_second_run(spark, tree, run):
    out, _ = run
    store = f"{out}/silver/store"
    counts = {t: store_table(spark, store, t).read().count() for t in STORE}
    assert counts == {"subreddits": 2, "authors": 5, "posts": 7, "comments": 40}
    first = {t: rows(store_table(spark, store, t).read(), "*") for t in STORE}
    run_medallion(spark, tree, out, "v2")
    assert {t: rows(store_table(spark, store, t).read(), "*") for t in STORE} == first


def test_empty_start(spark, tmp_path):
    paths = run_medallion(spark, str(tmp_path / "nothing"), str(tmp_path / "out"), "v1")
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == dict.fromkeys(paths, 0)


def test_posts_only(spark, tmp_path):
    """A first run without comments works."""
    write_lines(f"{tmp_path}/raw/posts/part-20250101_0000-a.ndjson", ['{"id": "x", "subreddit": "a"}'])
    paths = run_medallion(spark, f"{tmp_path}/raw", f"{tmp_path}/out", "v1")
    assert spark.read.parquet(paths["fact_posts"]).count() == 1
    assert spark.read.parquet(paths["fact_comments"]).count() == 0


def test_first_post_of_each_file_is_by_line_not_by_score(spark, tree):
    got = {r["file"].rsplit("/", 1)[1]: r["post_id"] for r in first_posts(spark, tree).collect()}
    assert got == {
        "part-20250101_0000-art.ndjson": "p3", "part-20250101_0000-maps.ndjson": "p4", "part-20250102_0000-art.ndjson": "p1",
    }


def test_write_raw_replaces_its_batch_only(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], None)], "n INT, l ARRAY<STRING>, s STRING")
    for batch in ("b1", "b2", "b1"):
        ndjson.write_raw(df, str(tmp_path), batch)
    back = spark.read.schema("n INT, l STRING, s STRING, batch_ts STRING").json(str(tmp_path))
    assert rows(back, "*") == [(1, '["a"]', None, "b1"), (1, '["a"]', None, "b2")]


def test_union_widens_numbers_and_texts(spark):
    a = spark.createDataFrame([(1, 1.5)], "k INT, v DOUBLE")
    b = spark.createDataFrame([("x", 2)], "k STRING, v INT")
    c = spark.createDataFrame([(3,)], "v INT")
    assert rows(lake.union_batches(a, b, c), "k", "v") == [("1", 1.5), ("x", 2.0), (None, 3.0)]


def test_split_read_prunes_folders(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "val")], "id STRING, split STRING")
    lake.write_splits(df, str(tmp_path))
    val = lake.read_split(spark, str(tmp_path), "val")
    assert rows(val, "id") == [("b",)]
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()


def test_catalog_tables_are_idempotent(spark, tmp_path):
    for _ in range(2):
        ensure_tables(spark, "forum_test", str(tmp_path / "db"))
    assert [r[0] for r in list_tables(spark, "forum_test").collect()] == sorted(STORE)
    assert spark.table("forum_test.posts").columns == store_schema("posts").fieldNames()
    spark.sql("DROP DATABASE forum_test CASCADE")


# --- discovery ---


def listing(spark):
    data = [("a", 1, False, 10.0), ("b", 2, None, 20.0), ("a", 3, True, 30.0), ("c", 4, False, 40.0), ("b", 5, False, 50.0)]
    return spark.createDataFrame(data, "subreddit STRING, pos INT, over_18 BOOLEAN, created_utc DOUBLE")


def test_ranked_ties_go_to_the_first_seen(spark):
    out = discover_ranked(listing(spark), 2, F.col("pos"), include_nsfw=True)
    assert [r["subreddit"] for r in out.collect()] == ["a", "b"]
    safe = discover_ranked(listing(spark), 3, F.col("pos"))
    assert [(r["subreddit"], r["n_posts"]) for r in safe.collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_popular_finds_safe_entries_anywhere(spark):
    rows_ = [(i, f"s{i}", i < 49) for i in range(100)]
    df = spark.createDataFrame(rows_, "position INT, subreddit STRING, over18 BOOLEAN")
    assert [r["position"] for r in discover_popular(df, 2, "position").collect()] == [49, 50]
    assert [r["position"] for r in discover_popular(df, 2, "position", include_nsfw=True).collect()] == [0, 1]


def test_sample_rule():
    assert sample_limit(10) == 200 and sample_limit(100) == 500


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        discover(listing(spark), 1, "best", F.col("pos"), 10, F.lit(None).cast("timestamp_ntz"))


@pytest.mark.parametrize("k", [3, 1500])
def test_top_per_group_small_and_large_k(spark, k):
    df = spark.range(8000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise("b").alias("g"), "id")
    out = top_per_group(df, "g", [F.desc("id")], k)
    for g in ("hot", "b"):
        got = [r["id"] for r in out.where(F.col("g") == g).orderBy("place").collect()]
        assert got == sorted((i for i in range(8000) if ("hot" if i % 3 < 2 else "b") == g), reverse=True)[:k]


def test_time_filter(spark):
    df = spark.sql("SELECT timestamp_ntz'2025-01-08 00:00:00' - make_dt_interval(id, 0, 0, 0) AS ts FROM range(10)")
    now = F.expr("timestamp_ntz'2025-01-08 00:00:00'")
    assert [within(df, "ts", f, now).count() for f in ("hour", "day", "week", "month", "all")] == [1, 2, 8, 10, 10]
