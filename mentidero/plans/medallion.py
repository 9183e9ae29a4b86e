"""RAW to BRONZE to SILVER, and discovery of communities over stored posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentidero.functions.clock import epoch_to_ts
from mentidero.functions.keys import normalize_key
from mentidero.operators import silver
from mentidero.operators.bronze import to_bronze
from mentidero.operators.discover import discover_popular, discover_ranked, hot_list, top_posts_of, within
from mentidero.schemas import BRONZE, CREATED_COLUMN, bronze_schema, raw_text_schema
from mentidero.session import scratch_dir
from mentidero.sources.lake import materialize, read_batches, write_batch, write_by_date, write_version
from mentidero.sources.ndjson import read_raw_batches, with_scan_order, write_raw
from mentidero.sources.store import KeyedTable, ensure_tables, store_table


def build_bronze(spark: SparkSession, raw_root: str, bronze_root: str, batch_ts: str | None = None) -> list[str]:
    """Type and lay out landed NDJSON, all batches or one. Running a batch again replaces it."""
    for entity in BRONZE:
        raw = read_raw_batches(spark, f"{raw_root}/{entity}", entity)
        if batch_ts is not None:
            raw = raw.where(F.col("batch_ts") == batch_ts)
        typed = to_bronze(raw, entity, keep=("batch_ts",))
        write_bronze(typed, entity, f"{bronze_root}/{entity}", () if batch_ts is None else (batch_ts,))
    return list(BRONZE)


def write_bronze(typed: DataFrame, entity: str, root: str, batches: Sequence[str] = ()) -> None:
    if entity in CREATED_COLUMN:
        write_by_date(typed, root, CREATED_COLUMN[entity], batches)
    else:
        write_batch(typed, root, batches)


def read_bronze(spark: SparkSession, bronze_root: str, entity: str) -> DataFrame:
    return read_batches(spark, f"{bronze_root}/{entity}", bronze_schema(entity), entity in CREATED_COLUMN)


def build_silver(spark: SparkSession, bronze_root: str, silver_root: str, version: str,
                 buckets: int = 64, database: str | None = None) -> dict[str, str]:
    """All bronze batches to two dimensions and two facts, each in a new version folder, then into the
    keyed store. A table that others need is written first and read back, so it is computed once.
    `buckets` is the store's; a bucket should hold a few GB. `database` is where the store's tables show in the catalog."""
    paths: dict[str, str] = {}

    def put(df: DataFrame, name: str) -> DataFrame:
        paths[name] = write_version(df, silver_root, name, version)
        return spark.read.schema(df.schema).parquet(paths[name])

    dim = put(_entity(silver.dim_subreddit(read_bronze(spark, bronze_root, "subreddits")), "subreddits"), "dim_subreddit")
    posts = _entity(silver.normalize_posts(read_bronze(spark, bronze_root, "posts")), "posts")
    posts = put(silver.fact_posts(posts, dim), "fact_posts")
    comments = _entity(silver.normalize_comments(read_bronze(spark, bronze_root, "comments")), "comments")
    comments = put(silver.fact_comments(comments, posts), "fact_comments")
    authors = put(silver.dim_author(posts, comments), "dim_author")

    store = f"{silver_root}/store"
    def keyed(table: str) -> KeyedTable:
        return store_table(spark, store, table, buckets, database)

    if database:
        ensure_tables(spark, database, store)
    # The silver tables have one row per key.
    keyed("subreddits").upsert(dim, unique=True)
    keyed("authors").insert_ignore(authors)
    keyed("posts").upsert(posts, unique=True)
    keyed("comments").upsert(comments, unique=True)
    return paths


def _entity(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*bronze_schema(entity).fieldNames())


def run_medallion(spark: SparkSession, raw_root: str, out_root: str, batch_ts: str,
                  buckets: int = 64, database: str | None = None) -> dict[str, str]:
    """Landed NDJSON to silver. `batch_ts` names the silver version; all landed batches take part."""
    build_bronze(spark, raw_root, f"{out_root}/bronze")
    return build_silver(spark, f"{out_root}/bronze", f"{out_root}/silver", batch_ts, buckets, database)


def first_posts(spark: SparkSession, raw_root: str) -> DataFrame:
    """The first post of every landed file: the posts whose comments a collector fetches next."""
    raw = with_scan_order(read_raw_batches(spark, f"{raw_root}/posts", "posts"))
    rows = raw.select(F.col("scan_pos.file").alias("file"), F.col("id").alias("post_id"), "subreddit", "scan_pos")
    return silver.first_per_group(rows, "file", "scan_pos")


def discover(posts: DataFrame, n: int, strategy: str, position: Column, posts_limit: int | None, now: Column,
             include_nsfw: bool = False) -> DataFrame:
    """Rank communities over stored posts and return the evidence record, best first.

    all_hot looks at all posts, all_top_day at those of the last day; `posts_limit`, where given, keeps only
    the newest or the best of them. `popular` ranks a listing, not posts: see `discover_popular`.
    """
    if strategy not in ("all_hot", "all_top_day"):
        raise ValueError(f"{strategy!r} doesn't rank stored posts")
    if strategy == "all_top_day":
        dated = posts.withColumn("_dt", epoch_to_ts(F.col("created_utc")))
        pool, best_first = within(dated, "_dt", "day", now), "score"
    else:
        pool, best_first = posts, "created_utc"
    if posts_limit is not None:
        pool = pool.orderBy(F.desc(best_first), position).limit(posts_limit)
    ranked = discover_ranked(pool, n, position, include_nsfw)
    return hot_list(ranked.orderBy(F.desc("n_posts"), "first_pos"), strategy, posts_limit, include_nsfw)


def discover_medallion(
    spark: SparkSession, landed_root: str, out_root: str, batch_ts: str, n: int, strategy: str, now: Column, limit: int = 50,
    time_filter: str = "day", posts_limit: int | None = None, include_nsfw: bool = False, fetch_comments: bool = True,
    buckets: int = 64, database: str | None = None,
) -> dict[str, str]:
    """Discovery over what has landed, carried through to silver.

    The ranking becomes a RAW batch of its own, with the chosen communities' descriptions, their `limit` best posts
    within `time_filter` and the comments of each one's best post; that batch then goes to bronze and silver.
    `popular` takes the first `n` of the landed communities, in scan order.
    """
    landed = {e: read_raw_batches(spark, f"{landed_root}/{e}", e) for e in ("posts", "comments", "subreddits")}
    key = lambda c: normalize_key(F.col(c))
    posts = to_bronze(landed["posts"], "posts").withColumn("_dt", epoch_to_ts(F.col("created_utc")))
    position = F.col("post_id")
    if strategy == "popular":
        listing = to_bronze(with_scan_order(landed["subreddits"]), "subreddits", keep=("scan_pos",))
        names = hot_list(discover_popular(listing, n, "scan_pos", include_nsfw), strategy, posts_limit, include_nsfw)
    else:
        names = discover(posts.drop("_dt"), n, strategy, position, posts_limit, now, include_nsfw)
    names = materialize(names, scratch_dir(spark, "communities"))  # n rows
    chosen = names.select(key("subreddit").alias("subreddit"))
    keyed = posts.withColumn("subreddit", key("subreddit"))
    best = top_posts_of(keyed, chosen, limit, "_dt", time_filter, now, position).select("post_id", "place")
    best = materialize(best, scratch_dir(spark, "best-posts"))  # n times `limit` rows

    def put(entity: str, rows: DataFrame) -> None:
        write_raw(rows.select(*[c for c in raw_text_schema(entity).fieldNames() if c in rows.columns and c != "_corrupt_record"]), f"{out_root}/raw/{entity}", batch_ts)

    write_raw(names, f"{out_root}/raw/hot_sublists", batch_ts)
    named = landed["subreddits"].withColumn("_key", key("subreddit")).join(chosen.withColumnRenamed("subreddit", "_key"), "_key", "left_semi")
    put("subreddits", named)
    put("posts", landed["posts"].join(best.select(F.col("post_id").alias("id")), "id", "left_semi"))
    if fetch_comments:
        put("comments", landed["comments"].join(best.where("place = 1").select("post_id"), "post_id", "left_semi"))
    return run_medallion(spark, f"{out_root}/raw", out_root, batch_ts, buckets, database)
