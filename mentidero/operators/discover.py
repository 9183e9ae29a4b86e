"""Ranking and listing of communities and posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values ---
STRATEGIES = ("popular", "all_hot", "all_top_day")
TIME_FILTERS = {
    "hour": "INTERVAL 1 HOUR",
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 30 DAYS",
    "year": "INTERVAL 365 DAYS",
    "all": None,
}
# --- end of fixed values ---


def sample_limit(limit: int) -> int:
    """Posts to rank when discovering communities."""
    return max(200, limit * 5)


def safe_rows(df: DataFrame, flag: str, include_nsfw: bool) -> DataFrame:
    """Drop flagged rows unless asked for; a missing flag counts as safe."""
    return df if include_nsfw else df.where(~F.coalesce(F.col(flag), F.lit(False)))


def discover_ranked(posts: DataFrame, n: int, position: Column, include_nsfw: bool = False) -> DataFrame:
    """Top n communities by post count; the one seen first wins a tie."""
    counted = (
        safe_rows(posts, "over_18", include_nsfw)
        .groupBy("subreddit")
        .agg(F.count("*").alias("n_posts"), F.min(position).alias("first_pos"))
    )
    return counted.orderBy(F.desc("n_posts"), "first_pos").limit(n)


def discover_popular(listing: DataFrame, n: int, position: str, include_nsfw: bool = False) -> DataFrame:
    """First n safe entries of an ordered listing, wherever in it they stand."""
    return safe_rows(listing, "over18", include_nsfw).orderBy(position).limit(n)


def hot_list(names: DataFrame, strategy: str, posts_limit: int | None, include_nsfw: bool) -> DataFrame:
    """The evidence record of a discovery run."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    return names.select(
        "subreddit",
        F.lit(strategy).alias("strategy"),
        F.lit(posts_limit).cast("bigint").alias("posts_limit"),
        F.lit(include_nsfw).alias("include_nsfw"),
    )


def within(df: DataFrame, ts: str, time_filter: str, now: Column) -> DataFrame:
    """Rows created within the named span before `now`."""
    span = TIME_FILTERS[time_filter]
    return df if span is None else df.where(F.col(ts) >= now - F.expr(span))


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group. Each task keeps only its first k rows of a group before the shuffle (the
    session's window group limit, which `build_session` leaves open for any k)."""
    place = "_place"
    ranked = df.withColumn(place, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col(place) <= k).withColumnRenamed(place, "place")


def top_posts_of(posts: DataFrame, communities: DataFrame, k: int, ts: str, time_filter: str, now: Column, position: Column) -> DataFrame:
    """The k best posts of each of the named communities within a span, with their `place`."""
    names = communities.select("subreddit").distinct()
    wanted = within(posts, ts, time_filter, now).join(names, "subreddit", "left_semi")
    return top_per_group(wanted, "subreddit", [F.desc("score"), position], k)


def search_posts(posts: DataFrame, query: str, limit: int, texts: Sequence[str], order: Sequence[Column],
                 subreddit: str = "all") -> DataFrame:
    """Posts that contain every term of the query in one of the text columns."""
    found = posts if subreddit == "all" else posts.where(F.col("subreddit") == subreddit)
    body = F.lower(F.concat_ws(" ", *texts))
    for term in query.lower().split():
        found = found.where(F.contains(body, F.lit(term)))
    return found.orderBy(*order).limit(limit)


def user_recent(posts: DataFrame, username: str, limit: int = 50) -> DataFrame:
    """The newest posts of a user as (username, subreddit, last post, time)."""
    return (
        posts.where(F.col("author") == username)
        .orderBy(F.desc("created_utc"), "post_id")
        .limit(limit)
        .select(
            F.col("author").alias("username"),
            "subreddit",
            F.col("post_id").alias("last_post_id"),
            F.col("created_utc").alias("last_created_utc"),
        )
    )
