"""BRONZE to SILVER: deduplicated facts and dimensions, and reference checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.functions.keys import normalize_key
from mentidero.operators.joins import parent_join
from mentidero.operators.upsert import one_per_key
from mentidero.schemas import REFERENCES, bronze_schema, store_schema

ORDER = ["batch_ts", "created_utc"]


def dedupe_latest(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key: the newest batch, then the newest creation time, then the largest row."""
    wanted = order or [c for c in ORDER if c in df.columns]
    return one_per_key(df, [key], wanted)


def recast(df: DataFrame, entity: str) -> DataFrame:
    """Bring bronze columns to their types again; values that do not fit become null."""
    return df.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in bronze_schema(entity).fields})


def normalize_posts(bronze: DataFrame) -> DataFrame:
    typed = recast(bronze, "posts").withColumn("subreddit", normalize_key(F.col("subreddit")))
    return dedupe_latest(typed, "post_id")


def normalize_comments(bronze: DataFrame) -> DataFrame:
    return dedupe_latest(recast(bronze, "comments"), "comment_id")


def dim_subreddit(bronze: DataFrame) -> DataFrame:
    typed = recast(bronze, "subreddits").withColumns(
        {
            "subreddit": normalize_key(F.col("subreddit")),
            "subscribers": F.coalesce(F.col("subscribers").try_cast("bigint"), F.lit(0).cast("bigint")),
        }
    )
    return dedupe_latest(typed, "subreddit")


def dim_author(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """All names seen on either side. Each side drops its own repeats before the union shuffles."""
    names = posts.select(F.col("author").alias("author_name")).unionByName(
        comments.select(F.col("author").alias("author_name"))
    )
    return names.dropna().distinct()


def with_reference_flag(facts: DataFrame, parents: DataFrame, key: str, row_key: str, flag: str) -> DataFrame:
    """Left join on a unique parent key: every fact row and column stays, plus a found flag."""
    marks = parents.select(key).distinct().withColumn(flag, F.lit(True))
    joined = parent_join(facts, marks, key, "left")
    return joined.select(*facts.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def fact_posts(posts: DataFrame, dim: DataFrame) -> DataFrame:
    return with_reference_flag(posts, dim, "subreddit", "post_id", "has_dim")


def fact_comments(comments: DataFrame, posts: DataFrame) -> DataFrame:
    return with_reference_flag(comments, posts, "post_id", "comment_id", "has_post")


def orphans(facts: DataFrame, parents: DataFrame, key: str, row_key: str) -> DataFrame:
    """Fact rows whose declared parent is missing; a row without a parent key is no orphan."""
    named = facts.where(F.col(key).isNotNull())
    return parent_join(named, parents.select(key).distinct(), key, "left_anti").select(*facts.columns)


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan count per declared reference; `tables` are store tables by name."""
    reports = []
    for child, (key, parent) in REFERENCES.items():
        row_key = store_schema(child).fieldNames()[0]
        found = orphans(tables[child], tables[parent], key, row_key).agg(F.count("*").alias("orphans"))
        reports.append(found.select(F.lit(child).alias("child"), F.lit(key).alias("reference"), "orphans"))
    return reports[0].unionByName(reports[1])


def first_per_group(df: DataFrame, group: str, position: str) -> DataFrame:
    """The row that comes first in scan order within each group."""
    rest = [c for c in df.columns if c not in (group, position)]
    first = df.groupBy(group).agg(F.min(F.struct(position, *rest)).alias("first"))
    return first.select(group, *[F.col("first")[c].alias(c) for c in rest])
