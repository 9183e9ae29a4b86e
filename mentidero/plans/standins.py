"""The driver tables seen as raw batches, posts, comments and communities.

Every stand-in covers its whole table. Dirty values (padding, words for flags, tombstones, nulls) are
derived from the row's own columns, the same way in Spark here and in `oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentidero.functions.clock import ts_to_epoch
from mentidero.operators.bronze import to_bronze

BATCH = "20240131_0000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw posts, every field as text, some columns missing."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("t3_"), F.col("event_id").cast("string")).alias("name"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit("\t")).alias("subreddit"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"),
        F.concat_ws(" ", "event_type", F.lit("by"), F.col("user_id").cast("string")).alias("title"),
        F.col("props").alias("selftext"),
        F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")).alias("score"),
        F.col("user_id").cast("string").alias("num_comments"),
        F.when(F.col("value") >= 200, "Yes").when(F.col("value") < 1, "maybe").otherwise("off").alias("over_18"),
        ts_to_epoch(F.col("ts")).cast("string").alias("created_utc"),
        F.when(F.col("event_type") == "click", "1").otherwise("F").alias("is_self"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(raw_posts(spark, sf_dir), "posts")


def raw_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw comments with removed, missing and link-bearing bodies."""
    d = table(spark, sf_dir, "documents")
    lang, source = F.col("lang"), F.col("source")
    link = F.concat(F.lit(" see http://www."), source, F.lit(".example.com/a?b=1 ok? wow!"))
    body = (
        F.when(source == "src7", "[deleted]")
        .when((source == "src11") & (lang == "fr"), "[removed]")
        .when((source == "src13") & (lang == "de"), F.lit(None))
        .when(lang == "es", F.concat("text", link))
        .otherwise(F.col("text"))
    )
    return d.select(
        F.col("doc_id").cast("string").alias("comment_id"),
        F.col("n_chars").cast("string").alias("post_id"),
        F.when(~((source == "src5") & (lang == "de")), source).alias("author"),
        body.alias("body"),
        (F.col("doc_id") * 60 + 1704067200).cast("string").alias("created_utc"),
        F.concat(F.lit("t1_"), F.col("doc_id").cast("string")).alias("parent_id"),
        F.concat(F.lit("t3_"), F.col("n_chars").cast("string")).alias("link_id"),
        F.col("n_chars").cast("string").alias("score"),
        F.when(lang == "en", "on").when(lang == "fr", "No").alias("is_submitter"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(raw_comments(spark, sf_dir), "comments")


def raw_subreddits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as communities: padded lower-case names, some subscriber counts unusable."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("\t"), F.lower("s_name"), F.lit(" ")).alias("subreddit"),
        F.when(F.col("s_acctbal") < 0, "n/a").otherwise(F.col("s_acctbal").cast("string")).alias("subscribers"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("public_description"),
        F.col("s_suppkey").cast("string").alias("created_utc"),
        F.when(F.col("s_nationkey") < 5, "TRUE").otherwise("n").alias("over18"),
    )


def subreddits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(raw_subreddits(spark, sf_dir), "subreddits")


def supplier_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts whose community is a supplier name; some users have no supplier."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.concat(F.lit("SUPPLIER#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("subreddit"),
        "value",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as labelled predictions of three models on two splits."""
    li = table(spark, sf_dir, "lineitem")
    key = (
        F.when(F.col("l_returnflag") == "A", "bert_bert-base-multilingual-uncased-sentiment")
        .when(F.col("l_returnflag") == "N", "mlp_transformer")
        .otherwise("bert_distilbert-base-uncased-finetuned-sst-2-english")
    )
    return li.select(
        key.alias("model_key"),
        F.when(F.col("l_linestatus") == "O", "val").otherwise("test").alias("split"),
        (F.col("l_quantity") > 25).cast("int").alias("label"),
        (F.col("l_extendedprice") > 40000).cast("int").alias("prediction"),
    )


def logits(spark: SparkSession, sf_dir: str, width: int, second: int = 2) -> DataFrame:
    """Vector components as class logits: every width-th is summed into one of `width` (and of `second`) classes."""
    e = table(spark, sf_dir, "embeddings")
    summed = lambda w: F.expr(
        f"transform(sequence(0, {w - 1}), k -> aggregate(sequence(k, size(embedding) - 1, {w}), 0D, (s, i) -> s + CAST(embedding[i] AS DOUBLE)))"
    )
    return e.select("vec_id", summed(width).alias("z"), summed(second).alias("z2"), "label")
