"""One callable per operator: (spark, folder of driver tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentidero.functions import casts, clock, keys, labels, text, vectors
from mentidero.operators import (
    discover,
    embed,
    evaluate,
    profile,
    sampling,
    scaler,
    scoring,
    silver,
    training,
    upsert,
    wrangle,
)
from mentidero.operators.bronze import to_bronze
from mentidero.plans import medallion, profiling
from mentidero.plans import standins as si
from mentidero.plans.medallion import discover as discover_job
from mentidero.plans.medallion import write_bronze
from mentidero.plans.train_compare import summary
from mentidero.plans.training_set import wrangle_training_set as training_set_job
from mentidero.schemas import bronze_schema, raw_schema
from mentidero.session import scratch_dir
from mentidero.sources import lake, ndjson, store
from mentidero.sources.store import KeyedTable
from mentidero.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}
DIGITS = 6


def query(fn: Query) -> Query:
    REGISTERED[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


# --- sources and sinks ---------------------------------------------------------------------------


@query
def scan_ndjson(spark: SparkSession, d: str) -> DataFrame:
    """Events landed as NDJSON posts, read back with the raw schema."""
    path = scratch_dir(spark, "scan-ndjson")
    landed = to_bronze(si.raw_posts(spark, d), "posts").withColumnRenamed("post_id", "id")
    ndjson.write_raw(landed, path, si.BATCH)
    raw = ndjson.read_raw_typed(spark, path, "posts")
    return raw.select("id", "subreddit", "author", "score", "over_18", "created_utc", "is_self", "batch_ts")


@query
def sink_ndjson_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """One batch per speaker role; a batch written twice is there once."""
    path = scratch_dir(spark, "sink-ndjson")
    turns = si.table(spark, d, "conversations")
    for role in ("user", "assistant", "system", "user"):
        ndjson.write_raw(turns.where(F.col("role") == role), path, f"20240101_{role}")
    return ndjson.read_ndjson(spark, path, turns.schema).select("conv_id", "turn", "role", "text", "batch_ts")


@query
def sanitize_values(spark: SparkSession, d: str) -> DataFrame:
    """Nested values become JSON text, scalars stay."""
    e = si.table(spark, d, "events")
    nested = e.select("event_id", F.struct("event_type", "user_id").alias("pair"), F.array("event_type").alias("list"))
    return ndjson.sanitize(nested)


@query
def partition_by_date(spark: SparkSession, d: str) -> DataFrame:
    """Posts written by batch and calendar day, read back with their folder columns."""
    path = scratch_dir(spark, "by-date")
    write_bronze(si.posts(spark, d).withColumn("batch_ts", F.lit(si.BATCH)), "posts", path)
    back = lake.read_batches(spark, path, bronze_schema("posts"), dated=True)
    return back.select("post_id", "score", "batch_ts", "YYYY", "MM", "DD")


@query
def scan_parquet_all(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as one batch per priority; all batches scanned as one table."""
    path = scratch_dir(spark, "scan-all")
    orders = si.table(spark, d, "orders")
    lake.write_batch(orders.withColumn("batch_ts", F.substring("o_orderpriority", 1, 1)), path)
    back = lake.read_batches(spark, path, orders.schema)
    return back.select("o_orderkey", "o_custkey", "o_totalprice", "batch_ts")


@query
def union_batches(spark: SparkSession, d: str) -> DataFrame:
    """Five batches with drifting types and a missing column, united."""
    e = si.table(spark, d, "events").select("event_id", "user_id", "event_type", "value", "props")
    kinds = ("click", "view", "signup", "error", "purchase")
    click, view, signup, error, purchase = (e.where(F.col("event_type") == k) for k in kinds)
    return lake.union_batches(
        click.drop("props"),
        view.withColumn("user_id", F.concat(F.lit("u"), F.col("user_id").cast("string"))),
        signup.withColumn("user_id", F.col("user_id").cast("int")),
        error,
        purchase,
    ).select("event_id", "user_id", "event_type", "value", "props")


@query
def read_split(spark: SparkSession, d: str) -> DataFrame:
    """Split table on disk; only the val folder is read."""
    path = scratch_dir(spark, "splits")
    lake.write_splits(sampling.stratified_split(si.table(spark, d, "labels"), "doc_id", "quality"), path)
    return lake.read_split(spark, path, "val").select("doc_id", "quality", "toxic", "split")


@query
def embedding_metadata(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "embeddings")
    e = si.table(spark, d, "embeddings")
    split = F.when(F.col("label") < 7, "train").when(F.col("label") < 9, "val").otherwise("test")
    rows = e.select(F.col("vec_id").cast("string").alias("id"), split.alias("split"), "embedding")
    created = F.expr("timestamp_ntz'2024-01-31 10:20:30'")
    embed.save_embeddings(rows, path, "org/encoder", created)
    stored = spark.read.parquet(f"{path}/vectors")
    meta = embed.embedding_metadata(stored, "org/encoder", created)
    return meta.select("model_name", "split", "n", "dim", "artifact")


# --- bronze --------------------------------------------------------------------------------------


@query
def bronze_posts(spark: SparkSession, d: str) -> DataFrame:
    return si.posts(spark, d)


@query
def bronze_comments(spark: SparkSession, d: str) -> DataFrame:
    return si.comments(spark, d)


@query
def bronze_subreddits(spark: SparkSession, d: str) -> DataFrame:
    return si.subreddits(spark, d)


@query
def bronze_usersubs(spark: SparkSession, d: str) -> DataFrame:
    e = si.table(spark, d, "events")
    raw = e.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("username"),
        F.col("event_type").alias("subreddit"),
        F.col("event_id").alias("last_post_id"),
        F.concat(F.col("user_id").cast("string"), F.lit(".5 ")).alias("last_created_utc"),
    )
    return to_bronze(raw, "usersubs")


@query
def bronze_hotlist(spark: SparkSession, d: str) -> DataFrame:
    raw = si.table(spark, d, "customer").select(
        F.col("c_name").alias("subreddit"),
        F.col("c_mktsegment").alias("strategy"),
        F.col("c_acctbal").alias("posts_limit"),
        F.col("c_nationkey").alias("include_nsfw"),
    )
    return to_bronze(raw, "hot_sublists")


# --- scalar functions ----------------------------------------------------------------------------


def _dirty(d: DataFrame) -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit("\t")))
        .when(kind == "view", F.col("value").cast("string"))
        .when(kind == "signup", F.concat(F.col("user_id").cast("string"), F.lit("d")))
        .when(kind == "error", F.concat(F.lit("-"), F.col("value").cast("string")))
        .otherwise(F.lit(""))
    )


@query
def cast_int_lenient(spark: SparkSession, d: str) -> DataFrame:
    e = si.table(spark, d, "events")
    return e.select("event_id", casts.lenient_int(_dirty(e)).alias("as_int"))


@query
def cast_float_lenient(spark: SparkSession, d: str) -> DataFrame:
    e = si.table(spark, d, "events")
    return e.select("event_id", casts.lenient_float(_dirty(e)).alias("as_float"))


@query
def cast_bool_lenient(spark: SparkSession, d: str) -> DataFrame:
    e = si.table(spark, d, "events")
    kind = F.col("event_type")
    word = (
        F.when(kind == "click", " ON ").when(kind == "view", "No").when(kind == "signup", "maybe")
        .when(kind == "error", "t").otherwise("0")
    )
    number = F.col("user_id") - 8
    return e.select(
        "event_id",
        casts.lenient_bool(word).alias("from_word"),
        casts.lenient(number, "boolean", e.schema["user_id"].dataType).alias("from_number"),
    )


@query
def normalize_key(spark: SparkSession, d: str) -> DataFrame:
    c = si.table(spark, d, "customer")
    padded = F.concat(F.lit("\t "), F.lower("c_name"), F.lit("\n"))
    return c.select("c_custkey", keys.normalize_key(padded).alias("key"))


@query
def slugify(spark: SparkSession, d: str) -> DataFrame:
    return si.table(spark, d, "pages").select("page_id", keys.slugify(F.col("url")).alias("slug"))


@query
def search_tag(spark: SparkSession, d: str) -> DataFrame:
    return si.table(spark, d, "part").select("p_partkey", keys.search_tag(F.col("p_name")).alias("tag"))


@query
def epoch_to_ts(spark: SparkSession, d: str) -> DataFrame:
    e = si.table(spark, d, "events")
    ts = clock.epoch_to_ts(clock.ts_to_epoch(F.col("ts")))
    return e.select(
        "event_id",
        clock.ts_to_micros(ts).alias("micros"),
        clock.batch_tag(ts).alias("batch_tag"),
        clock.artifact_stamp(ts).alias("stamp"),
    )


@query
def nfkc_normalize(spark: SparkSession, d: str) -> DataFrame:
    """A prefix of compatibility characters is folded; the prose itself is already normal."""
    prefix = F.lit("ﬁne Ａ１ …  ")
    docs = si.table(spark, d, "documents")
    return docs.select("doc_id", text.nfkc(F.concat(prefix, F.col("text"))).alias("normal"))


@query
def text_features(spark: SparkSession, d: str) -> DataFrame:
    c = si.comments(spark, d)
    return c.withColumns(text.text_features(F.col("body"))).select(
        "comment_id", "text_len", "word_count", "has_exclamation", "has_question"
    )


@query
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    return si.comments(spark, d).select("comment_id", text.clean_text(F.col("body")).alias("clean_text"))


@query
def to_json_record(spark: SparkSession, d: str) -> DataFrame:
    p = si.table(spark, d, "part")
    return p.select("p_partkey", F.to_json(F.struct("p_name", "p_size", "p_brand")).alias("record"))


@query
def artifact_names(spark: SparkSession, d: str) -> DataFrame:
    o = si.table(spark, d, "orders")
    stamp = clock.artifact_stamp(F.col("o_orderdate"))
    name = keys.artifact_name(F.concat(F.lit("org/"), F.col("o_orderpriority")), F.col("o_orderstatus"), stamp)
    return o.select("o_orderkey", name.alias("name"))


# --- cleaning and features -----------------------------------------------------------------------


@query
def drop_tombstones(spark: SparkSession, d: str) -> DataFrame:
    kept = wrangle.drop_tombstones(wrangle.flag_comments(si.comments(spark, d)))
    return kept.select("comment_id", "has_author", clock.ts_to_micros(F.col("created_dt")).alias("created_us"))


@query
def keep_null_bodies(spark: SparkSession, d: str) -> DataFrame:
    """A missing body is the text None."""
    kept = wrangle.wrangle_features(si.comments(spark, d))
    return kept.select("comment_id", "text_len", "word_count")


@query
def drop_null_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The variant in which a missing body goes."""
    kept = wrangle.wrangle_features(si.comments(spark, d), null_text=None)
    return kept.select("comment_id", "text_len", "word_count")


@query
def wrangle_features(spark: SparkSession, d: str) -> DataFrame:
    f = wrangle.wrangle_features(si.comments(spark, d))
    return f.select("comment_id", "text_len", "word_count", "has_exclamation", "has_question", "has_author")


@query
def wrangle_clean(spark: SparkSession, d: str) -> DataFrame:
    cleaned = wrangle.with_clean_text(wrangle.wrangle_features(si.comments(spark, d)))
    return cleaned.select("comment_id", F.md5("clean_text").alias("clean_md5"), F.length("clean_text").alias("clean_len"))


@query
def winsorize(spark: SparkSession, d: str) -> DataFrame:
    features = wrangle.wrangle_features(si.comments(spark, d)).select("comment_id", "score", "text_len")
    features = lake.materialize(features, scratch_dir(spark, "features"))
    out = wrangle.winsorize(features, wrangle.fit_tails(features))
    return rounded(out.select("comment_id", "score_clipped", "text_len_clipped"), "score_clipped", "text_len_clipped")


@query
def median_label(spark: SparkSession, d: str) -> DataFrame:
    o = si.table(spark, d, "orders")
    labelled = wrangle.label(o, wrangle.fit_median(o, "o_totalprice"), "o_totalprice")
    return labelled.select("o_orderkey", "sentiment")


@query
def wrangle_training_set(spark: SparkSession, d: str) -> DataFrame:
    """Comments to the labelled modelling set, all steps in one."""
    out = training_set_job(si.comments(spark, d), scratch_dir(spark, "training-set"))
    return rounded(out, "score_clipped", "text_len_clipped").withColumn(
        "created_dt", clock.ts_to_micros(F.col("created_dt"))
    )


# --- profiling -----------------------------------------------------------------------------------


@query
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.null_profile(si.comments(spark, d))


@query
def column_info(spark: SparkSession, d: str) -> DataFrame:
    return profile.column_info(si.table(spark, d, "lineitem"))


@query
def flag_rates(spark: SparkSession, d: str) -> DataFrame:
    body = F.col("body")
    flags = {
        "deleted_rate": body == text.TOMBSTONES[0],
        "removed_rate": body == text.TOMBSTONES[1],
        "has_author": F.col("author").isNotNull(),
        "has_exclamation": F.contains(body, F.lit("!")),
        "has_question": F.contains(body, F.lit("?")),
    }
    return rounded(profile.rates(si.comments(spark, d), flags), "proportion")


@query
def retention(spark: SparkSession, d: str) -> DataFrame:
    body = F.col("body")
    out = profile.retention(si.comments(spark, d), body.isNotNull() & ~text.is_tombstone(body))
    return rounded(out, "retained")


@query
def describe_numeric(spark: SparkSession, d: str) -> DataFrame:
    out = profile.describe_numeric(
        si.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]
    )
    return rounded(out, "mean", "std", "p25", "p50", "p75")


@query
def describe_categorical(spark: SparkSession, d: str) -> DataFrame:
    return profile.describe_categorical(si.comments(spark, d), ["author", "body", "is_submitter"])


@query
def class_distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.class_distribution(si.table(spark, d, "labels"), "quality"), "share")


@query
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return profile.duplicate_keys(si.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def uniqueness(spark: SparkSession, d: str) -> DataFrame:
    return profile.uniqueness(si.table(spark, d, "documents"), "doc_id")


@query
def quantiles(spark: SparkSession, d: str) -> DataFrame:
    o = si.table(spark, d, "orders")
    wanted = {"o_totalprice": (0.01, 0.25, 0.5, 0.75, 0.99), "o_custkey": (0.0, 0.5, 1.0)}
    return rounded(profile.quantile_table(o, wanted), "value")


@query
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    out = profile.corr_matrix(si.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return rounded(out, "corr")


@query
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.histogram(si.table(spark, d, "orders"), "o_totalprice", 20), "bin_low", "bin_high")


@query
def value_histogram(spark: SparkSession, d: str) -> DataFrame:
    return profile.value_counts(si.table(spark, d, "documents"), "n_chars")


@query
def box_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.box_stats(si.table(spark, d, "documents"), "n_chars"), "q1", "median", "q3")


@query
def box_stats_grouped(spark: SparkSession, d: str) -> DataFrame:
    out = profile.box_stats_by(si.table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice")
    return rounded(out, "q1", "median", "q3")


@query
def quartile_bucket(spark: SparkSession, d: str) -> DataFrame:
    out = profile.quartile_bucket(si.table(spark, d, "documents"), "n_chars", "len_bucket")
    return out.select("doc_id", "len_bucket")


@query
def kth_example(spark: SparkSession, d: str) -> DataFrame:
    """The lowest of the lower half and the 111th highest of the upper half."""
    docs = si.table(spark, d, "documents")
    labelled = wrangle.label(docs, wrangle.fit_median(docs, "n_chars"), "n_chars")
    low = profile.kth_row(labelled.where("sentiment = 0"), [F.asc("n_chars"), F.asc("doc_id")], 0)
    high = profile.kth_row(labelled.where("sentiment = 1"), [F.desc("n_chars"), F.asc("doc_id")], 110)
    return low.unionByName(high).select("doc_id", "n_chars", "sentiment")


@query
def head_rows(spark: SparkSession, d: str) -> DataFrame:
    return profile.head(si.table(spark, d, "orders"), [F.asc("o_orderkey")]).select("o_orderkey", "o_totalprice")


# --- dedupe, dimensions, facts, upserts -----------------------------------------------------------


@query
def dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    """The newest event per user and type."""
    e = si.table(spark, d, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("post_id"),
        clock.ts_to_epoch(F.col("ts")).alias("created_utc"), "event_id", "value",
    )
    return silver.dedupe_latest(e, "post_id").select("post_id", "event_id", "value")


@query
def first_post_per_group(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each type in file order."""
    e = ndjson.with_scan_order(si.table(spark, d, "events"))
    return silver.first_per_group(e.select("event_type", "event_id", "scan_pos"), "event_type", "scan_pos")


@query
def dim_author(spark: SparkSession, d: str) -> DataFrame:
    return silver.dim_author(si.posts(spark, d), si.comments(spark, d))


@query
def dim_subreddit(spark: SparkSession, d: str) -> DataFrame:
    return silver.dim_subreddit(si.subreddits(spark, d))


@query
def fact_posts(spark: SparkSession, d: str) -> DataFrame:
    return silver.fact_posts(si.supplier_posts(spark, d), silver.dim_subreddit(si.subreddits(spark, d)))


@query
def fact_comments(spark: SparkSession, d: str) -> DataFrame:
    comments = silver.normalize_comments(si.comments(spark, d))
    out = silver.fact_comments(comments, si.posts(spark, d))
    return out.select("comment_id", "post_id", "author", "score", "is_submitter", "has_post")


@query
def silver_posts(spark: SparkSession, d: str) -> DataFrame:
    """Bronze posts normalised and deduplicated."""
    out = silver.normalize_posts(si.posts(spark, d))
    return out.select("post_id", "subreddit", "author", "score", "num_comments", "over_18")


@query
def orphan_comments(spark: SparkSession, d: str) -> DataFrame:
    out = silver.orphans(si.comments(spark, d), si.posts(spark, d), "post_id", "comment_id")
    return out.select("comment_id", "post_id")


def _accounts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Customers as the table; spend per ordering customer and all suppliers as the incoming batch."""
    target = si.table(spark, d, "customer").select(
        F.col("c_name").alias("subreddit"),
        F.col("c_custkey").alias("subscribers"),
        F.col("c_mktsegment").alias("description"),
        F.col("c_acctbal").alias("created_utc"),
        (F.col("c_acctbal") < 0).alias("over18"),
    )
    spend = si.table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    changed = spend.select(
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("subreddit"),
        F.col("n").alias("subscribers"),
        F.lit(None).cast("string").alias("description"),
        F.lit(None).cast("double").alias("created_utc"),
        F.lit(True).alias("over18"),
    )
    added = si.table(spark, d, "supplier").select(
        F.col("s_name").alias("subreddit"),
        F.col("s_suppkey").alias("subscribers"),
        F.lit("new").alias("description"),
        F.col("s_acctbal").alias("created_utc"),
        F.lit(False).alias("over18"),
    )
    return target, changed.unionByName(added)


@query
def orphan_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per declared reference between store tables."""
    posts = si.supplier_posts(spark, d)
    tables = {"subreddits": silver.dim_subreddit(si.subreddits(spark, d)), "posts": posts, "comments": si.comments(spark, d)}
    return silver.orphan_report(tables)


@query
def upsert_full_row(spark: SparkSession, d: str) -> DataFrame:
    target, incoming = _accounts(spark, d)
    return upsert.replace_rows(target, incoming, "subreddit")


@query
def store_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The same upsert through the keyed store on disk."""
    target, incoming = _accounts(spark, d)
    table = KeyedTable(spark, scratch_dir(spark, "store"), target.schema, "subreddit", buckets=8)
    table.upsert(target)
    table.upsert(incoming)
    return table.read()


def _authors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Authors of signups as the table, authors of all events as the incoming batch."""
    e = si.table(spark, d, "events")
    name = F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author_name")
    return e.where(F.col("event_type") == "signup").select(name).distinct(), e.select(name)


@query
def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    target, incoming = _authors(spark, d)
    return upsert.insert_ignore(target, incoming, "author_name")


@query
def store_insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    target, incoming = _authors(spark, d)
    table = KeyedTable(spark, scratch_dir(spark, "authors"), target.schema, "author_name", buckets=8)
    table.insert_ignore(target)
    table.insert_ignore(incoming)
    return table.read()


# --- jobs, store tables and catalog ---------------------------------------------------------------


def _database(purpose: str) -> str:
    """A catalog database of this run alone."""
    return f"{purpose}_{uuid.uuid4().hex[:12]}"


def _medallion(spark: SparkSession, d: str, database: str | None = None) -> tuple[str, dict[str, str]]:
    """Landed NDJSON of three entities through bronze to silver and the store."""
    path = scratch_dir(spark, "medallion")
    for entity, rows in (("posts", si.raw_posts), ("comments", si.raw_comments), ("subreddits", si.raw_subreddits)):
        ndjson.write_raw(rows(spark, d), f"{path}/raw/{entity}", si.BATCH)
    return path, medallion.run_medallion(spark, f"{path}/raw", path, si.BATCH, buckets=8, database=database)


@query
def run_medallion(spark: SparkSession, d: str) -> DataFrame:
    """The whole job; comments as the catalog shows them, next to the fact table's reference flag."""
    database = _database("medallion")
    _, paths = _medallion(spark, d, database)
    flags = spark.read.parquet(paths["fact_comments"]).select("comment_id", "has_post")
    stored = spark.table(f"{database}.comments").select("comment_id", "post_id", "author", "score", "is_submitter")
    return stored.join(flags, "comment_id")


@query
def silver_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the four silver tables, and of bronze entities that never landed."""
    path, paths = _medallion(spark, d)
    counts = [spark.read.parquet(p).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, p in paths.items()]
    for entity in ("usersubs", "hot_sublists"):
        rows = medallion.read_bronze(spark, f"{path}/bronze", entity)
        counts.append(rows.agg(F.count("*").alias("n")).select(F.lit(entity).alias("name"), "n"))
    return reduce(DataFrame.unionByName, counts)


@query
def discover_medallion(spark: SparkSession, d: str) -> DataFrame:
    """Discovery carried through to silver: the best posts of the three largest communities, with the ranking's batch."""
    path = scratch_dir(spark, "discovered")
    for entity, rows in (("posts", si.raw_posts), ("comments", si.raw_comments), ("subreddits", si.raw_subreddits)):
        ndjson.write_raw(rows(spark, d), f"{path}/landed/{entity}", si.BATCH)
    paths = medallion.discover_medallion(
        spark, f"{path}/landed", path, si.BATCH, 3, "all_hot", _newest(spark, d), limit=40, time_filter="all", buckets=4
    )
    ranked = medallion.read_bronze(spark, f"{path}/bronze", "hot_sublists")
    names = ranked.select(keys.normalize_key(F.col("subreddit")).alias("subreddit"), "strategy")
    return spark.read.parquet(paths["fact_posts"]).join(names, "subreddit").select("post_id", "subreddit", "score", "strategy")


@query
def top_posts_of(spark: SparkSession, d: str) -> DataFrame:
    """Best 1,500 posts of last month of two named communities."""
    posts = si.posts(spark, d).withColumns({"subreddit": text.strip(F.col("subreddit")), "dt": clock.epoch_to_ts(F.col("created_utc"))})
    names = spark.createDataFrame([("click",), ("purchase",), ("nobody",)], "subreddit STRING")
    top = discover.top_posts_of(posts, names, 1500, "dt", "month", _newest(spark, d), F.col("post_id").cast("bigint"))
    return top.select("subreddit", "post_id", "score", "place")


@query
def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    """Posts upserted in two batches, read through the catalog, before and after the parts are merged."""
    database, root = _database("catalog"), scratch_dir(spark, "catalog")
    store.ensure_tables(spark, database, root)
    posts = silver.normalize_posts(si.posts(spark, d))
    table = store.store_table(spark, root, "posts", 8, database)
    table.upsert(posts.withColumn("score", F.lit(-1).cast("bigint")))
    table.upsert(posts)
    before = spark.table(f"{database}.posts")
    table.compact()
    after = spark.table(f"{database}.posts")
    return after.intersect(before).select("post_id", "subreddit", "author", "score", "num_comments", "over_18")


@query
def store_comments(spark: SparkSession, d: str) -> DataFrame:
    """Comments into their store table: the newer of two versions of a row stays, whichever came first."""
    comments = silver.normalize_comments(si.comments(spark, d))
    table = store.store_table(spark, scratch_dir(spark, "comments"), "comments", 8)
    table.upsert(comments, order=["created_utc"], unique=True)
    older = comments.withColumns({"created_utc": F.col("created_utc") - 1, "author": F.lit("old")})
    table.upsert(older, order=["created_utc"], unique=True)
    return table.read().select("comment_id", "post_id", "author", "score", "is_submitter")


@query
def store_no_rows(spark: SparkSession, d: str) -> DataFrame:
    """Batches without a usable row are no version."""
    target, incoming = _accounts(spark, d)
    table = KeyedTable(spark, scratch_dir(spark, "store"), target.schema, "subreddit", buckets=8)
    table.upsert(target)
    parts = table.parts()
    table.upsert(incoming.where("subscribers < 0"))
    table.insert_ignore(incoming.withColumn("subreddit", F.lit(None).cast("string")))
    return table.read().withColumn("same_version", F.lit(table.parts() == parts))


@query
def list_store_tables(spark: SparkSession, d: str) -> DataFrame:
    """The store's tables in the catalog with the rows they show."""
    database = _database("listed")
    _medallion(spark, d, database)
    names = [r["tableName"] for r in store.list_tables(spark, database).collect()]
    counts = [spark.table(f"{database}.{name}").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name in names]
    return reduce(DataFrame.unionByName, counts)


@query
def profile_comments(spark: SparkSession, d: str) -> DataFrame:
    """The profile job; its tables of shares, cuts and counts in one long table."""
    out = profiling.profile_comments(si.comments(spark, d))
    long = lambda name, key, value: out[name].select(F.lit(name).alias("part"), F.col(key).cast("string").alias("name"), F.col(value).cast("double").alias("value"))
    retained = out["retention"].unpivot([], ["total_rows", "kept_rows"], "name", "value")
    parts = [
        long("null_profile", "column", "nulls"), long("tombstone_rates", "feature", "proportion"), long("mark_rates", "feature", "proportion"),
        long("score_quantiles", "prob", "value"), long("length_quartiles", "prob", "value"), long("describe_categorical", "column", "unique"),
        long("score_by_exclamation", "has_exclamation", "median"),
        retained.select(F.lit("retention").alias("part"), "name", F.col("value").cast("double").alias("value")),
    ]
    return rounded(reduce(DataFrame.unionByName, parts), "value")


# --- discovery, listings, search ------------------------------------------------------------------


@query
def discover_ranked(spark: SparkSession, d: str) -> DataFrame:
    posts = si.posts(spark, d).withColumn("subreddit", F.col("author"))
    return discover.discover_ranked(posts, 20, F.col("post_id").cast("bigint"))


@query
def discover_popular(spark: SparkSession, d: str) -> DataFrame:
    listing = si.table(spark, d, "customer").select(
        F.col("c_custkey").alias("position"),
        F.col("c_name").alias("subreddit"),
        F.when(F.col("c_acctbal") < 0, True).when(F.col("c_acctbal") > 5000, False).alias("over18"),
    )
    return discover.discover_popular(listing, 40, "position")


def _newest(spark: SparkSession, d: str) -> Column:
    e = si.table(spark, d, "events")
    return e.agg(F.max("ts")).scalar()


@query
def discover_hot(spark: SparkSession, d: str) -> DataFrame:
    posts = si.posts(spark, d).withColumn("subreddit", F.col("author"))
    position = F.col("post_id").cast("bigint")
    return discover_job(posts, 10, "all_hot", position, None, _newest(spark, d))


@query
def discover_top_day(spark: SparkSession, d: str) -> DataFrame:
    posts = si.posts(spark, d).withColumn("subreddit", F.col("author"))
    position = F.col("post_id").cast("bigint")
    return discover_job(posts, 10, "all_top_day", position, None, _newest(spark, d), include_nsfw=True)


@query
def search_posts(spark: SparkSession, d: str) -> DataFrame:
    docs = si.table(spark, d, "documents")
    found = discover.search_posts(docs, "The en", 100, ["text", "source"], [F.desc("n_chars"), F.asc("doc_id")])
    return found.select("doc_id", "n_chars")


@query
def top_posts_window(spark: SparkSession, d: str) -> DataFrame:
    """Best 25 events of the last week per type."""
    e = si.table(spark, d, "events")
    recent = discover.within(e, "ts", "week", _newest(spark, d))
    top = discover.top_per_group(recent, "event_type", [F.desc("value"), F.asc("event_id")], 25)
    return top.select("event_type", "event_id", "value", "place")


@query
def new_posts(spark: SparkSession, d: str) -> DataFrame:
    """The 25 newest events per type."""
    e = si.table(spark, d, "events")
    top = discover.top_per_group(e, "event_type", [F.desc("ts"), F.asc("event_id")], 25)
    return top.select("event_type", "event_id", "place")


@query
def user_recent_communities(spark: SparkSession, d: str) -> DataFrame:
    out = discover.user_recent(si.posts(spark, d), "user8")
    return out.withColumn("subreddit", text.strip(F.col("subreddit")))


# --- splits and samples ---------------------------------------------------------------------------


@query
def stratified_split(spark: SparkSession, d: str) -> DataFrame:
    out = sampling.stratified_split(si.table(spark, d, "labels"), "doc_id", "quality")
    return out.select("doc_id", "quality", "split")


@query
def sample_exact(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sample_exact(si.table(spark, d, "documents"), "doc_id", 0.37).select("doc_id", "n_chars")


# --- vectors, models, scoring ---------------------------------------------------------------------


@query
def softmax_argmax(spark: SparkSession, d: str) -> DataFrame:
    z = si.logits(spark, d, 5)
    return z.select(
        "vec_id",
        vectors.argmax(F.col("z")).alias("top"),
        *[F.round(vectors.softmax(F.col("z"))[i], DIGITS).alias(f"p{i}") for i in range(5)],
        F.round(vectors.max_probability(F.col("z")), DIGITS).alias("p_top"),
    )


@query
def logits_to_binary(spark: SparkSession, d: str) -> DataFrame:
    five, two = si.logits(spark, d, 5, 2), F.col("z2")
    names = scoring.CLASSIFIERS
    return five.select(
        "vec_id",
        labels.binary_from_logits(F.col("z"), F.lit(names["bert_nlptown"])).alias("from_stars"),
        labels.binary_from_logits(two, F.lit(names["bert_distilbert"])).alias("from_pair"),
    )


@query
def logits_to_label(spark: SparkSession, d: str) -> DataFrame:
    five, two = si.logits(spark, d, 5, 2), F.col("z2")
    names = scoring.CLASSIFIERS
    return five.select(
        "vec_id",
        labels.label_from_logits(F.col("z"), F.lit(names["bert_nlptown"])).alias("from_stars"),
        labels.label_from_logits(two, F.lit(names["bert_distilbert"])).alias("from_pair"),
    )


@query
def scaler_fit(spark: SparkSession, d: str) -> DataFrame:
    return rounded(scaler.scaler_stats(si.table(spark, d, "embeddings"), "embedding"), "mean", "std")


@query
def scaler_transform(spark: SparkSession, d: str) -> DataFrame:
    """Fitted on labels below 7 only; three components and the row's sum."""
    e = si.table(spark, d, "embeddings")
    fitted = scaler.fit_scaler(e.where("label < 7"), "embedding")
    out = fitted.transform(e, "embedding")
    total = F.aggregate("scaled", F.lit(0.0), lambda acc, x: acc + x)
    return rounded(
        out.select("vec_id", F.col("scaled")[0].alias("s0"), F.col("scaled")[1].alias("s1"),
                   F.col("scaled")[63].alias("s63"), total.alias("total")),
        "s0", "s1", "s63", "total",
    )


def _letter_encoder() -> embed.Encoder:
    return lambda texts: np.array([[len(t), t.count("e"), t.count(" ")] for t in texts], dtype="float32")


@query
def embed_texts(spark: SparkSession, d: str) -> DataFrame:
    """A small injected encoder: length, letters e, blanks."""
    docs = si.table(spark, d, "documents")
    out = embed.embed_texts(docs, "text", _letter_encoder)
    return out.select(
        "doc_id", *[F.col("embedding")[i].cast("int").alias(n) for i, n in enumerate(("n_len", "n_e", "n_blank"))]
    )


@query
def embed_hashed(spark: SparkSession, d: str) -> DataFrame:
    """The built-in hashed-words encoder over cleaned texts."""
    docs = si.table(spark, d, "documents")
    docs = docs.select("doc_id", text.clean_text(F.col("text")).alias("clean_text"))
    docs = lake.materialize(docs, scratch_dir(spark, "cleaned"))
    vectors_out = embed.apply_encoder(embed.fit_encoder(docs), docs)
    return vectors_out.select("doc_id", F.size("embedding").alias("dim"), "embedding")


@query
def binary_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.binary_metrics(si.predictions(spark, d), "label", "prediction"), "accuracy", "f1")


@query
def metrics_no_positives(spark: SparkSession, d: str) -> DataFrame:
    """F1 is 0 where neither truth nor prediction has a positive."""
    rows = si.table(spark, d, "labels").select("quality", F.lit(0).alias("y"), F.lit(0).alias("p"))
    return evaluate.binary_metrics(rows, "y", "p", ["quality"])


RESULT_NUMBERS = ("val_accuracy", "val_f1", "test_accuracy", "test_f1")


@query
def evaluate_by_split(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.evaluate_by_split(si.predictions(spark, d)), *RESULT_NUMBERS)


def _results(spark: SparkSession, d: str) -> DataFrame:
    return training.model_results(si.predictions(spark, d), "run-1")


@query
def model_enrich(spark: SparkSession, d: str) -> DataFrame:
    out = evaluate.model_enrich(_results(spark, d))
    return out.select("model_key", "run_id", "family", "hyperparams", "cost_prod", "latency_prod")


@query
def unpivot_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.unpivot_metrics(_results(spark, d), "f1", "f1_score"), "f1_score")


@query
def unpivot_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.unpivot_metrics(_results(spark, d), "accuracy", "accuracy"), "accuracy")


@query
def model_compare(spark: SparkSession, d: str) -> DataFrame:
    out = evaluate.model_compare(_results(spark, d))
    return rounded(out, *RESULT_NUMBERS, "gap_f1_val_test", "gap_acc_val_test")


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Nation keys as text stand in for the registered versions."""
    return si.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("version"))


@query
def champion_select(spark: SparkSession, d: str) -> DataFrame:
    out = evaluate.champion(_results(spark, d), _versions(spark, d))
    return rounded(out, "best_val_f1", "best_test_f1")


@query
def comparison_summary(spark: SparkSession, d: str) -> DataFrame:
    """The one-row summary with the comparison table as JSON."""
    out = summary(_results(spark, d), _versions(spark, d))
    return out.select("best_model_key", F.json_array_length("comparison_table").alias("n_models"),
                      F.get_json_object("comparison_table", "$[0].model_key").alias("first_model"))


def _sigmoid_sum(vector: Column) -> Column:
    """A fixed linear scorer with unit weights."""
    total = F.aggregate(vectors.as_doubles(vector), F.lit(0.0), lambda acc, x: acc + x)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _leading(width: int) -> Callable[[Column], Column]:
    return lambda vector: vectors.as_doubles(F.slice(vector, 1, width))


CLASSIFIER_COLUMNS = {"bert_nlptown": _leading(5), "bert_distilbert": _leading(2)}
SCORE_COLUMNS = ("label", "score", "model_key", "backend_model_name", "warning", "confidence")


def _score(rows: DataFrame, **options: object) -> DataFrame:
    out = scoring.score_comments(rows.select("vec_id", "embedding", "wanted"), "embedding", _sigmoid_sum, **options)
    return rounded(out.select("vec_id", *SCORE_COLUMNS), "score", "confidence")


def _routed(spark: SparkSession, d: str) -> DataFrame:
    wanted = (
        F.when(F.col("label") < 3, "mlp_transformer").when(F.col("label") < 6, "bert_nlptown")
        .when(F.col("label") < 9, "bert_distilbert").otherwise("other")
    )
    return si.table(spark, d, "embeddings").withColumn("wanted", wanted)


@query
def score_mlp(spark: SparkSession, d: str) -> DataFrame:
    return _score(_routed(spark, d))


@query
def score_router(spark: SparkSession, d: str) -> DataFrame:
    return _score(_routed(spark, d), classifiers=CLASSIFIER_COLUMNS, model_key=F.col("wanted"))


@query
def score_injected(spark: SparkSession, d: str) -> DataFrame:
    """An injected classifier (Arrow batches) over texts, then labels in SQL."""

    def make_model() -> scoring.LogitsFn:
        return lambda texts: np.array([[t.count("a"), t.count("e")] for t in texts], dtype="float64")

    docs = si.table(spark, d, "documents")
    z = scoring.classifier_logits(make_model)(F.col("text"))
    name = F.lit(scoring.CLASSIFIERS["bert_distilbert"])
    scored = docs.select("doc_id", z.alias("z"))
    return scored.select("doc_id", labels.label_from_logits(F.col("z"), name).alias("label"))


@query
def score_threshold(spark: SparkSession, d: str) -> DataFrame:
    out = _score(_routed(spark, d))
    return out.select("vec_id", labels.is_confident(F.col("score")).alias("is_confident"))


@query
def polarity_bucket(spark: SparkSession, d: str) -> DataFrame:
    c = si.table(spark, d, "customer")
    word = (
        F.when(F.col("c_mktsegment") == "BUILDING", "NEGATIVE").when(F.col("c_mktsegment") == "HOUSEHOLD", "pos")
        .when(F.col("c_mktsegment") == "MACHINERY", "Neutral").otherwise(F.col("c_mktsegment"))
    )
    return c.select("c_custkey", labels.polarity(word).alias("polarity"))


def _features(spark: SparkSession, d: str) -> tuple[DataFrame, int]:
    """Vectors, a binary label and a split, scaled on the train rows and written once."""
    e = si.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), "embedding", (F.col("label") >= 5).cast("int").alias("label")
    )
    split = sampling.stratified_split(e, "id", "label")
    features, fitted = training.scaled_features(split, "embedding")
    features = training.with_features(features).drop("embedding", "scaled")
    return lake.materialize(features, scratch_dir(spark, "features")), len(fitted.mean)


TRIAL = training.Trial(hidden=128, alpha=1e-2, rate=1e-3, batch_size=256, max_iter=10)


@query
def mlp_train_score(spark: SparkSession, d: str) -> DataFrame:
    """Scale, fit MLlib's network on train rows, score all rows."""
    features, width = _features(spark, d)
    model = training.fit_trial(features.where("split = 'train'"), width, TRIAL)
    return training.predict(model, features).select("id", "split", "label", "prediction", "p_positive")


@query
def network_train_score(spark: SparkSession, d: str) -> DataFrame:
    """The same through a saved and loaded model: every row keeps its place, its class follows from its probability."""
    features, width = _features(spark, d)
    path = scratch_dir(spark, "model")
    training.fit_trial(features.where("split = 'train'"), width, TRIAL).write().save(path)
    scored = training.predict(PipelineModel.load(path), features)
    p = F.col("p_positive")
    return scored.select(
        "id", "split", "label", ((p >= 0.5) == (F.col("prediction") == 1)).alias("class_follows"), p.between(0, 1).alias("is_probability")
    )


@query
def linear_train_score(spark: SparkSession, d: str) -> DataFrame:
    features, _ = _features(spark, d)
    model = training.fit_linear(features.where("split = 'train'"), TRIAL)
    return training.predict(model, features).select("id", "split", "label", "prediction", "p_positive")


@query
def hpo_random_search(spark: SparkSession, d: str) -> DataFrame:
    """All trials over one written table; which is best, by F1 on the val rows, then by number."""
    features, width = _features(spark, d)
    trials = training.draw_trials()
    table, best = training.random_search(features, width, trials)
    bounded = F.col("val_f1").between(0, 1) & F.col("val_accuracy").between(0, 1)
    first = table.orderBy(F.desc("val_f1"), "trial").limit(1).first()["trial"]
    return table.select(
        "trial", "hidden", "alpha", "rate", "batch_size", "max_iter", bounded.alias("is_scored"),
        F.lit(trials.index(best) == first).alias("best_is_first"),
    )


# --- streams --------------------------------------------------------------------------------------


@query
def stream_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Raw posts landed as NDJSON, streamed to the bronze layout."""
    path = scratch_dir(spark, "stream-bronze")
    ndjson.write_raw(si.raw_posts(spark, d), f"{path}/raw", si.BATCH)
    run = incremental.stream_bronze(spark, f"{path}/raw/batch_ts={si.BATCH}", "posts", f"{path}/bronze",
                                    f"{path}/checkpoint", si.BATCH)
    run.awaitTermination()
    return lake.read_batches(spark, f"{path}/bronze", bronze_schema("posts"), dated=True).select(
        "post_id", "score", "over_18", "batch_ts", "YYYY", "MM", "DD"
    )


def _event_stream(spark: SparkSession, d: str, times: int = 1) -> DataFrame:
    schema = si.table(spark, d, "events").schema
    stream = incremental.table_stream(spark, f"{d}/events.parquet", schema)
    rows = stream.select(
        F.col("event_id").cast("string").alias("post_id"), "event_type", "user_id", "value",
        clock.ts_to_epoch(F.col("ts")).alias("created_utc"),
    )
    # Every row arrives `times` times, as when batches overlap.
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy")


@query
def stream_dedupe(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "stream-dedupe")
    rows = _event_stream(spark, d, 2)
    for run in ("first", "again"):  # the second starts without a checkpoint: every key comes again, beyond any span
        incremental.stream_dedupe(rows, "post_id", f"{path}/out", f"{path}/{run}", "10 minutes").awaitTermination()
    return incremental.read_deduped(spark, f"{path}/out", rows.schema).select("post_id", "event_type", "value")


@query
def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Events streamed into a keyed table of users: the newest event per user stays."""
    path = scratch_dir(spark, "stream-upsert")
    rows = _event_stream(spark, d).select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("author"), "post_id", "value", "created_utc"
    )
    table = KeyedTable(spark, f"{path}/table", rows.schema, "author", buckets=8)
    incremental.stream_upsert(rows, table, f"{path}/checkpoint", order=["created_utc"]).awaitTermination()
    return table.read().select("author", "post_id", "value")


@query
def stream_score(spark: SparkSession, d: str) -> DataFrame:
    """The scoring transform on a stream of vectors."""
    path = scratch_dir(spark, "stream-score")
    schema = si.table(spark, d, "embeddings").schema
    stream = incremental.table_stream(spark, f"{d}/embeddings.parquet", schema).withColumn("wanted", F.lit("mlp_transformer"))
    run = incremental.stream_score(stream, _score, f"{path}/out", f"{path}/checkpoint")
    run.awaitTermination()
    return incremental.read_scored(spark, f"{path}/out", _score(stream).schema).select("vec_id", "label", "score")
