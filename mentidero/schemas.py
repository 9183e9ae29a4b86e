"""Entity schemas. Bronze specs give (raw name, bronze name, lenient type) in column order."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# --- fixed values: raw, bronze and silver column lists --------------------------------------

RAW = {
    "posts": "id STRING, name STRING, subreddit STRING, author STRING, title STRING, selftext STRING, "
    "url STRING, permalink STRING, score BIGINT, num_comments BIGINT, over_18 BOOLEAN, "
    "stickied BOOLEAN, created_utc DOUBLE, edited STRING, link_flair_text STRING, is_self BOOLEAN, "
    "spoiler BOOLEAN, locked BOOLEAN, thumbnail STRING",
    "comments": "comment_id STRING, post_id STRING, author STRING, body STRING, created_utc DOUBLE, "
    "parent_id STRING, link_id STRING, score BIGINT, is_submitter BOOLEAN",
    "subreddits": "subreddit STRING, subscribers BIGINT, public_description STRING, created_utc DOUBLE, "
    "over18 BOOLEAN",
    "usersubs": "username STRING, subreddit STRING, last_post_id STRING, last_created_utc DOUBLE",
    "hot_sublists": "subreddit STRING, strategy STRING, posts_limit BIGINT, include_nsfw BOOLEAN",
}

BRONZE = {
    "posts": [
        ("id", "post_id", "string"),
        ("subreddit", "subreddit", "string"),
        ("author", "author", "string"),
        ("title", "title", "string"),
        ("selftext", "selftext", "string"),
        ("url", "url", "string"),
        ("permalink", "permalink", "string"),
        ("score", "score", "bigint"),
        ("num_comments", "num_comments", "bigint"),
        ("over_18", "over_18", "boolean"),
        ("created_utc", "created_utc", "double"),
        ("link_flair_text", "link_flair_text", "string"),
        ("is_self", "is_self", "boolean"),
        ("spoiler", "spoiler", "boolean"),
        ("locked", "locked", "boolean"),
        ("thumbnail", "thumbnail", "string"),
    ],
    "comments": [
        ("comment_id", "comment_id", "string"),
        ("post_id", "post_id", "string"),
        ("author", "author", "string"),
        ("body", "body", "string"),
        ("created_utc", "created_utc", "double"),
        ("parent_id", "parent_id", "string"),
        ("link_id", "link_id", "string"),
        ("score", "score", "bigint"),
        ("is_submitter", "is_submitter", "boolean"),
    ],
    "subreddits": [
        ("subreddit", "subreddit", "string"),
        ("subscribers", "subscribers", "bigint"),
        ("public_description", "description", "string"),
        ("created_utc", "created_utc", "double"),
        ("over18", "over18", "boolean"),
    ],
    "usersubs": [
        ("username", "username", "string"),
        ("subreddit", "subreddit", "string"),
        ("last_post_id", "last_post_id", "string"),
        ("last_created_utc", "last_created_utc", "double"),
    ],
    "hot_sublists": [
        ("subreddit", "subreddit", "string"),
        ("strategy", "strategy", "string"),
        ("posts_limit", "posts_limit", "bigint"),
        ("include_nsfw", "include_nsfw", "boolean"),
    ],
}

# The column that places a bronze row on a calendar day; entities without one are appended flat.
CREATED_COLUMN = {"posts": "created_utc", "comments": "created_utc"}

# Store tables: canonical column order, first column is the key.
STORE = {
    "subreddits": "subreddit STRING, subscribers BIGINT, description STRING, created_utc DOUBLE, over18 BOOLEAN",
    "authors": "author_name STRING",
    "posts": "post_id STRING, title STRING, selftext STRING, url STRING, permalink STRING, score BIGINT, "
    "num_comments BIGINT, over_18 BOOLEAN, created_utc DOUBLE, link_flair_text STRING, is_self BOOLEAN, "
    "spoiler BOOLEAN, locked BOOLEAN, thumbnail STRING, subreddit STRING, author STRING",
    "comments": "comment_id STRING, post_id STRING, author STRING, body STRING, created_utc DOUBLE, "
    "parent_id STRING, link_id STRING, score BIGINT, is_submitter BOOLEAN",
}

# Declared references between store tables; advisory, reported by the orphan checks.
REFERENCES = {"posts": ("subreddit", "subreddits"), "comments": ("post_id", "posts")}

MODELLING = (
    "comment_id STRING, clean_text STRING, score_clipped DOUBLE, text_len_clipped DOUBLE, word_count INT, "
    "has_exclamation BOOLEAN, has_question BOOLEAN, created_dt TIMESTAMP_NTZ, is_submitter BOOLEAN, sentiment INT"
)

# --- end of fixed values ---------------------------------------------------------------------


def raw_schema(entity: str) -> StructType:
    return StructType.fromDDL(RAW[entity])


def raw_text_schema(entity: str) -> StructType:
    """Every raw field as text: a field whose JSON type drifts between files never nulls its row."""
    fields = [StructField(f.name, StringType()) for f in raw_schema(entity)]
    return StructType(fields + [StructField("_corrupt_record", StringType())])


def bronze_schema(entity: str) -> StructType:
    return StructType.fromDDL(", ".join(f"{name} {kind}" for _, name, kind in BRONZE[entity]))


def store_schema(table: str) -> StructType:
    return StructType.fromDDL(STORE[table])
