"""Keys, slugs, tags and hash ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentidero.functions.text import strip

RANK_BITS = 60


def normalize_key(value: Column) -> Column:
    return F.upper(strip(value.cast("string")))


def slugify(value: Column) -> Column:
    """Lower case, blanks to `_`, other signs dropped; an empty slug becomes a stable 8-digit tag."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    slug = F.regexp_replace(F.replace(strip(F.lower(text)), F.lit(" "), F.lit("_")), "[^a-z0-9_-]+", "")
    return F.when(slug != "", slug).otherwise(F.substring(F.md5(text), 1, 8))


def search_tag(query: Column) -> Column:
    """File tag of a search: `q-` and 28 hash bits of the query text."""
    bits = F.conv(F.substring(F.md5(query), 1, 7), 16, 10)
    return F.concat(F.lit("q-"), bits)


def artifact_name(model: Column, split: Column, stamp: Column) -> Column:
    return F.concat_ws("_", F.replace(model, F.lit("/"), F.lit("_")), split, stamp)


def hash_rank(seed: int, row_id: Column) -> Column:
    """A uniform 60-bit integer per id; ordering rows by it is a seeded shuffle."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, RANK_BITS // 4), 16, 10).cast("bigint")


def key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
