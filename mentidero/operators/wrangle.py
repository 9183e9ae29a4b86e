"""Comments to a labelled modelling set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.functions.clock import epoch_to_ts
from mentidero.functions.text import (
    MIN_CLEAN_LENGTH,
    MIN_RAW_LENGTH,
    clean_text,
    is_tombstone,
    nfkc,
    text_features,
)
from mentidero.operators.once import compute_once
from mentidero.operators.quantiles import exact_quantiles
from mentidero.schemas import MODELLING

# --- fixed values ---
SCORE_TAILS = (0.01, 0.99)
LENGTH_TAIL = 0.99
NULL_TEXT = "None"
MODEL_COLUMNS = [c.split()[0] for c in MODELLING.split(", ")]
# --- end of fixed values ---


def drop_tombstones(df: DataFrame, null_text: str | None = NULL_TEXT) -> DataFrame:
    """Drop removed bodies. A null body is the text `null_text`; without one it is dropped, too."""
    if null_text is not None:
        df = df.withColumn("body", F.coalesce(F.col("body"), F.lit(null_text)))
    return df.where(F.col("body").isNotNull() & ~is_tombstone(F.col("body")))


def flag_comments(df: DataFrame) -> DataFrame:
    return df.withColumns({"has_author": F.col("author").isNotNull(), "created_dt": epoch_to_ts(F.col("created_utc"))})


def wrangle_features(comments: DataFrame, null_text: str | None = NULL_TEXT) -> DataFrame:
    """Flags, NFKC text, length and punctuation features; texts of 2 characters or less go."""
    kept = drop_tombstones(flag_comments(comments), null_text)
    normal = compute_once(kept, "body", nfkc(F.col("body")))
    return normal.withColumns(text_features(F.col("body"))).where(F.col("text_len") > MIN_RAW_LENGTH)


def clip(x: Column, low: float | None = None, high: float | None = None) -> Column:
    """Both ends optional; null stays null."""
    value = x.cast("double")
    if high is not None:
        value = F.when(value > F.lit(high), F.lit(high)).otherwise(value)
    if low is not None:
        value = F.when(value < F.lit(low), F.lit(low)).otherwise(value)
    return value


@dataclass(frozen=True)
class Tails:
    """Fitted clipping bounds."""

    score_low: float | None
    score_high: float | None
    length_high: float | None


def fit_tails(features: DataFrame) -> Tails:
    cuts = exact_quantiles(features, {"score": SCORE_TAILS, "text_len": (LENGTH_TAIL,)})
    return Tails(*cuts["score"], *cuts["text_len"])


def winsorize(features: DataFrame, tails: Tails) -> DataFrame:
    """Clip score on both sides and text length from above. A narrow transform."""
    return features.withColumns(
        {
            "score_clipped": clip(F.col("score"), tails.score_low, tails.score_high),
            "text_len_clipped": clip(F.col("text_len"), None, tails.length_high),
        }
    )


def with_clean_text(df: DataFrame) -> DataFrame:
    """Add the cleaned text and drop rows where 3 characters or less are left."""
    return long_enough(compute_once(df, "clean_text", clean_text(F.col("body"))))


def long_enough(df: DataFrame) -> DataFrame:
    return df.where(F.length("clean_text") > MIN_CLEAN_LENGTH)


def fit_median(df: DataFrame, column: str = "score_clipped") -> float | None:
    return exact_quantiles(df, {column: (0.5,)})[column][0]


def label(df: DataFrame, threshold: float | None, column: str = "score_clipped") -> DataFrame:
    """1 at or above the median, else 0; a missing score is 0."""
    at_least = F.col(column) >= F.lit(threshold).cast("double")
    return df.withColumn("sentiment", F.coalesce(at_least, F.lit(False)).cast("int"))


def model_columns(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["clean_text"]).select(*MODEL_COLUMNS)
