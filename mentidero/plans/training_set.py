"""Comments to train, val and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.functions.text import MIN_CLEAN_LENGTH, clean_text
from mentidero.operators import wrangle
from mentidero.operators.once import compute_once
from mentidero.operators.sampling import stratified_split
from mentidero.sources.lake import materialize, write_splits


def wrangle_training_set(comments: DataFrame, stage_root: str, null_text: str | None = wrangle.NULL_TEXT) -> DataFrame:
    """The labelled modelling set.

    The text is worked on once, in one narrow pass whose result is written without the raw body. The
    tails (after the raw length rule, before the clean one) and the median (after it) then read two
    numeric columns of that stage.
    """
    features = wrangle.wrangle_features(comments, null_text)
    texts = compute_once(features, "clean_text", clean_text(F.col("body"))).drop("body")
    texts = texts.withColumn("clean_len", F.length("clean_text"))
    stage = materialize(texts, f"{stage_root}/texts")
    clipped = wrangle.winsorize(stage, wrangle.fit_tails(stage)).where(F.col("clean_len") > MIN_CLEAN_LENGTH)
    return wrangle.model_columns(wrangle.label(clipped, wrangle.fit_median(clipped)))


def build_training_set(comments: DataFrame, out_root: str, seed: int = 42, null_text: str | None = wrangle.NULL_TEXT) -> str:
    """Write the modelling set with its 70/15/15 split; returns the path of the split table."""
    modelling = wrangle_training_set(comments, f"{out_root}/stages", null_text)
    path = f"{out_root}/splits"
    write_splits(stratified_split(modelling, "comment_id", "sentiment", seed), path)
    return path
