"""From logits and probabilities to labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentidero.functions.vectors import argmax

# --- fixed values ---
STAR_MODEL_MARK = "nlptown"  # five star classes; every other classifier has (negative, positive)
POSITIVE_FLOOR = 0.5
HIGHLIGHT_DEFAULT = 0.7
HIGHLIGHT_RANGE = (0.5, 0.99)
STABLE_GAP = 0.02
OVERFIT_GAP = 0.05
# --- end of fixed values ---


def is_star_model(model_name: Column) -> Column:
    return F.contains(model_name, F.lit(STAR_MODEL_MARK))


def binary_from_logits(logits: Column, model_name: Column) -> Column:
    """0/1 for training metrics: four and five stars are positive, three stars are not."""
    place = argmax(logits)
    return F.when(is_star_model(model_name), place >= 3).otherwise(place == 1).cast("int")


def label_from_logits(logits: Column, model_name: Column) -> Column:
    """Text label for scoring: here three stars are neutral."""
    place = argmax(logits)
    stars = (
        F.when(place <= 1, F.lit("negative")).when(place == 2, F.lit("neutral")).otherwise(F.lit("positive"))
    )
    pair = F.when(place == 1, F.lit("positive")).otherwise(F.lit("negative"))
    return F.when(is_star_model(model_name), stars).otherwise(pair)


def label_from_probability(positive: Column) -> Column:
    return F.when(positive >= POSITIVE_FLOOR, F.lit("positive")).otherwise(F.lit("negative"))


def polarity(label: Column) -> Column:
    text = F.lower(label)
    return (
        F.when(F.contains(text, F.lit("neg")), F.lit("negative"))
        .when(F.contains(text, F.lit("pos")), F.lit("positive"))
        .when(F.contains(text, F.lit("neu")), F.lit("neutral"))
        .otherwise(F.lit("unknown"))
    )


def is_confident(score: Column, threshold: float = HIGHLIGHT_DEFAULT) -> Column:
    low, high = HIGHLIGHT_RANGE
    if not low <= threshold <= high:
        raise ValueError(f"threshold must be within {low}..{high}")
    return score >= F.lit(threshold)


def overfit_signal(gap: Column) -> Column:
    return (
        F.when(F.abs(gap) < STABLE_GAP, F.lit("stable"))
        .when(gap > OVERFIT_GAP, F.lit("overfit"))
        .otherwise(F.lit("moderate"))
    )
