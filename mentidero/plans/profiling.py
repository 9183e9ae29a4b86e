"""The profile of a comments table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.functions.text import TOMBSTONES, is_tombstone, text_features
from mentidero.operators import profile
from mentidero.operators.wrangle import flag_comments, label
from mentidero.session import scratch_dir
from mentidero.sources.lake import materialize

SCORE_PROBS = (0.01, 0.25, 0.50, 0.75, 0.99)
NEGATIVE_EXAMPLE, POSITIVE_EXAMPLE = 0, 110


def narrow_comments(comments: DataFrame) -> DataFrame:
    """What the profile counts of each comment, written once: the body as its digest and its features."""
    body = F.col("body")
    kept = F.coalesce(~is_tombstone(body), F.lit(False))
    flagged = flag_comments(comments).withColumns({**text_features(body), "is_kept": kept})
    flagged = flagged.withColumns({"is_deleted": body == TOMBSTONES[0], "is_removed": body == TOMBSTONES[1], "body": F.md5(body)})
    return materialize(flagged, scratch_dir(comments.sparkSession, "comment-features"))


def profile_comments(comments: DataFrame, bins: int = 50) -> dict[str, DataFrame]:
    """Named result tables, each small. The bodies are read once for all statistics, and again only where whole
    values are shown."""
    written = narrow_comments(comments)
    flagged = written.select(*comments.columns, "has_author", "created_dt")
    clean = written.where("is_kept")
    numeric = ["score", "text_len", "word_count"]
    # One selection for the quantiles of all columns.
    cuts = profile.quantile_cuts(clean, {"score": SCORE_PROBS, "text_len": profile.QUARTILES, "word_count": profile.QUARTILES})
    bucketed = profile.quartile_bucket(clean, "text_len", "len_bucket", cuts)
    labelled = label(clean, cuts["score"][0.50], "score")

    def shown(row: DataFrame) -> DataFrame:
        return comments.join(row.select("comment_id").limit(1), "comment_id").select("score", "body")

    return {
        "null_profile": profile.null_profile(flagged),
        "column_info": profile.column_info(flagged),
        "describe_categorical": profile.describe_categorical(flag_comments(comments), ["author", "body", "is_submitter", "has_author"]),
        "tombstone_rates": profile.rates(
            written, {"deleted_rate": F.col("is_deleted"), "removed_rate": F.col("is_removed")}
        ),
        "retention": profile.retention(written, F.col("is_kept")),
        "duplicates": profile.duplicate_keys(flagged, ["comment_id"]),
        "score_quantiles": profile.quantile_table(clean, {"score": SCORE_PROBS}, cuts),
        "score_histogram": profile.histogram(clean, "score", bins),
        "score_box": profile.box_stats(clean, "score", cuts),
        "length_histogram": profile.value_counts(clean, "text_len"),
        "length_box": profile.box_stats(clean, "text_len", cuts),
        "describe_numeric": profile.describe_numeric(clean, numeric, cuts),
        "mark_rates": profile.rates(
            clean, {"has_exclamation": F.col("has_exclamation"), "has_question": F.col("has_question")}
        ),
        "score_by_exclamation": profile.box_stats_by(clean, "has_exclamation", "score"),
        "score_by_length": profile.box_stats_by(bucketed, "len_bucket", "score"),
        "correlations": profile.corr_matrix(clean, numeric),
        "length_quartiles": profile.quantile_table(clean, {"text_len": profile.QUARTILES}, cuts),
        "negative_example": shown(profile.kth_row(labelled.where("sentiment = 0"), [F.asc("score"), F.asc("comment_id")], NEGATIVE_EXAMPLE)),
        "positive_example": shown(profile.kth_row(labelled.where("sentiment = 1"), [F.desc("score"), F.asc("comment_id")], POSITIVE_EXAMPLE)),
    }


def inspect_split(split: DataFrame) -> dict[str, DataFrame]:
    """The checks made on each split: nulls, types, summary, class shares."""
    return {
        "head": profile.head(split, [F.asc("comment_id")]),
        "column_info": profile.column_info(split),
        "null_profile": profile.null_profile(split),
        "describe_numeric": profile.describe_numeric(split, ["score_clipped", "text_len_clipped", "word_count"]),
        "class_distribution": profile.class_distribution(split, "sentiment"),
    }
