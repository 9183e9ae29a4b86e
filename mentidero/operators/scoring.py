"""Scoring texts with a chosen model, on tables and on streams alike. No shuffle anywhere."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from mentidero.functions.arrow import align
from mentidero.functions.labels import label_from_logits, label_from_probability
from mentidero.functions.vectors import max_probability

# --- fixed values ---
CLASSIFIERS = {
    "bert_nlptown": "nlptown/bert-base-multilingual-uncased-sentiment",
    "bert_distilbert": "distilbert-base-uncased-finetuned-sst-2-english",
}
DEFAULT_MODEL = "mlp_transformer"
DEFAULT_BACKEND = "sentiment_deep_model@champion"
MAX_TOKENS = 256
# --- end of fixed values ---

LogitsFn = Callable[[Sequence[str]], np.ndarray]


def classifier_logits(make_model: Callable[[], LogitsFn]) -> Callable[[Column], Column]:
    """Wrap a user's sequence classifier (texts to a logits matrix), loaded once per task. The model
    cuts its input to MAX_TOKENS tokens itself, as its tokenizer knows what a token is."""

    @F.pandas_udf(ArrayType(DoubleType()))
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for texts in batches:
            known = texts.dropna()
            rows = np.asarray(model(known.tolist()), dtype="float64") if len(known) else []
            yield align(rows, texts)

    return logits


def _record(label: Column, score: Column, key: Column, backend: Column, warning: Column | None = None) -> Column:
    note = F.lit(None).cast("string") if warning is None else warning
    return F.struct(
        label.alias("label"), score.alias("score"), key.alias("model_key"),
        backend.alias("backend_model_name"), note.alias("warning"),
    )


def classifier_record(logits: Column, key: str) -> Column:
    name = F.lit(CLASSIFIERS[key])
    return _record(label_from_logits(logits, name), max_probability(logits), F.lit(key), name)


def probability_record(positive: Column, warning: Column | None = None, backend: str = DEFAULT_BACKEND) -> Column:
    """The score is P(positive), for negative labels too."""
    return _record(label_from_probability(positive), positive, F.lit(DEFAULT_MODEL), F.lit(backend), warning)


def route(model_key: Column, positive: Column, logits: dict[str, Column]) -> Column:
    """Pick each row's model by key; an unknown key goes to the default model with a warning."""
    unknown = F.concat(
        F.lit("model_key desconocido '"), model_key, F.lit(f"', se usó {DEFAULT_MODEL}.")
    )
    record = F.when(model_key == DEFAULT_MODEL, probability_record(positive))
    for key, column in logits.items():
        record = record.when(model_key == key, classifier_record(column, key))
    return record.otherwise(probability_record(positive, unknown))


def score_comments(df: DataFrame, text: str, positive: Callable[[Column], Column],
                   classifiers: dict[str, Callable[[Column], Column]] | None = None,
                   model_key: Column | None = None) -> DataFrame:
    """Add (label, score, model_key, backend_model_name, warning, confidence).

    `positive` and `classifiers` turn the text column into P(positive) and logits. A classifier only
    receives the texts routed to it; the others reach it as null.
    """
    key = F.lit(DEFAULT_MODEL) if model_key is None else F.coalesce(model_key, F.lit(DEFAULT_MODEL))
    classifiers = classifiers or {}
    routed = df.withColumn("_key", key)
    mine = {k: F.when(F.col("_key") == k, F.col(text)) for k in classifiers}
    scored = routed.withColumns({f"_z_{k}": fn(mine[k]) for k, fn in classifiers.items()})
    if classifiers:
        rest = F.when(~F.col("_key").isin(*classifiers), F.col(text))
    else:
        rest = F.col(text)
    scored = scored.withColumn("_p", positive(rest))
    record = route(F.col("_key"), F.col("_p"), {k: F.col(f"_z_{k}") for k in classifiers})
    out = scored.withColumn("_r", record).select(*df.columns, "_r.*")
    return out.withColumn("confidence", F.greatest("score", F.lit(1.0) - F.col("score")))
