"""Metrics of binary predictions and comparison of models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.functions.labels import overfit_signal

SPLITS = ("val", "test")
REGISTERED_MODEL = "mlp_transformer"

# --- fixed values: notes per known model ---
MODEL_NOTES = [
    # (mark in the key, exact match, family, hyper-parameters, production cost, latency)
    (
        "bert-base-multilingual-uncased-sentiment",
        False,
        "bert_sequence_classifier",
        "hf_model=nlptown/bert-base-multilingual-uncased-sentiment",
        "alto (modelo grande, multilingüe)",
        "media-alta",
    ),
    (
        "distilbert-base-uncased-finetuned-sst-2-english",
        False,
        "bert_sequence_classifier",
        "hf_model=distilbert-base-uncased-finetuned-sst-2-english",
        "medio (modelo compacto)",
        "media",
    ),
    (
        "mlp_transformer",
        True,
        "mlp_classifier + sentence_transformer",
        "ST=all-MiniLM-L6-v2, hidden=(256,), max_iter=10",
        "medio (embeddings + MLP)",
        "baja-media (si embeddings precalculados)",
    ),
]
UNKNOWN_NOTES = ("desconocido", "", "", "")
# --- end of fixed values ---


def accuracy(y: Column, p: Column) -> Column:
    return F.avg((y == p).cast("int"))


def f1(y: Column, p: Column) -> Column:
    """Binary F1 of class 1; 0 when there is nothing positive."""
    tp = F.count_if((y == 1) & (p == 1))
    wrong = F.count_if((y == 1) & (p != 1)) + F.count_if((y != 1) & (p == 1))
    return F.when(2 * tp + wrong > 0, 2 * tp / (2 * tp + wrong)).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, y: str, p: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy and F1, overall or per group; one pass of conditional counts."""
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        accuracy(F.col(y), F.col(p)).alias("accuracy"),
        f1(F.col(y), F.col(p)).alias("f1"),
    )


def evaluate_by_split(predictions: DataFrame, y: str = "label", p: str = "prediction") -> DataFrame:
    """One row per model with accuracy and F1 on val and test, one pass over all predictions."""
    measured = []
    for split in SPLITS:
        here = F.col("split") == split
        truth, guess = F.when(here, F.col(y)), F.when(here, F.col(p))
        measured += [accuracy(truth, guess).alias(f"{split}_accuracy"), f1(truth, guess).alias(f"{split}_f1")]
    return predictions.groupBy("model_key").agg(*measured)


def model_enrich(results: DataFrame) -> DataFrame:
    """Add family, hyper-parameter note, cost and latency by model key."""
    names = ("family", "hyperparams", "cost_prod", "latency_prod")
    key = F.col("model_key")
    columns = {}
    for place, name in enumerate(names):
        value: Column | None = None
        for mark, exact, *notes in MODEL_NOTES:
            cond = key == mark if exact else F.contains(key, F.lit(mark))
            value = F.when(cond, notes[place]) if value is None else value.when(cond, notes[place])
        columns[name] = value.otherwise(F.lit(UNKNOWN_NOTES[place]))
    return results.withColumns(columns)


def model_compare(results: DataFrame) -> DataFrame:
    """Val-test gaps, an overfitting hint, best first. One row per model."""
    gaps = results.withColumns(
        {
            "gap_f1_val_test": F.col("val_f1") - F.col("test_f1"),
            "gap_acc_val_test": F.col("val_accuracy") - F.col("test_accuracy"),
        }
    )
    return gaps.withColumn("signal", overfit_signal(F.col("gap_f1_val_test"))).orderBy(F.desc("val_f1"), "model_key")


def unpivot_metrics(results: DataFrame, metric: str, name: str) -> DataFrame:
    """Wide (val, test) to long, one row per model and split."""
    return results.unpivot(["model_key"], [f"{s}_{metric}" for s in SPLITS], "split", name)


def champion(results: DataFrame, versions: DataFrame) -> DataFrame:
    """Best model by val F1. A champion version, the newest one, is named only for the registered model."""
    best = results.orderBy(F.desc("val_f1"), "model_key").limit(1)
    newest = versions.agg(F.max(F.col("version").try_cast("bigint"))).scalar()
    return best.select(
        F.col("model_key").alias("best_model_key"),
        F.col("val_f1").alias("best_val_f1"),
        F.col("test_f1").alias("best_test_f1"),
        F.when(F.col("model_key") == REGISTERED_MODEL, newest).alias("champion_version"),
    )
