"""Training, search and comparison of sentiment models over vector tables."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.functions.vectors import as_doubles
from mentidero.operators.evaluate import binary_metrics, evaluate_by_split
from mentidero.operators.scaler import Scaler, fit_scaler

# --- fixed values: the search space ---
HIDDEN_CHOICES = (128, 256, 512)
BATCH_CHOICES = (64, 128, 256)
ITER_CHOICES = (5, 10, 20)
ALPHA_RANGE = (1e-5, 1e-1)
RATE_RANGE = (1e-4, 5e-3)
MAX_TRIALS = 20
SEED = 42
# --- end of fixed values ---


@dataclass(frozen=True)
class Trial:
    """One point of the search space."""

    hidden: int
    alpha: float
    rate: float
    batch_size: int
    max_iter: int


def draw_trials(n: int = MAX_TRIALS, seed: int = SEED) -> list[Trial]:
    rng = random.Random(seed)

    def log_uniform(low: float, high: float) -> float:
        return math.exp(rng.uniform(math.log(low), math.log(high)))

    return [
        Trial(
            rng.choice(HIDDEN_CHOICES), log_uniform(*ALPHA_RANGE), log_uniform(*RATE_RANGE),
            rng.choice(BATCH_CHOICES), rng.choice(ITER_CHOICES),
        )
        for _ in range(n)
    ]


def training_columns(splits: DataFrame) -> DataFrame:
    return splits.select(
        F.col("comment_id").alias("id"), F.col("clean_text").cast("string"),
        F.col("sentiment").cast("int").alias("label"), "split",
    )


def scaled_features(df: DataFrame, vector: str, train_split: str = "train") -> tuple[DataFrame, Scaler]:
    """Add `scaled`: standardised with statistics of the training rows only."""
    scaler = fit_scaler(df.where(F.col("split") == train_split), vector)
    return scaler.transform(df, vector, "scaled"), scaler


def with_features(df: DataFrame) -> DataFrame:
    return df.withColumn("features", array_to_vector(as_doubles(F.col("scaled"))))


def fit_trial(train: DataFrame, width: int, trial: Trial, seed: int = SEED) -> PipelineModel:
    """MLlib's network with one hidden layer over `features`; gradients are summed across all tasks in every
    iteration. `batch_size` is the rows of a block; MLlib's solver picks its own steps and has no penalty, so `rate`
    and `alpha` are recorded but don't act."""
    mlp = MultilayerPerceptronClassifier(
        featuresCol="features", labelCol="label", layers=[width, trial.hidden, 2], maxIter=trial.max_iter,
        blockSize=trial.batch_size, seed=seed,
    )
    return Pipeline(stages=[mlp]).fit(train)


def fit_linear(train: DataFrame, trial: Trial) -> PipelineModel:
    """A deterministic baseline over `features`, with the trial's penalty."""
    linear = LogisticRegression(
        featuresCol="features", labelCol="label", regParam=trial.alpha, maxIter=trial.max_iter, standardization=False
    )
    return Pipeline(stages=[linear]).fit(train)


def predict(model: Transformer, df: DataFrame) -> DataFrame:
    """Add `prediction` (0/1) and `p_positive` with an MLlib model."""
    out = model.transform(df).drop("rawPrediction")
    return out.withColumns(
        {"p_positive": vector_to_array("probability")[1], "prediction": F.col("prediction").cast("int")}
    ).drop("probability")


def random_search(features: DataFrame, width: int, trials: list[Trial]) -> tuple[DataFrame, Trial]:
    """Fit every trial on train rows, score F1 on val rows; returns the trial table and the winner.

    `features` should be written once: every iteration and every score is a Spark job over it. The driver holds
    the trial specifications, one fitted model and two numbers a trial.
    """
    train = features.where("split = 'train'")
    val = features.where("split = 'val'")
    rows = []
    for i, trial in enumerate(trials):
        scored = binary_metrics(predict(fit_trial(train, width, trial), val), "label", "prediction").first()
        rows.append((i, trial.hidden, trial.alpha, trial.rate, trial.batch_size, trial.max_iter,
                     scored["accuracy"], scored["f1"]))
    best = max(rows, key=lambda r: (r[-1] if r[-1] is not None else -1.0, -r[0]))
    table = features.sparkSession.createDataFrame(
        rows, "trial INT, hidden INT, alpha DOUBLE, rate DOUBLE, batch_size INT, max_iter INT, "
        "val_accuracy DOUBLE, val_f1 DOUBLE",
    )
    return table, trials[best[0]]


def model_results(predictions: DataFrame, run_id: str) -> DataFrame:
    """The comparison record of each model in a table of predictions."""
    measured = evaluate_by_split(predictions)
    return measured.select(
        "model_key", F.lit(run_id).alias("run_id"), "val_accuracy", "val_f1", "test_accuracy", "test_f1"
    )
