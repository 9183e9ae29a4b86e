"""Splits to trained, evaluated and compared models."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.functions.clock import artifact_stamp
from mentidero.functions.labels import binary_from_logits
from mentidero.operators import training
from mentidero.operators.embed import DIMENSIONS, apply_encoder, embed_texts, fit_encoder, save_embeddings
from mentidero.operators.evaluate import SPLITS, REGISTERED_MODEL, champion, model_compare, model_enrich
from mentidero.operators.sampling import sample_exact
from mentidero.operators.scaler import Scaler
from mentidero.operators.scoring import CLASSIFIERS
from mentidero.sources.lake import materialize

MODEL_KEYS = {key: "bert_" + name.split("/")[-1] for key, name in CLASSIFIERS.items()}
HASHED = "hashed-words"


@dataclass
class Comparison:
    results: DataFrame  # model_results, one row per model
    comparison: DataFrame  # with notes, gaps and the overfitting hint, best first
    trials: DataFrame
    summary: DataFrame  # one row
    model: PipelineModel
    scaler: Scaler
    model_path: str


def sample_splits(splits: DataFrame, fraction: float, seed: int = training.SEED) -> DataFrame:
    """Exactly int(n * fraction) rows of every split."""
    if fraction >= 1.0:
        return splits
    parts = [
        sample_exact(splits.where(F.col("split") == name), "comment_id", fraction, seed + i)
        for i, name in enumerate(("train", *SPLITS))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def train_and_compare(
    splits: DataFrame,
    out_root: str,
    run_id: str,
    now: Column,
    sample_frac: float = 1.0,
    trials: int = training.MAX_TRIALS,
    encoder: Callable | None = None,
    encoder_name: str = HASHED,
    dimensions: int = DIMENSIONS,
    classifiers: dict[str, Callable[[Column], Column]] | None = None,
) -> Comparison:
    """Sample, embed once, scale on train rows, search, fit, evaluate next to the given classifiers.

    `encoder` is a factory as in `embed_texts` (default: hashed words). `classifiers` maps a key of
    CLASSIFIERS to a text-to-logits column function; without them only the network is compared.
    """
    texts = training.training_columns(sample_splits(splits, sample_frac))
    if encoder is None:
        vectors = apply_encoder(fit_encoder(texts.where("split = 'train'"), dimensions), texts)
    else:
        vectors = embed_texts(texts, "clean_text", encoder)
    vectors = materialize(vectors, f"{out_root}/embedded")
    save_embeddings(vectors, f"{out_root}/embeddings", encoder_name, now)

    features, scaler = training.scaled_features(vectors.drop("clean_text"), "embedding")
    features = training.with_features(features).drop("embedding", "scaled")
    features = materialize(features, f"{out_root}/features")  # read by every trial
    width = len(scaler.mean)
    table, best = training.random_search(features, width, training.draw_trials(trials))
    model = training.fit_trial(features.where("split = 'train'"), width, best)
    held_out = F.col("split").isin(*SPLITS)
    predicted = training.predict(model, features.where(held_out)).select(
        F.lit(REGISTERED_MODEL).alias("model_key"), "split", "label", "prediction"
    )
    for key, logits in (classifiers or {}).items():
        guess = binary_from_logits(F.col("z"), F.lit(CLASSIFIERS[key]))
        scored = texts.where(held_out).withColumn("z", logits(F.col("clean_text")))
        predicted = predicted.unionByName(
            scored.select(F.lit(MODEL_KEYS[key]).alias("model_key"), "split", "label", guess.alias("prediction"))
        )
    results = materialize(training.model_results(predicted, run_id), f"{out_root}/model_results")
    spark = results.sparkSession
    stamp = spark.range(1).select(artifact_stamp(now)).first()[0]
    path = f"{out_root}/models/{REGISTERED_MODEL}_{stamp}"
    model.write().overwrite().save(f"{path}/network")
    scaler.save(spark, f"{path}/scaler")
    versions = spark.createDataFrame([("1",)], "version STRING")
    return Comparison(
        results, model_compare(model_enrich(results)), table, summary(results, versions), model, scaler, path
    )


def summary(results: DataFrame, versions: DataFrame) -> DataFrame:
    """One row: the champion, and the comparison table (one entry per model) as JSON."""
    ranked = F.sort_array(
        F.collect_list(F.struct("val_f1", "model_key", "run_id", "val_accuracy", "test_accuracy", "test_f1")), asc=False
    )
    table = results.agg(F.to_json(ranked)).scalar()
    return champion(results, versions).withColumn("comparison_table", table)
