"""Texts to vectors, and storing vectors with their description."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from mentidero.functions.arrow import align
from mentidero.functions.clock import artifact_stamp
from mentidero.functions.keys import artifact_name

Encoder = Callable[[Sequence[str]], np.ndarray]

# --- fixed values ---
DIMENSIONS = 384
BATCH_SIZE = 32
# --- end of fixed values ---


def embed_texts(df: DataFrame, text: str, make_encoder: Callable[[], Encoder], name: str = "embedding",
                batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add vectors from a user's model. `make_encoder` runs once per task, on the worker; texts reach
    the model in batches. Null texts get null vectors. Works on tables and streams."""

    @F.pandas_udf(ArrayType(FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            known = texts.dropna()
            vectors: list[np.ndarray] = []
            for start in range(0, len(known), batch_size):
                vectors.extend(np.asarray(encoder(known.iloc[start : start + batch_size].tolist()), dtype="float32"))
            yield align(vectors, texts)

    return df.withColumn(name, encode(F.col(text)))


def default_encoder(dimensions: int = DIMENSIONS) -> Pipeline:
    """A download-free encoder: hashed word counts, weighted by rarity, unit length."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol="clean_text", outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
            IDF(inputCol="_counts", outputCol="_weighted"),
            Normalizer(inputCol="_weighted", outputCol="_unit"),
        ]
    )


def fit_encoder(train: DataFrame, dimensions: int = DIMENSIONS) -> PipelineModel:
    return default_encoder(dimensions).fit(train)


def apply_encoder(model: PipelineModel, df: DataFrame, name: str = "embedding") -> DataFrame:
    out = model.transform(df).withColumn(name, vector_to_array("_unit", "float32"))
    return out.drop("_words", "_counts", "_weighted", "_unit")


def embedding_metadata(vectors: DataFrame, model_name: str, created: Column, by: str = "split") -> DataFrame:
    """One record per split: model, shape, creation time, artifact name."""
    shape = vectors.groupBy(by).agg(
        F.count("*").alias("n"), F.min(F.size("embedding")).alias("dim"), F.max(F.size("embedding")).alias("max_dim")
    )
    return shape.select(
        F.lit(model_name).alias("model_name"),
        F.col(by).alias("split"),
        F.col("n"),
        F.when(F.col("dim") == F.col("max_dim"), F.col("dim")).alias("dim"),
        created.alias("created_utc"),
        artifact_name(F.lit(model_name), F.col(by), artifact_stamp(created)).alias("artifact"),
    )


def save_embeddings(vectors: DataFrame, root: str, model_name: str, created: Column) -> None:
    """Vectors as Parquet by split, and one description record per split next to them."""
    vectors.select("id", "split", "embedding").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("split").parquet(f"{root}/vectors")
    stored = vectors.sparkSession.read.parquet(f"{root}/vectors")
    embedding_metadata(stored, model_name, created).coalesce(1).write.mode("overwrite").json(f"{root}/metadata")
