"""Standard scaling of vector columns with the population deviation."""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentidero.functions.vectors import as_doubles, standardize

EPS = sys.float_info.epsilon


def scaler_stats(df: DataFrame, vector: str) -> DataFrame:
    """Per dimension: mean and population deviation. One scan; the state is two arrays of one vector's
    width, combined inside each task before anything moves."""
    packed = array_to_vector(as_doubles(F.col(vector)))
    summary = df.select(packed.alias("v")).agg(
        Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s")
    )
    arrays = summary.select(
        F.col("s.count").cast("double").alias("n"),
        vector_to_array(F.col("s.mean")).alias("mean"),
        vector_to_array(F.col("s.variance")).alias("var"),
    )
    # The summary gives the sample variance.
    spread = F.transform("var", lambda v: F.sqrt(v * (F.col("n") - 1) / F.col("n")))
    zipped = F.posexplode(F.arrays_zip(F.col("mean"), spread.alias("std")))
    return arrays.select(F.col("n"), zipped.alias("dim", "m")).select(
        "dim", F.col("n").cast("bigint").alias("n"), F.col("m.mean").alias("mean"), F.col("m.std").alias("std")
    )


@dataclass(frozen=True)
class Scaler:
    mean: list[float]
    scale: list[float]

    def transform(self, df: DataFrame, vector: str, name: str = "scaled") -> DataFrame:
        return df.withColumn(name, standardize(as_doubles(F.col(vector)), self.mean, self.scale))


    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, m, s) for i, (m, s) in enumerate(zip(self.mean, self.scale))]
        spark.createDataFrame(rows, "dim INT, mean DOUBLE, scale DOUBLE").coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> Scaler:
    rows = spark.read.parquet(path).orderBy("dim").collect()
    return Scaler([r["mean"] for r in rows], [r["scale"] for r in rows])


def fit_scaler(df: DataFrame, vector: str) -> Scaler:
    """Fit on training rows only. A constant dimension gets scale 1."""
    rows = scaler_stats(df, vector).orderBy("dim").collect()  # one row per dimension
    return Scaler([r["mean"] for r in rows], [_scale(r["mean"], r["std"], r["n"]) for r in rows])


def _scale(mean: float, std: float, n: int) -> float:
    """1 where the deviation is only rounding noise around the mean."""
    variance = std * std
    noise = n * EPS * variance + (n * mean * EPS) ** 2
    return 1.0 if variance <= noise else std
