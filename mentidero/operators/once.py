"""Evaluating a costly expression once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add or replace a column whose later filters must not repeat its expression.

    A filter on a projected column is pushed below the projection together with the expression, which
    then runs for the filter and again for the output (twice through Python for a UDF). Filters on a
    generated column stay above the generator. One element per array: rows neither vanish nor multiply.
    """
    held = "_once"
    rest = [c for c in df.columns if c != name]
    generated = df.select("*", F.explode(F.array(value)).alias(held))
    order = df.columns if name in df.columns else [*rest, name]
    return generated.select(*[F.col(held).alias(c) if c == name else F.col(c) for c in order])
