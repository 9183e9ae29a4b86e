"""Array maths on `array<float|double>` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def softmax(logits: Column) -> Column:
    """Shifted by the maximum, so large logits do not overflow."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(powers, lambda x: x / total)


def max_probability(logits: Column) -> Column:
    """Largest softmax value: 1 / sum(exp(x - max)), without building the array."""
    top = F.array_max(logits)
    return F.lit(1.0) / F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))


def argmax(vector: Column) -> Column:
    """Zero-based place of the first maximum."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def standardize(vector: Column, mean: Sequence[float], scale: Sequence[float]) -> Column:
    centre, width = F.lit(list(mean)), F.lit(list(scale))
    shifted = F.zip_with(vector, centre, lambda x, m: x - m)
    return F.zip_with(shifted, width, lambda x, s: x / s)


def dot(vector: Column, weights: Sequence[float]) -> Column:
    products = F.zip_with(vector, F.lit(list(weights)), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
