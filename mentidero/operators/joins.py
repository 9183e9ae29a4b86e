"""Joins of facts to unique parent keys where one parent may own a large share of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parent_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Equi-join ("inner", "left", "left_semi" or "left_anti") of facts with one narrow row per key.

    Facts without a key match nothing and stay out of the shuffle. A key with many facts is split by the
    enabled skew-join re-planner at run time, so the parents are copied only where a key is hot, and the
    size Spark weighs for a broadcast is the true one.
    """
    matched = left.where(F.col(key).isNotNull()).join(right, key, how)
    if how in ("inner", "left_semi"):
        return matched
    return matched.unionByName(left.where(F.col(key).isNull()), allowMissingColumns=True)
