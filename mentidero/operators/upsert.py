"""Keyed merges of an incoming batch into a table, as plain DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_rejects(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and rows whose key is null (those never enter a table)."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the row with the largest `order` values per key; ties go to the largest remaining columns.

    The winner is chosen on keys and order alone: narrow rows, combined inside each task, so a key holding a third
    of all rows costs the shuffle a row per task. Whole rows then only meet the winners' keys. Those that tie on
    order are compared whole, again by an aggregate.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if not order and not rest:
        return df.distinct()
    if not order:
        return _largest(df, keys, order)
    if not rest:
        return _largest(df, keys, order)
    counted = df.groupBy(*keys, *order).agg(F.count("*").alias("_n"))
    best = counted.groupBy(*keys).agg(F.max(F.struct(*order, "_n")).alias("_best"))
    named = {c: f"_key_{i}" for i, c in enumerate(keys)}
    winners = best.select(*[F.col(c).alias(named[c]) for c in keys], "_best")
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(named[c]))
    for c in order:
        same = same & F.col(c).eqNullSafe(F.col("_best")[c])
    met = df.join(winners, same).select(*df.columns, F.col("_best")["_n"].alias("_n"))
    alone = met.where("_n = 1").drop("_n")
    return alone.unionByName(_largest(met.where("_n > 1").drop("_n"), keys, order))


def _largest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*[F.col(c) if c in keys else F.col("best")[c].alias(c) for c in df.columns])


def replace_rows(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Full-row upsert: every incoming row wins over the target row of its key.

    `incoming` has one row per key. It is the small side as a rule; Spark broadcasts its keys
    when their measured size allows and sorts and merges otherwise.
    """
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(incoming.select(*target.columns))


def insert_new(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The incoming rows whose key is not in the target."""
    return incoming.join(target.select(key), key, "left_anti").select(*incoming.columns)


def insert_ignore(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Insert-or-ignore: present rows win."""
    new = insert_new(target, one_per_key(incoming.where(F.col(key).isNotNull()), [key], []), key)
    return target.unionByName(new)
