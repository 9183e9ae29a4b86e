"""Parquet tables: date-partitioned bronze, whole-table scans, splits, versioned silver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentidero.functions.clock import date_parts

DATE_COLUMNS = ("YYYY", "MM", "DD")


def with_date_parts(df: DataFrame, created_column: str) -> DataFrame:
    return df.withColumns(date_parts(F.col(created_column)))


def write_by_date(df: DataFrame, root: str, created_column: str, batches: Sequence[str] = ()) -> None:
    """Replace the whole slices of the batches in `df`, and of `batches`, of a table laid out by batch and calendar
    day: a day that a batch no longer has goes too, and so does all of a named batch that has no rows any more.

    The day parts come from the numeric creation time; rows without one land in the default folder.

    `rebalance` gathers a day's rows into few files, and the runtime re-planner splits a day
    that is too large for one task; a day holding a third of the batch stays parallel.
    """
    dated = with_date_parts(df, created_column)
    for batch in _batches(df, batches):
        (
            dated.where(F.col("batch_ts").eqNullSafe(F.lit(batch)))
            .drop("batch_ts")
            .hint("rebalance", *DATE_COLUMNS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*DATE_COLUMNS)
            .parquet(f"{root}/batch_ts={batch}")
        )


def write_batch(df: DataFrame, root: str, batches: Sequence[str] = ()) -> None:
    """Replace the slices of the batches in `df`, and of `batches`, of a table without a calendar layout."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_ts").parquet(root)
    if batches:
        landed = {r.batch_ts for r in df.where(F.col("batch_ts").isin(list(batches))).select("batch_ts").distinct().collect()}
        for gone in sorted(set(batches) - landed):
            none = df.drop("batch_ts").limit(0)
            none.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/batch_ts={gone}")


def _batches(df: DataFrame, named: Sequence[str]) -> list[str]:
    """One per landed batch. A single named batch is known to be all there is, so its rows aren't read for it."""
    if len(named) == 1:
        return list(named)
    return sorted({*named, *(r.batch_ts for r in df.select("batch_ts").distinct().collect())}, key=str)


def read_batches(spark: SparkSession, root: str, schema: StructType, dated: bool = False) -> DataFrame:
    """All batches of a bronze table; batch and day columns come from the folder names.

    A table without any file yet gives no rows, not an error.
    """
    parts = "batch_ts STRING, YYYY INT, MM INT, DD INT" if dated else "batch_ts STRING"
    full = StructType(schema.fields + StructType.fromDDL(parts).fields)
    return or_empty(lambda: spark.read.schema(full).parquet(root), spark, full)


def or_empty(read: Callable[[], DataFrame], spark: SparkSession, schema: StructType) -> DataFrame:
    """The table, or a typed empty one when its folder does not exist yet."""
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed table without rows, for an entity that has not landed yet."""
    return spark.createDataFrame([], schema)


def union_batches(*batches: DataFrame) -> DataFrame:
    """Union by name; a column missing from a batch is null there, drifting types widen to text."""
    kinds: dict[str, set[str]] = {}
    for batch in batches:
        for field in batch.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    drifting = [name for name, seen in kinds.items() if _drifts(seen)]
    out = None
    for batch in batches:
        texts = {c: F.col(c).cast("string") for c in drifting if c in batch.columns}
        aligned = batch.withColumns(texts) if texts else batch
        out = aligned if out is None else out.unionByName(aligned, allowMissingColumns=True)
    return out


def _drifts(seen: set[str]) -> bool:
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    real = seen - {"void"}
    return len(real) > 1 and not real <= numeric


def write_splits(df: DataFrame, root: str) -> None:
    """One table for all splits; reading one split touches only its folder."""
    df.hint("rebalance", "split").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("split").parquet(root)


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    return spark.read.parquet(root).where(F.col("split") == split)


def write_version(df: DataFrame, root: str, name: str, version: str) -> str:
    """Write a silver table into its own version folder, so no reader's input is overwritten."""
    path = f"{root}/{name}/version={version}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a stage table and read it back: cuts the plan and survives lost executors."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
