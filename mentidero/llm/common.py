"""Small helpers the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentidero.functions.arrow import give_back  # noqa: F401 - for the operators
from mentidero.session import scratch_dir
from mentidero.sources.lake import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field(df: DataFrame, name: str, kind: str) -> Column:
    """A column by name and type; a typed null where the table has none."""
    return (F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name)


def narrow(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, typed. Whatever else the table carries can't clash with new names."""
    return df.select(*[field(df, name, kind) for name, kind in kinds.items()])


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write under the shared folder and read back: cuts the lineage, survives lost executors."""
    return materialize(df, scratch_dir(df.sparkSession, purpose))


ROWS_PER_FILE = 200_000


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """Deal a narrow table of at most about `rows` rows to as many files as it needs.

    A shuffled table of a few thousand rows otherwise comes as one file per shuffle partition. Dealt anew, not
    coalesced: a task over many partitions of a join would hold the sort buffers of all of them.
    """
    return df.repartition(max(1, -(-rows // ROWS_PER_FILE)))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` evaluated once per row; a plain alias may be inlined many times."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
