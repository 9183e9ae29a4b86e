"""RAW batches: one JSON object per line, one folder per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mentidero.functions.casts import scalar_text
from mentidero.schemas import raw_schema, raw_text_schema
from mentidero.sources.lake import or_empty

BATCH_IN_NAME = r"part-(\d{8}_\d{4})"


def read_ndjson(spark: SparkSession, path: str | list[str], schema: StructType, stream: bool = False) -> DataFrame:
    reader = spark.readStream if stream else spark.read
    return (
        reader.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", "false")
        .json(path)
    )


def read_raw(spark: SparkSession, path: str | list[str], entity: str, stream: bool = False) -> DataFrame:
    """All batches of an entity, every field as text; typing happens in bronze.

    A malformed line is kept: its fields are null and `_corrupt_record` holds the line.
    """
    return read_ndjson(spark, path, raw_text_schema(entity), stream)


def read_raw_batches(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """Like `read_raw`, with `batch_ts`: from the batch folder, else from the file name."""
    schema = raw_text_schema(entity)
    dated = StructType([*schema.fields, StructField("batch_ts", StringType())])
    raw = or_empty(lambda: read_ndjson(spark, root, schema), spark, dated)
    if "batch_ts" in raw.columns:
        return raw.withColumn("batch_ts", F.col("batch_ts").cast("string"))
    return raw.withColumn("batch_ts", F.regexp_extract(F.col("_metadata.file_name"), BATCH_IN_NAME, 1))


def read_raw_typed(spark: SparkSession, path: str | list[str], entity: str) -> DataFrame:
    return read_ndjson(spark, path, raw_schema(entity))


def with_scan_order(raw: DataFrame) -> DataFrame:
    """Add `scan_pos`: file, block and line order. Must be applied right after the scan."""
    return raw.withColumn(
        "scan_pos",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ),
    )


def sanitize(df: DataFrame) -> DataFrame:
    """Scalars stay as they are; nested values become JSON text."""
    nested = {
        f.name: scalar_text(F.col(f.name), f.dataType)
        for f in df.schema.fields
        if f.dataType.typeName() in ("array", "map", "struct")
    }
    return df.withColumns(nested) if nested else df


def write_raw(df: DataFrame, root: str, batch_ts: str) -> None:
    """Write a batch untransformed. Writing the same batch again replaces it; other batches stay.

    Null fields are written out, so every line carries the full set of keys.
    """
    (
        sanitize(df)
        .withColumn("batch_ts", F.lit(batch_ts))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("batch_ts")
        .json(root)
    )
