"""Structured Streaming runs of the medallion steps. Each picks up the files that arrived since its
checkpoint, applies the batch transform and stops (`availableNow`)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from mentidero.operators.bronze import to_bronze
from mentidero.schemas import CREATED_COLUMN
from mentidero.sources.lake import DATE_COLUMNS, or_empty, with_date_parts
from mentidero.sources.ndjson import read_raw
from mentidero.sources.store import KeyedTable

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # keys on disk, not on the heap


def raw_stream(spark: SparkSession, path: str, entity: str) -> DataFrame:
    return read_raw(spark, path, entity, stream=True)


def table_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream of the same files as a batch read. A stream takes
    a single file by a pattern only, so the name is given as a pattern that nothing else matches."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}")


def _append(df: DataFrame, path: str, checkpoint: str, parts: tuple[str, ...] = ()) -> StreamingQuery:
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if parts:
        writer = writer.partitionBy(*parts)
    return writer.option("path", path).trigger(availableNow=True).start()


def stream_bronze(spark: SparkSession, raw_path: str, entity: str, bronze_path: str, checkpoint: str,
                  batch_ts: str) -> StreamingQuery:
    """New RAW files to bronze; the file sink's log makes every input file count once."""
    raw = raw_stream(spark, raw_path, entity)
    typed = to_bronze(raw, entity).withColumn("batch_ts", F.lit(batch_ts))
    if entity in CREATED_COLUMN:
        dated = with_date_parts(typed, CREATED_COLUMN[entity])
        return _append(dated, bronze_path, checkpoint, ("batch_ts", *DATE_COLUMNS))
    return _append(typed, bronze_path, checkpoint, ("batch_ts",))


def stream_upsert(rows: DataFrame, table: KeyedTable, checkpoint: str, order: list[str] | None = None) -> StreamingQuery:
    """Upsert each micro-batch. A batch that runs again after a failure writes the same rows again,
    which changes nothing."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()  # the upsert reads it more than once
        try:
            table.upsert(held, order)
        finally:
            held.unpersist()

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedupe_stream(rows: DataFrame, key: str, span: str) -> DataFrame:
    """Drop repeats of a key that arrive within `span`. State is one small entry per key, freed after
    the span. The watermark runs on arrival time, so no row is ever late, however old its content."""
    timed = rows.withColumn("_arrival", F.current_timestamp())
    return timed.withWatermark("_arrival", span).dropDuplicatesWithinWatermark([key]).drop("_arrival")


def stream_dedupe(rows: DataFrame, key: str, out: str, checkpoint: str, span: str) -> StreamingQuery:
    """The first row of every key. Repeats within `span` meet the keys in state (RocksDB); later ones meet the
    stored keys, read as one column. Each micro-batch owns a folder of `out`, so one that runs again replaces
    what it wrote; the folder's name holds the query's id, which a lost checkpoint changes."""
    spark, schema = rows.sparkSession, rows.schema

    def append(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = f"{query_id}-{batch_id}"
        known = read_deduped(batch.sparkSession, out, schema, keep=("piece",)).where(F.col("piece") != own)
        known = known.select(F.col(key).alias("_known"))
        new = batch.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
        new.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{out}/piece={own}")

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:  # a query keeps the provider with which it started
        writer = dedupe_stream(rows, key, span).writeStream.foreachBatch(append)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE, before)


def read_deduped(spark: SparkSession, out: str, schema: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    full = StructType(schema.fields + StructType.fromDDL("piece STRING").fields)
    return or_empty(lambda: spark.read.schema(full).parquet(out), spark, full).select(*schema.fieldNames(), *keep)


def stream_score(rows: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Score new rows with the batch scoring transform."""
    return _append(score(rows), out, checkpoint)


def read_scored(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """What `stream_score` has written; nothing if no file has arrived yet."""
    return or_empty(lambda: spark.read.schema(schema).parquet(out), spark, schema)
