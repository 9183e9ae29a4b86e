"""Readers and writers: NDJSON batches, date-partitioned Parquet, the keyed store."""
