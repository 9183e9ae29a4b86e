"""Epoch seconds and calendar parts. Zone-less timestamps: results do not depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_to_ts(seconds: Column) -> Column:
    usable = F.when(~F.isnan(seconds.cast("double")), seconds)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), usable.try_cast("decimal(18,6)"))
    return F.expr(EPOCH) + step


def ts_to_micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts.cast("timestamp_ntz"))


def ts_to_epoch(ts: Column) -> Column:
    return ts_to_micros(ts) / F.lit(1_000_000.0)


def date_parts(seconds: Column) -> dict[str, Column]:
    ts = epoch_to_ts(seconds)
    return {"YYYY": F.year(ts), "MM": F.month(ts), "DD": F.dayofmonth(ts)}


def batch_tag(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmm")


def artifact_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")
