"""Profiling: nulls, describe, rates, quantile summaries, correlations, histograms, boxes, buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.operators.joins import parent_join
from mentidero.operators.quantiles import copied, exact_quantiles, exact_quantiles_by
from mentidero.session import scratch_dir
from mentidero.sources.lake import materialize

Cuts = Mapping[str, Mapping[float, float | None]]
QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5
START = 64  # characters of a value that order ties before whole values are looked at


def _rows(columns: Sequence[Column]) -> Column:
    return F.inline(F.array(*columns))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "nulls")


def column_info(df: DataFrame) -> DataFrame:
    """Column, type and non-null count, one scan."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    return counted.select(
        _rows(
            [
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column"),
                    F.lit(f.dataType.simpleString()).alias("type"),
                    F.col(f.name).alias("non_null"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
    )


def without_nan(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NaN is no value to any numeric profile: it becomes null."""
    floats = [f.name for f in df.schema.fields if f.name in columns and f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def quantile_cuts(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> Cuts:
    """Exact quantiles by column and share, for several of the tables below from one selection."""
    return {c: dict(zip(wanted[c], values)) for c, values in exact_quantiles(df, wanted).items()}


def _picked(df: DataFrame, wanted: Mapping[str, Sequence[float]], cuts: Cuts | None) -> dict[str, list[float | None]]:
    known = quantile_cuts(df, wanted) if cuts is None else cuts
    return {c: [known[c][p] for p in probs] for c, probs in wanted.items()}


def describe_numeric(df: DataFrame, columns: Sequence[str], cuts: Cuts | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per column."""
    df = without_nan(df, columns)
    cuts = _picked(df, {c: QUARTILES for c in columns}, cuts)
    parts = []
    for c in columns:
        parts += [
            F.count(c).alias(f"{c}_count"),
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).cast("double").alias(f"{c}_min"),
            F.max(c).cast("double").alias(f"{c}_max"),
        ]
    summary = df.agg(*parts)
    return summary.select(
        _rows(
            [
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"{c}_count").alias("count"),
                    F.col(f"{c}_mean").alias("mean"),
                    F.col(f"{c}_std").alias("std"),
                    F.col(f"{c}_min").alias("min"),
                    *[F.lit(q).cast("double").alias(n) for q, n in zip(cuts[c], ("p25", "p50", "p75"))],
                    F.col(f"{c}_max").alias("max"),
                )
                for c in columns
            ]
        )
    )


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (the smallest of several) and its count, per column.

    Values are counted by digest next to their first characters, so whole texts never move. A second scan looks
    only at values that tie for the top and begin like the smallest of them.
    """
    texts = {c: F.col(c).cast("string") for c in columns}
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.md5(t).alias("key"), F.substring(t, 1, START).alias("start")) for c, t in texts.items()
    ])))
    counted = long.where(F.col("key").isNotNull()).groupBy("column", "key", "start").agg(F.count("*").alias("n"))
    counted = materialize(counted, scratch_dir(df.sparkSession, "value-counts"))
    # Most frequent first, then what begins smallest: the minimum of (-n, start).
    top = F.min(F.struct((-F.col("n")).alias("neg"), "start")).alias("top")
    rows = counted.groupBy("column").agg(F.sum("n").alias("n"), F.count("*").alias("keys"), top).collect()
    found = {r["column"]: r for r in rows}  # one row per column
    leads = lambda c, start: F.lit(False) if c not in found else start == F.lit(found[c]["top"]["start"])
    tied = F.lit(False)
    for c in found:
        tied = tied | ((F.col("column") == c) & (F.col("n") == -found[c]["top"]["neg"]) & leads(c, F.col("start")))
    shown = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.when(leads(c, F.substring(t, 1, START)), t).alias("value")) for c, t in texts.items()
    ]))).where(F.col("value").isNotNull())
    winners = shown.withColumn("key", F.md5("value")).join(counted.where(tied).select("column", "key"), ["column", "key"])
    winners = {r["column"]: r["value"] for r in winners.groupBy("column").agg(F.min("value").alias("value")).collect()}
    out = [
        (c, found[c]["n"], found[c]["keys"], winners[c], -found[c]["top"]["neg"]) if c in found else (c, 0, 0, None, None) for c in columns
    ]
    return df.sparkSession.createDataFrame(out, "column STRING, count BIGINT, unique BIGINT, top STRING, freq BIGINT")


def rates(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Share of rows for which each condition holds; an unknown condition counts as not holding."""
    shares = df.agg(
        *[F.avg(F.coalesce(cond, F.lit(False)).cast("int")).alias(name) for name, cond in flags.items()]
    )
    return shares.unpivot([], list(flags), "feature", "proportion")


def retention(df: DataFrame, keep: Column) -> DataFrame:
    """Rows before and after a filter and the retained share, one scan."""
    kept = F.count_if(keep)
    total = F.count("*")
    return df.agg(
        total.alias("total_rows"), kept.alias("kept_rows"),
        F.when(total > 0, kept / total).alias("retained"),
    )


def quantile_table(df: DataFrame, wanted: Mapping[str, Sequence[float]], cuts: Cuts | None = None) -> DataFrame:
    cuts = _picked(df, wanted, cuts)
    rows = [(c, float(p), v) for c, ps in wanted.items() for p, v in zip(ps, cuts[c])]
    return df.sparkSession.createDataFrame(rows, "column STRING, prob DOUBLE, value DOUBLE")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, one scan, long form (both orders and the diagonal)."""
    df = without_nan(df, columns)
    pairs = list(combinations_with_replacement(columns, 2))
    counted = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}~{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        for left, right in {(a, b), (b, a)}:
            cells.append(
                F.struct(F.lit(left).alias("col_a"), F.lit(right).alias("col_b"), F.col(f"{a}~{b}").alias("corr"))
            )
    return counted.select(_rows(cells))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class; the total is summed over the counted classes."""
    counted = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select(label, "n", (F.col("n") / total).alias("share"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values on more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        (F.count("*") == F.count_distinct(key)).alias("is_unique"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """The finest histogram: one bin per value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over the column's range; the last bin is closed. Empty bins are left out."""
    df = without_nan(df, [column])
    x = F.col(column).cast("double")
    edge = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("e")).scalar()
    placed = df.where(x.isNotNull()).select(x.alias("x"), edge.alias("e"))
    lo, hi = F.col("e.lo"), F.col("e.hi")
    width = (hi - lo) / F.lit(bins)
    spot = F.when(hi > lo, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (
        placed.select(spot.cast("int").alias("bin"), lo.alias("lo"), width.alias("width"))
        .groupBy("bin", "lo", "width")
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_low"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
            "n",
        )
    )


def box_stats(df: DataFrame, column: str, cuts: Cuts | None = None) -> DataFrame:
    """Quartiles, whisker ends (last values within 1.5 IQR of the box), min, max, outlier count."""
    df = without_nan(df, [column])
    q1, q2, q3 = _picked(df, {column: QUARTILES}, cuts)[column]
    x = F.col(column).cast("double")
    box = {"q1": q1, "median": q2, "q3": q3}
    named = {k: F.lit(v).cast("double") for k, v in box.items()}
    inside = _in_fences(x, named["q1"], named["q3"])
    return df.where(x.isNotNull()).agg(
        F.count("*").alias("n"),
        F.min(x).alias("min"),
        *[v.alias(k) for k, v in named.items()],
        F.max(x).alias("max"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def _in_fences(x: Column, q1: Column, q3: Column) -> Column:
    reach = F.lit(WHISKER) * (q3 - q1)
    return (x >= q1 - reach) & (x <= q3 + reach)


def box_stats_by(df: DataFrame, group: str, column: str) -> DataFrame:
    """Box statistics per group; rows meet their group's quartiles, copied to them unless the groups are many, and
    combine inside each task."""
    x = F.col(column).cast("double")
    usable = df.where(F.col(group).isNotNull() & x.isNotNull() & ~F.isnan(x)).select(group, x.alias("x"))
    quart = exact_quantiles_by(usable, group, "x", QUARTILES).select(
        group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    quart = materialize(quart, scratch_dir(df.sparkSession, "quartiles"))
    quart = copied(quart, quart.count())
    inside = _in_fences(F.col("x"), F.col("q1"), F.col("q3"))
    return (
        parent_join(usable, quart, group, "inner")
        .groupBy(group)
        .agg(
            F.count("*").alias("n"),
            F.min("x").alias("min"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.max("x").alias("max"),
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def quartile_bucket(df: DataFrame, column: str, name: str = "bucket", cuts: Cuts | None = None) -> DataFrame:
    """Q1..Q4 by the quartiles of the column; right ends closed, the minimum falls into Q1."""
    q1, q2, q3 = (F.lit(v) for v in _picked(df, {column: QUARTILES}, cuts)[column])
    x = F.col(column)
    bucket = F.when(x <= q1, "Q1").when(x <= q2, "Q2").when(x <= q3, "Q3").when(x.isNotNull(), "Q4")
    return df.withColumn(name, bucket)


def kth_row(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The row at zero-based place k of an ordering; k is a small report position."""
    return df.orderBy(*order).offset(k).limit(1)


def head(df: DataFrame, order: Sequence[Column], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
