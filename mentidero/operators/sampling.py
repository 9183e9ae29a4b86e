"""Exact-size seeded samples and stratified splits without a global sort.

Every row gets a uniform 60-bit hash of its id. Counts by the leading hash bits tell in which slice a wanted
row count is reached; that slice is counted by its next bits, until it holds few rows, which are ranked. All
strata are refined together, so rounds depend on the largest one's size only (12 bits each). What comes out is
one (hash, id) boundary per cut and stratum: a table beside the rows, which meet it in a join that Spark
broadcasts while it is small. The cut is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentidero.functions.keys import RANK_BITS, hash_rank
from mentidero.session import scratch_dir
from mentidero.sources.lake import materialize

BITS = 12  # per round: 2^BITS counts per slice
RANKED = 4096  # rows of a slice that are ranked instead of counted again


def allocate(counts: dict[object, int], total: int) -> dict[object, int]:
    """Share `total` among strata in proportion to their counts, by largest remainder."""
    n = sum(counts.values())
    if n == 0:
        return {k: 0 for k in counts}
    exact = {k: c * total / n for k, c in counts.items()}
    out = {k: math.floor(v) for k, v in exact.items()}
    by_remainder = sorted(counts, key=lambda k: (-(exact[k] - out[k]), k is not None, str(k)))
    for k in by_remainder[: total - sum(out.values())]:
        out[k] += 1
    return out


def split_sizes(counts: dict[object, int], holdout: float = 0.30, test_share: float = 0.50) -> dict[object, tuple[int, int, int]]:
    """(train, val, test) rows per stratum. Held-out parts are rounded up, as the reference flow does."""
    n = sum(counts.values())
    temp_total = math.ceil(holdout * n)
    train = allocate(counts, n - temp_total)
    temp = {k: counts[k] - train[k] for k in counts}
    val = allocate(temp, temp_total - math.ceil(test_share * temp_total))
    return {k: (train[k], val[k], temp[k] - val[k]) for k in counts}


def boundaries(
    df: DataFrame, row_id: str, seed: int, cuts: dict[object, list[int]], stratum: str | None = None, bits: int = BITS, ranked: int = RANKED
) -> DataFrame:
    """(stratum, cut, rank, row_id): for each stratum and each of its row counts `k` above 0 (the `cut`-th of the
    list) the k-th smallest (hash, id). The ids are unique; of `cuts` the driver holds a row per class."""
    spark = df.sparkSession
    part = F.col(stratum) if stratum else F.lit(None).cast("int")
    keyed = _stage(df.select(
        part.alias("stratum"), F.col(row_id).cast("string").alias("row_id"), hash_rank(seed, F.col(row_id)).alias("rank")
    ), "ranks")
    kind = df.schema[stratum].dataType.simpleString() if stratum else "int"
    asked = [(s, i, k, 0) for s, ks in cuts.items() for i, k in enumerate(ks) if k > 0]
    state = _stage(spark.createDataFrame(asked, f"s {kind}, cut INT, nth BIGINT, slice BIGINT"), "slices")
    depth = 0
    while depth < RANK_BITS:
        finer = min(depth + bits, RANK_BITS)
        state = _stage(_refine(keyed, state, depth, finer), "slices")
        depth = finer
        if (state.agg(F.max("rows")).first()[0] or 0) <= ranked:
            break
    slices = state.select("s", "slice").distinct()
    held = keyed.withColumn("at", F.shiftright("rank", RANK_BITS - depth))
    inside = held.join(slices, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("at") == F.col("slice")), "left_semi")
    placed = inside.withColumn("place", F.row_number().over(Window.partitionBy("stratum", "at").orderBy("rank", "row_id")))
    met = placed.join(state, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("at") == F.col("slice")) & (F.col("place") == F.col("nth")))
    return _stage(met.select("stratum", "cut", "rank", "row_id"), "boundaries")


def _stage(df: DataFrame, purpose: str) -> DataFrame:
    return materialize(df, scratch_dir(df.sparkSession, purpose))


def _refine(keyed: DataFrame, state: DataFrame, depth: int, finer: int) -> DataFrame:
    """For every wanted row its slice by `finer` leading bits, its place there and the slice's rows."""
    slices = state.select("s", "slice").distinct()
    before = F.shiftright("rank", RANK_BITS - depth)
    inside = keyed.join(slices, F.col("stratum").eqNullSafe(F.col("s")) & (before == F.col("slice")), "left_semi")
    counted = inside.groupBy("stratum", before.alias("outer"), F.shiftright("rank", RANK_BITS - finer).alias("inner")).agg(F.count("*").alias("rows"))
    running = Window.partitionBy("stratum", "outer").orderBy("inner").rowsBetween(Window.unboundedPreceding, 0)  # 2^BITS rows
    totals = counted.withColumn("upto", F.sum("rows").over(running))
    hit = (F.col("nth") > F.col("upto") - F.col("rows")) & (F.col("nth") <= F.col("upto"))
    wanted = state.select("s", "cut", "nth", "slice")
    met = totals.join(wanted, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("outer") == F.col("slice")) & hit)
    return met.select("s", "cut", (F.col("nth") - F.col("upto") + F.col("rows")).alias("nth"), F.col("inner").alias("slice"), "rows")


def _within(row_id: str, seed: int, cut_rank: Column, cut_id: Column) -> Column:
    """Whether a row is at or before the cut; not, where there is none."""
    rank, ident = hash_rank(seed, F.col(row_id)), F.col(row_id).cast("string")
    return F.coalesce((rank < cut_rank) | ((rank == cut_rank) & (ident <= cut_id)), F.lit(False))


def sample_exact(df: DataFrame, row_id: str, fraction: float, seed: int = 42) -> DataFrame:
    """Exactly int(n * fraction) rows without replacement, by unique id; 1 or more keeps all."""
    if fraction >= 1.0:
        return df
    size = int(df.count() * fraction)
    cut = boundaries(df, row_id, seed, {None: [size]}).first() if size else None
    return df.where(_within(row_id, seed, F.lit(cut["rank"]), F.lit(cut["row_id"])) if cut else F.lit(False))


def stratified_split(df: DataFrame, row_id: str, stratum: str, seed: int = 42) -> DataFrame:
    """Add `split` (train, val, test): 70/15/15, class shares kept, sizes exact. Ids are unique.

    Within a stratum, rows in hash order go to test first, then val, then train. The driver shares the sizes
    among the classes: one row per class.
    """
    counts = {r[stratum]: r["n"] for r in df.groupBy(stratum).agg(F.count("*").alias("n")).collect()}
    sizes = split_sizes(dict(sorted(counts.items(), key=lambda kv: (kv[0] is not None, str(kv[0])))))
    marks = boundaries(df, row_id, seed, {s: [test, test + val] for s, (_, val, test) in sizes.items()}, stratum)
    end = lambda cut, name: F.max(F.when(F.col("cut") == cut, F.col(name)))
    ends = marks.groupBy(F.col("stratum").alias("_stratum")).agg(
        end(0, "rank").alias("_test_rank"), end(0, "row_id").alias("_test_id"), end(1, "rank").alias("_val_rank"), end(1, "row_id").alias("_val_id")
    )
    ends = _stage(ends, "ends")
    met = df.join(ends, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    split = F.when(_within(row_id, seed, F.col("_test_rank"), F.col("_test_id")), F.lit("test"))
    split = split.when(_within(row_id, seed, F.col("_val_rank"), F.col("_val_id")), F.lit("val")).otherwise(F.lit("train"))
    return met.select(*df.columns, split.alias("split"))
