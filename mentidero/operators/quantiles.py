"""Exact quantiles (linear interpolation between neighbours) by distributed selection.

All columns, or all groups of a column, are searched together and in the same way at every size. A search interval
holds the ranks still wanted in it. A round deals the values of each interval to CELLS cells and counts them, with
the least and the greatest value of each cell; the cells that hold wanted ranks are the next round's intervals. A
cell whose least value is its greatest is the answer for its ranks, so ties end a search at once. Counts combine
inside each task, and what a round returns has at most CELLS rows per interval.

Cells are equally wide in odd rounds and equally wide in the logarithm in even ones: after one of those an interval
spans few powers of two whatever the data, and each of the others cuts it by CELLS, so some 14 rounds end any search.
Even columns take two or three.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentidero.session import scratch_dir
from mentidero.sources.lake import materialize

CELLS = 1024  # per interval and round
FEW = 100_000  # rows of intervals or groups, some 8 MB, that are copied to the values instead of moving these
STATE = ("key", "lo", "hi", "below", "ranks")


def _ranks(n: int, prob: float) -> tuple[int, int, float]:
    """Neighbouring ranks of a quantile and the weight of the upper one."""
    place = prob * max(n - 1, 0)
    low = math.floor(place)
    return low, math.ceil(place), place - low


def _stage(df: DataFrame, purpose: str) -> DataFrame:
    return materialize(df, scratch_dir(df.sparkSession, purpose))


def copied(df: DataFrame, rows: int) -> DataFrame:
    """A narrow table of known length for the small side of a join. Unless it is copied, the large side is dealt by a
    key that may have three values, and a task holds and sorts a third of it."""
    return F.broadcast(df) if rows <= FEW else df


def _log_scale(x: Column) -> Column:
    """A monotone scale on which powers of two are equally far apart, zero and infinities included."""
    return F.signum(x) * (F.greatest(F.least(F.log2(F.abs(x)), F.lit(1100.0)), F.lit(-1100.0)) + 1101)


def _cell(x: Column, lo: Column, hi: Column, by_log: bool) -> Column:
    infinite = F.abs(lo).eqNullSafe(F.lit(math.inf)) | F.abs(hi).eqNullSafe(F.lit(math.inf))
    # The difference of two large values may be infinite, that of their halves not.
    even = F.when(hi - lo < math.inf, (x - lo) / (hi - lo)).otherwise((x / 2 - lo / 2) / (hi / 2 - lo / 2))
    first, last = _log_scale(lo), _log_scale(hi)
    log = F.when(x == 0, 0.0).otherwise(_log_scale(x))
    first, last = F.when(lo == 0, 0.0).otherwise(first), F.when(hi == 0, 0.0).otherwise(last)
    spread = (log - first) / (last - first)
    share = F.when((F.lit(by_log) | infinite) & (last > first), spread).otherwise(even)
    return F.greatest(F.lit(0), F.least(F.floor(share * CELLS), F.lit(CELLS - 1))).cast("int")


def _narrow(values: DataFrame, state: DataFrame, by_log: bool, rows: int) -> DataFrame:
    """The next intervals of every key, from one scan of the values; `state` has `rows` rows."""
    ends = copied(state.select(F.col("key").alias("of"), "lo", "hi"), rows)
    met = values.join(ends, F.col("key").eqNullSafe(F.col("of")) & F.col("x").between(F.col("lo"), F.col("hi")))
    placed = met.select("key", "lo", F.col("x"), _cell(F.col("x"), F.col("lo"), F.col("hi"), by_log).alias("cell"))
    counted = placed.groupBy("key", "lo", "cell").agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
    before = Window.partitionBy("key", "lo").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # at most CELLS rows
    running = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = state.select(F.col("key").alias("of"), F.col("lo").alias("at"), "below", "ranks")
    both = running.join(wanted, F.col("key").eqNullSafe(F.col("of")) & (F.col("lo") == F.col("at")))
    first = F.col("below") + F.col("before")
    cut = both.select("key", F.col("least").alias("lo"), F.col("most").alias("hi"), first.alias("below"), "n", "ranks")
    inside = F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))
    return cut.withColumn("ranks", inside).where(F.size("ranks") > 0).select(*STATE)


def order_statistics(values: DataFrame, state: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(key, rank, value) of every wanted rank. `values` has (key, x), `state` STATE, one row per key with its least
    and greatest value; `keep` holds each round's intervals, as a table or as rows on the driver."""
    found = None
    turn = 0
    while True:
        state = keep(state)
        hit = state.where("lo = hi").select("key", F.explode("ranks").alias("rank"), F.col("lo").alias("value"))
        found = hit if found is None else found.unionByName(hit)
        state = state.where("lo < hi")
        rows = state.count()
        if not rows:
            return found
        turn += 1
        state = _narrow(values, state, turn % 2 == 0, rows)


def _first_state(values: DataFrame, ranks: Column) -> DataFrame:
    ends = values.groupBy("key").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    return ends.select("key", "n", "lo", "hi", F.lit(0).cast("bigint").alias("below"), ranks.alias("ranks"))


def _known(x: Column) -> Column:
    """Nulls and NaN are no values; minus zero is zero."""
    return F.when(~F.isnan(x.cast("double")), x.cast("double") + 0.0)


def _ranks_of(n: Column, probs: Sequence[float]) -> Column:
    places = [F.lit(float(p)) * (n - 1) for p in probs]
    return F.array_distinct(F.array(*[end.cast("bigint") for place in places for end in (F.floor(place), F.ceil(place))]))


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact quantiles per numeric column; nulls and NaN are left out. Runs at once: the source is read once for a
    narrow table, which every round scans for all columns together. Rows on the driver: one per column and rank."""
    spark = df.sparkSession
    columns = list(wanted)
    wide = df.select(*[_known(F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    long = wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("key"), F.col(f"c{i}").alias("x")) for i in range(len(columns))])))
    values = _stage(long.where(F.col("x").isNotNull()), "values")
    ranks = F.array().cast("array<bigint>")
    for i, c in enumerate(columns):
        ranks = F.when(F.col("key") == i, _ranks_of(F.col("n"), wanted[c])).otherwise(ranks)
    first = _first_state(values, ranks).collect()
    counts = {r["key"]: r["n"] for r in first}
    schema = "key int, lo double, hi double, below bigint, ranks array<bigint>"
    state = spark.createDataFrame([tuple(r[c] for c in STATE) for r in first], schema)
    hits = order_statistics(values, state, lambda s: spark.createDataFrame(s.collect(), schema)).collect()
    value = {(r["key"], r["rank"]): r["value"] for r in hits}
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(columns):
        places = [_ranks(counts.get(i, 0), p) for p in wanted[c]]
        ends = [(value.get((i, low)), value.get((i, high)), part) for low, high, part in places]
        out[c] = [lo if lo is None or lo == hi else lo + (hi - lo) * part for lo, hi, part in ends]
    return out


def exact_quantiles_by(df: DataFrame, group: str, column: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of every group: columns (group, n, q) with `q` in the order of `probs`.

    All groups are refined by the same rounds, whatever their number and sizes; intervals are a table beside the
    values. Groups without a value are left out.
    """
    rows = df.select(F.col(group).alias("key"), _known(F.col(column)).alias("x"))
    values = _stage(rows.where(F.col("x").isNotNull()), "values")
    first = _stage(_first_state(values, _ranks_of(F.col("n"), probs)), "groups")
    hits = order_statistics(values, first.select(*STATE), lambda s: _stage(s, "intervals"))
    # At most two values per quantile and group.
    listed = hits.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    sizes = first.select(F.col("key").alias("of"), "n")
    both = listed.join(sizes, F.col("key").eqNullSafe(F.col("of")))
    answers = []
    for p in probs:
        place = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = (F.col("at")[end.cast("bigint")] for end in (F.floor(place), F.ceil(place)))
        answers.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place - F.floor(place))))
    return both.select(F.col("key").alias(group), "n", F.array(*answers).alias("q"))
