"""Centroid clustering of integer vectors by progressive search over Walsh-Hadamard coefficients.

The transform of 64 whole numbers is exact and keeps distances: squared differences of coefficients add up to
64 times the squared distance. Coefficients stand coarse to fine (by sign changes). A vector's differences to
all centroids are added up over the coarsest coefficients first; the centroid that then leads is measured in
full, and every centroid whose partial sum already exceeds the best full distance is out. The others go on to
the next finer coefficients; who is left has all 64 summed. Only strictly worse centroids go, so ties stay.

Each round is one scan: tasks assign their vectors and give sums of coefficients per cluster, which add up to
one row per cluster and limb. The sums of components follow by the inverse transform. No vector is shuffled.

Defined results: vectors that are null, not of 64 components, or with a null or non-finite one are left out;
repeated rows and rows with equal or null ids count each (a null id is the text `2:`; ties start in order of
their coefficients); with fewer vectors than centroids there are fewer centroids; no vectors, no rows. Components
of any size are computed exactly (as Python integers from WIDE on); a distance or sum that 64 bits can't hold
is null. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.llm.common import field, stage

SIZE = 64
ENDS = (8, 16, 32, 64)  # a step of the search sums the coefficients up to here
SCALE = 256
WIDE = 1 << 20  # components below it keep all sums of one vector within 64 bits, and coefficients within 32
LIMB = 20  # bits
ROWS = 1024  # vectors searched at a time


def _order() -> np.ndarray:
    """Walsh functions of the natural order, from few sign changes to many."""
    signs = transform(np.eye(SIZE, dtype=np.int64), np.arange(SIZE))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def transform(rows: np.ndarray, order: np.ndarray | None = None) -> np.ndarray:
    """Coefficients of each row, coarse to fine, by additions and subtractions only."""
    out = rows.copy()
    half = 1
    while half < SIZE:
        pairs = out.reshape(len(out), SIZE // (2 * half), 2, half)
        out = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(len(out), SIZE)
        half *= 2
    return out[:, ORDER if order is None else order]


def inverse(coefficients: np.ndarray) -> np.ndarray:
    """The rows again; exact, as the transform is its own inverse but for the factor 64."""
    back = np.empty_like(coefficients)
    back[:, ORDER] = coefficients
    return transform(back, np.arange(SIZE)) // SIZE


ORDER = _order()


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smallest of several) and the squared distance, both from coefficients."""
    n = len(rows)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, rows.dtype)
    row, centroid = np.divmod(np.arange(n * len(centroids)), len(centroids))
    partial = np.zeros(len(row), rows.dtype)
    best = None
    begin = 0
    for end in ENDS:
        partial = partial + ((rows[row, begin:end] - centroids[centroid, begin:end]) ** 2).sum(axis=1)
        begin = end
        if end == SIZE:
            break
        # Pairs stand row by row; the leader of a row is its first smallest partial sum.
        starts = np.searchsorted(row, np.arange(n))
        low = np.minimum.reduceat(partial, starts)
        leads = np.flatnonzero(partial == low[row])
        leads = leads[np.searchsorted(row[leads], np.arange(n))]
        full = ((rows - centroids[centroid[leads]]) ** 2).sum(axis=1)
        best = full if best is None else np.minimum(best, full)
        stays = (partial <= best[row]).astype(bool)
        row, centroid, partial = row[stays], centroid[stays], partial[stays]
    starts = np.searchsorted(row, np.arange(n))
    low = np.minimum.reduceat(partial, starts)
    first = np.flatnonzero(partial == low[row])
    first = first[np.searchsorted(row[first], np.arange(n))]
    return centroid[first], low // SIZE


def quantise(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """floor(SCALE * x) as 64-bit integers, and which rows hold a component too large for that (theirs are 0)."""
    wide = (np.abs(values) >= WIDE / SCALE).any(axis=1)
    return np.floor(np.where(wide[:, None], 0.0, values) * SCALE).astype(np.int64), wide


def whole(x: float) -> int:
    """floor(SCALE * x) for any finite double."""
    above, below = float(x).as_integer_ratio()
    return SCALE * above // below


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
        ints, wide = quantise(values)
        ends = np.concatenate([[0], np.cumsum(np.where(wide, 0, SIZE))])
        offsets = pa.array(ends, pa.int32(), mask=np.append(wide, False))
        coefficients = pa.ListArray.from_arrays(offsets, pa.array(transform(ints[~wide]).astype("i4").ravel()))
        large = [None] * len(values)
        for i in np.flatnonzero(wide):
            exact = transform(np.array([[whole(x) for x in values[i]]], dtype=object))[0]
            large[i] = [str(c) for c in exact]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), coefficients, pa.array(large, pa.list_(pa.string()))], names=["vec_id", "coefficients", "large"]
        )


def prepare(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, coefficients, large): the kept vectors' coefficients; those of wide vectors as decimal text."""
    kept = df.select(field(df, key, "bigint").alias("vec_id"), field(df, vector, "array<double>").alias("vector")).where(
        (F.size("vector") == SIZE) & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is greater
    )
    return kept.mapInArrow(_prepare, "vec_id long, coefficients array<int>, large array<string>")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, coefficients) in blocks of one kind of integer."""
    narrow = batch.column("coefficients")
    known = np.flatnonzero(np.asarray(narrow.is_valid()))
    flat = narrow.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, SIZE)  # nulls add nothing
    for at in range(0, len(known), ROWS):
        yield known[at : at + ROWS], flat[at : at + ROWS]
    large = batch.column("large")
    wide = np.flatnonzero(np.asarray(large.is_valid()))
    for i in wide:
        yield np.array([i]), np.array([[int(c) for c in large[int(i)].as_py()]], dtype=object)


def assign(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(places, coefficients, clusters, distances) of a batch's vectors."""
    small = max(int(abs(centroids).max()), 0) < SIZE * WIDE
    for places, rows in _blocks(batch):
        if rows.dtype == object or not small:
            rows = rows.astype(object)
            yield places, rows, *nearest(rows, centroids)
        else:
            yield places, rows, *nearest(rows, centroids.astype(np.int64))


def _limbs(value: int) -> list[int]:
    """Signed limbs, lowest first; a single one for what is added up in 64 bits."""
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    while rest:
        out.append(sign * (rest & ((1 << LIMB) - 1)))
        rest >>= LIMB
    return out


def cluster_sums(prepared: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, sums of coefficients) per cluster, as exact integers: at most a row per cluster and limb is collected."""
    shared = prepared.sparkSession.sparkContext.broadcast(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            counts = np.zeros(len(own), np.int64)
            totals = np.zeros((len(own), SIZE), np.int64)
            large = np.zeros((len(own), SIZE), object)
            for _, rows, clusters, _ in assign(batch, own):
                np.add.at(counts, clusters, 1)
                np.add.at(large if rows.dtype == object else totals, clusters, rows)
            out = [(int(c), 0, int(counts[c]), totals[c].tolist()) for c in np.flatnonzero(counts)]
            for c in np.flatnonzero((large != 0).any(axis=1)):
                limbs = [_limbs(v) for v in large[c]]
                out += [(int(c), n, 0, [v[n] if n < len(v) else 0 for v in limbs]) for n in range(max(map(len, limbs)))]
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.list_(pa.int64()))],
                names=["cluster", "limb", "n", "sums"],
            )

    parts = prepared.mapInArrow(work, "cluster int, limb int, n long, sums array<long>")
    added = parts.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(SIZE)]).alias("sums"))
    counts, totals = np.zeros(len(centroids), object), np.zeros((len(centroids), SIZE), object)
    for r in added.collect():
        counts[r["cluster"]] += r["n"]
        totals[r["cluster"]] += np.array([int(v) << (LIMB * r["limb"]) if v >= 0 else -(int(-v) << (LIMB * r["limb"])) for v in r["sums"]], dtype=object)
    return counts, totals


def first_centroids(prepared: DataFrame, k: int, salt: str = "2") -> np.ndarray:
    """Coefficients of the `k` vectors with the smallest hash of their id."""
    hashed = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = prepared.orderBy(hashed, "coefficients", "large").limit(k).collect()
    return np.array([[int(c) for c in r["coefficients"] or r["large"]] for r in chosen], dtype=object).reshape(len(chosen), SIZE)


def cluster_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    spark = df.sparkSession
    prepared = stage(prepare(df, key, vector), "coefficients")
    centroids = first_centroids(prepared, k)
    for _ in range(rounds if len(centroids) else 0):
        counts, totals = cluster_sums(prepared, centroids)
        sums = inverse(totals)
        moved = [sums[c] // counts[c] if counts[c] else inverse(centroids[c : c + 1])[0] for c in range(len(centroids))]
        centroids = transform(np.array(moved, dtype=object))
    shared = spark.sparkContext.broadcast(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters, distances = np.zeros(batch.num_rows, np.int32), [None] * batch.num_rows
            for places, _, found, away in assign(batch, shared.value):
                clusters[places] = found
                for place, d in zip(places.tolist(), away.tolist()):
                    distances[place] = d if d < 1 << 63 else None
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(clusters), pa.array(distances, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    placed = stage(prepared.mapInArrow(work, "vec_id long, cluster int, distance long"), "clusters")
    # One row per cluster; a distance that isn't known makes its sums unknown.
    whole_sum = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    own = placed.groupBy("cluster").agg(whole_sum.alias("cluster_inertia")).collect()
    total = None if any(r["cluster_inertia"] is None for r in own) else sum(int(r["cluster_inertia"]) for r in own)
    fits = lambda v: None if v is None or v >= 1 << 63 else int(v)
    digests = [hashlib.sha256(",".join(str(v) for v in row).encode()).hexdigest() for row in inverse(centroids)] if len(centroids) else []
    facts = [(r["cluster"], fits(r["cluster_inertia"]), fits(total), digests[r["cluster"]]) for r in own]
    said = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(said), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
