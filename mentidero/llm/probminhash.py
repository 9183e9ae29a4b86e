"""Near duplicates by ProbMinHash of weighted word shingles, banding, and exact verification.

A text's shingles are runs of SHINGLE words (white-space separated, lower-cased), weighted by how often they
occur; a text of fewer words, but not none, is one shingle. ProbMinHash gives each shingle a Poisson process
of arrivals whose rate is its weight; an arrival falls into one of REGISTERS registers and a register keeps
its earliest. A shingle is dropped as soon as its next arrival is later than the latest register, so long
texts end after few arrivals. Two texts share a register with the probability of their probability Jaccard.

Bands of registers are buckets. A text with repeated shingles has further bands, of its shingles with weight 1,
as texts are linked by either Jaccard; a text without repeats has the same signature both ways. In each bucket every text is compared with a pivot, not with every other text;
rounds with ever more pivots follow for buckets whose texts are still in several classes, until each bucket
either lies in one class or all its texts but one class have been compared with all others. Compared pairs are
verified on the whole texts: linked from a probability Jaccard, or a plain Jaccard, of SIMILARITY.

Equal texts are one node from the start, so copies are never expanded into pairs.

Defined results: null texts are empty; texts without words have no shingles and are in a class with equal
texts only. Repeated rows and ids stay rows of their own. A class is named after its smallest doc_id (null
only if all are null). An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from mentidero.llm.classes import merge_labels
from mentidero.llm.common import few_files, give_back, narrow, stage

SHINGLE, SIMILARITY = 5, 0.8
REGISTERS, BAND = 80, 4
_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
KNOWN_WORDS = 1 << 18  # word hashes a task remembers
SKETCH_BITS, SKETCH_SIGMAS = 2048, 5  # one bit per register; a pair of exactly 0.8 fails with probability 0.000001
SHORT = 20  # texts of fewer distinct shingles are always compared whole


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) >> 1  # fits a signed integer
        return value


BATCH_BITS = 9  # a batch of texts is sorted as one array of (text number, shingle hash) in 64 bits


def shingles(texts: list[str | None], known: WordHashes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash of 55 bits, weight), sorted by both, for a batch of at most 512 texts."""
    words = [(text or "").lower().split() for text in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.array([h for ws in words for h in map(known.__getitem__, ws)], dtype=np.int64).view(np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(flat))
    padded = np.concatenate([flat, np.zeros(size, dtype=np.uint64)])
    code = np.zeros(len(flat), dtype=np.uint64)
    for step in range(size):  # words after the text's last count as 0
        code = code * _GOLDEN + np.where(left > step, padded[step : step + len(flat)], np.uint64(0))
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), counts)
    starts = left >= size
    starts[(np.cumsum(counts) - counts)[counts > 0]] = True
    shift = np.uint64(64 - BATCH_BITS)
    keys = np.sort((owner[starts] << shift) | (_mix(code[starts]) >> np.uint64(BATCH_BITS)))
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    held = keys[first]
    code = held & np.uint64((1 << (64 - BATCH_BITS)) - 1)
    return (held >> shift).astype(np.int64), code, np.diff(np.append(first, len(keys))).astype(np.float64)


def signatures(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """n x registers: the shingle whose arrival was first in each register. Texts without shingles get 0."""
    best = np.full(n * registers, np.inf)
    holder = np.zeros(n * registers, dtype=np.uint64)
    time = np.zeros(len(code))
    turn = 0
    with np.errstate(over="ignore"):
        while len(code):
            turn += 1
            draw = _mix(code + np.uint64(turn) * _GOLDEN)
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / weight
            cell = owner * registers + (_mix(draw + _GOLDEN) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(best, cell, time)
            won = time == best[cell]
            holder[cell[won]] = code[won]
            latest = best.reshape(n, registers).max(axis=1)
            alive = time < latest[owner]
            owner, code, weight, time = owner[alive], code[alive], weight[alive], time[alive]
    return holder.reshape(n, registers)


def bands(signature: np.ndarray, band: int = BAND) -> np.ndarray:
    """n x (registers / band): one 64-bit bucket per band; the band's number is part of it."""
    n, registers = signature.shape
    out = np.zeros((n, registers // band), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for step in range(band):
            out = _mix(out * _GOLDEN + signature[:, step::band] + np.arange(registers // band, dtype=np.uint64))
    return out.view(np.int64)


def sketches(owner: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """n x (SKETCH_BITS / 64) integers: one bit of the shingle in each of SKETCH_BITS registers.

    The register's number is part of the bit, so the bits of few shingles are independent, too.
    """
    with np.errstate(over="ignore"):
        turned = _mix((np.arange(SKETCH_BITS, dtype=np.uint64) + np.uint64(1)) * _GOLDEN)
        bits = (_mix(signatures(owner, code, weight, n, SKETCH_BITS) + turned) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


def _sketches_near(a: Column, b: Column, threshold: float) -> Column:
    """Whether texts of the threshold's similarity could have these sketches (weighted, then plain, in one array).

    Equal registers give equal bits, others do so half the time: a share of (1 + similarity) / 2 is expected.
    """
    share = (1 + threshold) / 2
    allowed = SKETCH_BITS * (1 - share) + SKETCH_SIGMAS * (SKETCH_BITS * share * (1 - share)) ** 0.5
    words = SKETCH_BITS // 64
    apart = [sum((F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(k * words, (k + 1) * words)), F.lit(0)) for k in (0, 1)]
    return (apart[0] <= allowed) | (apart[1] <= allowed)


def similar(a: str | None, b: str | None, threshold: float = SIMILARITY) -> bool:
    """Whether two texts have a probability Jaccard, or a plain Jaccard, of the threshold."""
    owner, code, weight = shingles([a, b], WordHashes())
    return _similar((code[owner == 0], weight[owner == 0]), (code[owner == 1], weight[owner == 1]), threshold)


def _similar(x, y, threshold: float) -> bool:
    (cx, wx), (cy, wy) = x, y
    if not len(cx) or not len(cy):
        return False
    common, ix, iy = np.intersect1d(cx, cy, assume_unique=True, return_indices=True)
    if len(common) / (len(cx) + len(cy) - len(common)) >= threshold:
        return True
    return probability_jaccard(wx, wy, ix, iy) >= threshold


def probability_jaccard(wx: np.ndarray, wy: np.ndarray, ix: np.ndarray, iy: np.ndarray) -> float:
    """Sum over common elements i of 1 / sum over all j of max(x_j / x_i, y_j / y_i).

    With the ratios r = x / y sorted, the maxima split at r_i into a sum over x and a sum over y.
    """
    px, py = wx / wx.sum(), wy / wy.sum()
    x, y = px[ix], py[iy]
    if not len(x):
        return 0.0
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    only_x, only_y = max(1 - x.sum(), 0.0), max(1 - y.sum(), 0.0)
    y_upto = np.cumsum(y)  # j with a ratio up to r_i: y_j / y_i is the larger
    x_after = x.sum() - np.cumsum(x)
    return float((1 / ((x_after + only_x) / x + (y_upto + only_y) / y)).sum())


def _unit_weights(owner: np.ndarray, code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The texts with repeated shingles, and their shingles with weight 1 (the others' weights are all 1)."""
    again = np.unique(owner[weight > 1])
    of = np.isin(owner, again)
    return again, (np.searchsorted(again, owner[of]), code[of], np.ones(of.sum()), len(again))


def text_buckets(texts: DataFrame) -> DataFrame:
    """(node, bucket): one row per band of every text with words, and per band of its unit weights if a shingle
    is repeated. `texts` has (node, text)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                owner, code, weight = shingles(part.column(1).to_pylist(), known)
                found = bands(signatures(owner, code, weight, part.num_rows))
                with_words = np.unique(owner)
                again, plain = _unit_weights(owner, code, weight)
                rows = pa.array(np.repeat(np.concatenate([with_words, again]), found.shape[1]))
                found = np.concatenate([found[with_words], bands(signatures(*plain))]) if len(again) else found[with_words]
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), pa.array(found.ravel())], names=["node", "bucket"])
            give_back()

    return texts.mapInArrow(sketch, "node binary, bucket bigint")


def verify(pairs: DataFrame, texts: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar."""

    @F.pandas_udf(BooleanType())
    def check(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = WordHashes()
        for left, right in batches:
            verdicts: list[bool] = []
            for start in range(0, len(left), 256):
                both = pd.concat([left.iloc[start : start + 256], right.iloc[start : start + 256]])
                names, distinct = pd.factorize(both)  # a pivot occurs many times
                owner, code, weight = shingles(list(distinct), known)
                cuts = np.searchsorted(owner, np.arange(len(distinct) + 1))
                sets = [(code[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:])]
                half = len(names) // 2
                verdicts += [_similar(sets[i], sets[j], threshold) for i, j in zip(names[:half], names[half:])]
            yield pd.Series(verdicts, dtype=bool)

    held = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    held = held.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return held.withColumn("alike", check("text_a", "text_b")).where("alike").select("a", "b")


def shingle_stats(texts: DataFrame) -> DataFrame:
    """Per text (node, text): n distinct shingles, `common` of them also in another of these texts, `alone` the
    share of its weight in the others, whether a shingle is `repeated`, and the sketch."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                owner, code, weight = shingles(part.column(1).to_pylist(), known)
                weighted = sketches(owner, code, weight, part.num_rows)
                plain, (again, units) = weighted.copy(), _unit_weights(owner, code, weight)
                if len(again):
                    plain[again] = sketches(*units)
                held = pa.array(list(np.hstack([weighted, plain])), type=pa.list_(pa.int64()))
                first = np.ones(len(owner), dtype=bool)
                first[1:] = owner[1:] != owner[:-1]  # a text's first row carries its sketch
                where = pa.array(owner, mask=~first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), pa.array(code.view(np.int64)), pa.array(weight.astype(np.int64)), held.take(where)],
                    names=["node", "shingle", "times", "sketch"],
                )
            give_back()

    kinds = "node binary, shingle bigint, times bigint, sketch array<bigint>"
    rows = stage(texts.select("node", "text").mapInArrow(explode, kinds), "shingles")
    met = rows.groupBy("shingle").count().where("count > 1").select("shingle", F.lit(True).alias("met"))
    numbers = rows.select("node", "shingle", "times").join(met, "shingle", "left").groupBy("node").agg(
        F.count("*").alias("n"), F.count("met").alias("common"),
        (F.sum(F.when(F.col("met").isNull(), F.col("times")).otherwise(0)) / F.sum("times")).alias("alone"),
        (F.max("times") > 1).alias("repeated"),
    )
    return numbers.join(rows.where("sketch IS NOT NULL").select("node", "sketch"), "node")


def _may_be_similar(common: Column, n_a: Column, n_b: Column, repeated: Column, alone: Column, threshold: float) -> Column:
    """Exact bounds: a text shares at most its `common` shingles, which bounds the plain Jaccard by
    common / (n_a + n_b - common). Without repeated shingles the probability Jaccard is the same number;
    else it is at most the weight outside `alone`. A small slack covers rounding."""
    plain = common * (1 + threshold) >= threshold * (n_a + n_b) - 1e-6
    return plain | (repeated & (1 - alone >= threshold - 1e-6))


def _drop_settled(open_rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Open rows with their text's shingle numbers, without the texts that can have no partner in a bucket."""
    stats = shingle_stats(texts.join(open_rows.select("node").distinct(), "node", "left_semi"))
    own = open_rows.groupBy("node").agg(F.collect_set("bucket").alias("buckets"))  # at most one per band
    rows = open_rows.join(stats.join(own, "node"), "node")
    least = rows.groupBy("bucket").agg(F.min("n").alias("least"), F.max("repeated").alias("any_repeated"))
    rows = rows.join(least, "bucket")
    partner = _may_be_similar(F.col("common"), F.col("n"), F.col("least"), F.col("any_repeated"), F.col("alone"), threshold)
    return rows.where(partner).drop("least", "any_repeated")


def link_texts(texts: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(node, label) of every text that is linked to another. `texts` has (node, text); nodes may repeat.

    Only texts that share a bucket with another are kept for verification, once each. After the first round
    the shingles of the texts still open are counted, and exact bounds on the similarity settle most of them. From
    then on a pair is looked at in the first bucket it shares: a text leaves a bucket only after it has met all others
    there or when all are of one class, so the pair is met there or needs no meeting.
    """
    every = stage(text_buckets(texts).distinct(), "bands")
    shared = every.groupBy("bucket").count().where("count > 1")
    met_rows = stage(every.join(shared, "bucket"), "shared")
    # The text with the most bucket neighbours is the best pivot: a common original is near all its copies.
    degrees = met_rows.groupBy("node").agg(F.sum("count").alias("degree"))
    open_rows = met_rows.join(degrees, "node").select("bucket", "node", "degree", F.col("node").alias("label"))
    open_rows = stage(open_rows, "buckets")
    wanted = texts.join(open_rows.select("node").distinct(), "node", "left_semi")
    texts = stage(wanted.groupBy("node").agg(F.first("text").alias("text")), "texts")
    labels = compared = None
    pivots_each = 1
    numbers = ["n", "common", "alone", "repeated", "sketch", "buckets"]
    while n_open := open_rows.count():
        known = [c for c in numbers if c in open_rows.columns]
        part = F.pmod(F.xxhash64("node", "bucket", F.lit(1)), F.lit(pivots_each))
        order = [(-F.col("degree")).alias("d"), F.xxhash64("node", "bucket").alias("h")]
        pivots = open_rows.groupBy("bucket", part.alias("part")).agg(F.min(F.struct(*order, "node", "label", *known)).alias("p"))
        pivots = pivots.select("bucket", *[F.col(f"p.{c}").alias(f"pivot_{c}") for c in ("node", "label", *known)])
        met = open_rows.join(pivots, "bucket").where("node <> pivot_node AND label <> pivot_label")
        if known:
            met = met.where(_may_be_similar(
                F.least("common", "pivot_common"), F.col("n"), F.col("pivot_n"), F.col("repeated") | F.col("pivot_repeated"),
                F.greatest("alone", "pivot_alone"), threshold,
            ) & ((F.least("n", "pivot_n") < SHORT) | _sketches_near(F.col("sketch"), F.col("pivot_sketch"), threshold)))
            # Two texts that share several buckets meet in the first of them, not once in each.
            met = met.where(F.col("bucket") == F.array_min(F.array_intersect("buckets", "pivot_buckets")))
        pairs = met.select(F.least("node", "pivot_node").alias("a"), F.greatest("node", "pivot_node").alias("b")).distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["a", "b"], "left_anti")
        pairs = stage(few_files(pairs, n_open * min(pivots_each, 8)), "pairs")
        found = stage(few_files(verify(pairs, texts, threshold), n_open), "linked")
        compared = pairs if compared is None else compared.unionByName(pairs)
        labels = merge_labels(labels, found)
        rest = open_rows.join(pivots.select("bucket", F.col("pivot_node").alias("node")), ["bucket", "node"], "left_anti")
        rest = rest.drop("label").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        rest = stage(few_files(rest.select("bucket", "node", "degree", "label", *known), n_open), "buckets")
        open_rows = stage(few_files(_unsettled(rest), n_open), "buckets")
        if pivots_each == 1 and open_rows.limit(1).count():
            bounded = stage(few_files(_drop_settled(open_rows, texts, threshold), n_open), "bounded")
            open_rows = stage(few_files(_unsettled(bounded), n_open), "buckets")
        pivots_each *= 8
    if labels is None:
        return every.select("node", F.col("node").alias("label")).limit(0)
    return labels


def _unsettled(rows: DataFrame) -> DataFrame:
    """The rows of buckets whose texts are in several classes."""
    mixed = rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return rows.join(mixed.select("bucket"), "bucket")


def near_duplicate_classes(documents: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class) and class_size, one row per document."""
    docs = narrow(documents, doc_id="bigint", text="string")
    whole = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.unhex(F.md5(whole)).alias("node"), whole.alias("text"))
    labels = link_texts(keyed.select("node", "text"), threshold)
    rows = stage(
        keyed.select("doc_id", "node").join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("label")),
        "members",
    )
    classes = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(classes, "label").select("doc_id", "class_id", "class_size")


def one_of_each_class(documents: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """The documents without near copies: of each class the row with its smallest doc_id stays, once."""
    copies = stage(near_duplicate_classes(documents, threshold).where("class_size > 1"), "classes")
    kept = copies.where("doc_id = class_id").groupBy("doc_id").count()
    dropped = copies.where("doc_id <> class_id").select("doc_id").distinct().join(kept, "doc_id", "left_anti")
    rest = documents.join(dropped, "doc_id", "left_anti").select(*documents.columns)
    repeated = kept.where("count > 1").select("doc_id")
    if not repeated.limit(1).count():
        return rest
    once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, "doc_id", "left_anti").unionByName(once).select(*documents.columns)
