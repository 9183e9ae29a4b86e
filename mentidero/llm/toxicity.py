"""Toxicity by a convolutional text classifier, trained in numpy and applied in Arrow batches.

A word's vector is the sum of hashed embeddings of the word and of its beginnings, so inflected forms share
most of it. Filters of several widths run over the whole text, each keeps its maximum, a linear layer and a
logistic give the probability. The first embedding dimension starts as the shrunken log odds of a cell in
toxic and clean training texts; everything is then trained by Adam.

Gradients see at most SAMPLE rows per class of those that `is_training` allows: three quarters of those with the
smallest hash of their id. Per language a threshold is calibrated on all other rows that it allows, each class
weighted to its share of all of them, and moved to PREDICT on the score's scale, so one cut serves all languages.
The language is guessed from the text's own function words. Every document is scored.

Defined results: null and empty texts get the score of no words; rows with a null label are not learnt from.
Without labelled rows of both classes every score is 0. Repeated rows are scored each; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from mentidero.llm.common import field, fresh, give_back, narrow

SAMPLE = 2500
CELLS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 16, 8, 8, (1, 2, 3), (3, 4, 5, 6)  # beginnings in bytes
EPOCHS, BATCH, RATE = 8, 64, 0.01
PREDICT = 0.7
BINS = 64  # of the thresholds' histograms, per unit of the logit
KNOWN_WORDS, CHUNK_WORDS = 100_000, 20_000  # of a worker's table (25 MB at most) and of one step
SLICE = 64  # texts of a batch that are held as Python strings
WORD = re.compile(r"\w+")
SPACED = {i: " " for i in range(128) if not WORD.match(chr(i))}  # the same words of ASCII texts by a split
# --- fixed values: frequent function words ---
FUNCTION_WORDS = {
    "en": frozenset("the of and to in is that it for was with as be on are this".split()),
    "de": frozenset("der die und das von zu mit ist im den nicht ein sich dem auf für".split()),
    "fr": frozenset("le la les et des du un une est pour dans que qui sur pas au".split()),
    "es": frozenset("el los las y que en del se por con una para al su es no".split()),
}
# --- end of fixed values ---
OTHER = "other"


def words_of(text: str | None) -> list[str]:
    lowered = (text or "").lower()
    return lowered.translate(SPACED).split() if lowered.isascii() else WORD.findall(lowered)


def language_of(words: list[str]) -> str:
    counts = {lang: sum(map(listed.__contains__, words)) for lang, listed in FUNCTION_WORDS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else OTHER


def cells_of(word: str) -> list[int]:
    """The word's cell, then those of its beginnings; a beginning as long as the word repeats its cell."""
    raw = word.encode()
    return [zlib.crc32(raw) % CELLS, *[zlib.crc32(raw[:n], 1) % CELLS for n in PREFIXES]]


# What a byte does to a CRC-32, for steps over many words at once.
CRC = np.array([zlib.crc32(bytes([i ^ 255])) ^ 0xFF000000 for i in range(256)], np.uint32)


def cells_of_all(words: list[str]) -> np.ndarray:
    """`cells_of` each word: the whole words one by one, the beginnings byte by byte over all words."""
    raws = [word.encode() for word in words]
    cells = np.empty((len(raws), 1 + len(PREFIXES)), np.int64)
    cells[:, 0] = np.fromiter(map(zlib.crc32, raws), np.int64, len(raws))
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    letters = np.array(raws, f"S{PREFIXES[-1]}").view(np.uint8).reshape(len(raws), PREFIXES[-1])
    state = np.full(len(raws), 1 ^ 0xFFFFFFFF, np.uint32)
    for at in range(PREFIXES[-1]):
        state = np.where(at < lengths, CRC[(state ^ letters[:, at]) & np.uint32(255)] ^ (state >> np.uint32(8)), state)
        if at + 1 in PREFIXES:
            cells[:, 1 + PREFIXES.index(at + 1)] = state ^ np.uint32(0xFFFFFFFF)
    return cells % CELLS


class Numbers(dict):
    """Words to numbers in the order in which they are met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Network:
    """Embeddings, filters per width (place, dimension, filter), output layer, thresholds by language."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.params = {"embed": draw.normal(0, 0.05, (CELLS, DIM)).astype("f4")}
        for width in WIDTHS:
            self.params[f"filter{width}"] = draw.normal(0, 0.3, (width, DIM, FILTERS)).astype("f4")
            self.params[f"bias{width}"] = np.zeros(FILTERS, "f4")
        self.params["out"] = draw.normal(0, 0.1, len(WIDTHS) * FILTERS).astype("f4")
        self.params["shift"] = np.zeros(1, "f4")
        self.shifts: dict[str, float] = {}

    def pooled(self, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Maxima per text of the filters; `rows` holds each word's products with every filter place."""
        pools, at = [], 0
        for width in WIDTHS:
            total = rows[:, at : at + FILTERS].copy()
            for place in range(1, width):
                total[:-place] += rows[place:, at + place * FILTERS : at + (place + 1) * FILTERS]
            at += width * FILTERS
            pools.append(np.maximum.reduceat(total, starts, axis=0) + self.params[f"bias{width}"])
        return np.maximum(np.concatenate(pools, axis=1), 0)

    def products(self, cells: np.ndarray) -> np.ndarray:
        """Each word's products with every place of every filter."""
        vectors = self.params["embed"][cells].sum(axis=1)
        kernels = [self.params[f"filter{w}"].transpose(1, 0, 2).reshape(DIM, -1) for w in WIDTHS]
        return vectors @ np.concatenate(kernels, axis=1)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.params["out"] + self.params["shift"]


PAD = max(WIDTHS)  # empty words behind each text, so every filter fits and no text runs into the next


def _flatten(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, each followed by PAD times 0, and where each text starts."""
    flat = np.array([n for words in texts for n in (*words, *([0] * PAD))], dtype=np.int64)
    lengths = np.array([len(words) + PAD for words in texts])
    return flat, np.cumsum(lengths) - lengths


def train(texts: list[str], labels: list[int], seed: int = 7) -> tuple[Network | None, list[int]]:
    """Fit on three quarters of labelled texts; the network without thresholds, and the places of the texts it saw."""
    y_all = np.array(labels, dtype="f4")
    if not len(y_all) or y_all.min() == y_all.max():
        return None, []
    net, draw = Network(seed), np.random.default_rng(seed)
    numbers: dict[str, int] = {"": 0}
    docs = [words_of(t) for t in texts]
    coded = [[numbers.setdefault(w, len(numbers)) for w in words] for words in docs]
    cells = np.array([cells_of(w) for w in numbers], dtype=np.int64)
    order = draw.permutation(len(docs))
    used = order[len(order) // 4 :]

    # Log odds of a cell among the texts used, shrunken by how many texts have it.
    seen = np.zeros((2, CELLS))
    for i in used:
        seen[int(y_all[i])][np.unique(cells[coded[i]])] += 1
    totals = np.maximum([np.sum(y_all[used] == 0), np.sum(y_all[used] == 1)], 1)
    odds = np.log((seen[1] + 0.5) / (totals[1] + 1)) - np.log((seen[0] + 0.5) / (totals[0] + 1))
    both = seen.sum(axis=0)
    net.params["embed"][:, 0] = odds * both / (both + 8)
    net.params["embed"][cells[0]] = 0
    for width in WIDTHS:
        net.params[f"filter{width}"][:, 0, 0] = 0.5

    momentum = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.params.items()}
    step = 0
    for _ in range(EPOCHS):
        draw.shuffle(used)
        for begin in range(0, len(used), BATCH):
            batch = used[begin : begin + BATCH]
            grads = _gradients(net, [coded[i] for i in batch], cells, y_all[batch])
            step += 1
            for name, grad in grads.items():
                mean, square = momentum[name]
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                net.params[name] -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net, used.tolist()


def _gradients(net: Network, coded: list[list[int]], cells: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    flat, starts = _flatten(coded)
    vectors = net.params["embed"][cells[flat]].sum(axis=1)
    vectors[flat == 0] = 0
    grads = {k: np.zeros_like(v) for k, v in net.params.items()}
    pools, winners = [], []
    text_of = np.repeat(np.arange(len(coded)), np.diff(np.append(starts, len(flat))))
    for width in WIDTHS:
        total = vectors @ net.params[f"filter{width}"][0]
        for place in range(1, width):
            total[:-place] += vectors[place:] @ net.params[f"filter{width}"][place]
        best = np.maximum.reduceat(total, starts, axis=0)
        at = np.full(best.shape, -1)
        rows, columns = np.nonzero(total == best[text_of])
        at[text_of[rows[::-1]], columns[::-1]] = rows[::-1]  # the first place of each maximum
        pools.append(best + net.params[f"bias{width}"])
        winners.append(at)
    raw = np.concatenate(pools, axis=1)
    pooled = np.maximum(raw, 0)
    p = 1 / (1 + np.exp(-np.clip(net.logits(pooled), -30, 30)))
    error = ((p - y) / len(y)).astype("f4")
    grads["out"], grads["shift"] = pooled.T @ error, np.array([error.sum()], "f4")
    back = np.outer(error, net.params["out"]) * (raw > 0)
    flow = np.zeros_like(vectors)
    for number, width in enumerate(WIDTHS):
        part, at = back[:, number * FILTERS : (number + 1) * FILTERS], winners[number]
        grads[f"bias{width}"] = part.sum(axis=0)
        for place in range(width):
            where = np.minimum(at + place, len(flat) - 1)
            grads[f"filter{width}"][place] = np.einsum("tf,tfd->df", part, vectors[where])
            np.add.at(flow, where.ravel(), (part[:, :, None] * net.params[f"filter{width}"][place].T[None]).reshape(-1, DIM))
    moved = np.flatnonzero(np.abs(flow).sum(axis=1) * (flat > 0))
    for column in range(cells.shape[1]):
        np.add.at(grads["embed"], cells[flat[moved], column], flow[moved])
    return grads


def _set_shifts(net: Network, histogram: np.ndarray, langs: np.ndarray, seen: list[int]) -> None:
    """Per language the logit with the best F1, halfway to the next lower one; overall where a language has few
    rows of either class. `histogram` has rows of (bin, clean, toxic), `langs` their languages; `seen` are the
    rows per class that gradients saw and that aren't in it."""
    unseen = histogram[:, 1:].sum(axis=0)
    weights = (unseen + seen) / np.maximum(unseen, 1)

    def cut(chosen: np.ndarray) -> float:
        bins, at = np.unique(-histogram[chosen, 0], return_inverse=True)  # the highest first
        counts = np.stack([np.bincount(at, histogram[chosen, k]) for k in (1, 2)], axis=1) * weights
        hits = np.cumsum(counts[:, 1])
        best = int(np.argmax(2 * hits / (np.cumsum(counts.sum(axis=1)) + hits[-1])))
        least = -bins[best] / BINS
        low = (1 - bins[best + 1]) / BINS if best + 1 < len(bins) else least - 2
        return float((least + low) / 2)

    overall = cut(np.ones(len(histogram), dtype=bool)) if unseen[1] else 0.0
    for lang in (*FUNCTION_WORDS, OTHER):
        chosen = langs == lang
        net.shifts[lang] = cut(chosen) if histogram[chosen, 1:].sum(axis=0).min() >= 10 else overall


class Scorer:
    """Scores batches of texts; remembers the products of words it has met."""

    def __init__(self, net: Network):
        self.net = net
        self.reset()

    def reset(self) -> None:
        self.numbers = Numbers({"": 0})
        self.table = np.zeros((1024, sum(WIDTHS) * FILTERS), "f4")
        self.languages = np.zeros((1024, len(FUNCTION_WORDS)), "i1")

    def number(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """As `_flatten`: numbers of all words, each text's followed by PAD times 0, and where each text starts."""
        if len(self.numbers) > KNOWN_WORDS:
            self.reset()
        numbers, old = self.numbers, len(self.numbers)
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        coded = np.fromiter(map(numbers.__getitem__, chain.from_iterable(docs)), np.int64, lengths.sum())
        if len(numbers) > old:
            new = list(numbers)[old:]
            if len(numbers) > len(self.table):
                grown = np.zeros((max(2 * len(self.table), len(numbers)), self.table.shape[1]), "f4")
                grown[:old] = self.table[:old]
                self.table = grown
                flags = np.zeros((len(grown), len(FUNCTION_WORDS)), "i1")
                flags[:old] = self.languages[:old]
                self.languages = flags
            self.table[old : len(numbers)] = self.net.products(cells_of_all(new))
            for column, listed in enumerate(FUNCTION_WORDS.values()):
                self.languages[[numbers[w] for w in listed if numbers.get(w, -1) >= old], column] = 1
        flat = np.zeros(len(coded) + PAD * len(docs), np.int64)
        flat[np.arange(len(coded)) + np.repeat(PAD * np.arange(len(docs)), lengths)] = coded
        return flat, np.cumsum(lengths + PAD) - lengths - PAD

    def score(self, texts: list[str | None]) -> list[float]:
        logits, langs = self.logits(texts)
        moved = logits - [self.net.shifts.get(lang, 0.0) for lang in langs] + np.log(PREDICT / (1 - PREDICT))
        return (1 / (1 + np.exp(-np.clip(moved.astype("f8"), -30, 30)))).tolist()

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
        """Logits before the thresholds, and languages."""
        logits: list[np.ndarray] = [np.zeros(0, "f4")]
        langs: list[str] = []
        docs: list[list[str]] = []
        size = 0
        for text in texts:
            docs.append(words_of(text))
            size += len(docs[-1])
            if size >= CHUNK_WORDS:
                self._chunk(docs, logits, langs)
                docs, size = [], 0
        if docs:
            self._chunk(docs, logits, langs)
        return np.concatenate(logits), langs

    def _chunk(self, docs: list[list[str]], logits: list[np.ndarray], langs: list[str]) -> None:
        flat, starts = self.number(docs)
        logits.append(self.net.logits(self.net.pooled(self.table[flat], starts)))
        seen = np.add.reduceat(self.languages[flat], starts, axis=0, dtype="i8")
        langs += np.where(seen.max(axis=1) > 0, np.array([*FUNCTION_WORDS])[seen.argmax(axis=1)], OTHER).tolist()


def is_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Train on at most `sample` labelled training rows per class, whose texts come to the driver; all others set
    the thresholds."""
    known = narrow(labels, doc_id="bigint", toxic="int").where(is_training(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for kind in (0, 1):
        part = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = narrow(documents, doc_id="bigint", text="string").join(F.broadcast(chosen), "doc_id")
    first = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id")
    got = first.collect()
    net, used = train([r.text or "" for r in got], [r.toxic for r in got])
    if net is not None:
        _calibrate(net, documents, known, [(got[i].doc_id, got[i].toxic) for i in used])
    return net


def _calibrate(net: Network, documents: DataFrame, known: DataFrame, used: list[tuple[int, int]]) -> None:
    """Set the thresholds from all rows of `known` that aren't `used`; a bounded histogram comes to the driver.

    Texts are scored where they are and only numbers are joined. Of repeated ids the lowest bin counts.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(net)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for begin in range(0, whole.num_rows, SLICE):
                batch = whole.slice(begin, SLICE)
                logits, langs = scorer.logits(batch.column("text").to_pylist())
                bins = np.floor(np.clip(logits.astype("f8"), -30, 30) * BINS).astype("i4")
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bins), pa.array(langs, pa.string())], names=["doc_id", "bin", "lang"])
            give_back()

    rows = narrow(documents, doc_id="bigint", text="string").where(is_training(F.col("doc_id")))
    unseen = known.join(F.broadcast(spark.createDataFrame([(i,) for i, _ in used], "doc_id long")), "doc_id", "left_anti")
    judged = rows.mapInArrow(judge, "doc_id long, bin int, lang string").join(unseen, "doc_id")
    once = judged.groupBy("doc_id", "toxic").agg(F.min(F.struct("bin", "lang")).alias("j"))
    counted = once.groupBy("j.lang", "j.bin").agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic"))
    found = counted.collect()
    if found:
        toxic = sum(kind for _, kind in used)
        histogram = np.array([(r["bin"], r["clean"], r["toxic"]) for r in found], dtype="f8")
        _set_shifts(net, histogram, np.array([r["lang"] for r in found]), [len(used) - toxic, toxic])


def add_score(documents: DataFrame, net: Network | None, name: str) -> DataFrame:
    """All columns, and the score."""
    if net is None:
        return documents.withColumn(name, F.lit(0.0))
    shared = documents.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for texts in batches:
            parts = [scorer.score(texts.slice(i, SLICE).to_pylist()) for i in range(0, len(texts), SLICE)]
            yield pa.array([s for part in parts for s in part], pa.float64())
            give_back()

    return documents.withColumn(name, score(field(documents, "text", "string")))


def remove_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score under PREDICT, with all their columns."""
    name = fresh(documents, "_toxicity")
    return add_score(documents, fit(documents, labels), name).where(F.col(name) < PREDICT).drop(name)
