"""Language identification by a byte convolutional network, trained in numpy and applied in Arrow batches.

A text's UTF-8 bytes (A-Z as a-z) are cut into windows of WINDOW bytes that overlap by the widest filter less one,
so every run of bytes that a filter can see lies in a window. Filters of several widths run over the embedded bytes
of a window, each keeps its maximum, a linear layer and a softmax give probabilities. A text's probabilities are
those of its windows, weighted by their letter bytes. All windows of every text are scored.

Gradients see at most `per_lang` documents a language of those `is_training` allows (those with the smallest hash
of their id), and of each SNIPPETS windows at hashed places; only these come to the driver, so what it holds grows
with the number of languages alone.

Defined results: null texts and texts without a letter are `und` with score 0, and so is everything if there is no
labelled training row; rows with a null language or id are not learnt from. Repeated rows are scored each; an empty
table gives no rows; the result has only the named columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mentidero.llm.common import give_back, narrow, stage
from mentidero.llm.toxicity import is_training

WINDOW, WIDTHS, DIM, FILTERS = 128, (2, 3, 4, 5), 8, 16
STRIDE = WINDOW - max(WIDTHS) + 1
PER_LANG, SNIPPETS = 600, 4
EPOCHS, BATCH, RATE = 5, 64, 0.01
ROWS = 64  # windows scored at a time; what one filter makes of them stays in the cache
RANKS = 1 << 52
UNKNOWN = "und"
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
IS_LETTER = np.zeros(256, np.int64)
IS_LETTER[97:123] = 1
IS_LETTER[128:] = 1


def windows_of(text: str) -> np.ndarray:
    """All windows of a text; the last is filled up with zeros."""
    raw = FOLD[np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)]
    n = max(1, -(-(len(raw) - WINDOW + STRIDE) // STRIDE))
    held = np.zeros((n - 1) * STRIDE + WINDOW, np.uint8)
    held[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(held, WINDOW)[::STRIDE]


class Network:
    """Embedding, filters per width (place, dimension, filter) and the output layer; `langs` name the classes."""

    def __init__(self, langs: list[str], seed: int = 11):
        draw = np.random.default_rng(seed)
        self.langs = langs
        self.params = {"embed": draw.normal(0, 0.5, (256, DIM)).astype("f4")}
        for width in WIDTHS:
            self.params[f"filter{width}"] = draw.normal(0, (1 / (width * DIM)) ** 0.5, (width, DIM, FILTERS)).astype("f4")
            self.params[f"bias{width}"] = np.zeros(FILTERS, "f4")
        self.params["out"] = draw.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype("f4")
        self.params["shift"] = np.zeros(len(langs), "f4")


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 11) -> Network:
    """Adam over cross entropy; a maximum passes its gradient to the place that won."""
    net, draw = Network(langs, seed), np.random.default_rng(seed)
    momentum = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.params.items()}
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(windows))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            grads = _gradients(net, windows[chosen], labels[chosen])
            step += 1
            rate = RATE / (1 + 0.5 * step * BATCH / len(windows))
            for name, grad in grads.items():
                mean, square = momentum[name]
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                net.params[name] -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    p, n = net.params, len(windows)
    vectors = p["embed"][windows]
    raw, winners = [], []
    for width in WIDTHS:
        places = WINDOW - width + 1
        total = sum(vectors[:, at : at + places] @ p[f"filter{width}"][at] for at in range(width))
        best = total.argmax(axis=1)
        winners.append(best)
        raw.append(np.take_along_axis(total, best[:, None], axis=1)[:, 0] + p[f"bias{width}"])
    raw_all = np.concatenate(raw, axis=1)
    pooled = np.maximum(raw_all, 0)
    error = softmax(pooled @ p["out"] + p["shift"])
    error[np.arange(n), labels] -= 1
    error = (error / n).astype("f4")
    grads = {"out": pooled.T @ error, "shift": error.sum(axis=0)}
    back = (error @ p["out"].T) * (raw_all > 0)
    flow = np.zeros_like(vectors)
    row = np.arange(n)[:, None]
    for number, width in enumerate(WIDTHS):
        part = back[:, number * FILTERS : (number + 1) * FILTERS]
        grads[f"bias{width}"] = part.sum(axis=0)
        grads[f"filter{width}"] = np.zeros_like(p[f"filter{width}"])
        for at in range(width):
            where = winners[number] + at
            grads[f"filter{width}"][at] = np.einsum("nf,nfd->df", part, vectors[row, where])
            np.add.at(flow, (row, where), part[:, :, None] * p[f"filter{width}"][at].T[None])
    moved = np.abs(flow).sum(axis=2) > 0
    grads["embed"] = np.zeros_like(p["embed"])
    np.add.at(grads["embed"], windows[moved], flow[moved])
    return grads


class Scorer:
    """A network with the sums of filter places for one byte and for two bytes in a row, as tables."""

    def __init__(self, net: Network):
        self.net, p = net, net.params
        self.steps: list[tuple[int, list[tuple[int, int, np.ndarray]]]] = []
        for width in WIDTHS:
            single = [p["embed"] @ p[f"filter{width}"][at] for at in range(width)]
            tables = []
            for at in range(0, width - 1, 2):
                tables.append((at, 2, (single[at][:, None] + single[at + 1][None]).reshape(1 << 16, FILTERS)))
            if width % 2:
                tables.append((width - 1, 1, single[width - 1]))
            self.steps.append((width, tables))

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        pools = []
        for width, tables in self.steps:
            places = WINDOW - width + 1
            total = None
            for at, size, table in tables:
                keys = (pairs if size == 2 else windows)[:, at : at + places]
                total = table[keys] if total is None else np.add(total, table[keys], out=total)
            pools.append(total.max(axis=1) + self.net.params[f"bias{width}"])
        pooled = np.maximum(np.concatenate(pools, axis=1), 0)
        return softmax(pooled @ self.net.params["out"] + self.net.params["shift"])

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the likeliest language and its probability, per text with a letter."""
        sums = np.zeros((len(texts), len(self.net.langs)))
        waiting: list[tuple[int, np.ndarray]] = []
        size = 0

        def settle() -> None:
            windows = np.concatenate([w for _, w in waiting])
            owner = np.repeat([i for i, _ in waiting], [len(w) for _, w in waiting])
            np.add.at(sums, owner, self.probabilities(windows) * IS_LETTER[windows].sum(axis=1)[:, None])

        for i, text in enumerate(texts):
            all_windows = windows_of(text)
            for begin in range(0, len(all_windows), ROWS):
                part = all_windows[begin : begin + ROWS]
                waiting.append((i, part))
                size += len(part)
                if size >= ROWS:
                    settle()
                    waiting, size = [], 0
        if waiting:
            settle()
        sums /= np.maximum(sums.sum(axis=1, keepdims=True), 1e-300)
        return sums.argmax(axis=1), np.clip(sums.max(axis=1, initial=0), 0, 1)


def fit(documents: DataFrame, per_lang: int = PER_LANG) -> Network | None:
    """Train on windows of at most `per_lang` labelled training documents per language."""
    rows = narrow(documents, doc_id="bigint", text="string", lang="string").where(is_training(F.col("doc_id")) & F.col("lang").isNotNull())
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(RANKS))
    # One row a language, written: Spark sees its size and, while it is small, broadcasts it, so no text moves for it.
    sizes = stage(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    # About three times the rows wanted pass by their hash; the exact cut ranks only those.
    near = rows.join(sizes, "lang").where(rank.cast("double") * F.col("n") < 3.0 * per_lang * RANKS).where(F.col("text").rlike(r"\p{L}"))
    span = F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1
    cut = lambda k: F.substring(F.col("text"), (F.pmod(F.xxhash64("doc_id", F.lit(k)), span) + 1).cast("int"), F.lit(WINDOW))
    cuts = near.select("lang", "doc_id", rank.alias("rank"), F.array(*[cut(k) for k in range(SNIPPETS)]).alias("snippets"))
    once = cuts.groupBy("lang", "doc_id", "rank").agg(F.min("snippets").alias("snippets"))
    first = once.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id"))).where(F.col("place") <= per_lang)
    got = sorted(first.select("lang", "doc_id", "snippets").collect())
    if not got:
        return None
    langs = sorted({r["lang"] for r in got})
    draw = np.random.default_rng(5)
    windows, labels = [], []
    for r in got:
        for number, snippet in enumerate(r["snippets"]):
            window = windows_of(snippet)[0].copy()
            if number % 2:  # short texts are met in training too
                window[draw.integers(8, WINDOW) :] = 0
            windows.append(window)
            labels.append(langs.index(r["lang"]))
    return train(np.array(windows), np.array(labels), langs)


def add_language(documents: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    rows = narrow(documents, doc_id="bigint", text="string")
    if net is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = documents.sparkSession.sparkContext.broadcast(net)
    judged = rows.withColumn("judged", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        langs = np.array(scorer.net.langs, dtype=object)
        for whole in batches:
            for begin in range(0, whole.num_rows, 64):
                batch = whole.slice(begin, 64)
                known = np.flatnonzero(batch.column("judged").to_numpy(zero_copy_only=False))
                found, sure = scorer.predict(batch.column("text").take(pa.array(known)).to_pylist())
                names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
                names[known], scores[known] = langs[found], sure
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"]
                )
            give_back()

    return judged.mapInArrow(work, "doc_id long, lang_pred string, score double")
