"""Personal data by candidates and gradient boosting.

Base spans follow fixed patterns per kind and always stay. Around them, generators of high recall propose
overlapping candidates (mail-like words, runs of digits with separators, dotted numbers, long opaque tokens).
Boosted trees judge each candidate by its format and by the words around it; a candidate at or above its
kind's calibrated threshold that no base span overlaps is added, the most probable first.

The trees are fitted on the candidates of all texts, equal texts once. Their labels are weak: a candidate is
positive if a base span is exactly it, or if it is an opaque token next to a word that names a secret; all other
candidates are negative. Tasks turn candidates into a byte per feature, its bin, and count equal ones; the trees
grow from sums over that table. A fourth of the texts, which the trees don't see, sets the thresholds: the lowest
score with a precision of PRECISION. Every document is judged whole.

Offsets are code points, ends exclusive. Defined results: null and empty texts have no spans; repeated rows
are judged each; an empty table gives no rows; other columns are ignored or passed on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.llm.common import ROWS_PER_FILE, few_files, field, fresh, give_back, narrow, stage

# --- fixed values: kinds in order, and the base patterns ---
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match never starts inside a run of digits
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# --- end of fixed values ---
DIGIT = re.compile("[0-9]")
PRECISION, STEPS = 0.99, 10_000
ROUNDS, RATE = 20, 0.5
ONE = 1 << 20  # gradients are whole numbers of its parts
TEXTS, SLICE = 64, 50_000  # texts and vectors worked on at a time
GENERATORS = (
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}[ ]?(?:@|\(at\)|\[at\])[ ]?[A-Za-z0-9-]{1,63}(?:(?:\.|[ ]?(?:\(dot\)|\[dot\])[ ]?)[A-Za-z0-9-]{1,63}){1,8}")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){11,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])\+?[0-9(][ ().0-9-]{6,18}[0-9](?![0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{16,200}(?![A-Za-z0-9_/+-])")),
)
NEAR_WORDS = re.compile(r"token|passw|secret|key|mail|phone|tel|call|card|visa|\bip\b|host|server|address", re.I)
SECRET_WORDS = re.compile(r"(?:token|passw(?:or)?d|secret|api[_-]?key|access[_-]?key)[\"']?\s*[:=]\s*[\"']?\Z", re.I)
SECRET_FORMS = re.compile(r"(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9-]{20,}|xox[abp]-[A-Za-z0-9-]{10,})\Z")
CONTEXT = 24
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base spans, by kind as listed, then start. Linear in the text: an address is found from its @."""
    spans: list[Span] = []
    reach, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > reach and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append(("email", start, match.end()))
            reach = match.end()
        else:
            reach = at + 1
        at = text.find("@", max(at + 1, reach))
    if not DIGIT.search(text):
        return spans
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0")[:4] or 0) <= 255 for part in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


def candidates(text: str) -> list[Span]:
    mail = "@" in text or "(at)" in text or "[at]" in text
    worth = {"email": mail, "secret": True}
    digit = bool(DIGIT.search(text))
    return [
        (kind, m.start(), m.end()) for kind, pattern in GENERATORS if worth.get(kind, digit) for m in pattern.finditer(text)
    ]


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    value, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    size, digits = len(value), _digits(value)
    letters = sum(c.isalpha() for c in value)
    upper = sum(c.isupper() for c in value)
    hexes = sum(c in "0123456789abcdef" for c in value)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    return [
        KINDS.index(kind), size, len(digits), len(digits) / size, letters / size, upper / size, hexes / size,
        len(set(value)) / size, changes / size, value.count("."), value.count("-") + value.count(" "),
        float("@" in value), float(value[:1] == "+"), float(bool(digits) and luhn(digits)),
        max((int(p[:4]) for p in re.findall(r"[0-9]+", value)), default=0) if kind == "ip" else 0,
        float(bool(NEAR_WORDS.search(before))), float(bool(SECRET_WORDS.search(before))), float(bool(SECRET_FORMS.match(value))),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\"'=" and before != ""),
    ]


# A feature's bin is its value times its scale, rounded down: shares in 64ths, numbers of an address in twos.
SCALE = np.array([1, 1, 1] + [64] * 6 + [1] * 5 + [0.5] + [1] * 6)
WIDTH, BINS = len(SCALE), 256


def bins_of(rows: list[list[float]]) -> np.ndarray:
    return np.clip(np.floor(np.array(rows, dtype=float) * SCALE), 0, BINS - 1).astype(np.uint8)


def weak_labels(text: str, found: list[Span]) -> list[int]:
    base = set(base_spans(text))
    return [
        int(s in base if s[0] != "secret" else bool(
            SECRET_FORMS.match(text[s[1] : s[2]])
            or SECRET_WORDS.search(text[max(0, s[1] - CONTEXT) : s[1]]) and any(c.isdigit() for c in text[s[1] : s[2]])
        ))
        for s in found
    ]


class BoostedTrees:
    """Second-order boosting for the logistic loss: trees of a fixed depth, grown level by level from the sums of
    gradient and curvature in each node, feature and bin. Who sums doesn't matter: numpy over rows in memory (`fit`)
    or Spark over a table (`fit_table`)."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Rows in memory, over quantile bins."""
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, self.bins + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
        once = np.ones(len(y), dtype=np.int64)
        self.boost(lambda feature, cut, level: self.sums(binned, y, once, feature, cut, level, self.bins), y.sum(), len(y))
        value = lambda f, c: float(cuts[f][int(c)]) if np.isfinite(c) else np.inf
        self.trees = [(f, np.array([value(*split) for split in zip(f, c)]), leaf) for f, c, leaf in self.trees]
        return self

    def fit_table(self, vectors: DataFrame, parts: int = 1) -> BoostedTrees:
        """`vectors` (v: a byte per feature, its bin; y; n: how many). Every level is one job over the whole table;
        what returns has a row per node, feature and bin, added up in `parts` tasks."""
        positive, total = vectors.agg(F.sum(F.col("n") * F.col("y")), F.sum("n")).first()

        def sums(feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
            shape = (2**level, WIDTH, BINS, 2)

            def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                found = np.zeros(shape)
                for x, y, n in _rows_of(batches):
                    found += self.sums(x, y, n, feature, cut, level, BINS)
                flat = found.reshape(-1, 2).astype(np.int64)
                at = np.flatnonzero(flat.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at, 0]), pa.array(flat[at, 1])], names=["at", "g", "h"])

            rows = vectors.select("v", "y", "n").mapInArrow(work, "at long, g long, h long")
            got = rows.repartition(parts, "at").groupBy("at").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
            out = np.zeros((int(np.prod(shape[:-1])), 2))
            out[got["at"].to_numpy(np.int64)] = got[["g", "h"]].to_numpy(float)
            return out.reshape(shape)

        self.boost(sums, positive, total)
        return self

    def boost(self, sums: Callable[[np.ndarray, np.ndarray, int], np.ndarray], positive: float, total: float) -> None:
        share = np.clip(positive / total, 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        for _ in range(self.rounds):
            inner = 2**self.depth - 1
            feature, cut, leaf = np.zeros(inner, dtype=int), np.full(inner, np.inf), np.zeros(2**self.depth)
            for level in range(self.depth):
                for at, node in enumerate(sums(feature, cut, level) / ONE):
                    g, h = np.cumsum(node[:, :, 0], axis=1), np.cumsum(node[:, :, 1], axis=1)
                    g_all, h_all = g[0, -1], h[0, -1]
                    gain = g**2 / (h + self.ridge) + (g_all - g) ** 2 / (h_all - h + self.ridge) - g_all**2 / (h_all + self.ridge)
                    f, c = np.unravel_index(int(gain.argmax()), gain.shape)
                    left = (g_all, h_all)
                    if gain[f, c] > 1e-6:
                        feature[2**level - 1 + at], cut[2**level - 1 + at], left = f, c, (g[f, c], h[f, c])
                    if level == self.depth - 1:
                        leaf[2 * at] = -self.rate * left[0] / (left[1] + self.ridge)
                        leaf[2 * at + 1] = -self.rate * (g_all - left[0]) / (h_all - left[1] + self.ridge)
            self.trees.append((feature, cut, leaf))

    def sums(self, x, y, n, feature, cut, level: int, bins: int) -> np.ndarray:
        """Sums over the rows for each node of a level, feature and bin; gradients are whole numbers of 1 / ONE, so
        the order of adding doesn't matter."""
        p = self.predict(x)
        grad, curve = np.rint((p - y) * ONE) * n, np.rint(np.maximum(p * (1 - p), 1e-6) * ONE) * n
        node = self._down(x, feature, cut, level) - (2**level - 1)
        out = np.empty((2**level, x.shape[1], bins, 2))
        for f in range(x.shape[1]):
            cell = node * bins + x[:, f]
            for i, value in enumerate((grad, curve)):
                out[:, f, :, i] = np.bincount(cell, value, 2**level * bins).reshape(-1, bins)
        return out

    def _down(self, x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(levels):
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.start)
        for feature, cut, leaf in self.trees:
            margin += leaf[self._down(x, feature, cut, self.depth) - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-margin))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins, labels and numbers of rows (v, y, n), some thousands at a time."""
    for whole in batches:
        for begin in range(0, whole.num_rows, SLICE):
            part = whole.slice(begin, SLICE)
            x = np.frombuffer(b"".join(part.column("v").to_pylist()), np.uint8).reshape(-1, WIDTH)
            yield x.astype(np.int64), part.column("y").to_numpy(), part.column("n").to_numpy()


class Detector:
    """Fitted trees and the threshold of each kind (above 1: the kind adds nothing)."""

    def __init__(self, trees: BoostedTrees | None, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def spans(self, texts: list[str | None]) -> list[tuple[list[Span], list[Span]]]:
        """Per text its base spans and all its spans, each by kind as listed, then start."""
        bases = [base_spans(t or "") for t in texts]
        added: list[list[tuple[float, Span]]] = [[] for _ in texts]
        if self.trees is not None:
            open_spans: list[tuple[int, Span]] = []
            for i, text in enumerate(texts):
                taken = bases[i]
                open_spans += [
                    (i, s) for s in (candidates(text) if text else ())
                    if all(s[2] <= b[1] or s[1] >= b[2] for b in taken)
                ]
            if open_spans:
                p = self.trees.predict(bins_of([features(texts[i], s) for i, s in open_spans]).astype(np.int64))
                for (i, s), value in zip(open_spans, p.tolist()):
                    if value >= self.thresholds.get(s[0], 2.0):
                        added[i].append((value, s))
        out = []
        for base, more in zip(bases, added):
            chosen: list[Span] = []
            for _, s in sorted(more, key=lambda m: (-m[0], m[1][1], -m[1][2])):
                if all(s[2] <= c[1] or s[1] >= c[2] for c in chosen):
                    chosen.append(s)
            out.append((base, sorted(base + chosen, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))))
        return out


def training_vectors(documents: DataFrame) -> DataFrame:
    """(v, y, held, n): the candidates of all texts by their bins and weak label; equal texts count once. A fourth of
    the texts, by their hash, is held back from the trees."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, TEXTS):
                part = whole.slice(begin, TEXTS)
                rows: Counter[tuple[int, bytes, int]] = Counter()
                for key, text in zip(part.column("h").to_pylist(), part.column("text").to_pylist()):
                    found = candidates(text)
                    if found:
                        x = bins_of([features(text, s) for s in found])
                        # one text's own counts: a copy in the same slice must not add to them
                        rows.update({(key, v, y): n for (v, y), n in Counter(zip(map(bytes, x), weak_labels(text, found))).items() if (key, v, y) not in rows})
                keys = list(rows)
                columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.binary()), pa.array([k[2] for k in keys], pa.int64()), pa.array(list(rows.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "v", "y", "n"])
            give_back()

    texts = narrow(documents, text="string").where("text <> ''").select(F.xxhash64("text").alias("h"), "text")
    once = texts.mapInArrow(work, "h long, v binary, y long, n long").groupBy("h", "v", "y").agg(F.max("n").alias("n"))
    held = (F.pmod("h", F.lit(4)) == 3).alias("held")
    return once.groupBy("v", "y", held).agg(F.sum("n").alias("n"))


def calibrate(trees: BoostedTrees, vectors: DataFrame) -> dict[str, float]:
    """Per kind the lowest score, in steps of 1 / STEPS, with a precision of PRECISION; above 1 where there is none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y, n in _rows_of(batches):
            step = np.floor(trees.predict(x) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(step), pa.array(y * n), pa.array(n)], names=["kind", "step", "hits", "n"])

    scored = vectors.select("v", "y", "n").mapInArrow(work, "kind long, step long, hits long, n long")
    steps = scored.groupBy("kind", "step").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).toPandas()  # STEPS rows a kind
    thresholds = {}
    for place, name in enumerate(KINDS):
        mine = steps[steps["kind"] == place].sort_values("step", ascending=False)
        fine = np.flatnonzero(mine["hits"].cumsum() / mine["n"].cumsum() >= PRECISION)
        thresholds[name] = max(mine["step"].iloc[fine[-1]] / STEPS, 0.5) if len(fine) else 2.0
    return thresholds


def fit(documents: DataFrame) -> Detector:
    """Fit on the candidates of all texts. Only sums by bin and step come to the driver."""
    vectors = stage(training_vectors(documents), "candidates")
    seen = vectors.where("NOT held").agg(F.count("*"), F.sum("n"), F.min("y"), F.max("y")).first()
    if (seen[1] or 0) < 50 or seen[2] == seen[3]:
        return Detector(None, {})
    own = stage(few_files(vectors.where("NOT held"), seen[0]), "candidates")
    trees = BoostedTrees(ROUNDS, rate=RATE).fit_table(own, -(-seen[0] // ROWS_PER_FILE))
    return Detector(trees, calibrate(trees, vectors.where("held")))


SPANS = "array<struct<kind: string, start: bigint, stop: bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
FOUND = pa.struct([("base", _SPANS), ("spans", _SPANS), ("redacted", pa.string())])


def add_spans(documents: DataFrame, detector: Detector, name: str) -> DataFrame:
    """All columns, and `name`: struct of the base spans, all spans, and the redacted text."""
    shared = documents.sparkSession.sparkContext.broadcast(detector)

    @F.arrow_udf(f"struct<base: {SPANS}, spans: {SPANS}, redacted: string>")
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        as_rows = lambda spans: [{"kind": k, "start": a, "stop": b} for k, a, b in spans]
        for whole in batches:
            parts = [pa.array([], FOUND)]
            for begin in range(0, len(whole), TEXTS):
                texts = whole.slice(begin, TEXTS).to_pylist()
                found = shared.value.spans(texts)
                parts.append(pa.array([
                    {"base": as_rows(base), "spans": as_rows(every), "redacted": redact(text, every)}
                    for text, (base, every) in zip(texts, found)
                ], FOUND))
            yield pa.concat_arrays(parts)
            give_back()

    return documents.withColumn(name, detect(field(documents, "text", "string")))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    if text is None or not spans:
        return text
    parts, at = [], 0
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, stop)
    return "".join(parts) + text[at:]


def redact_documents(documents: DataFrame) -> DataFrame:
    """The documents with redacted texts; n_chars, where there is one, follows the text."""
    name = fresh(documents, "_found")
    found = add_spans(documents, fit(documents), name)
    changed = found.withColumn("text", F.col(f"{name}.redacted")).drop(name)
    if "n_chars" in documents.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return changed.select(*documents.columns)
