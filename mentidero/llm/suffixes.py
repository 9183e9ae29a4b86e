"""Benchmark decontamination with suffix arrays of the training texts.

Each task turns its documents, batch by batch, into one word sequence (a shard) and sorts the suffixes that
can match: those that start with the first words of some benchmark suffix. Every benchmark suffix is binary
searched in the shard's array; the equal range gives all places that share a whole window with it. Hit words
and items follow from these ranges alone. Where a match can't be extended to the left it is extended to the
right, and per place and item the longest verbatim match is kept, with its place in the item; places and
sources of one window are never multiplied, so repetitive texts stay linear. No text is shuffled.

The benchmark is read in blocks of bounded size, one pass of the documents' rows through the same task per
block, so what a task holds has a bound however large the benchmark is.

Words: A-Z lower-cased, then runs without U+0000-002F, 003A-0060, 007B-007F. A window is WINDOW consecutive
words of an item; an item of fewer words, but not none, is one window.

Defined results: null or empty texts have no words and no hits and are not contaminated. Null item ids are
ignored in the list of items but their windows count as hits; repeated items count once by id. Repeated
documents are judged each for itself. Empty tables give no rows, or no hits. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.llm.common import field, fresh, give_back, narrow, stage
from mentidero.operators.once import compute_once

WINDOW = 13
HIT_SHARE = 20  # contaminated from one word in so many
PREFIX = 3  # words that a suffix must share with the benchmark to enter the array
BLOCK_CHARS = 16_000_000
SHARD_WORDS = 100_000
PAIRS, REACH = 200_000, 64  # pairs extended at once, words compared at once

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Needles:
    """The benchmark suffixes of one block, ready to be searched for."""

    def __init__(self, items: list[tuple[int | None, str | None]], window: int = WINDOW):
        texts = [(item, split_words(text)) for item, text in items]
        self.items = [item for item, words in texts if words]
        self.vocabulary: dict[bytes, int] = {}
        for _, words in texts:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
        found: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for number, words in enumerate(words for _, words in texts if words):
            ids = [self.vocabulary[w] for w in words]
            length = min(window, len(ids))
            for place in range(len(ids) - length + 1):
                found.setdefault(tuple(ids[place : place + length]), []).append((number, place))
        self.window = window
        self.lengths = np.array([len(key) for key in found], dtype=np.int64)
        self._index_sources([words for _, words in texts if words], list(found.values()))
        self.low, self.high = self._keys(found, b"\x00"), self._keys(found, b"\xff")
        self.prefix = min([PREFIX, *self.lengths.tolist()])
        starts = {key[: self.prefix] for key in found}
        codes = np.zeros(len(starts), dtype=np.uint64)
        for column in range(self.prefix):
            codes = codes * np.uint64(len(self.vocabulary) + 1) + np.array([s[column] for s in starts], dtype=np.uint64)
        self.starts = np.sort(codes)

    def _index_sources(self, texts: list[list[bytes]], sources: list[list[tuple[int, int]]]) -> None:
        """Every needle's places in the items, by the word to their left; and the set of items it stands in."""
        self.tokens = np.full(sum(map(len, texts)) + len(texts) + 1, -1, dtype=np.int64)  # -1 ends an item
        starts = np.cumsum([0] + [len(words) + 1 for words in texts])
        for words, at in zip(texts, starts.tolist()):
            self.tokens[at : at + len(words)] = [self.vocabulary[w] for w in words]
        self.item = np.array([number for places in sources for number, _ in places], dtype=np.int64)
        self.place = np.array([place for places in sources for _, place in places], dtype=np.int64)
        self.spot = starts[self.item] + self.place
        needle = np.repeat(np.arange(len(sources)), [len(places) for places in sources])
        left = np.where(self.place > 0, self.tokens[self.spot - 1] + 1, 0)
        self.codes = needle * self.radix + left
        order = np.argsort(self.codes, kind="stable")
        self.codes, self.item, self.place, self.spot = self.codes[order], self.item[order], self.place[order], self.spot[order]
        self.begin = np.searchsorted(self.codes, np.arange(len(sources) + 1) * self.radix)
        numbers: dict[tuple[int, ...], int] = {}
        self.set_of = np.array(
            [numbers.setdefault(tuple(sorted({number for number, _ in places})), len(numbers)) for places in sources], dtype=np.int64
        )
        self.sets = [frozenset(self.items[n] for n in key) - {None} for key in numbers]

    @property
    def radix(self) -> int:
        """One more than the code of any word to the left: 0 an item's start, ids + 1, and a document's start."""
        return len(self.vocabulary) + 3

    def longest(self, ids: np.ndarray, ends: np.ndarray, first: np.ndarray, places: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Rows (place, item number, place in the item, length): per place and item the longest match that
        begins there and can't be extended to the left. `first`: whether a word is its document's first."""
        left = np.where(first[places], self.radix - 1, ids[places - 1] + 1)
        a = np.searchsorted(self.codes, found * self.radix + left, "left")
        b = np.searchsorted(self.codes, found * self.radix + left, "right")
        low, counts = self.begin[found], self.begin[found + 1] - self.begin[found] - (b - a)
        parts = [np.empty((0, 4), dtype=np.int64)]
        todo = np.flatnonzero(counts)
        group = np.cumsum(counts[todo]) // PAIRS
        for rows in np.split(todo, np.flatnonzero(np.diff(group)) + 1):
            n = counts[rows]
            row = np.repeat(rows, n)
            source = low[row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            source += np.where(source >= a[row], (b - a)[row], 0)
            length = self._extend(ids, ends, places[row], self.spot[source], self.lengths[found[row]])
            item, place = self.item[source], self.place[source]
            order = np.lexsort((place, -length, item, places[row]))
            best = np.stack([places[row], item, place, length], axis=1)[order]
            parts.append(best[np.flatnonzero(np.diff(best[:, :2], axis=0, prepend=-1).any(axis=1))])
        return np.concatenate(parts)

    def _extend(self, ids: np.ndarray, ends: np.ndarray, places: np.ndarray, spots: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Words that agree from each place and spot on, of which `known` are known to."""
        length, open_, reach = known.copy(), np.arange(len(places)), np.arange(REACH)
        while len(open_):
            step = 8_192  # pairs a time, so that few words are held
            going = []
            for some in np.split(open_, range(step, len(open_), step)):
                here, there = (at[some] + length[some] for at in (places, spots))
                mine, theirs = here[:, None] + reach, there[:, None] + reach
                same = ids[np.minimum(mine, len(ids) - 1)] == self.tokens[np.minimum(theirs, len(self.tokens) - 1)]
                same &= mine < ends[places[some]][:, None]
                all_same = same.all(axis=1)
                length[some] += np.where(all_same, REACH, same.argmin(axis=1))
                going.append(some[all_same])
            open_ = np.concatenate(going)
        return length

    def _keys(self, found, filler: bytes) -> np.ndarray:
        width = 4 * self.window
        raw = [np.array(key, dtype=">u4").tobytes().ljust(width, filler) for key in found]
        return np.frombuffer(b"".join(raw), dtype=f"S{width}")

    def sequence(self, texts: list[list[bytes]]) -> np.ndarray:
        get = self.vocabulary.get
        ids = [get(word, 0) for words in texts for word in words]
        return np.array(ids, dtype=np.int64)

    def search(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the shard, number of the needle) of every match. `ends`: each word's document end."""
        none = np.empty(0, dtype=np.int64)
        if not len(self.starts) or not len(ids):
            return none, none
        codes, known = np.zeros(len(ids), dtype=np.uint64), np.ones(len(ids), dtype=bool)
        padded = np.concatenate([ids, np.zeros(self.window, dtype=np.int64)])
        for column in range(self.prefix):
            here = padded[column : column + len(ids)]
            known &= here > 0
            codes = codes * np.uint64(len(self.vocabulary) + 1) + here.astype(np.uint64)
        places = np.flatnonzero(known)
        at = np.searchsorted(self.starts, codes[places])
        at[at == len(self.starts)] = 0
        places = places[self.starts[at] == codes[places]]
        if not len(places):
            return none, none
        steps = places[:, None] + np.arange(self.window)
        rows = np.where(steps < ends[places][:, None], padded[np.minimum(steps, len(padded) - 1)], 0)
        keys = np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * self.window}").ravel()
        order = np.argsort(keys, kind="stable")  # the suffix array, as deep as a window
        array = keys[order]
        first, last = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        counts = np.maximum(last - first, 0)
        needle = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return places[order[first[needle] + inside]], needle


def _judge(needles: Needles, texts: list[str | None], with_matches: bool) -> list[tuple]:
    """Per text: its words, the stretches of hit words (start, length), the items, the longest matches
    (item number, place in the item, start, length)."""
    words = [split_words(text) for text in texts]
    counts = [len(w) for w in words]
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    ids = needles.sequence(words)
    del words
    ends = np.repeat(offsets[1:], counts)
    places, found = needles.search(ids, ends)
    out: list[tuple] = [(n, [], set(), []) for n in counts]
    if not len(places):
        return out

    def owner(at: np.ndarray) -> np.ndarray:
        return np.searchsorted(offsets, at, "right") - 1

    size = len(ids) + 1
    hit = np.cumsum(np.bincount(places, minlength=size) - np.bincount(places + needles.lengths[found], minlength=size)) > 0
    first = np.zeros(size, dtype=bool)
    first[offsets] = True
    starts = np.flatnonzero(hit & (first | ~np.roll(hit, 1)))
    stops = np.flatnonzero(hit[:-1] & (first[1:] | ~hit[1:])) + 1
    for doc, start, length in zip(owner(starts).tolist(), (starts - offsets[owner(starts)]).tolist(), (stops - starts).tolist()):
        out[doc][1].append((start, length))
    for pair in np.unique(owner(places) * len(needles.sets) + needles.set_of[found]).tolist():
        doc, which = divmod(pair, len(needles.sets))
        out[doc][2].update(needles.sets[which])
    if with_matches:
        best = needles.longest(ids, ends, first, places, found)
        for doc, (place, item, start, length) in zip(owner(best[:, 0]).tolist(), best.tolist()):
            out[doc][3].append((item, start, place - int(offsets[doc]), length))
    return out


HITS = "array<struct<start: bigint, length: bigint>>"
MATCHES = "array<struct<item_id: bigint, item_start: bigint, start: bigint, length: bigint>>"
FOUND = f"struct<n_words: bigint, hits: {HITS}, items: array<bigint>, matches: {MATCHES}>"


def _blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    """The benchmark in parts of about `block_chars`; as many as its measured size needs."""
    items = narrow(benchmark, item_id="bigint", text="string")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    n = -(-total // block_chars) or 1
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _shards(texts: pd.Series) -> Iterator[list[str | None]]:
    """Runs of texts with about SHARD_WORDS words (six bytes each)."""
    cuts = np.flatnonzero(np.diff(texts.str.len().fillna(0).cumsum() // (6 * SHARD_WORDS))) + 1
    bounds = [0, *cuts.tolist(), len(texts)]
    for a, b in zip(bounds, bounds[1:]):
        yield texts.iloc[a:b].tolist()


def _searcher(shared: Broadcast, with_matches: bool):
    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        needles = shared.value
        for texts in batches:
            rows = [row for shard in _shards(texts) for row in _judge(needles, shard, with_matches)]
            yield pd.DataFrame({
                "n_words": [n for n, _, _, _ in rows],
                "hits": [[{"start": a, "length": n} for a, n in hits] for _, hits, _, _ in rows],
                "items": [sorted(items) for _, _, items, _ in rows],
                "matches": [
                    [{"item_id": needles.items[i], "item_start": s, "start": a, "length": n} for i, s, a, n in matches]
                    for _, _, _, matches in rows
                ],
            })
            del rows
            give_back()

    return search


def add_matches(
    documents: DataFrame, benchmark: DataFrame, name: str, window: int = WINDOW, block_chars: int = BLOCK_CHARS, with_matches: bool = True
) -> DataFrame:
    """All columns, and `name`: word count, the stretches of hit words, the items that hit (null ids left out), and
    (empty unless `with_matches`) the longest matches: one per item and place at which a match begins that can't
    be extended to the left.

    One block is the rule. With more, the rows are written after each, so a task never holds two.
    """
    context = documents.sparkSession.sparkContext
    rows, part = documents, fresh(documents, "_part")
    for number, block in enumerate(_blocks(benchmark, block_chars)):
        search = _searcher(context.broadcast(Needles([(r.item_id, r.text) for r in block.collect()], window)), with_matches)
        if number == 0:
            rows = rows.withColumn(name, search(field(documents, "text", "string")))
        else:
            both = stage(rows, "matches").withColumn(part, search(field(documents, "text", "string")))
            lists = [F.concat(f"{name}.{f}", f"{part}.{f}").alias(f) for f in ("hits", "items", "matches")]
            rows = both.withColumn(name, F.struct(f"{name}.n_words", *lists)).drop(part)
    return rows


def hit_words(matches: Column) -> Column:
    """Words inside at least one stretch or match: in order of their start, overlaps counted once."""
    spans = F.sort_array(F.transform(matches, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))

    def add(so_far: Column, span: Column) -> Column:
        more = F.greatest(span["b"] - F.greatest(span["a"], so_far["reach"]), F.lit(0).cast("bigint"))
        return F.struct((so_far["n"] + more).alias("n"), F.greatest(so_far["reach"], span["b"]).alias("reach"))

    return F.aggregate(spans, zero, add, lambda last: last["n"])


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (HIT_SHARE * n_hit >= n_words)


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_hit, the sorted `items`, `matches`, and whether it is contaminated."""
    docs = narrow(documents, doc_id="bigint", text="string")
    found = compute_once(add_matches(docs, benchmark, "found", window), "found", F.col("found"))
    ids = F.transform("found.items", lambda i: i.cast("string"))
    judged = found.select(
        "doc_id", "found.n_words", hit_words(F.col("found.hits")).alias("n_hit"),
        F.array_sort(F.array_distinct(ids)).alias("items"), "found.matches",
    )
    return judged.withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = fresh(documents, "_found")
    rows = add_matches(documents, benchmark, found, window, with_matches=False)
    rows = compute_once(rows, found, F.struct(hit_words(F.col(f"{found}.hits")).alias("n"), F.col(f"{found}.n_words").alias("of")))
    return rows.where(~is_contaminated(F.col(f"{found}.n"), F.col(f"{found}.of"))).drop(found)
