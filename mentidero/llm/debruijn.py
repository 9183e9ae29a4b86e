"""Collocations from a weighted de Bruijn graph of word runs.

Tasks cut texts into pieces and count, for every place of a piece, the run of LONGEST words that begins there; near
a piece's end the run is shorter. A full run is an edge from its first LONGEST - 1 words to its last ones, its count
the weight; the shorter runs are the corrections at piece ends. The count of a node is the weight that leaves it plus
its correction, and so on down to words: runs of k words are summed over their continuation, level by level.

Where all of an edge's weight passes through a node into one next edge, the two are one path; such unary paths are
compacted by pointer jumping. A path lists each of its edges' parts once for the question which phrases lie in a
longer one of the same count.

A word or a pair of words that occurs less than `least` times can't be part of a counted phrase, so pieces may also
be cut there; runs that stay in one part are the same. Bit maps of bounded size (hashed words, hashed pairs) mark
what is frequent; what they mark by chance costs time only. Words are 64-bit hashes of language and word until the
end; if a frequent word shares its hash with another word, another salt is taken, so no count is mixed.

Tasks cut blocks of many texts into words by array operations on their bytes and look up each distinct word of a
block once.

Defined results: a null text is empty, a null language is `und`; repeated rows count each; empty tables and pieces
give nothing; other columns are ignored. Nothing is cut from long texts: tasks hand on counts per PLACES words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentidero.llm.common import few_files, give_back, narrow, stage

LONGEST = 5
# --- fixed values: what ends a piece, what stands between words ---
BREAKS, BLANKS = ".,;:!?\n\x0b\x0c\r", " \t"
# --- end of fixed values ---
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)  # of a byte: A-Z only
KINDS = np.zeros(256, np.uint8)  # of a byte: 1 between words, 2 ends a piece
KINDS[list(BLANKS.encode())], KINDS[list(BREAKS.encode())] = 1, 2
PLACES = 250_000  # words whose runs are counted together in a task
KNOWN = 100_000  # spellings a task remembers
SLICE = 1 << 20  # characters read at a time
MOST_BITS = 1 << 26  # of a bit map: 8 MB
CELLS = 1 << 44  # of pair counts
RUN = [f"w{i}" for i in range(LONGEST)]
# 38 digits hold both products.
SCORE = """CAST((CAST(a AS DECIMAL(17,0)) * CAST(total AS DECIMAL(17,0)) * CAST(1000 AS DECIMAL(4,0)))
    div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0))) AS BIGINT)"""


def lead(salt: int, lang: str) -> bytes:
    return f"{salt}\0{lang}\0".encode("utf-8", "replace")


def digest(before: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(before + word, 42) or 1


def hashed(salt: int, lang: str, word: str) -> int:
    """As `hash_of` in Spark; 0 stands for no word."""
    return digest(lead(salt, lang), word.encode("utf-8", "replace"))


def hash_of(salt: int) -> Column:
    """As `hashed` in Python, signed."""
    value = F.xxhash64(F.concat(F.lit(f"{salt}\0"), F.col("lang"), F.lit("\0"), F.col("word")))
    return F.when(value == 0, F.lit(1)).otherwise(value)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two arrays of unsigned 64-bit numbers."""
    out = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(31))


def slices(text: str) -> Iterator[str]:
    """The text in parts that end where a word ends."""
    at = 0
    while len(text) - at > SLICE:
        end = at + SLICE
        cut = max(text.rfind(c, at, end) for c in BREAKS + BLANKS) + 1
        while cut <= at and end < len(text):  # one word longer than a slice
            end += SLICE
            cut = max(text.rfind(c, at, end) for c in BREAKS + BLANKS) + 1
        cut = cut if cut > at else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:]


def texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 64):
            batch = whole.slice(begin, 64)
            yield from zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist())
        give_back()


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    """(lang, block): texts of a language, each with a line feed behind it, or in turn the slices of a long one."""
    held: dict[str, list[str]] = {}
    size = 0
    for lang, text in texts_of(batches):
        if len(text) > SLICE:
            yield from ((lang, part) for part in slices(text))
            yield lang, "\n"
            continue
        held.setdefault(lang, []).append(text)
        size += len(text) + 1
        if size >= 2 * SLICE:
            yield from ((own, "\n".join([*texts, ""])) for own, texts in held.items())
            held, size = {}, 0
    yield from ((own, "\n".join([*texts, ""])) for own, texts in held.items())


class Bits:
    """A bit map over hashes; its size follows the number of entries up to MOST_BITS."""

    def __init__(self, words: np.ndarray):
        self.words = words  # 64 bits each, a power of two of them

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys & np.uint64(64 * len(self.words) - 1)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def bits_of(keys: DataFrame, name: str) -> Bits:
    """The lowest bits of the 64-bit column name its place; words of 64 bits are made in Spark, at most MOST_BITS / 64."""
    size = 1 << 10
    wanted = 32 * keys.count()
    while size < wanted and size < MOST_BITS:
        size *= 2
    slots = keys.select(F.expr(f"shiftright({name} & {size - 1}, 6)").alias("at"), F.expr(f"shiftleft(1L, CAST({name} & 63 AS INT))").alias("bit"))
    filled = slots.groupBy("at").agg(F.bit_or("bit").alias("bits"))
    words = np.zeros(size // 64, np.int64)
    got = filled.toPandas()
    words[got["at"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return Bits(words.view(np.uint64))


def words_in(block: str) -> tuple[np.ndarray, list[bytes]]:
    """The block's words as places among its distinct ones, -1 where pieces end; the distinct words, lower-cased."""
    raw = np.frombuffer(block.encode("utf-8", "replace"), np.uint8)
    kinds = KINDS[raw]
    inside = kinds == 0
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(stops - starts, out=offsets[1:])
    letters = LOWER[raw[inside]]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    ends = np.searchsorted(starts, np.flatnonzero(kinds == 2))
    ends = ends[np.diff(ends, prepend=-1) != 0]
    return np.insert(words.indices.to_numpy().astype(np.int64), ends, -1), words.dictionary.to_numpy(zero_copy_only=False).tolist()


BREAK = 0  # the place that stands for no word


class Table:
    """Hashes of the words a task has met, 0 for those that `frequent` rules out."""

    def __init__(self, salt: int, frequent: Bits | None):
        self.salt, self.frequent = salt, frequent
        self.of: dict[str, dict[bytes, int]] = {}  # by language, the places of its words
        self.names: list[tuple[str, bytes]] = [("", b"")]
        self.hashes = np.zeros(1024, np.uint64)

    def add(self, lang: str, words: list[bytes]) -> None:
        first, end = len(self.names), len(self.names) + len(words)
        self.of[lang].update(zip(words, range(first, end)))
        self.names += [(lang, word) for word in words]
        before = lead(self.salt, lang)
        numbers = np.array([digest(before, word) for word in words], np.uint64)
        if self.frequent is not None:
            numbers[~self.frequent.has(numbers)] = 0
        if end > len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(end, np.uint64)])
        self.hashes[first:end] = numbers

    def places(self, lang: str, block: str) -> np.ndarray:
        own = self.of.setdefault(lang, {})
        at, distinct = words_in(block)
        self.add(lang, [word for word in distinct if word not in own])
        found = np.fromiter(map(own.__getitem__, distinct), np.int64, len(distinct))
        return np.append(found, BREAK)[at]


def count_words(documents: DataFrame) -> DataFrame:
    """(lang, word, n) of all words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, met, size = Table(0, None), [np.zeros(0, np.int64)], 0
        times = np.zeros(0, np.int64)

        def tally() -> np.ndarray:
            added = np.bincount(np.concatenate(met), minlength=len(table.names))
            added[: len(times)] += times
            return added

        def counted() -> pa.RecordBatch:
            all_times = tally()
            seen = np.flatnonzero(all_times)
            seen = seen[seen > BREAK]
            names = [table.names[i] for i in seen.tolist()]
            spelled = pa.array([word for _, word in names], pa.binary()).cast(pa.string())
            columns = [pa.array([lang for lang, _ in names], pa.string()), spelled, pa.array(all_times[seen])]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

        for lang, block in blocks_of(batches):
            met.append(table.places(lang, block))
            size += len(met[-1])
            if len(table.names) > KNOWN:
                yield counted()
                table, met, size, times = Table(0, None), [np.zeros(0, np.int64)], 0, np.zeros(0, np.int64)
            elif size >= PLACES:
                times, met, size = tally(), [np.zeros(0, np.int64)], 0
        yield counted()

    parts = documents.mapInArrow(work, "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def runs(documents: DataFrame, salt: int, frequent: Callable[[], Bits], reduce: Callable[[np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """`reduce` over arrays of word hashes with 0 between pieces. Arrays overlap by LONGEST - 1 places, which are
    to be looked at from the array in which they are the last no more; zeros stand behind the last."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(salt, frequent())
        held, size = [np.zeros(0, np.uint64)], 0
        for lang, block in blocks_of(batches):
            places = table.places(lang, block)
            held.append(table.hashes[places])
            size += len(places)
            if size >= PLACES:
                words = np.concatenate(held)
                yield reduce(words)
                held, size = [words[len(words) - LONGEST + 1 :]], 0
            if len(table.names) > KNOWN:
                table = Table(salt, frequent())
        yield reduce(np.concatenate([*held, np.zeros(LONGEST - 1, np.uint64)]))

    return documents.mapInArrow(work, schema)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """A hash per place of the pair that begins there, 0 for none."""
    out = np.zeros(len(words), np.uint64)
    if len(words) > 1:
        out[:-1] = np.where((words[:-1] != 0) & (words[1:] != 0), mixed(words[:-1], words[1:]) % np.uint64(CELLS) + np.uint64(1), np.uint64(0))
    return out


def count_pairs(words: np.ndarray) -> pa.RecordBatch:
    cells = pair_hashes(words[: len(words) - LONGEST + 2])[: max(0, len(words) - LONGEST + 1)]
    cells, counts = np.unique(cells[cells != 0], return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["cell", "n"])


def count_runs(words: np.ndarray, linked: Bits) -> pa.RecordBatch:
    """Runs from every place, cut where a pair isn't linked, equal ones counted together as far as they sort together."""
    n = max(0, len(words) - LONGEST + 1)
    pairs = pair_hashes(words)
    link = (pairs != 0) & linked.has(pairs)
    columns = [words[:n]]
    goes_on = np.ones(n, bool)
    for at in range(1, LONGEST):
        goes_on = goes_on & link[at - 1 : at - 1 + n]
        columns.append(np.where(goes_on, words[at : at + n], np.uint64(0)))
    known = columns[0] != 0
    columns = [c[known] for c in columns]
    key = columns[0]
    for column in columns[1:]:
        key = mixed(key, column)
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(order)))
    arrays = [pa.array(c[starts].view(np.int64)) for c in columns] + [pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(arrays, names=[*RUN, "n"])


def graph(documents: DataFrame, least: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, word, n, id) of frequent words, (lang, n) of all words, and (w0 … w4, n) of runs."""
    spark = documents.sparkSession
    counted = stage(count_words(documents), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    salt = 0
    while True:
        ids = counted.select("lang", "word", "n", hash_of(salt).alias("id"))
        mixed_up = ids.groupBy("id").agg(F.count("*").alias("words"), F.sum("n").alias("n")).where((F.col("words") > 1) & (F.col("n") >= least))
        if not mixed_up.limit(1).count():
            break
        salt += 1
    words = stage(ids.where(F.col("n") >= least), "frequent-words")
    frequent = spark.sparkContext.broadcast(bits_of(words, "id"))
    pairs = runs(documents, salt, lambda: frequent.value, count_pairs, "cell long, n long")
    cells = pairs.groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("cell")
    linked = spark.sparkContext.broadcast(bits_of(stage(cells, "pairs"), "cell"))
    schema = ", ".join(f"{c} long" for c in [*RUN, "n"])
    parts = runs(documents, salt, lambda: frequent.value, lambda w: count_runs(w, linked.value), schema)
    return words, totals, stage(parts.groupBy(*RUN).agg(F.sum("n").alias("n")), "runs")


def phrase_counts(edges: DataFrame, least: int) -> DataFrame:
    """(w0 … w4, k, n) of all phrases of 1 to LONGEST words that occur `least` times or more, 0 behind the last word.

    The runs of k words are those of k + 1 words summed over the last, which holds what leaves a node, together with
    the runs that end there.
    """
    level, found = edges, None
    for k in range(LONGEST, 0, -1):
        if k < LONGEST:
            level = level.groupBy(*RUN[:k]).agg(F.sum("n").alias("n"))
            if k > 1:  # read again by the next level and by this one's result
                level = stage(level, f"runs-{k}")
        own = level.where((F.col(RUN[k - 1]) != 0) & (F.col("n") >= least))
        full = own.select(*[F.col(c) if i < k else F.lit(0).cast("bigint").alias(c) for i, c in enumerate(RUN)], F.lit(k).alias("k"), "n")
        found = full if found is None else found.unionByName(full)
    written = stage(found, "counts")
    return stage(few_files(written, written.count()), "counts")


def compact_paths(counts: DataFrame) -> DataFrame:
    """(words, n) of the maximal unary paths over the frequent edges; a lone edge is a path of its own.

    Edges e and f are joined if e ends in the node in which f begins and both weights equal the node's count: then
    all that passes the node comes by e and leaves by f, so an edge has at most one such successor and predecessor,
    and no path is a ring (each occurrence ends somewhere). Round i knows of each edge the edge 2^i before it. A path
    is a run of words within one piece, so no longer than a text.
    """
    edges = counts.where(F.col("k") == LONGEST).select(F.monotonically_increasing_id().alias("edge"), *RUN, "n")
    edges = stage(edges, "edges")
    nodes = counts.where(F.col("k") == LONGEST - 1).select(*[F.col(c).alias(f"v{i}") for i, c in enumerate(RUN[:-1])], F.col("n").alias("held"))
    node = [f"v{i}" for i in range(LONGEST - 1)]
    into = edges.select("edge", *[F.col(c).alias(v) for c, v in zip(RUN[1:], node)], F.col("n").alias("held"))
    out_of = edges.select(F.col("edge").alias("next"), *[F.col(c).alias(v) for c, v in zip(RUN[:-1], node)], F.col("n").alias("held"))
    joined = into.join(nodes, [*node, "held"], "left_semi").join(out_of, [*node, "held"]).select(F.col("next").alias("edge"), F.col("edge").alias("head"))
    n = edges.count()
    state = edges.select("edge").join(joined, "edge", "left").select(
        "edge", F.coalesce("head", "edge").alias("head"), F.when(F.col("head").isNull(), 0).otherwise(1).cast("bigint").alias("place")
    )
    state = stage(few_files(state, n), "paths")
    while True:
        back = state.select(F.col("edge").alias("head"), F.col("head").alias("farther"), F.col("place").alias("more"))
        after = stage(few_files(state.join(back, "head").select("edge", F.col("farther").alias("head"), (F.col("place") + F.col("more")).alias("place")), n), "paths")
        moved = after.agg(F.sum("place")).first()[0] != state.agg(F.sum("place")).first()[0]
        state = after
        if not moved:
            break
    steps = state.join(edges, "edge").groupBy("head").agg(
        F.array_sort(F.collect_list(F.struct("place", *RUN))).alias("steps"), F.first("n").alias("n")
    )
    begin = F.array(*[F.col("steps")[0][c] for c in RUN[:-1]])
    return steps.select(F.concat(begin, F.transform("steps", lambda s: s[RUN[-1]])).alias("words"), "n")


def padded(words: Column, k: int) -> list[Column]:
    return [(words[i] if i < k else F.lit(0).cast("bigint")).alias(RUN[i]) for i in range(LONGEST)]


def contained(counts: DataFrame, paths: DataFrame) -> DataFrame:
    """(w0 … w4, most): the largest count of a longer phrase around each phrase of 2 or more words."""
    inner = None
    longer = counts.where(F.col("k").between(3, LONGEST - 1)).select(F.array(*RUN).alias("words"), "k", "n")
    sources = [(longer.where(F.col("k") == k).select("words", "n"), k, list(range(2, k))) for k in range(3, LONGEST)]
    sources.append((paths, None, list(range(2, LONGEST))))
    for rows, size, lengths in sources:
        for k in lengths:
            last = F.size("words") - k if size is None else F.lit(size - k)
            cut = rows.select(F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, k))).alias("part"), "n")
            one = cut.select(*padded(F.col("part"), k), "n")
            inner = one if inner is None else inner.unionByName(one)
    return inner.groupBy(*RUN).agg(F.max("n").alias("most"))


def collocations(documents: DataFrame, least: int = 100, share: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases of 2 to LONGEST words.

    A phrase goes if a longer one around it has at least `share` percent of its count. The score is that of the
    lowest-scoring cut in two (of several the first).
    """
    docs = narrow(documents, text="string", lang="string").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words, totals, edges = graph(docs, least)
    counts = phrase_counts(edges, least)
    around = contained(counts, compact_paths(counts))
    left = counts.where("k >= 2").join(around, RUN, "left").where(F.coalesce(100 * F.col("most") < share * F.col("n"), F.lit(True)))
    left = stage(left.select(F.monotonically_increasing_id().alias("phrase_id"), *RUN, "k", F.col("n").alias("a")), "candidates")
    named = _named(left, words)
    scored = _scored(left, counts, named.join(totals, "lang"))
    return _best(stage(scored, "scored"), top)


def _named(left: DataFrame, words: DataFrame) -> DataFrame:
    """(phrase_id, lang, phrase, a): at most LONGEST words meet in a group."""
    each = left.select("phrase_id", "a", F.posexplode(F.array(*RUN)).alias("at", "id")).where("id <> 0")
    own = each.join(words.select("id", "lang", "word"), "id")
    listed = own.groupBy("phrase_id", "a").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("listed"), F.min("lang").alias("lang"))
    return listed.select("phrase_id", "lang", F.array_join(F.transform("listed", lambda w: w["word"]), " ").alias("phrase"), "a")


def _scored(left: DataFrame, counts: DataFrame, named: DataFrame) -> DataFrame:
    cuts = None
    for k in range(2, LONGEST + 1):
        for at in range(1, k):
            blank = F.lit(0).cast("bigint")
            one = left.where(F.col("k") == k).select(
                "phrase_id", F.lit(at).alias("cut"),
                *[(F.col(RUN[i]) if i < at else blank).alias(f"x{i}") for i in range(LONGEST - 1)],
                *[(F.col(RUN[at + i]) if at + i < k else blank).alias(f"y{i}") for i in range(LONGEST - 1)],
            )
            cuts = one if cuts is None else cuts.unionByName(one)
    part = lambda side, name: counts.where(F.col("k") < LONGEST).select(*[F.col(c).alias(f"{side}{i}") for i, c in enumerate(RUN[:-1])], F.col("n").alias(name))
    keys = lambda side: [f"{side}{i}" for i in range(LONGEST - 1)]
    met = cuts.join(part("x", "l"), keys("x")).join(part("y", "r"), keys("y")).select("phrase_id", "cut", "l", "r").join(named, "phrase_id")
    value = F.expr(SCORE)
    lowest = met.withColumn("score", value).groupBy("phrase_id", "lang", "phrase", "a", "total").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return lowest.select("lang", "phrase", "a", "low.l", "low.r", F.col("total").alias("n"), "low.score")


def _best(scored: DataFrame, top: int) -> DataFrame:
    """The first `top` of each language: best ones of hashed parts until few are left, then those in order."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = 10 * top
    n = scored.count()
    while n > part * 10:
        salt = F.pmod(F.xxhash64("phrase"), F.lit(-(-n // part)))
        ranked = scored.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        scored = stage(ranked.where(F.col("rank") <= top).drop("salt", "rank"), "best")
        n, before = scored.count(), n
        if n > before // 2:  # so many languages that each part holds few of any
            break
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
