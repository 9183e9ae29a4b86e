"""Quality rules: base counts of a text, and the log-likelihood ratio of its hashed n-grams between the
multinomial of trusted documents and that of the whole corpus, per n-gram. DataFrame functions only.

Words are runs without the white space U+0020 and U+0009 to U+000D. The n-grams are single words and pairs,
hashed into a fixed number of cells, so both multinomials are arrays of a fixed size whatever the input.

Defined results: a null or empty text has no words, all counts 0, score 0, `base_failed`, not kept. Repeated
rows are scored each for itself and count each in the multinomials. An empty table gives no rows. Without any
trusted document the ratio is 0 everywhere and only the base rules decide. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentidero.llm.common import let, narrow, stage

# --- fixed values: the base rules ---
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
# --- end of fixed values ---
CELLS = 1 << 14
# Share of the trusted documents that the threshold may fail, and the step scores are rounded to for it.
FAILED_SHARE, STEP = 0.001, 0.01
# Most trusted documents that the target multinomial is fitted on; beyond, those with the smallest id hash.
TRUSTED_LIMIT = 50_000


def split_white(text: Column) -> Column:
    """Parts between single white-space characters, empty ones too: one more than there are of those.

    Plain replacements and a split at one plain character, which need no pattern matching.
    """
    spaced = F.coalesce(text, F.lit(""))
    for char in WHITE[1:]:
        spaced = F.replace(spaced, F.lit(char), F.lit(" "))
    return F.split(spaced, " ")


def words_of(text: Column) -> Column:
    return F.filter(split_white(text), lambda w: w != "")


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    return let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))


def count_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{SYMBOLS}]"))


def _places(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def pair_hashes(hashes: Column) -> Column:
    both = F.zip_with(hashes, F.slice(hashes, 2, F.size(hashes)), lambda a, b: F.xxhash64(a, b))
    return F.slice(both, 1, F.greatest(F.size(hashes) - 1, F.lit(0)))


def repeat_words(pairs: Column, window: int = WINDOW) -> Column:
    """Words inside windows that occur twice or more in the text, from the hashes of its word pairs.

    A window is the 64-bit hash of its pairs. Only when two are equal are (hash, place) structs sorted;
    places whose neighbour has the same hash are repeats, and the union of their windows is counted in order.
    """

    def windows(p: Column) -> Column:
        return F.transform(
            _places(F.size(p) - window + 2), lambda i: F.xxhash64(*[F.get(p, i + j) for j in range(0, window, 2)])
        )

    def covered(h: Column) -> Column:
        sorted_pairs = F.sort_array(F.transform(h, lambda value, i: F.struct(value.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            same = lambda at, p: F.coalesce(F.get(s, at)["h"] == p["h"], F.lit(False))
            marked = F.filter(s, lambda p, j: same(j - 1, p) | same(j + 1, p))
            return F.sort_array(F.transform(marked, lambda p: p["i"]))

        def total(at: Column) -> Column:
            spans = F.transform(at, lambda p, k: F.least(F.coalesce(F.get(at, k + 1) - p, F.lit(window)), F.lit(window)))
            return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, b: a + b)

        return let(let(sorted_pairs, repeated), total)

    return let(
        windows(pairs),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)),
    )


def cell_of(gram: Column, cells: int) -> Column:
    return F.pmod(gram, F.lit(cells)).cast("int")


def log_ratios(documents: DataFrame, trusted: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row: `ratios`, log p(cell | trusted) / p(cell | corpus), both with one added to every count.

    The corpus multinomial counts every document. `trusted` has the doc_id of trusted documents; the target
    is fitted on at most TRUSTED_LIMIT of them, which bounds what is broadcast. No text is shuffled; the
    counts meet as at most `cells` rows per task.
    """
    docs = narrow(documents, doc_id="bigint", text="string")
    known = narrow(trusted, doc_id="bigint").where("doc_id IS NOT NULL").distinct()
    fitted = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED_LIMIT).withColumn("trusted", F.lit(1))
    marked = docs.join(F.broadcast(fitted), "doc_id", "left")

    hashes = let(word_hashes(words_of(F.col("text"))), lambda h: F.concat(h, pair_hashes(h)))
    grams = marked.select(
        F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(hashes).alias("gram")
    )
    counts = grams.groupBy(cell_of(F.col("gram"), cells).alias("cell")).agg(F.count("*").alias("n"), F.sum("trusted").alias("t"))
    every = documents.sparkSession.range(cells).select(F.col("id").cast("int").alias("cell"))
    filled = every.join(counts, "cell", "left").na.fill(0, ["n", "t"])
    rows = F.sort_array(F.collect_list(F.struct("cell", "n", "t")))
    totals = filled.agg(rows.alias("rows"), F.sum("n").alias("n"), F.sum("t").alias("t"))
    ratio = lambda r: F.log((r["t"] + 1) / (F.col("t") + cells)) - F.log((r["n"] + 1) / (F.col("n") + cells))
    return totals.select(
        F.when(F.col("t") > 0, F.transform("rows", ratio)).otherwise(F.array_repeat(F.lit(0.0), cells)).alias("ratios")
    )


def score_documents(documents: DataFrame, ratios: list[float]) -> DataFrame:
    """Base counts and score of every document; no shuffle. `ratios` has one number per cell."""
    cells = len(ratios)
    # Folded into one literal when planned; a subquery isn't allowed inside a lambda.
    held = F.split(F.lit(",".join(f"{r:.9f}" for r in ratios)), ",").cast("array<double>")
    docs = narrow(documents, doc_id="bigint", text="string").withColumn("text", F.coalesce("text", F.lit("")))

    def total(grams: Column) -> Column:
        return F.aggregate(grams, F.lit(0.0), lambda a, gram: a + F.get(held, cell_of(gram, cells)))

    def of_hashes(hashes: Column) -> Column:
        def of_pairs(pairs: Column) -> Column:
            n = F.size(hashes) + F.size(pairs)
            return F.struct(
                F.size(hashes).cast("bigint").alias("n_words"),
                repeat_words(pairs).alias("n_repeat_words"),
                F.when(n > 0, (total(hashes) + total(pairs)) / n).otherwise(F.lit(0.0)).alias("score"),
            )

        return let(pair_hashes(hashes), of_pairs)

    def of_parts(parts: Column) -> Column:
        white = F.size(parts) - 1
        hashes = word_hashes(F.filter(parts, lambda w: w != ""))
        return F.struct((F.char_length("text") - white).cast("bigint").alias("word_chars"), let(hashes, of_hashes).alias("h"))

    measured = docs.select(
        "doc_id",
        count_symbols(F.col("text")).cast("bigint").alias("n_symbols"),
        dup_lines(F.col("text")).cast("bigint").alias("n_dup_lines"),
        let(split_white(F.col("text")), of_parts).alias("m"),
    )
    return measured.select(
        "doc_id", "m.h.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m.h.n_repeat_words", "m.h.score"
    )


def quality_rules(documents: DataFrame, trusted: DataFrame, cells: int = CELLS) -> DataFrame:
    """Base counts, score and verdict of every document.

    The threshold is the largest rounded score that fails at most FAILED_SHARE of the trusted documents
    which pass the base rules; the same rows give the same threshold at every size.
    """
    ratios = log_ratios(documents, trusted, cells).first()["ratios"]
    scored = stage(score_documents(documents, ratios), "llr-scores")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    judged = scored.withColumn("base_failed", failed)
    good = judged.where(~F.col("base_failed")).join(narrow(trusted, doc_id="bigint").distinct(), "doc_id", "left_semi")
    steps = good.groupBy(F.floor(F.col("score") / STEP).alias("step")).count()
    cut = steps.agg(F.percentile("step", FAILED_SHARE, F.col("count"))).scalar()
    passes = F.col("score") >= F.floor(F.coalesce(cut, F.lit(float("-inf")))) * STEP
    return judged.withColumn("kept", ~F.col("base_failed") & passes)
