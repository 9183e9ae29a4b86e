"""Collocations by a de Bruijn graph against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mentidero.llm import debruijn
from mentidero.llm.oracles import ORACLES
from mentidero.llm.queries import op11_debruijn_collocations
from oracle_check import compare, connect

DDL = "doc_id long, text string, lang string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, share=100, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, 6):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = {g: f for g, f in own.items() if len(g) > 1 and f >= least}
        around = Counter()
        for g, f in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    around[g[i : i + k]] = max(around[g[i : i + k]], f)
        rated = []
        for g, a in found.items():
            if g in around and 100 * around[g] >= share * a:
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (own[g[:k]] * own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            rated.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, DDL).withColumns({"W0": F.lit(1), "n": F.lit("x"), "word": F.lit(2)})
    return sorted(tuple(r) for r in debruijn.collocations(df, **more).collect())


def drawn(n, seed, vocabulary=12):
    draw = np.random.default_rng(seed)
    words = [f"W{i}é" for i in range(vocabulary)]
    return " ".join(words[min(vocabulary - 1, int(draw.exponential(3)))] + ("." if draw.random() < 0.05 else "") for _ in range(n))


ODD = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n.;", None), (4, "one", None), (None, "A a A a a a a a", "en"), (5, "a b c\x0bd a b c", "x"),
    (6, "x" * 3000, "x"), (7, "same words in a row here", "und"), (8, "same words in a row here", None), (8, "same words in a row here", None),
]


def test_counts_scores_and_ties(spark):
    rows = ODD + [(10 + i, drawn(400, i % 4), ("en", None)[i % 2]) for i in range(8)]
    for least in (2, 7):
        assert run(spark, rows, least=least) == brute(rows, least)
    assert run(spark, rows, least=2, share=60, top=15) == brute(rows, 2, 60, 15)


def test_hot_text_long_text_and_empty_table(spark):
    rows = [(i, drawn(60, 1), "de") for i in range(150)] + [(500, drawn(30_000, 2), "de"), (501, "ha " * 20_000, "de")]
    assert run(spark, rows, least=20) == brute(rows, 20)
    assert run(spark, []) == [] and run(spark, [(1, None, None)]) == []


def test_small_blocks_and_slices_change_nothing(spark, monkeypatch):
    text = drawn(3000, 5)
    monkeypatch.setattr(debruijn, "SLICE", 40)
    assert "".join(debruijn.slices(text)) == text and all(len(s) <= 40 for s in debruijn.slices(text))
    assert [s for s in debruijn.slices("y" * 500) if s] == ["y" * 500]
    whole = np.append(np.random.default_rng(1).integers(0, 4, 500).astype(np.uint64), np.zeros(4, np.uint64))
    every = debruijn.Bits(np.full(16, 2**64 - 1, np.uint64))

    def total(parts):
        counts = Counter()
        for part in parts:
            for *run_, n in zip(*(c.to_pylist() for c in debruijn.count_runs(part, every).columns)):
                counts[tuple(run_)] += n
        return counts

    cut = [whole[:200], whole[196:350], whole[346:]]
    assert total(cut) == total([whole])


def test_words_of_a_block():
    text = " A.b  C\u00c9\t.\r..e\x85f\u00a0g a,A\n"
    at, distinct = debruijn.words_in(text)
    pieces = [re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", text.translate(LOWER))]
    got = " ".join("|" if i < 0 else distinct[i].decode() for i in at)
    assert re.split(r"[| ]*\|[| ]*", got) == [" ".join(p) for p in pieces if p] + [""]
    assert len(set(distinct)) == len(distinct) == len({w for p in pieces for w in p})
    for blank in ("", " ", ".", "\n"):
        assert debruijn.words_in(blank)[1] == []


def test_blocks_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(debruijn, "SLICE", 30)
    rows = [(("en", "de")[i % 2], "y z. " * (i % 9)) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    got = defaultdict(str)
    for lang, block in debruijn.blocks_of([batch]):
        got[lang] += block
    for lang in ("en", "de"):
        texts = [t for own, t in rows if own == lang]
        assert sorted(got[lang].split("\n")[:-1]) == sorted(texts)
    assert list(debruijn.blocks_of([])) == []


def test_paths_are_maximal(spark):
    words = [f"t{i}" for i in range(40)]
    rows = [(i, " ".join(words), "en") for i in range(9)] + [(20 + i, " ".join(words[10:20]), "en") for i in range(4)]
    _, _, edges = debruijn.graph(spark.createDataFrame(rows, DDL).select("lang", "text"), 3)
    paths = debruijn.compact_paths(debruijn.phrase_counts(edges, 3)).select(F.size("words"), "n").collect()
    # Words 10 to 19 have weight 13; what leads to them and away from them has 9.
    assert sorted(map(tuple, paths)) == [(10, 13), (14, 9), (24, 9)]


def test_python_and_spark_hash_alike(spark):
    rows = [("en", "word"), ("und", "é€"), ("x", "")]
    got = spark.createDataFrame(rows, "lang string, word string").select(debruijn.hash_of(3).alias("id")).collect()
    assert [r["id"] % (1 << 64) for r in got] == [debruijn.hashed(3, *r) for r in rows]


def test_scores_beyond_64_bits_are_exact(spark):
    rows = [(123_456_789_012, 98_765_432_109_876, 130_000_000_017, 222_222_222_221), (100, 10**16, 100, 100), (100, 200, 10**18, 10**18)]
    got = spark.createDataFrame(rows, "a long, total long, l long, r long").select(F.expr(debruijn.SCORE).alias("s")).collect()
    assert [r["s"] for r in got] == [1000 * a * n // (x * y) for a, n, x, y in rows]


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(connect(sf_dir), op11_debruijn_collocations(spark, sf_dir), ORACLES["op11_debruijn_collocations"]) is None
