"""Column functions against plain Python."""

import re
import unicodedata

from pyspark.sql import functions as F

from mentidero.functions import casts, clock, keys, labels, text, vectors
from mentidero.functions.text import WHITESPACE

TEXTS = [
    "", "   ", "ab", "Hello  World!", "see http://x.y/z?q=1 now", "see http://x.y　after", "https", "http ",
    "it’s “quoted”…", "ﬁne ＡＢＣ x", "tab\tnew\nline\r\n", "año NUEVO çà", "😀 ok", "a\x1cb\x85c d",
    "no​break", "İstanbul ΣΑΣ", "?!.,'", "don't—stop", "mixed http://a http://b?c end", "[removed]",
] + [f"x{c}y{c}" for c in WHITESPACE]


def frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(999, None)], "i INT, t STRING")


def column(spark, value):
    rows = frame(spark).select("i", value.alias("v")).collect()
    return {r["i"]: r["v"] for r in rows}


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == sorted(chr(i) for i in range(0x110000) if chr(i).isspace())


def test_nfkc(spark):
    out = column(spark, text.nfkc(F.col("t")))
    assert out.pop(999) is None
    assert out == {i: unicodedata.normalize("NFKC", t) for i, t in enumerate(TEXTS)}


def test_strip(spark):
    out = column(spark, text.strip(F.col("t")))
    assert [out[i] for i in range(len(TEXTS))] == [t.strip() for t in TEXTS]


def test_word_count(spark):
    out = column(spark, text.word_count(F.col("t")))
    assert out.pop(999) is None
    assert out == {i: len(t.split()) for i, t in enumerate(TEXTS)}


def test_clean_text_is_the_three_step_definition(spark):
    def expected(t):
        t = re.sub(r"http\S+", "", t.lower())
        t = re.sub(r"[^a-z0-9?!.,'’ ]", " ", t)
        return re.sub(" +", " ", t).strip(" ")

    out = column(spark, text.clean_text(F.col("t")))
    assert out.pop(999) is None
    assert out == {i: expected(t) for i, t in enumerate(TEXTS)}


def test_features_on_null_and_code_points(spark):
    rows = frame(spark).withColumns(text.text_features(F.col("t"))).where("i IN (12, 999)").orderBy("i").collect()
    assert rows[0]["text_len"] == 4 and rows[0]["word_count"] == 2
    assert rows[1]["text_len"] is None and rows[1]["has_question"] is None


DIRTY = [
    # text, int, float, bool
    (" 12 ", 12, 12.0, None),
    ("12.7", 12, 12.7, None),
    ("-3.9", -3, -3.9, None),
    ("1e3", 1000, 1000.0, None),
    ("abc", None, None, None),
    ("", None, None, None),
    ("12d", None, None, None),
    ("1", 1, 1.0, True),
    ("0", 0, 0.0, False),
    ("\tON\n", None, None, True),
    ("No", None, None, False),
    ("maybe", None, None, None),
    ("99999999999999999999", None, 1e20, None),
    (None, None, None, None),
]


def test_lenient_casts(spark):
    df = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DIRTY)], "i INT, s STRING")
    rows = df.select(
        "i", casts.lenient_int(F.col("s")), casts.lenient_float(F.col("s")), casts.lenient_bool(F.col("s"))
    ).orderBy("i").collect()
    assert [tuple(r)[1:] for r in rows] == [d[1:] for d in DIRTY]


def test_lenient_from_numbers(spark):
    df = spark.createDataFrame([(2.9, 2, True), (float("nan"), 0, False)], "d DOUBLE, n BIGINT, b BOOLEAN")
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(
        casts.lenient(F.col("d"), "bigint", types["d"]).alias("di"),
        casts.lenient(F.col("n"), "boolean", types["n"]).alias("nb"),
        casts.lenient(F.col("b"), "bigint", types["b"]).alias("bi"),
        casts.lenient(F.col("n"), "double", types["n"]).alias("nd"),
    ).collect()
    assert [tuple(r) for r in out] == [(2, True, 1, 2.0), (None, False, 0, 0.0)]


def test_slug_and_key(spark):
    df = spark.createDataFrame([(" Ask Me_Now! ",), ("!!!",), (None,), ("ñandú-1",)], "s STRING")
    slugs = [r[0] for r in df.select(keys.slugify(F.col("s"))).collect()]
    assert slugs[0] == "ask_me_now" and slugs[3] == "and-1"
    assert re.fullmatch("[0-9a-f]{8}", slugs[1]) and re.fullmatch("[0-9a-f]{8}", slugs[2])
    assert [r[0] for r in df.select(keys.normalize_key(F.col("s"))).collect()][0] == "ASK ME_NOW!"


def test_epoch_is_independent_of_the_session_zone(spark):
    df = spark.createDataFrame([(1735689600.25,), (-1.0,), (None,), (float("nan"),)], "s DOUBLE")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Lima")
        rows = df.select(
            clock.ts_to_micros(clock.epoch_to_ts(F.col("s"))), *clock.date_parts(F.col("s")).values()
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in rows] == [
        (1735689600250000, 2025, 1, 1), (-1000000, 1969, 12, 31), (None,) * 4, (None,) * 4,
    ]


def test_vectors_ties_and_large_logits(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, -5.0],), ([0.0, 1.0, 2.0],)], "z ARRAY<DOUBLE>")
    rows = df.select(vectors.argmax(F.col("z")).alias("a"), vectors.softmax(F.col("z")).alias("p"),
                     vectors.max_probability(F.col("z")).alias("m")).collect()
    assert [r["a"] for r in rows] == [0, 2]
    assert abs(rows[0]["p"][0] - 0.5) < 1e-12 and all(abs(sum(r["p"]) - 1) < 1e-12 for r in rows)
    assert all(abs(max(r["p"]) - r["m"]) < 1e-12 for r in rows)


def test_three_stars_differ_between_training_and_scoring(spark):
    df = spark.createDataFrame([([0.0, 0.0, 9.0, 0.0, 0.0],)], "z ARRAY<DOUBLE>")
    name = F.lit("nlptown/any")
    row = df.select(labels.binary_from_logits(F.col("z"), name), labels.label_from_logits(F.col("z"), name)).first()
    assert tuple(row) == (0, "neutral")


def test_overfit_signal_and_polarity(spark):
    df = spark.createDataFrame([(0.01, "NEG"), (0.06, "LABEL_pos"), (-0.06, "Neutral"), (0.03, "x")], "g DOUBLE, l STRING")
    rows = [tuple(r) for r in df.select(labels.overfit_signal(F.col("g")), labels.polarity(F.col("l"))).collect()]
    assert rows == [("stable", "negative"), ("overfit", "positive"), ("moderate", "neutral"), ("moderate", "unknown")]


def test_nfkc_of_a_batch_in_parts():
    """A batch longer than a part: every text at its place, nulls kept, no whole batch as Python strings."""
    import unicodedata

    import pyarrow as pa

    from mentidero.functions import text

    rows = [None if i % 7 == 0 else f"ﬁne Ａ１ … {i}" for i in range(3 * text.TEXTS + 5)]
    got = list(text.normalized(iter([pa.array(rows), pa.array([], pa.string())])))
    assert got[0].to_pylist() == [None if r is None else unicodedata.normalize("NFKC", r) for r in rows] and len(got[1]) == 0
