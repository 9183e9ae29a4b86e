"""The operators against brute force on small rows: nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import itertools
import base64
import collections
import hashlib
import random
import re
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mentidero.llm import bpe, chat, edits, llr, pii, probminhash, suffixes, tagpaths, toxicity, warc
from mentidero.session import scratch_dir

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = [f"word{i}" for i in range(400)]


def text_of(start, n):
    return " ".join(WORDS[(start * 37 + i * (start + 3)) % 400] for i in range(n))


DOCS = [
    (1, text_of(1, 60)), (2, text_of(1, 60)), (3, text_of(1, 60) + " tail"), (4, text_of(2, 80)), (5, None), (6, ""),
    (7, "  \n\t "), (8, "x" * 120_000), (9, "one two"), (9, "one two"), (None, text_of(3, 30)), (10, "a b c d e f g h " * 5),
    (11, "mail me at jo.doe@mail.example.org or +1 (555) 010-9999, 10.0.0.1 and 4111 1111 1111 1111.\nline\nline\n#*$"),
    (12, " " * 150_000 + "end"), (13, text_of(4, 3000)),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"N_TOKENS_": F.lit(1), "score": F.lit("x"), "matches": F.lit(0), "label": F.lit(2), "n": F.lit(3)}
    )


@pytest.fixture
def docs(spark):
    return frame(spark, DOCS)


def test_warc_round_trip(spark):
    evil = "<p>WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n</p>WARC/1.0\r\nContent-Length: 99999\r\n\r\n"
    rows = [(i, "u", evil + "y" * 500 * (i % 3)) for i in range(6)] + [
        (50, None, None), (51, "u", ""), (52, "u", "WARC/1." * 900), (None, "u", "z"), (60, "a\r\nb: c", "dup"), (60, "a", "dup"), (61, "a", "WARC/1.1\r\n"),
    ]
    win = {}
    for k, _, h in rows:
        win[h or ""] = max(win.get(h or "", -1), -1 if k is None else k)
    expected = collections.Counter()
    for k, _, h in rows:
        body, winner = (h or "").encode(), win[h or ""]
        first = winner == -1 or k == winner
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        expected[k, len(body), digest, "response" if first else "revisit", None if first else winner] += 1
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    for block in ("128m", "3k"):
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", block)
            path = scratch_dir(spark, "warc-test")
            warc.write_archives(df, path, "page_id", "html", "url")
            got = warc.page_records(warc.read_archives(spark, path)).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert collections.Counter(tuple(r) for r in got) == expected


def test_warc_urls_that_hold_the_magic(spark):
    urls = [
        "https://x.org/WARC/1.1/spec", "https://x.org/WARC/1.1", "WARC/1.WARC/1.0", "https://x.org/plain", "https://x.org/WARC%2F1.1",
        "https://x.org/WARC%252F1.1/WARC/1.1", "https://x.org/WARC/1\r\n.1", "https://x.org/WARC%2f1.1?%25",
    ]
    rows = [(3 * i + k, u, body) for i, u in enumerate(urls) for k, body in enumerate((f"body {i}", "same", f"WARC/1.1\r\n{i}"))]
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path, "page_id", "html", "url")
    records = warc.read_archives(spark, path)
    url = F.regexp_extract("head", r"(?m)^WARC-Target-URI: (.*?)\r?$", 1)
    got = records.select(F.regexp_extract("head", r"<urn:page:(\d+)>", 1).cast("int").alias("k"), url.alias("url")).collect()
    assert sorted(map(tuple, got)) == [(k, u.replace("\r\n", "")) for k, u, _ in rows]
    assert {(r.key, r.payload_bytes) for r in warc.page_records(records).collect()} == {(k, len(b)) for k, _, b in rows}


def test_warc_of_nothing(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path, "page_id", "html", "url")
    assert warc.page_records(warc.read_archives(spark, path)).count() == 0


def shingle_counts(text):
    words = (text or "").lower().split()
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def test_probability_jaccard_and_signature_estimate():
    draw = np.random.default_rng(3)
    x, y = draw.integers(1, 9, 300).astype(float), draw.integers(1, 9, 300).astype(float)
    code = draw.integers(0, 1 << 55, 400, dtype=np.uint64)
    ix, iy = np.arange(100, 300), np.arange(0, 200)  # elements 100..299 are common
    px, py = dict(zip(range(300), x / x.sum())), dict(zip(range(100, 400), y / y.sum()))
    want = sum(
        1 / sum(max(px.get(j, 0) / px[i], py.get(j, 0) / py[i]) for j in range(400)) for i in range(100, 300)
    )
    assert probminhash.probability_jaccard(x, y, ix, iy) == pytest.approx(want)
    owner = np.repeat([0, 1], 300)
    signature = probminhash.signatures(owner, np.concatenate([code[:300], code[100:]]), np.concatenate([x, y]), 2, 4000)
    assert (signature[0] == signature[1]).mean() == pytest.approx(want, abs=0.04)


def test_near_duplicates_match_all_pairs(spark):
    base = [w + str(i) for i, w in enumerate(WORDS[:150])]
    rows = [(100 + i, " ".join(w if (j * 7 + i) % (41 + i) else f"new{i}" for j, w in enumerate(base))) for i in range(25)]
    rows += DOCS
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingle_counts(rows[i][1]), shingle_counts(rows[j][1])
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or probminhash.similar(rows[i][1], rows[j][1]) or a and b and len(a & b) / len(a | b) >= 0.8:
                parent[find(i)] = find(j)
    names = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        names[find(i)].append(doc)
    expected = collections.Counter(
        (doc, min((d for d in names[find(i)] if d is not None), default=None), len(names[find(i)])) for i, (doc, _) in enumerate(rows)
    )
    got = probminhash.near_duplicate_classes(frame(spark, rows)).collect()
    assert collections.Counter(tuple(r) for r in got) == expected
    kept = probminhash.one_of_each_class(frame(spark, rows)).collect()
    assert len(kept) == len(names)
    assert probminhash.near_duplicate_classes(frame(spark, rows).limit(0)).count() == 0


def test_main_text():
    page = (
        "<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></ul></nav><div class='cookie-notice'>We use cookies.</div>"
        "<div id=content><h1>A title, long enough</h1><p>First &amp; best,\n  with words. And <b>more</b> words.<p>Second one, it is.</p>"
        "<!-- no --><script>var x='<p>no</p>'</script></div><div class=comments><p>Nice post, thanks.</p></div><footer>c</footer></body></html>"
    )
    assert tagpaths.main_text(page) == "A title, long enough\nFirst & best, with words. And more words.\nSecond one, it is."
    assert tagpaths.main_text("<nav>x</nav><article><h1>T</h1><p>a<div class=ad>b</div></article>") == "T\na"
    assert [tagpaths.main_text(x) for x in (None, "", "<!-- open", "<script>x", "<p>")] == [""] * 5


def test_path_ratios_decide_on_every_page():
    body = [f"Sentence {i} of the text, with some words. And a second one, to be sure." for i in range(6)]
    prose, wanted = "".join(f"<p>{x}</p>" for x in body), "\n".join(body)
    links = "<h2>Elsewhere</h2><ul>" + "<li><a href=/x>Another story</a></li>" * 9 + "</ul>"
    # Marked articles weigh more, but don't let link lists in and don't rule out a longer text elsewhere.
    assert tagpaths.main_text(f"<body><nav>n</nav><article>{prose}<section>{links}</section></article></body>") == wanted + "\nElsewhere"
    assert tagpaths.main_text(f"<body><div><article>Read on</article><article>More</article></div><div><div>{prose}</div></div></body>").endswith(wanted)
    # A wrapper that holds the text isn't boilerplate for its name; what is named within it stays so.
    for tag in ("div class='layout-with-sidebar'", "form id=f", "div role=dialog"):
        inner = f"<div class=sidebar><p>Buy, now.</p></div><div>{prose}</div><footer>Legal, text.</footer>"
        assert tagpaths.main_text(f"<body><{tag}>{inner}</{tag.split()[0]}></body>") == wanted
        assert tagpaths.main_text(f"<body><{tag}><article>{inner}</article></{tag.split()[0]}></body>") == wanted
    # Comments longer than the article they follow.
    assert tagpaths.main_text(f"<body><article>{prose}</article><div class=comments>{prose * 3}</div></body>") == wanted


def test_encoding_round_trip(spark, docs):
    rows = docs.withColumn("n_tokens", F.lit(5))
    encoded = bpe.encode_documents(rows, RANKS, PATTERN, ["doc_id"])
    got = bpe.decode_documents(encoded, RANKS, PATTERN, ["doc_id", "ids"]).collect()
    whole = bpe.load_encoding(RANKS, PATTERN)
    want = collections.Counter((d, np.array(whole.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t in DOCS)
    assert collections.Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got) == want
    assert bpe.encode_documents(rows.limit(0), RANKS, PATTERN, ["doc_id"]).count() == 0


def test_texts_too_long_for_one_call():
    whole = bpe.load_encoding(RANKS, PATTERN)
    text = " ".join(["it's", "a1b2", "\n\n", "Éa"] * 30_000)
    assert bpe.encode_text(whole, text) == whole.encode_ordinary(text)
    assert whole.decode(bpe.encode_text(whole, " " * 1_500_000)) == " " * 1_500_000


def test_quality_counts(spark, docs):
    trusted = spark.createDataFrame([(1,), (1,), (4,), (None,), (99,)], "doc_id long")
    got = llr.quality_rules(docs, trusted).collect()
    want = collections.Counter()
    for doc, text in DOCS:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        want[doc, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), failed] += 1
    fields = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collections.Counter(tuple(r[f] for f in fields) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)
    assert {r.doc_id for r in got if r.kept} >= {1, 2, 4}
    assert llr.quality_rules(docs.limit(0), trusted).count() == 0
    assert {r.score for r in llr.quality_rules(docs, trusted.limit(0)).collect()} == {0.0}


def test_toxicity_held_out(spark):
    draw = np.random.default_rng(5)
    rows, marks = [], []
    for i in range(600):
        words = [WORDS[j] for j in draw.integers(0, 400, 30)]
        toxic = i % 3 == 0
        if toxic:
            words[int(draw.integers(0, 30))] = "vile" + "abcdefgh"[i % 8]
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs, labels = frame(spark, [*rows, (700, None), (701, "")]), spark.createDataFrame(marks, "doc_id long, toxic int")
    net = toxicity.fit(docs, labels)
    scored = toxicity.add_score(docs.select("doc_id", "text"), net, "p").where(~toxicity.is_training(F.col("doc_id"))).collect()
    right = [(r.p >= toxicity.PREDICT) == (r.doc_id % 3 == 0) for r in scored if r.doc_id < 600]
    assert len(right) > 100 and np.mean(right) > 0.95
    assert all(0 <= r.p <= 1 for r in scored)
    clean = toxicity.remove_toxic(docs, labels)
    assert clean.columns == docs.columns and 0 < clean.count() < 602
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert toxicity.remove_toxic(docs.limit(0), labels).count() == 0


def test_toxicity_thresholds_see_the_true_class_ratio(spark):
    draw = np.random.default_rng(9)
    rows, marks = [], []
    for i in range(2700):
        words = [WORDS[j] for j in draw.integers(0, 400, 20)]
        toxic = i % 9 == 0
        # Among as many clean rows "doubtful" has the better F1, among eight times as many "vile" has.
        words += ["doubtful"] * (toxic or draw.random() < 0.2) + ["vile"] * (toxic and draw.random() < 0.7)
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    net = toxicity.fit(docs, labels, sample=150)
    scored = toxicity.add_score(docs.select("doc_id", "text"), net, "p").collect()
    clean = [r.p >= toxicity.PREDICT for r in scored if r.doc_id % 9 and "doubtful" in r.text]
    assert len(clean) > 300 and np.mean(clean) < 0.2
    assert np.mean([r.p >= toxicity.PREDICT for r in scored if "vile" in r.text]) > 0.8


def test_base_spans_are_those_of_the_patterns():
    mail, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    draw = np.random.default_rng(2)

    def brute(x):
        digits = lambda m: re.sub("[^0-9]", "", m.group())
        return (
            [("email", *m.span()) for m in mail.finditer(x)]
            + [("ip", *m.span()) for m in ip.finditer(x) if all(int(p) <= 255 for p in m.group().split("."))]
            + [("card", *m.span()) for m in pii.CARD.finditer(x) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
            + [("phone", *m.span()) for m in pii.PHONE.finditer(x) if 9 <= len(digits(m)) <= 15]
        )

    for _ in range(5000):
        x = "".join(draw.choice(list("a@.1 2+-()0.@b%9é"), 60))
        assert pii.base_spans(x) == brute(x)
    pii.base_spans("9" * 200_000 + "a" * 200_000)  # linear


def test_redaction(spark, docs):
    got = {r.doc_id: r for r in pii.redact_documents(docs.withColumn("n_chars", F.lit(0).cast("bigint"))).collect()}
    assert got[11].text.startswith("mail me at <email> or <phone>, <ip> and <card>.")
    assert got[11].n_chars == len(got[11].text) and got[5].text is None and got[4].text == DOCS[3][1]
    assert pii.redact("abcdef", [("ip", 1, 3), ("card", 2, 4)]) == "a<ip>ef"
    assert pii.redact_documents(docs.limit(0)).count() == 0


def test_boosted_trees_learn_a_rule():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.2) & (x[:, 2] < 0.5)).astype(float)
    p = pii.BoostedTrees().fit(x[:1500], y[:1500]).predict(x[1500:])
    assert ((p >= 0.5) == y[1500:]).mean() > 0.97


def test_contamination(spark, docs):
    items = [(1, text_of(1, 20)), (2, text_of(4, 13) + " " + text_of(2, 13)), (2, "One TWO"), (3, None), (4, "...") , (None, text_of(2, 15)), (12, text_of(1, 20).upper())]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = collections.defaultdict(set)
    for item, text in items:
        words = word.findall((text or "").lower())
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(item)
    want = collections.Counter()
    for doc, text in DOCS:
        words, hit, found = word.findall((text or "").lower()), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        names = tuple(sorted(str(i) for i in found if i is not None))
        want[doc, len(words), len(hit), names, bool(hit) and 20 * len(hit) >= len(words)] += 1
    fields = ("doc_id", "n_words", "n_hit", "items", "contaminated")
    as_rows = lambda df: collections.Counter(tuple(tuple(v) if isinstance(v, list) else v for v in (r[f] for f in fields)) for r in df.collect())
    assert as_rows(suffixes.contamination(docs, benchmark)) == want
    kept = suffixes.remove_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == sum(n for key, n in want.items() if not key[-1])
    in_blocks = suffixes.add_matches(docs.select("doc_id", "text"), benchmark, "found", block_chars=100)
    spans = in_blocks.select("doc_id", suffixes.hit_words(F.col("found.matches")).alias("n")).collect()
    assert collections.Counter((r.doc_id, r.n) for r in spans) == collections.Counter({k: v for k, v in collections.Counter((key[0], key[2]) for key in want.elements()).items()})
    assert suffixes.contamination(docs.limit(0), benchmark).count() == 0
    assert not any(r.contaminated for r in suffixes.contamination(docs, benchmark.limit(0)).collect())


def test_edits_keep_counts_right():
    whole, draw = bpe.load_encoding(RANKS, PATTERN), np.random.default_rng(4)
    for text in ("", "word", " ".join(WORDS), "it's  2 \n\n ok " * 50, "é" * 700):
        tree = edits.build_tree(whole, text, leaf=16)
        for _ in range(30):
            start = int(draw.integers(-2, len(text) + 3))
            stop = start + int(draw.integers(0, 20))
            new = "".join(draw.choice(list("ab 1'\n s"), int(draw.integers(0, 9))))
            a = min(max(start, 0), len(text))
            text = text[:a] + new + text[min(max(stop, a), len(text)) :]
            tree.edit(start, stop, new)
            assert "".join(tree.leaves) == text
            assert tree.n_tokens == len(whole.encode_ordinary(text)) and tree.n_chars == len(text)


def test_edit_table(spark, docs):
    trees = edits.build_trees(docs.where("doc_id < 8"), RANKS, PATTERN)
    change = F.expr("array(struct(0L AS start, 4L AS stop, 'new' AS text), struct(2L AS start, 2L AS stop, CAST(null AS string) AS text), null)")
    got = edits.apply_edits(trees.withColumn("edits", change), RANKS, PATTERN).collect()
    whole = bpe.load_encoding(RANKS, PATTERN)
    for r in got:
        assert r.n_tokens == len(whole.encode_ordinary("".join(r.leaves)))
        assert "".join(r.leaves) == "new" + (dict(DOCS)[r.doc_id] or "")[4:]


def test_chat_round_trip(spark):
    rows = [
        (1, 0, "user", "hi <|end|> <\\|x <|"), (1, 1, "user", None), (1, 2, "assistant", "<|turn|>a<|text|>"), (1, 3, "assistant", "b$1\\"),
        (2, 5, None, ""), (2, 5, None, ""), (2, None, "sys<|tem", "first"), (None, 0, "assistant", "é"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    got = {r.conv_id: r for r in chat.parse_chats(chat.format_chats(turns)).withColumn("learned", chat.loss_text(F.col("turns"))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "hi <|end|> <\\|x <|"), ("user", ""), ("assistant", "<|turn|>a<|text|>"), ("assistant", "b$1\\")]
    assert [tuple(t) for t in got[2].turns] == [("sys<|tem", "first"), ("", ""), ("", "")]
    assert got[1].learned == "<|turn|>a<|text|>b$1\\" and got[2].learned == "" and got[None].learned == "é"
    for r in got.values():
        at, masked = 0, ""
        for outside, inside in zip(r.loss_runs[::2], r.loss_runs[1::2]):
            masked += r.formatted[at + outside : at + outside + inside]
            at += outside + inside
        assert at == len(r.formatted)
        assert re.sub(r"<\\(\\*)\|", r"<\1|", masked) == r.learned
    assert got[1].formatted.count(chat.TURN) == 2  # adjacent turns of a role share a block
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_sketches_pass_similar_texts(spark):
    draw = np.random.default_rng(6)
    rows = []
    for i in range(300):  # 0.8 is 400 of 500 in common
        x = draw.integers(0, 1 << 55, 450, dtype=np.uint64)
        y = np.concatenate([x[:400], draw.integers(0, 1 << 55, 50, dtype=np.uint64)])
        far = np.concatenate([x[:200], draw.integers(0, 1 << 55, 250, dtype=np.uint64)])
        code, owner = np.concatenate([x, y, far]), np.repeat([0, 1, 2], 450)
        a, b, c = (s.tolist() * 2 for s in probminhash.sketches(owner, code, np.ones(len(code)), 3))
        rows.append((a, b, c))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>, c array<long>")
    near = lambda x, y: F.sum(probminhash._sketches_near(F.col(x), F.col(y), 0.8).cast("int"))
    assert tuple(df.agg(near("a", "b"), near("a", "c")).first()) == (300, 0)


def test_sketches_pass_similar_short_texts(spark):
    draw = np.random.default_rng(8)
    for n in (5, 10):
        rows = []
        for _ in range(300):
            x = draw.integers(0, 1 << 55, n, dtype=np.uint64)
            code, owner = np.concatenate([x, x[: n * 4 // 5]]), np.repeat([0, 1], [n, n * 4 // 5])
            rows.append(tuple(s.tolist() * 2 for s in probminhash.sketches(owner, code, np.ones(len(code)), 2)))
        df = spark.createDataFrame(rows, "a array<long>, b array<long>")
        assert df.where(probminhash._sketches_near(F.col("a"), F.col("b"), 0.8)).count() == 300


def test_texts_alike_but_for_repeats_meet(spark):
    start, phrase = text_of(1, 90), " ".join(WORDS[:6]) + " "
    rows = [(i, f"{start} {phrase * n}") for i, n in enumerate((2, 60, 1500))] + [(3, f"{start} " + " ".join(WORDS[:10]))]
    assert all(probminhash.similar(a[1], b[1]) for a in rows for b in rows)
    got = probminhash.near_duplicate_classes(frame(spark, rows)).collect()
    assert {(r.doc_id, r.class_id, r.class_size) for r in got} == {(i, 0, 4) for i in range(4)}


def test_masked_text_follows_the_mask(spark):
    rows = [(1, 0, "user", "é hi <|"), (1, 1, "assistant", "<|end|>𝄞a"), (1, 2, "assistant", ""), (1, 3, "assistant", "<\\|b"), (2, 0, "user", "x")]
    chats = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    masked = chat.masked_text(F.col("formatted"), F.col("loss_runs"))
    assert {r.conv_id: r.m for r in chats.select("conv_id", masked.alias("m")).collect()} == {1: "<|end|>𝄞a<\\|b", 2: ""}
    wrong = F.transform("loss_runs", lambda n, i: F.when(i % 2 == 1, 0).otherwise(n))
    assert {r.m for r in chats.select(chat.masked_text(F.col("formatted"), wrong).alias("m")).collect()} == {""}


def test_matches_of_repetitive_texts():
    """Hits, items and longest matches against plain loops, and equal words without a product."""
    draw = random.Random(3)
    for _ in range(60):
        window, letters = draw.choice([2, 3, 4]), "abc"[: draw.choice([2, 3])]
        items = [(draw.choice([None, 1, 2]), " ".join(draw.choices(letters, k=draw.randint(0, 12)))) for _ in range(3)]
        texts = [" ".join(draw.choices(letters + "z", k=draw.randint(0, 20))) for _ in range(4)]
        sources = [(item, text.split()) for item, text in items if text]
        for text, (n, hits, found, matches) in zip(texts, suffixes._judge(suffixes.Needles(items, window), texts, True)):
            words, hit, named, best = text.split(), set(), set(), {}
            for number, (item, source) in enumerate(sources):
                size = min(window, len(source))
                for p, s in itertools.product(range(len(words) - size + 1), range(len(source) - size + 1)):
                    if words[p : p + size] != source[s : s + size]:
                        continue
                    hit.update(range(p, p + size))
                    named.add(item)
                    if not p or not s or words[p - 1] != source[s - 1]:
                        same = itertools.takewhile(lambda pair: pair[0] == pair[1], zip(words[p:], source[s:]))
                        best[number, p] = max(best.get((number, p), (0, 0)), (sum(1 for _ in same), -s))
            assert n == len(words) and {q for a, k in hits for q in range(a, a + k)} == hit
            assert found == named - {None}
            assert {(i, p): (k, -s) for i, s, p, k in matches} == best
    same = "a " * 4000
    (n, hits, found, matches), = suffixes._judge(suffixes.Needles([(1, same)]), [same], True)
    assert (n, hits, found, matches[0], len(matches)) == (4000, [(0, 4000)], {1}, (0, 0, 0, 4000), 3988)


def test_detector_learns_from_every_text(spark):
    """All texts count, equal ones once, however they are dealt."""
    ids = spark.range(6000).withColumn("text", F.concat(F.lit("call +49 30 "), (F.col("id") + 100_000).cast("string"), F.lit(" or "), F.col("id").cast("string"), F.lit("@x.org")))
    texts = ids.select("text").unionByName(ids.select("text").where("id < 50")).unionByName(spark.createDataFrame([(None,), ("",)], "text string"))
    per_text = len(pii.candidates("call +49 30 100000 or 0@x.org"))
    assert per_text >= 2
    vectors = pii.training_vectors(texts.repartition(5))
    assert vectors.agg(F.sum("n")).first()[0] == 6000 * per_text
    assert sorted(map(tuple, vectors.collect())) == sorted(map(tuple, pii.training_vectors(texts.repartition(2)).collect()))


def test_texts_are_encoded_and_decoded_in_one_worker(spark, docs):
    rows = docs.select("doc_id", "text")
    both = bpe.encode_and_decode(rows, RANKS, PATTERN, ["doc_id"])
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = bpe.decode_documents(bpe.encode_documents(rows, RANKS, PATTERN, ["doc_id"]), RANKS, PATTERN, ["doc_id", "n_tokens", "ids"])
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert both.columns == apart.columns and order(both) == order(apart)
    stages = dict(corpus_pipeline.STAGES)["encoding"](spark, rows, "")
    assert stages._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_encoded_rows_are_handed_on_by_the_slice():
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(1000))})
    assert [b.num_rows for b in bpe._slices([rows])] == [bpe.SLICE] * 15 + [1000 - 15 * bpe.SLICE]


def test_many_words_have_the_cells_of_each():
    words = ["a", "_", "ab", "abc", "abcd", "abcdef", "abcdefg", "\u00e9", "\u00e9\u00e9\u00e9x", "\u65e5\u672c\u8a9e", "x" * 5000]
    assert toxicity.cells_of_all(words).tolist() == [toxicity.cells_of(w) for w in words]
    for text in ("", "A-b_c9 \x00d\x1ce\x7ff", "It's\u2028\u0130\u00df a.b"):
        assert toxicity.words_of(text) == re.findall(r"\w+", text.lower())


def test_words_are_numbered_as_they_are_laid_out():
    scorer = toxicity.Scorer(toxicity.Network())
    flat, starts = scorer.number([["a", "b", "a"], [], ["b"]])
    wanted = toxicity._flatten([[1, 2, 1], [], [2]])
    assert flat.tolist() == wanted[0].tolist() and starts.tolist() == wanted[1].tolist()
