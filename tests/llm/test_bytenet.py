"""The byte network: windows, tables against plain convolutions, gradients, held-out accuracy, odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from mentidero.llm import bytenet
from mentidero.llm.common import table
from mentidero.llm.queries import op12_byte_network

SF = "/root/testdata/sf0.01"


def plain(net, window):
    """Probabilities of one window by the definition."""
    vectors, pooled = net.params["embed"][window].astype("f8"), []
    for width in bytenet.WIDTHS:
        kernel, bias = net.params[f"filter{width}"].astype("f8"), net.params[f"bias{width}"]
        sums = [sum(vectors[i + k] @ kernel[k] for k in range(width)) for i in range(bytenet.WINDOW - width + 1)]
        pooled.append(np.maximum(np.max(sums, axis=0) + bias, 0))
    logits = np.concatenate(pooled) @ net.params["out"] + net.params["shift"]
    return np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()


def test_windows_cover_every_run_of_bytes():
    widest = max(bytenet.WIDTHS)
    for n in (0, 1, 127, 128, 129, 252, 253, 1000):
        raw = (("Añb" * n).encode()[:n]).decode("utf-8", "ignore")
        data = raw.translate(str.maketrans("A", "a")).encode()
        windows = bytenet.windows_of(raw)
        assert windows.shape[1] == bytenet.WINDOW and len(windows) == max(1, -(-(len(data) - widest + 1) // bytenet.STRIDE))
        held = {bytes(w[i : i + widest]) for w in windows for i in range(bytenet.WINDOW - widest + 1)}
        assert all(data[i : i + widest] in held for i in range(len(data) - widest + 1))


def test_tables_equal_plain_convolution():
    net = bytenet.Network(["a", "b", "c"])
    windows = np.random.default_rng(2).integers(0, 256, (5, bytenet.WINDOW)).astype(np.uint8)
    assert np.allclose(bytenet.Scorer(net).probabilities(windows), [plain(net, w) for w in windows], atol=1e-4)


def test_gradients_equal_differences():
    net, draw = bytenet.Network(["a", "b"]), np.random.default_rng(3)
    net.params = {k: v.astype("f8") for k, v in net.params.items()}
    windows, labels = draw.integers(0, 256, (4, bytenet.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])
    loss = lambda: -np.mean([np.log(plain(net, w)[y]) for w, y in zip(windows, labels)])
    grads = bytenet._gradients(net, windows, labels)
    for name, grad in grads.items():
        flat, at = net.params[name].reshape(-1), int(np.abs(grad).argmax())
        old, step = flat[at], 1e-5
        flat[at] = old + step
        up = loss()
        flat[at] = old - step
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * step) - grad.reshape(-1)[at]) < 1e-4 * max(1, abs(grad.reshape(-1)[at])), name


def test_held_out_accuracy_and_contract(spark):
    truth = {r["doc_id"]: r for r in table(spark, SF, "documents").select("doc_id", "lang", F.col("text").rlike(r"\p{L}").alias("known")).collect()}
    got = op12_byte_network(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth) and got[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    judged = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in got if r["held_out"] and truth[r["doc_id"]]["known"]]
    assert np.mean(judged) >= 0.97


def test_odd_rows(spark):
    texts = {"en": "the cat and the dog were with that thing ", "fr": "où est le garçon qui était à la fenêtre "}
    rows = [(i, text * 6, lang) for i in range(60) for lang, text in [list(texts.items())[i % 2]]]
    odd = [
        (100, None, "en"), (101, "", "fr"), (102, " 123 .!\n", "en"), (None, texts["en"], "xx"), (103, texts["fr"], None), (104, "é", None),
        (105, texts["en"] * 4000, None), (106, texts["fr"], "fr"), (106, texts["fr"], "fr"),
    ]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumns(
        {"rank": F.lit("x"), "n": F.lit(1), "judged": F.lit(2), "SCORE": F.lit(3), "place": F.lit(4)}
    )
    net = bytenet.fit(df)
    assert net.langs == ["en", "fr"]
    got = sorted(bytenet.add_language(df, net).collect(), key=repr)
    assert len(got) == len(rows) + len(odd)
    of = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert of[100] == of[101] == of[102] == ("und", 0.0) and of[103][0] == of[106][0] == "fr" and of[105][0] == of[None][0] == "en" and of[104][0] in texts
    unlabelled = df.withColumn("lang", F.lit(None).cast("string"))
    assert bytenet.fit(unlabelled) is None and {r["lang_pred"] for r in bytenet.add_language(df, None).collect()} == {"und"}
    assert bytenet.add_language(df.limit(0), net).count() == 0 and bytenet.fit(df.limit(0)) is None
    assert bytenet.add_language(df.drop("text", "lang"), net).where("lang_pred = 'und'").count() == len(got)
