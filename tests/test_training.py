import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from mentidero.operators import embed, scoring, training
from mentidero.operators.evaluate import binary_metrics, champion, model_compare, unpivot_metrics
from mentidero.operators.scaler import fit_scaler, load_scaler, scaler_stats
from mentidero.plans.train_compare import train_and_compare
from mentidero.plans.training_set import build_training_set

NOW = "timestamp_ntz'2025-01-31 10:20:30'"


def vectors(spark, n=400, d=6, seed=0):
    """Two noisy classes on either side of a curved border."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = ((x[:, 0] ** 2 + x[:, 1]) > 0.7).astype(int)
    split = np.where(np.arange(n) % 5 < 3, "train", np.where(np.arange(n) % 5 == 3, "val", "test"))
    rows = [(str(i), [float(v) for v in x[i]], int(y[i]), str(split[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id STRING, embedding ARRAY<DOUBLE>, label INT, split STRING"), x, y


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([([1.0, 0.1],), ([3.0, 0.1],), ([8.0, 0.1],)], "v ARRAY<DOUBLE>")
    stats = {r["dim"]: r for r in scaler_stats(df, "v").collect()}
    assert np.isclose(stats[0]["std"], np.std([1, 3, 8])) and np.isclose(stats[0]["mean"], 4)
    scaler = fit_scaler(df, "v")
    assert scaler.scale[1] == 1.0
    out = np.array([r["scaled"] for r in scaler.transform(df, "v").collect()])
    assert np.allclose(out[:, 0], (np.array([1, 3, 8]) - 4) / np.std([1, 3, 8])) and np.allclose(out[:, 1], 0)


def test_scaler_round_trip(spark, tmp_path):
    df, _, _ = vectors(spark, 50)
    scaler = fit_scaler(df, "embedding")
    scaler.save(spark, str(tmp_path / "s"))
    assert load_scaler(spark, str(tmp_path / "s")) == scaler


def features_of(df):
    features, _ = training.scaled_features(df, "embedding")
    return training.with_features(features)


def test_network_learns_a_curved_border_and_loads_as_saved(spark, tmp_path):
    df, _, _ = vectors(spark, 900)
    features = features_of(df).repartition(4)
    model = training.fit_trial(features.where("split = 'train'"), 6, training.Trial(32, 1e-4, 5e-3, 64, 80))
    scored = training.predict(model, features)
    assert binary_metrics(scored.where("split = 'test'"), "label", "prediction").first()["accuracy"] > 0.8
    model.write().save(str(tmp_path / "n"))
    again = training.predict(PipelineModel.load(str(tmp_path / "n")), features)
    assert scored.select("id", "p_positive").exceptAll(again.select("id", "p_positive")).count() == 0
    assert scored.where("prediction <> CAST(p_positive >= 0.5 AS INT)").count() == 0


def test_trials_are_seeded_and_in_range():
    trials = training.draw_trials(50)
    assert trials == training.draw_trials(50) and trials != training.draw_trials(50, seed=1)
    assert all(1e-5 <= t.alpha <= 1e-1 and 1e-4 <= t.rate <= 5e-3 for t in trials)


def test_search_returns_the_best_val_f1(spark):
    df, _, _ = vectors(spark, 300)
    trials = [training.Trial(8, 1e-4, 1e-4, 64, 1), training.Trial(32, 1e-4, 5e-3, 16, 15)]
    table, best = training.random_search(features_of(df).persist(), 6, trials)
    rows = sorted(table.collect(), key=lambda r: -r["val_f1"])
    assert trials[rows[0]["trial"]] == best


def test_f1_is_zero_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y INT, p INT")
    assert tuple(binary_metrics(df, "y", "p").first()) == (2, 1.0, 0.0)


def test_champion_version_only_for_the_registered_model(spark):
    schema = "model_key STRING, run_id STRING, val_accuracy DOUBLE, val_f1 DOUBLE, test_accuracy DOUBLE, test_f1 DOUBLE"
    rows = [("mlp_transformer", "r", 0.7, 0.714, 0.7, 0.709), ("bert_x", "r", 0.5, 0.39, 0.5, 0.371)]
    versions = spark.createDataFrame([("9",), ("10",), ("x",)], "version STRING")
    results = spark.createDataFrame(rows, schema)
    assert champion(results, versions).first()["champion_version"] == 10
    assert champion(results.where("model_key = 'bert_x'"), versions).first()["champion_version"] is None
    best = model_compare(results).first()
    assert best["model_key"] == "mlp_transformer" and best["signal"] == "stable"
    assert unpivot_metrics(results, "f1", "f1_score").count() == 4


def test_hashed_encoder_against_plain_python(spark):
    texts = ["a b a", "b c", "", "d d d d"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, clean_text STRING")
    model = embed.fit_encoder(df, 64)
    got = {r["i"]: np.array(r["embedding"]) for r in embed.apply_encoder(model, df).collect()}
    tf = model.stages[1]
    counts = np.zeros((4, 64))
    for i, t in enumerate(texts):
        for word in t.split(" ") if t else [""]:
            counts[i, tf.indexOf(word)] += 1
    idf = np.log((4 + 1) / ((counts > 0).sum(axis=0) + 1))
    weighted = counts * idf
    norm = np.linalg.norm(weighted, axis=1, keepdims=True)
    expected = np.divide(weighted, norm, out=np.zeros_like(weighted), where=norm > 0)
    for i in range(4):
        assert np.allclose(got[i], expected[i], atol=1e-6)


def test_injected_encoder_batches_and_nulls(spark):
    seen = []

    def make():
        def encode(batch):
            assert 0 < len(batch) <= 3
            return np.array([[len(t), 1.0] for t in batch])

        return encode

    df = spark.createDataFrame([(i, "x" * i if i % 4 else None) for i in range(20)], "i INT, t STRING")
    out = {r["i"]: r["embedding"] for r in embed.embed_texts(df, "t", make, batch_size=3).collect()}
    assert out == {i: [float(i), 1.0] if i % 4 else None for i in range(20)} and not seen


def test_router_sends_each_text_to_one_model(spark):
    df = spark.createDataFrame(
        [("good", "mlp_transformer"), ("good", "bert_nlptown"), ("good", "bert_distilbert"), ("good", "nope"), ("good", None)],
        "t STRING, k STRING",
    )

    def only_mine(width):
        def make():
            return lambda texts: np.array([[0.0] * (width - 1) + [2.0] for _ in texts])

        return scoring.classifier_logits(make)

    out = scoring.score_comments(
        df, "t", lambda c: F.when(c.isNotNull(), F.lit(0.25)),
        {"bert_nlptown": only_mine(5), "bert_distilbert": only_mine(2)}, F.col("k"),
    ).collect()
    assert [(r["label"], r["model_key"], r["warning"] is not None) for r in out] == [
        ("negative", "mlp_transformer", False), ("positive", "bert_nlptown", False),
        ("positive", "bert_distilbert", False), ("negative", "mlp_transformer", True), ("negative", "mlp_transformer", False),
    ]
    assert out[0]["score"] == 0.25 and out[0]["confidence"] == 0.75
    assert abs(out[1]["score"] - np.exp(2) / (4 + np.exp(2))) < 1e-12


def test_whole_flow(spark, tmp_path):
    """Comments to splits to compared models, with one injected classifier."""
    words = ["good", "great", "bad", "awful", "fine", "poor"]
    rows = [
        (f"c{i}", f"{words[i % 6]} text number {i} {words[(i * 7) % 6]}!", f"u{i % 9}", float(1735689600 + i),
         (100 if i % 6 in (0, 1, 4) else 1) + i % 7, False)
        for i in range(240)
    ]
    comments = spark.createDataFrame(
        rows, "comment_id STRING, body STRING, author STRING, created_utc DOUBLE, score BIGINT, is_submitter BOOLEAN"
    )
    path = build_training_set(comments, str(tmp_path / "set"))
    splits = spark.read.parquet(path)
    assert {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()} == {"train": 168, "val": 36, "test": 36}

    def make():
        return lambda texts: np.array([[t.count("bad") + t.count("awful") + t.count("poor"), 0.5] for t in texts])

    out = train_and_compare(
        splits, str(tmp_path / "run"), "run-1", F.expr(NOW), sample_frac=0.5, trials=2, dimensions=32,
        classifiers={"bert_distilbert": scoring.classifier_logits(make)},
    )
    results = {r["model_key"]: r for r in out.results.collect()}
    assert set(results) == {"mlp_transformer", "bert_distilbert-base-uncased-finetuned-sst-2-english"}
    assert all(0 <= r["val_f1"] <= 1 for r in results.values())
    assert out.trials.count() == 2 and out.comparison.count() == 2
    assert out.summary.first()["best_model_key"] in results
    meta = spark.read.json(str(tmp_path / "run/embeddings/metadata"))
    assert {r["split"]: (r["n"], r["dim"]) for r in meta.collect()} == {"train": (84, 32), "val": (18, 32), "test": (18, 32)}
    loaded = PipelineModel.load(f"{out.model_path}/network").stages[0]
    assert np.array_equal(loaded.weights.toArray(), out.model.stages[0].weights.toArray())
