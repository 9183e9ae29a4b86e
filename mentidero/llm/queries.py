"""The registered queries of this folder: thin layers that derive the agreed columns from the operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from mentidero.llm import bytenet, pii, toxicity
from mentidero.llm.bpe import encode_and_decode
from mentidero.llm.chat import format_chats, masked_text, parse_chats
from mentidero.llm.common import field, narrow, table
from mentidero.llm.debruijn import collocations
from mentidero.llm.edits import apply_edits, build_trees, sample_edits
from mentidero.llm.hadamard import cluster_vectors
from mentidero.llm.llr import quality_rules
from mentidero.llm.probminhash import near_duplicate_classes
from mentidero.llm.suffixes import contamination
from mentidero.llm.tagpaths import extract_text
from mentidero.llm.toxicity import add_score
from mentidero.llm.warc import page_records, read_archives, write_archives
from mentidero.operators.once import compute_once
from mentidero.session import scratch_dir

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path, key="page_id", payload="html", url="url")
    return page_records(read_archives(spark, path)).withColumnRenamed("key", "page_id")


def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op3_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = narrow(table(spark, sf_dir, "pages"), page_id="bigint", url="string", html="string")
    texts = compute_once(pages.withColumnRenamed("html", "text"), "text", extract_text(F.col("text")))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = narrow(table(spark, sf_dir, "documents"), doc_id="bigint", text="string")
    return encode_and_decode(docs, RANKS, public_tokenizers.PATTERN, ["doc_id"]).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality_rules(table(spark, sf_dir, "documents"), labels.where("quality = 1"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = narrow(table(spark, sf_dir, "documents"), doc_id="bigint", text="string")
    scored = add_score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), "score").select("doc_id", "score")
    return compute_once(scored, "score", F.col("score")).select(
        "doc_id", (~toxicity.is_training(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= toxicity.PREDICT).cast("int").alias("predicted"),
    )


def op7_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = narrow(table(spark, sf_dir, "documents"), doc_id="bigint", text="string")
    found = compute_once(pii.add_spans(docs, pii.fit(docs), "found").select("doc_id", "found"), "found", F.col("found"))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("found.base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in pii.BASE_KINDS],
        F.sha2(joined(F.col("found.base")), 256).alias("base_sha256"), joined(F.col("found.spans")).alias("spans"),
    )


def op8_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = narrow(table(spark, sf_dir, "documents"), doc_id="bigint", text="string")
    trees = build_trees(docs, RANKS, public_tokenizers.PATTERN)
    n_chars = F.aggregate("leaves", F.lit(0), lambda n, leaf: n + F.char_length(leaf))
    edited = apply_edits(
        trees.withColumn("edits", sample_edits(n_chars, field(trees, "doc_id", "bigint"))), RANKS, public_tokenizers.PATTERN
    )
    return edited.select(
        "doc_id", "tokens_before", F.col("n_tokens").alias("tokens_after"), "n_chars", "encoded_chars",
        F.sha2(F.array_join("leaves", ""), 256).alias("text_sha256"),
    )


def op10_relational_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = narrow(table(spark, sf_dir, "conversations"), conv_id="bigint", turn="bigint", role="string", text="string")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    parsed = parse_chats(format_chats(turns.unionByName(extra)))
    turn_text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = masked_text(F.col("formatted"), F.col("loss_runs"))
    return parsed.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(turn_text, 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op11_debruijn_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(~toxicity.is_training(F.col("doc_id")), F.lit(True))
    return bytenet.add_language(docs, bytenet.fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


REGISTERED = {
    f.__name__: f
    for f in (
        op1_warc, op2_probminhash, op3_tag_paths, op4_byte_bpe, op5_llr_quality, op6_toxicity, op7_boosted_pii,
        op8_suffix_decontamination, op9_edit_counts, op10_relational_chat, op11_debruijn_collocations,
        op12_byte_network, op13_hadamard_clusters, pipeline,
    )
}
