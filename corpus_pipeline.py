"""Raw documents to token ids: toxic texts, near copies and contaminated texts go, personal data is redacted,
the rest is encoded. Each stage's rows are written as Parquet in the shared folder and read by the next.

Defined results: a null text is empty to every stage; repeated rows are one group of copies; an empty table
gives no rows; further columns of documents are passed on up to the last stage, which returns doc_id, n_tokens,
`ids` (little-endian unsigned 32-bit) and `decoded`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mentidero.llm import pii, toxicity
from mentidero.llm.bpe import encode_and_decode
from mentidero.llm.common import stage, table
from mentidero.llm.probminhash import one_of_each_class
from mentidero.llm.suffixes import remove_contaminated

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_and_decode(docs, RANKS, public_tokenizers.PATTERN, ["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("encoding", encode),
]

# Trained models, sketches and tokenizers have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
