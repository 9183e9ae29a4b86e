"""The stages keep clean documents, drop planted ones, and end in ids that decode to the redacted texts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import corpus_pipeline
from conftest import SMALL_SF
from mentidero.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL_SF), reason="driver tables not present")


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet").withColumn("extra", F.lit(1))
    rows = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, rows, SMALL_SF).cache()
        assert kept.columns == docs.columns, name
        assert 0 < kept.count() <= rows.count(), name
        rows = kept
    last = corpus_pipeline.STAGES[-1][1](spark, rows, SMALL_SF).collect()
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    whole = bpe.load_encoding(corpus_pipeline.RANKS, corpus_pipeline.public_tokenizers.PATTERN)
    for r in last:
        assert bytes(r.decoded).decode() == texts[r.doc_id]
        assert np.frombuffer(r.ids, "<u4").tolist() == whole.encode_ordinary(texts[r.doc_id])


def test_no_documents(spark):
    schema = StructType.fromDDL("doc_id long, text string, lang string, source string, n_chars long")
    rows = spark.createDataFrame([], schema)
    for _, step in corpus_pipeline.STAGES:
        rows = step(spark, rows, SMALL_SF)
        assert rows.count() == 0
