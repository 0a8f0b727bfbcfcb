"""One query per operator over its whole table, and its SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame

from custbehav.llm import (
    bpe, html, lm, mixing, negatives, packing, passages, quality, resampling, secrets, simhash, toxicity, vectors,
)
from custbehav.llm.common import read, ship


def op1_packing(spark, folder) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(read(spark, folder, "documents"), vocabulary, end_id=2, window=4096, with_ids=False)


def op2_lm_scores(spark, folder) -> DataFrame:
    return lm.score_documents(read(spark, folder, "documents"))


def op3_simhash(spark, folder) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"), shingle=3, max_bits=3)


def op4_secrets(spark, folder) -> DataFrame:
    docs = read(spark, folder, "documents")
    return secrets.scan(docs, secrets.train(secrets.training_samples(docs)))


def op5_mixing(spark, folder) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op6_html(spark, folder) -> DataFrame:
    return html.main_text(read(spark, folder, "pages"))


def op7_passages(spark, folder) -> DataFrame:
    return passages.repeated_passages(read(spark, folder, "documents"))


def op8_quality(spark, folder) -> DataFrame:
    return quality.quality_report(read(spark, folder, "documents"))


def op9_token_counts(spark, folder) -> DataFrame:
    return bpe.token_counts(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op10_vectors(spark, folder) -> DataFrame:
    return vectors.near_duplicates(read(spark, folder, "embeddings"), threshold=0.9)


def op11_hard_negatives(spark, folder) -> DataFrame:
    return negatives.hard_negatives(read(spark, folder, "embeddings"))


def op12_toxicity(spark, folder) -> DataFrame:
    return toxicity.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"), threshold=0.7)


def op13_resampling(spark, folder) -> DataFrame:
    return resampling.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"), buckets=10_000, percent=25)


QUERIES = [
    op1_packing, op2_lm_scores, op3_simhash, op4_secrets, op5_mixing, op6_html, op7_passages, op8_quality,
    op9_token_counts, op10_vectors, op11_hard_negatives, op12_toxicity, op13_resampling,
]


def queries():
    def ready(query):
        return lambda spark, folder: query(ship(spark), folder)

    return {query.__name__: ready(query) for query in QUERIES}
