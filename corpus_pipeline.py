"""The corpus pipeline: documents to packed sequences, as stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
next one's docs. All but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers

from custbehav.llm import mixing, packing, quality, secrets, simhash
from custbehav.llm.common import read, ship, stored


def quality_rules(spark, docs, sf_dir):
    """Documents that keep most of their text, without the lines that fail."""
    return quality.clean(docs)


def simhash_dedup(spark, docs, sf_dir):
    """One document of every group of fingerprints linked at three bits or fewer."""
    ship(spark)
    return simhash.deduplicated(docs, shingle=3, max_bits=3)


def secret_scans(spark, docs, sf_dir):
    """All documents, with every secret replaced by a mark."""
    return secrets.redact(docs, secrets.train(secrets.training_samples(docs)))


def source_mixing(spark, docs, sf_dir):
    """Every document as often as the mixture of the sources takes it."""
    return mixing.replicate(docs)


def retrieval_packing(spark, docs, sf_dir):
    """Pieces of documents, with their ids, in sequences of 4,096 tokens."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, window=4096)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("retrieval_packing", retrieval_packing),
]

# Fuzzy hashing, tilted rates and retrieval have no counterpart in SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the documents of a folder."""
    docs = read(ship(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs)
    return docs
