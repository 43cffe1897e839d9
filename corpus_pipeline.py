"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the last return the columns of
``documents``. :func:`run` writes each stage's result as Parquet to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from panelloom.llm import exact_dedup, ngram_jaccard, packing, substring_dedup, toxicity
from panelloom.llm.frames import read_documents, read_labels, stored
from panelloom.llm.queries import END_ID, WORD_TOKENIZER


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores below one half; it is learned from all labels there are."""
    model = toxicity.learn_toxicity(docs, read_labels(spark, sf_dir))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z in either case, the document with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 on five-word shingles, the one with the smallest id."""
    return ngram_jaccard.keep_representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that windows of 35 words repeated anywhere cover."""
    return substring_dedup.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their ids."""
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: The classifier and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
