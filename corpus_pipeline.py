"""Raw documents to packed training sequences, in five stages.

Null texts, null ids and repeated rows are treated as the operators state: texts without
a letter go with the first stage, of equal and of similar documents one stays, the mix
repeats documents, and every repeated row is packed as a document of its own. Columns
besides those that the stages use are kept until the last one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillmill.durable import durable
from quillmill.llm import exact_dedup, jaccard_join, language_id, mixing, packing

#: Words that a worker of the last stage remembers; the workers of all stages share memory.
WORKER_WORDS = 40_000


def in_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones have.

    Texts without a letter go, and texts of which the landmarks know clearly fewer n-grams
    than of the labelled texts: other scripts, random letters, encoded data. So do all
    texts where there is nothing to learn from.
    """
    model = language_id.fit(docs)
    found = language_id.predict(docs, model, shares=True)
    kept = found.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("known") >= model.least_known))
    return kept.select("row.*")


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar word shingles, the one with the smallest id stays."""
    return jaccard_join.one_of_each_group(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the target weights; a document is repeated at most three times."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset`` of every piece."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), stored_words=WORKER_WORDS)


STAGES = [
    ("language id", in_known_languages),
    ("exact dedup", without_copies),
    ("n-gram jaccard join", without_near_copies),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]
#: Trained models, hashed orders and tokenizers have no SQL; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
