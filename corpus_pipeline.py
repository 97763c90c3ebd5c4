"""The training-data pipeline: documents to packed sequences in five stages.

Every stage is a function (spark, docs, sf_dir) -> DataFrame that calls one
operator of ``roadlens.llm``; its result is written as Parquet and read again
as the next stage's ``docs``. All stages but the last return the columns of
documents.

Defined cases: null text counts as empty in every stage; rows with a null doc_id
or source are documents like others (a null doc_id is never held out of the
classifier's training and loses ties, a null source is a source of its own);
repeated rows are equal texts, so exact dedup keeps one; very long texts are
read whole; an empty table passes all stages and gives no pieces; columns that
documents have besides their own are carried through all stages but packing,
whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import bagminhash, bm25_packing, chunk_dedup, qda_quality, source_mix
from roadlens.llm.common import table, written
from roadlens.llm.queries import WORD_BPE, WORD_BPE_SIZE


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return qda_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return chunk_dedup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bagminhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their target weights."""
    return source_mix.mix_sources(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return bm25_packing.pack_documents(docs, public_tokenizers.path(WORD_BPE), end_id=1, vocabulary=WORD_BPE_SIZE)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix),
    ("packing", pack),
]

#: Scores, signatures and tokenizers have no SQL form; tests hold ``run`` against a plain-Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
