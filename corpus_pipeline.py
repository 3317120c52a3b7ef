"""From raw documents to packed training sequences: a pipeline of four stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of ``documents``. ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from acervo.llm import kn_quality, minhash, packing, toxicity
from acervo.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score above their language's toxicity threshold."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose perplexity is above their language's threshold."""
    return kn_quality.reject_low_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest doc_id. Shingles of five words, similarity 0.8."""
    groups = minhash.near_duplicates(docs, width=5, percent=80)
    gone = cut(groups.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct())
    return docs.alias("d").join(gone.alias("g"), F.col("d.doc_id") == F.col("g.gone"), "left_anti")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's pieces with their place in a sequence of at most 1024 tokens."""
    pieces = packing.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return packing.pack(pieces.drop("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Trained models and packing are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stage's rows written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
