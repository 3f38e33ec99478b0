"""A training corpus from raw documents: toxic ones go, one of each group of near copies stays, sources are mixed to
target weights, and what is left is encoded to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it to the shared folder and reads
it again as the next one's documents. Documents may have more columns than the usual ones, whatever their names; all
stages but the last return those they got. A null text is an empty one. Empty tables give empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import automaton, mixing, ngram_join, shared, toxicity
from foliospark.llm.queries import WORD_BPE


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; the models learn from the labels of this run's documents.

    Null labels and ids teach nothing; without labels of both classes nothing is rejected. A score depends on the text
    alone, so equal texts are kept or rejected together, whatever their ids.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.ordinary_documents(docs, toxicity.fit(docs, labels))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies, and all others.

    Of rows with one id and one text one stays; rows without id all stay.
    """
    return ngram_join.kept_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix has them: once an epoch of their source, with a cut in the last.

    A null source is a source; documents without a token belong to no mix and go.
    """
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, decoded`` of every row of the mix; repeated rows and null ids are encoded each."""
    return automaton.encode(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near copies", near_copies_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# The toxicity models are fitted by Newton steps; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
