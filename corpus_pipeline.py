"""From raw documents to packed training sequences, in four stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; the first three return the columns
of ``documents``, of any number, name and type beside those that a stage uses. Documents are packed last, into
sequences of at most 2048 tokens. An empty table gives an empty one; a very long text is handled to its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civigrid.llm.common import written
from civigrid.llm.langid import accepted
from civigrid.llm.minhash import deduplicated
from civigrid.llm.packing import pack
from civigrid.llm.quality import clean
from civigrid.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines above the host's limit go; so do documents that fail the base rules or are depleted.

    Null and empty texts fail. Documents without a source are one host's. Copies of a text on a host have one verdict;
    repeated rows stay repeated and count as one document.
    """
    return clean(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told with calibrated confidence go.

    So do those without a letter, null texts among them, and all where no row has a language to learn from. A null lang
    or id teaches nothing and is no reason to go; repeated rows stay repeated.
    """
    return accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity of 0.8): the one with the smallest id.

    Texts without words are groups of their own. Of rows that repeat an id one stays; all rows without an id stay.
    """
    return deduplicated(docs, k=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; repeated rows are packed each for itself, null texts as empty ones."""
    return pack(docs, vocabulary("word_bpe_49k.json"), 2048)


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("packing", packing)]

#: SQL can express neither the trained classifier nor the fitted patterns; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; what each keeps is written to the shared folder for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
