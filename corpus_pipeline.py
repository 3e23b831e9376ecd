"""From raw documents to token ids: reject poor documents, drop copies and near copies, mix sources, encode.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``, whatever they are; a table without rows stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paritas.llm.bpe import encode
from paritas.llm.common import Workspace, table
from paritas.llm.exact_dedup import drop_exact_duplicates
from paritas.llm.mixing import mixed
from paritas.llm.near_dup import drop_near_duplicates
from paritas.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling rejects go.

    Null and empty texts score 0 and are judged by that; rows that repeat an id are
    judged each; ties at the cut stay.  Without labels of both kinds, all stay.
    """
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; null counts as empty, a null id as the smallest.

    Rows equal in id and text are one document, and one of them stays.
    """
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest doc_id.

    Documents without words are linked with nothing and stay; of rows equal in id and
    text one stays.
    """
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Null and empty texts hold no word and are copied as often as their source asks;
    null sources are a source of their own.  Rows equal in id and text are one document.
    """
    return mixed(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the byte offset where each token ends; null and empty texts have none."""
    return encode(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

#: SQL can't express the classifier, the banding or the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written below the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), name)
        if place:
            work.drop(STAGES[place - 1][0])
    return docs
