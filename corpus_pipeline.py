"""From raw documents to packed training sequences, one written table after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrangle.llm.common import fold, materialize, table
from quadrangle.llm.exact_dedup import drop_exact_duplicates
from quadrangle.llm.mixing import mixed_rows
from quadrangle.llm.ngram_join import drop_near_duplicates
from quadrangle.llm.packing import pack_documents
from quadrangle.llm.quality_classifier import fit_quality, keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled documents of three of four folds."""
    trees = fit_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn_from=fold(F.col("doc_id"), 4) != 2)
    return keep_good(docs, trees, threshold=0.7)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return drop_exact_duplicates(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the one with the smallest doc_id."""
    return drop_near_duplicates(docs, n=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice."""
    return mixed_rows(docs, max_repeats=2.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return pack_documents(docs, length=1024)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing sources", mix), ("best-fit packing", pack)]

#: The classifier and the tokenizer can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
