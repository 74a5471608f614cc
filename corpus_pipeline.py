"""A corpus from quality filter to packed sequences; each stage reads what the last one wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tonearm.llm.common import stash, table
from tonearm.llm.lines import dedup_lines
from tonearm.llm.mixing import mixed_documents
from tonearm.llm.near_dedup import one_of_each
from tonearm.llm.packing import best_fit_packing
from tonearm.llm.quality import good_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; the others stay as they are.

    Null and empty texts are scored like all others. Repeated rows stay or go together. Labels
    without a document, and null ones, are left out; without usable labels nothing can be told
    and all documents stay. An empty table stays empty."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the largest doc_id only; no row goes.

    A null or empty text has one empty line and stays as it is, a null doc_id is the smallest of
    all, repeated rows are one document. Texts of any length are split whole."""
    return dedup_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the smallest doc_id: five words,
    similarity 0.8. Texts without words are like no other and stay."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document is a row, whole, as often as it is
    taken. Rows are written by shard, shuffled in it. Texts without words have no size and are
    not taken; a null source is one of its own, repeated rows count each."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096 ids. An empty or null text is its end token
    alone; only documents longer than a sequence are cut. An empty table has no pieces."""
    return best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near dedup", near),
    ("source mix", mix),
    ("packing", pack),
]

#: The classifier and the mix are beyond SQL; tests replay each stage over what it read.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
