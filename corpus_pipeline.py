"""From raw documents to packed training sequences, in five stages.

Each stage works on the rows that its predecessor kept and is written before
the next one starts, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gavelframe.llm import exact_dedup, minhash
from gavelframe.llm.common import table
from gavelframe.llm.cotraining import classify
from gavelframe.llm.mixing import mixed_rows
from gavelframe.llm.packing import pack
from gavelframe.llm.queries import word_tokenizer
from gavelframe.session import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts. NULL and empty texts are judged like others, repeated rows alike."""
    return classify(docs, table(spark, sf_dir, "labels")).where("kept").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the largest id. NULL counts as empty; a row that repeats whole stays once."""
    return exact_dedup.keep_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates. Texts without words are classes of their own."""
    return minhash.keep_rows(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, always whole; the last one if that is nearer the target."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens; long texts go on in the next ones, NULL is an end alone."""
    return pack(docs, word_tokenizer())


STAGES = [("quality", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("packing", packing)]

# A trained classifier and a tokenizer cannot be expressed in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
