"""Column helpers and table readers that several corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Text with A-Z lower-cased and every other character unchanged; NULL counts as empty.

    `lower` does the same on pure ASCII and is much faster than a translation.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hand tables that are written inside to Python in batches of so many rows.

    Documents can be long; the default batch of ten thousand of them is held
    several times over by a task and its worker.
    """
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Whole rows as one struct `row` beside computed columns, so that no name can clash."""
    return docs.select(F.struct("*").alias("row"), *[column.alias(name) for name, column in columns.items()])


def text_key(id_column: Column, text: Column) -> Column:
    """Never-NULL name of a row's id and text, by which decisions find their rows again."""
    name = F.coalesce(F.concat(F.lit("="), id_column.cast("string")), F.lit("NULL"))
    return F.concat_ws("/", F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256), name)


def once(docs: DataFrame, key: Column, stay: DataFrame) -> DataFrame:
    """The rows of `docs` whose key is in the column `key` of `stay`, rows with equal keys once.

    Copies of a text have keys of their own by their ids, so no key is large
    unless whole rows repeat; those are combined within each task first.
    """
    rows = packed(docs, key=key).join(stay.select("key"), "key", "left_semi")
    return rows.groupBy("key").agg(F.first("row").alias("row")).select("row.*")
