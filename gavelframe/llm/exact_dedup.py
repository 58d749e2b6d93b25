"""Exact duplicates by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z. Three steps
reduce them: each task combines its own rows (the partial aggregate), rows of
one digest meet in salted groups, and the salt winners meet per digest. Every
step groups on the full text beside its digest, so a digest clash joins
nothing. A text that holds a third of all rows reaches each salted group as one
row per task, and the last step as one row per salt.

Only classes go back to the documents, without their texts: a digest that
turned out to have one text names its class, and for clashing digests the text
is compared once more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.llm.common import ascii_lower, once
from gavelframe.session import cut


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = _sha256,
) -> DataFrame:
    """One row per distinct text: digest, keep_id, group_size, variants, clash_text.

    `variants` is the number of distinct texts of the digest; `clash_text` is
    set only where that is more than one.
    """
    text = ascii_lower(F.col(text_col))
    keyed = docs.select(
        digest(text).alias("digest"),
        text.alias("content"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("salt"),
        F.col(id_col).alias("id"),
    )
    salted = keyed.groupBy("digest", "salt", "content").agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
    whole = (
        salted.repartition("digest")
        .groupBy("digest", "content")
        .agg(F.max("best").alias("keep_id"), F.sum("n").alias("group_size"))
    )
    variants = F.count(F.lit(1)).over(Window.partitionBy("digest"))
    return whole.withColumn("variants", variants).select(
        "digest", "keep_id", "group_size", "variants", F.when(F.col("variants") > 1, F.col("content")).alias("clash_text")
    )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = _sha256,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    The row with the largest id of equal texts stays. NULL texts count as
    empty. A NULL id loses against any other; in a group of NULL ids, all
    carry keep_id NULL and kept true. Rows that repeat the winning id are all
    marked as kept (`keep_rows` leaves one of them). Other columns of the input
    are not looked at. An empty table gives an empty result.
    """
    found = cut(classes(docs, id_col, text_col, salts, digest), "exact-classes")
    text = ascii_lower(F.col(text_col))
    keyed = docs.select(
        F.col(id_col).alias("id"), digest(text).alias("digest"), F.sha2(text, 256).alias("text_sha256")
    )
    sole = found.where("variants = 1").select("digest", "keep_id", "group_size")
    matched = keyed.join(sole, "digest")
    clashing = found.where("variants > 1")
    if not clashing.isEmpty():
        clash = docs.select(
            F.col(id_col).alias("id"),
            digest(text).alias("digest"),
            F.sha2(text, 256).alias("text_sha256"),
            text.alias("clash_text"),
        ).join(clashing.select("digest", "clash_text", "keep_id", "group_size"), ["digest", "clash_text"])
        matched = matched.unionByName(clash.drop("clash_text"))
    return matched.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The documents that stay, with all their columns; repeated rows of a winner once.

    Rows are dealt by text and id, so the copies of one text spread over the
    tasks, and only winners find a partner. A digest that clashed names all its
    texts' winners, and every one of them is of another text.
    """
    found = classes(docs, id_col, text_col, salts)
    winners = found.select(_winner_key(F.col("digest"), F.col("keep_id")).alias("key"))
    key = _winner_key(_sha256(ascii_lower(F.col(text_col))), F.col(id_col))
    return once(docs, key, cut(winners, "exact-winners"))


def _winner_key(digest: Column, id_column: Column) -> Column:
    return F.concat_ws("/", digest, F.coalesce(F.concat(F.lit("="), id_column.cast("string")), F.lit("NULL")))
