"""Removal of boilerplate lines by the number of distinct sites they stand on.

Lines are known by two hashes of their trimmed text. Each line hash gets a
HyperLogLog sketch of its sites; sketches are merged by the aggregate, first
within each task, so a line on every page arrives as one sketch per task. An
estimate clearly above or below the threshold decides. Lines whose estimate
lies within the sketch's error of the threshold get an exact distinct count,
whose first step counts each (line, site) once per task. Documents then drop
the lines that stand on too many sites.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.common import packed
from gavelframe.session import cut

_BLANK = " \t\r"
_SIGMAS = 4


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _key(line: Column) -> Column:
    """Two independent 64- and 32-bit hashes; NULL for a blank line."""
    line = F.trim(line, F.lit(_BLANK))
    return F.when(line != "", F.struct(F.xxhash64(line).alias("h"), F.crc32(line).alias("c")))


def _occurrences(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """id, site, key: each distinct line of a document once; a NULL site is a site of its own."""
    keys = F.array_distinct(F.array_compact(F.transform(_lines(F.col(text_col)), _key)))
    site = F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("NULL"))
    return docs.select(F.col(id_col).alias("id"), site.alias("site"), F.explode(keys).alias("key"))


def spread_lines(occurrences: DataFrame, min_sites: int, lg_k: int) -> DataFrame:
    """key, n_sites of the lines on at least `min_sites` sites.

    n_sites is exact near the threshold and an estimate above.
    """
    error = _SIGMAS * 1.04 / math.sqrt(2**lg_k)
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k))
    sketched = occurrences.groupBy("key").agg(estimate.alias("estimate"))
    # Never less than one site to either side, so small thresholds are always counted.
    low, high = min(min_sites * (1 - error), min_sites - 1), max(min_sites * (1 + error), min_sites + 1)
    possible = cut(sketched.where(F.col("estimate") >= low), "line-sketches")
    near = possible.where(F.col("estimate") <= high).select("key")
    exact = occurrences.join(near, "key", "left_semi").groupBy("key").agg(F.count_distinct("site").alias("n_sites"))
    far = possible.where(F.col("estimate") > high).select("key", F.col("estimate").alias("n_sites"))
    return exact.where(F.col("n_sites") >= min_sites).unionByName(far)


def remove_spread_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = 10,
    lg_k: int = 11,
) -> DataFrame:
    """One row per input row: its columns as struct `row`, n_lines, n_removed, clean_text.

    Lines are compared without blanks at their ends; blank lines are never
    counted or removed. A removed line goes everywhere, in every document.
    NULL text counts as empty, a NULL site as one site, NULL and repeated ids
    as one document for the lookup (the lines of each row decide). An empty
    table gives an empty result.
    """
    seen = cut(_occurrences(docs, id_col, text_col, site_col), "line-keys")
    spread = cut(spread_lines(seen, min_sites, lg_k), "spread-lines")
    held = seen.join(spread, "key").groupBy("id").agg(F.collect_set("key").alias("gone"))
    rows = packed(docs, own_id=F.col(id_col), lines=_lines(F.col(text_col)))
    joined = rows.join(held, F.expr("own_id <=> id"), "left")
    stays = F.filter("lines", lambda line: ~F.coalesce(F.array_contains("gone", _key(line)), F.lit(False)))
    n_lines = F.size(F.filter("lines", lambda line: F.trim(line, F.lit(_BLANK)) != ""))
    cleaned = joined.withColumn("stays", F.when(F.col("gone").isNull(), F.col("lines")).otherwise(stays))
    return cleaned.select(
        "row",
        n_lines.cast("long").alias("n_lines"),
        (F.size("lines") - F.size("stays")).cast("long").alias("n_removed"),
        F.array_join("stays", "\n").alias("clean_text"),
    )
