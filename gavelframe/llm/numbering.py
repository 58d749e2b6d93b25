"""Gapless numbers for rows without one task that sees them all.

Rows are written in partitions; a row's number is its place among the rows of
its group in its own partition, plus the rows of that group in the partitions
before. Only counts per partition and group are summed up, so a group of any
size is numbered by many tasks. What is written keeps the numbers as they were
given out, whichever executors are lost later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.session import cut

# monotonically_increasing_id: partition above, row of the partition below this bit.
_ROW_BITS = 33


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """`rows` with `position` (from 0, by `order` within `group`) and `members` (rows of the group).

    Group columns must not hold NULL. Rows that tie in `order` get their numbers
    in any sequence; they are spread over partitions, so repeated rows make no
    large one.
    """
    tie = F.monotonically_increasing_id()
    keys = [*[F.col(c) for c in group], *order]
    dealt = rows.withColumn("_tie", tie).repartitionByRange(*keys, F.col("_tie"))
    laid = cut(dealt.sortWithinPartitions(*keys, F.col("_tie")).drop("_tie").withColumn("_row", tie), name)
    return placed(laid.withColumn("_part", F.shiftright("_row", _ROW_BITS)), group)


def placed(laid: DataFrame, group: Sequence[str]) -> DataFrame:
    """Turn `_row`, ascending within each `_part` and gapless within each group there, into `position` and `members`."""
    here = laid.groupBy("_part", *group).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.sum("_n").over(of_group.orderBy("_part")) - F.col("_n")
    bounds = here.select("_part", *group, "_first", before.alias("_before"), F.sum("_n").over(of_group).alias("members"))
    found = laid.join(bounds, ["_part", *group])
    return found.withColumn("position", F.col("_row") - F.col("_first") + F.col("_before")).drop("_part", "_row", "_first", "_before")
