"""Shards of nearly equal bytes, or of a fixed capacity, by best-fit-decreasing bin packing.

Rows with equal texts form a group that no shard boundary may cut. Groups enter
bins from the largest down, each into the bin whose free room is the tightest
that still holds it; a balanced tree ordered by room finds that bin.

Groups of one size are interchangeable, so the bins are filled from a table of
sizes and how many groups have them: a bin takes as many groups of a size as
fit at once. Sizes count exactly below 65,536 and with sixteen significant bits
(rounded up, so no bin overflows) above, hence there are at most a million of
them for any corpus; only this table comes to the driver. What goes back is a
list of runs: the groups of a size numbered from here to there go to this bin.

Sizes, numbers of groups, and slots in shards are found by aggregates, sums
over partitions and joins. Texts are read once and never moved.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.common import packed
from gavelframe.llm.numbering import numbered, placed
from gavelframe.session import cut

_EXACT_BITS = 16
_RANGE = 4096  # groups of a size that meet the runs of bins in one join key
_CLOSE = 10_000  # the capacity is settled to this part of a mean shard


@dataclass(frozen=True)
class Run:
    """Groups `first` to `last` (excluded) of a size go to `bin`."""

    size: int
    first: int
    last: int
    bin: int


class _Node:
    __slots__ = ("key", "left", "right", "height")

    def __init__(self, key: tuple[int, int]) -> None:
        self.key, self.left, self.right, self.height = key, None, None, 1


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _turned(node: _Node, heavy: str, light: str) -> _Node:
    """Rotate the heavy child above the node."""
    up = getattr(node, heavy)
    setattr(node, heavy, getattr(up, light))
    setattr(up, light, node)
    for x in (node, up):
        x.height = 1 + max(_height(x.left), _height(x.right))
    return up


def _balanced(node: _Node) -> _Node:
    node.height = 1 + max(_height(node.left), _height(node.right))
    for heavy, light in (("left", "right"), ("right", "left")):
        child = getattr(node, heavy)
        if _height(child) > _height(getattr(node, light)) + 1:
            if _height(getattr(child, light)) > _height(getattr(child, heavy)):
                setattr(node, heavy, _turned(child, light, heavy))
            return _turned(node, heavy, light)
    return node


class Rooms:
    """Bins ordered by (free room, number) in a height-balanced search tree."""

    def __init__(self) -> None:
        self._root: _Node | None = None

    def add(self, room: int, bin_: int) -> None:
        def into(node: _Node | None) -> _Node:
            if node is None:
                return _Node((room, bin_))
            if (room, bin_) < node.key:
                node.left = into(node.left)
            else:
                node.right = into(node.right)
            return _balanced(node)

        self._root = into(self._root)

    def _without(self, node: _Node | None, key: tuple[int, int]) -> _Node | None:
        if node is None:
            return None
        if key < node.key:
            node.left = self._without(node.left, key)
        elif key > node.key:
            node.right = self._without(node.right, key)
        elif node.left is None or node.right is None:
            return node.left or node.right
        else:
            after = node.right
            while after.left:
                after = after.left
            node.key = after.key
            node.right = self._without(node.right, after.key)
        return _balanced(node)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least room that holds `size`, the lowest number first."""
        node, best = self._root, None
        while node:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        if best is not None:
            self._root = self._without(self._root, best)
        return best


def best_fit(sizes: Iterable[tuple[int, int]], capacity: int, most: int | None = None) -> tuple[list[Run], int] | None:
    """Runs and number of bins for (size, groups), sizes descending; None if more than `most` bins are needed.

    A group larger than the capacity gets a bin of its own.
    """
    rooms, runs, bins = Rooms(), [], 0
    for size, groups in sizes:
        at = 0
        while at < groups:
            found = rooms.take_tightest(size)
            if found is None:
                if bins == most:
                    return None
                found = (max(capacity, size), bins)
                bins += 1
            room, bin_ = found
            n = min(room // size, groups - at)
            runs.append(Run(size, at, at + n, bin_))
            at += n
            if room - n * size:
                rooms.add(room - n * size, bin_)
    return runs, bins


def level(sizes: list[tuple[int, int]], shards: int) -> list[Run]:
    """Runs over at most `shards` bins of nearly equal load.

    Groups above the fair share of what is left get a bin each. The others are
    packed into bins of the smallest capacity for which best fit needs no more
    bins than there are; a search halves the range between the mean and the mean
    plus the largest group, which always suffices.
    """
    runs: list[Run] = []
    left, total, kind, used = shards, sum(size * groups for size, groups in sizes), 0, 0
    while kind < len(sizes) and left > 1 and sizes[kind][0] * left > total:
        size, groups = sizes[kind]
        runs.append(Run(size, used, used + 1, len(runs)))
        left, total, used = left - 1, total - size, used + 1
        if used == groups:
            kind, used = kind + 1, 0
    if kind == len(sizes):
        return runs
    alone, (largest, groups) = len(runs), sizes[kind]
    rest = [(largest, groups - used), *sizes[kind + 1 :]]
    mean = -(-total // left)
    low, high = max(mean, largest), mean + largest
    best = best_fit(rest, high, left)
    while high > low and (high - low) * _CLOSE > mean:
        middle = (low + high) // 2
        found = best_fit(rest, middle, left)
        if found:
            best, high = found, middle
        else:
            low = middle + 1
    for run in best[0]:
        before = used if run.size == largest else 0
        runs.append(Run(run.size, run.first + before, run.last + before, run.bin + alone))
    return runs


def size_class(size: Column) -> Column:
    """The size rounded up to sixteen significant bits."""
    spare = F.greatest(F.length(F.bin(size)) - _EXACT_BITS, F.lit(0))
    step = F.pow(F.lit(2), spare).cast("long")
    return (F.floor((size + step - 1) / step) * step).cast("long")


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _shard_of_groups(rows: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """key, shard: one row per group of rows (key, size)."""
    groups = rows.groupBy("key").agg(F.sum("size").alias("total"))
    groups = numbered(groups.select("key", size_class(F.col("total")).alias("of_size")), ["of_size"], [F.col("key")], "shards-groups")
    found = groups.groupBy("of_size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("of_size")).collect()
    sizes = [(r["of_size"], r["n"]) for r in found]
    runs = best_fit(sizes, capacity)[0] if capacity else level(sizes, shards)
    kinds = {"size": pa.int64(), "first": pa.int64(), "last": pa.int64(), "bin": pa.int32()}
    listed = pa.table({c: pa.array([getattr(run, c) for run in runs], kind) for c, kind in kinds.items()})
    spread = cut(rows.sparkSession.createDataFrame(listed), "shards-runs").select(
        "*", F.explode(F.sequence(F.floor(F.col("first") / _RANGE), F.floor((F.col("last") - 1) / _RANGE))).alias("range")
    )
    met = groups.withColumn("range", F.floor(F.col("position") / _RANGE)).join(
        spread.withColumnRenamed("size", "of_size"), ["of_size", "range"]
    )
    return met.where("first <= position AND position < last").select("key", F.col("bin").alias("shard"))


def _keyed(docs: DataFrame, text_col: str, **columns: Column) -> DataFrame:
    text = _text(text_col)
    return docs.select(
        # Texts whose hashes clash stay together, too, which costs nothing but a larger group.
        F.xxhash64(text).alias("key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        *[column.alias(name) for name, column in columns.items()],
    )


def assign(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = 16,
    capacity: int | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, size, text_crc32, shard, slot.

    With `shards`, that many shards of nearly equal bytes (fewer if there are
    fewer groups); with `capacity`, few shards of at most so many bytes, save
    groups that are larger. Size is the text's UTF-8 bytes plus 1. NULL and
    empty texts are equal. Rows with equal texts share a shard, whatever their
    ids; a group above the fair share of bytes fills a shard alone, which is
    then larger than the others. NULL and repeated ids are rows as any other.
    Slots number the rows of a shard from 0 without a gap, in no promised
    order. Other columns are not looked at. An empty table gives an empty
    result.
    """
    text = _text(text_col)
    rows = cut(_keyed(docs, text_col, id=F.col(id_col), text_crc32=F.crc32(text)), "shards-rows")
    found = rows.join(cut(_shard_of_groups(rows, shards, capacity), "shards-of-groups"), "key").drop("key")
    laid = cut(found.sortWithinPartitions("shard", "id").withColumn("_row", F.monotonically_increasing_id()), "shards-slots")
    slots = placed(laid.withColumn("_part", F.shiftright("_row", 33)), ["shard"])
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", F.col("position").alias("slot"))


def with_shard(docs: DataFrame, text_col: str = "text", shards: int | None = 16, capacity: int | None = None) -> DataFrame:
    """Whole rows as a struct `row` beside their shard, for a write partitioned by shard."""
    of_groups = _shard_of_groups(cut(_keyed(docs, text_col), "shards-rows"), shards, capacity)
    return packed(docs, key=F.xxhash64(_text(text_col))).join(cut(of_groups, "shards-of-groups"), "key").drop("key")
