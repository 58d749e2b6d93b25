"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

Inner product is no metric, so every candidate gets one more component that
brings all of them to the same length; a query gets a zero there. Euclidean
distance then ranks candidates exactly as the inner product does, and the
triangle inequality holds.

Rows are dealt to shards of bounded size by a hash of their id. A task builds
the tree of a shard and writes it as one row of arrays. Queries form
blocks of bounded size; a tree and a block meet in one group, one for each
shard and block, and both are a few megabytes. A block walks a tree once: first every query drops to its
nearest leaf to get a bound, then all queries visit the tree together, and a
subtree is skipped for a query if `factor` times its least possible distance
exceeds the distance of the query's k-th best so far. A factor of one is
exact; larger ones skip more. The k best per shard are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.session import cut

_LEAF = 128
_SLACK = 1e-9  # relative rounding allowance of distances


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: rows with an id and a finite, non-zero vector of the most common length; equal rows once."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.coalesce(sound, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), "n").limit(1).select(F.col("n").alias("dim"))
    return rows.join(F.broadcast(common), F.size("v") == F.col("dim")).drop("dim").dropDuplicates(["id", "v"])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed component by component, so equal pairs give equal bits."""
    total = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        total += a[:, k, None] * b[None, :, k]
    return total


def build(ids: np.ndarray, vectors: np.ndarray, radius: float, seed: int) -> dict[str, np.ndarray]:
    """Tree in arrays: rows in leaf order, and per node its slice, vantage row, and distances to either half."""
    rest = np.sqrt(np.maximum(radius**2 - (vectors**2).sum(1), 0.0))
    points, rng = np.hstack([vectors, rest[:, None]]), np.random.default_rng(seed)
    order, nodes, todo = np.arange(len(ids)), [], [(0, len(ids), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = here
        node = [a, b, -1, -1, -1, 0.0, 0.0, 0.0, 0.0]
        nodes.append(node)
        if b - a <= _LEAF:
            continue
        own = order[a:b]
        vantage = own[rng.integers(b - a)]
        far = np.sqrt(((points[own] - points[vantage]) ** 2).sum(1))
        rank = np.argsort(far, kind="stable")
        order[a:b], far, middle = own[rank], far[rank], (a + b) // 2
        node[4:] = [int(vantage), far[0], far[middle - a - 1], far[middle - a], far[-1]]
        todo += [(middle, b, here, 1), (a, middle, here, 0)]
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    flat = np.array(nodes, float).reshape(-1, 9)
    inner = flat[:, 4] >= 0
    flat[inner, 4] = place[flat[inner, 4].astype(int)]
    return {"ids": ids[order], "vectors": vectors[order], "nodes": flat}


class _Best:
    """The k best of each query so far, by (score descending, id ascending)."""

    def __init__(self, n: int, k: int) -> None:
        self.score, self.id, self.k = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max), k

    def offer(self, queries: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if score.shape[1] > self.k:
            # Everything that ties with the k-th best is kept until ids have decided.
            edge = -np.partition(-score, self.k - 1, axis=1)[:, self.k - 1 : self.k]
            width = int((score >= edge).sum(1).max())
            if width < score.shape[1] // 2:
                top = np.argpartition(-score, width - 1, axis=1)[:, :width]
                score, ids = np.take_along_axis(score, top, 1), np.take_along_axis(ids, top, 1)
        score = np.hstack([self.score[queries], score])
        ids = np.hstack([self.id[queries], ids])
        best = np.lexsort((ids, -score), axis=1)[:, : self.k]
        self.score[queries], self.id[queries] = np.take_along_axis(score, best, 1), np.take_along_axis(ids, best, 1)


def search(tree: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, radius: float, k: int, factor: float) -> _Best:
    nodes, best = tree["nodes"], _Best(len(queries), k)
    reach = (queries**2).sum(1) + radius**2  # squared distance is reach - 2 * score
    tolerance = _SLACK * np.sqrt(reach)

    def leaf(node: np.ndarray, active: np.ndarray) -> None:
        a, b = int(node[0]), int(node[1])
        score = _products(queries[active], tree["vectors"][a:b])
        ids = np.broadcast_to(tree["ids"][a:b], score.shape)
        own = ids == query_ids[active, None]
        best.offer(active, np.where(own, -np.inf, score), np.where(own, np.iinfo(np.int64).max, ids))

    def to_vantage(node: np.ndarray, active: np.ndarray) -> np.ndarray:
        score = queries[active] @ tree["vectors"][int(node[4])]
        return np.sqrt(np.maximum(reach[active] - 2 * score, 0.0))

    done: dict[int, np.ndarray] = {}
    todo = [(0, np.arange(len(queries)))]
    while todo:  # first descent
        here, active = todo.pop()
        node = nodes[here]
        if node[4] < 0:
            leaf(node, active)
            done[here] = active
            continue
        near = to_vantage(node, active) <= (node[6] + node[7]) / 2
        todo += [(int(node[2 + side]), part) for side, part in ((1, active[~near]), (0, active[near])) if len(part)]
    todo = [(0, np.arange(len(queries)))]
    while todo:
        here, active = todo.pop()
        node = nodes[here]
        if node[4] < 0:
            active = np.setdiff1d(active, done[here]) if here in done else active
            if len(active):
                leaf(node, active)
            continue
        d = to_vantage(node, active)
        bound = np.sqrt(np.maximum(reach[active] - 2 * best.score[active, -1], 0.0))
        for side in (1, 0):
            nearest, farthest = node[5 + 2 * side], node[6 + 2 * side]
            least = np.maximum(np.maximum(nearest - d, d - farthest), 0.0)
            part = active[factor * least <= bound + tolerance[active]]
            if len(part):
                todo.append((int(node[2 + side]), part))
    return best


def _shard(id_column: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(shards)).cast("int")


def nearest(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    factor: float = 1.0,
    shard_rows: int = 16_384,
    block_rows: int = 1024,
    seed: int = 7,
) -> DataFrame:
    """One row per query and neighbour: query_id, rank, the id column, score.

    `queries` selects the query rows; every other usable row is a candidate. Score
    is the inner product in double precision, ties go to the smaller id, and a
    query with fewer candidates returns all. Vectors that are NULL, zero, of a
    length other than the most common one, or hold NULL or non-finite
    components take no part, nor do rows without an id; equal rows count once,
    and rows that share the query's id are not its candidates. An empty table
    gives an empty result.
    """
    found = cut(usable(vectors, id_col, vector_col), "vp-vectors")
    asked = vectors.where(queries).select(F.col(id_col).alias("id")).distinct()
    size = found.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("v")).alias("dim"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square"),
    ).head()
    n, dim, radius = size["n"], size["dim"] or 0, math.sqrt(size["square"] or 0.0) * (1 + 1e-12)
    shards = max(1, -(-n // shard_rows))

    def plant(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        tree = build(frame["id"].to_numpy(), np.stack(frame["v"].to_numpy()), radius, seed)
        return pd.DataFrame({"shard": [frame["shard"].iloc[0]], **{name: [array.tobytes()] for name, array in tree.items()}})

    trees = (
        found.withColumn("shard", _shard(F.col("id"), shards))
        .groupBy("shard")
        .applyInPandas(plant, "shard int, ids binary, vectors binary, nodes binary")
    )
    trees = cut(trees, "vp-trees")

    def to_blocks(frame: pd.DataFrame) -> pd.DataFrame:
        ids, values = frame["id"].to_numpy(), np.stack(frame["v"].to_numpy())
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "query_ids": [ids.tobytes()], "queries": [values.tobytes()]})

    n_blocks = max(1, -(-asked.count() // block_rows))
    blocks = (
        found.join(asked, "id", "left_semi")
        .withColumn("block", _shard(F.concat(F.lit("q"), F.col("id").cast("string")), n_blocks))
        .groupBy("block")
        .applyInPandas(to_blocks, "block int, query_ids binary, queries binary")
    )

    def walk(queried: pd.DataFrame, planted: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.empty(0, np.int64), "id": np.empty(0, np.int64), "score": np.empty(0)})]
        for tree_row in planted.itertuples():
            tree = {
                "ids": np.frombuffer(tree_row.ids, np.int64),
                "vectors": np.frombuffer(tree_row.vectors, np.float64).reshape(-1, dim),
                "nodes": np.frombuffer(tree_row.nodes, np.float64).reshape(-1, 9),
            }
            for row in queried.itertuples():
                ids = np.frombuffer(row.query_ids, np.int64)
                best = search(tree, ids, np.frombuffer(row.queries, np.float64).reshape(-1, dim), radius, k, factor)
                filled = best.score > -np.inf
                out.append(pd.DataFrame({"query_id": np.repeat(ids, filled.sum(1)), "id": best.id[filled], "score": best.score[filled]}))
        return pd.concat(out)

    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    left = blocks.withColumn("shard", every_shard).groupBy("shard", "block")
    right = trees.withColumn("block", every_block).groupBy("shard", "block")
    local = left.cogroup(right).applyInPandas(walk, "query_id long, id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
