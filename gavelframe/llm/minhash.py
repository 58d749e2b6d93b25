"""Near duplicates by DartMinHash, banded joining and exact verification.

DartMinHash throws darts at a region per element, as wide as its weight: every
element has a hashed stream of darts, each with a rank, a place on the weight
axis and a coordinate. A dart hits a set if its place lies below the element's
weight. The earliest dart of each coordinate is the signature. Darts depend on
the element only, so equal regions of two sets keep equal darts, and two
signatures agree in a coordinate with the sets' (weighted) Jaccard similarity.
Only ranks that a set needs to fill its coordinates are thrown: about
k log k + 2 k darts in all, whatever its size.

Equal shingle sets are folded into one node first. Nodes meet in the buckets of
their bands; every member is verified against the most central one, the node
that shares most bucket places with others, so a bucket gives one pair per
member. What still lies in different components of one bucket is compared
again, except within its largest component: in buckets of up to `_SHORT_BUCKET`
nodes pair by pair, in longer ones block by block, where a task counts common
shingles through an index and puts out the links only. So no link between
components that share a bucket is missed, and no group is expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.common import once, small_batches, text_key
from gavelframe.llm.components import components
from gavelframe.llm.shingles import mix, shingle_sets
from gavelframe.session import cut

_ROWS_AT_ONCE = 500
_ROW_BITS = 33
_SHORT_BUCKET = 32
_BLOCK = 512
_DART_STEP, _STRIP_STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_PLACE_SALT, _BAND_STEP = np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x9E3779B97F4A7C15)


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform values in (0, 1)."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _strips(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Weight axis in strips [0, 1), [1, 2), [2, 4), ...: hash, low end, width, weight, set of each strip that a weight reaches."""
    parts, low, width = [], 0.0, 1.0
    level, reach = np.zeros(1, np.uint64), np.ones(len(elements), bool)
    while reach.any():
        n = int(reach.sum())
        seeds = mix(elements[reach] + level * _STRIP_STEP)
        parts.append((seeds, np.full(n, low), np.full(n, width), weights[reach], owner[reach]))
        low, width = low + width, (1.0 if low == 0.0 else 2 * width)
        level = level + np.uint64(1)
        reach = weights > low
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def dart_minhash(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """Signatures (n_sets x k) of non-empty weighted sets; `owner` is the set of each element.

    Weights are positive. Sets whose coordinates are not all filled are thrown
    at again with twice the darts.
    """
    signature = np.zeros((n_sets, k), np.uint64)
    norm = np.bincount(owner, weights, n_sets)
    seed, low, width, weight, of = _strips(elements, weights, owner)
    open_sets, darts = np.arange(n_sets), k * np.log(k) + 2.0 * k
    while len(open_sets):
        limit = np.full(n_sets, -1.0)
        limit[open_sets] = darts / norm[open_sets]
        live = np.flatnonzero(limit[of] > 0)
        h, rank, ends = seed[live], np.zeros(len(live)), limit[of[live]]
        hits = []
        while len(live):
            h = mix(h + _DART_STEP)
            rank = rank - np.log(_unit(h)) / width[live]
            on = rank < ends
            live, h, rank, ends = live[on], h[on], rank[on], ends[on]
            own = mix(h ^ _PLACE_SALT)
            inside = low[live] + _unit(own) * width[live] < weight[live]
            hits.append((of[live][inside], rank[inside], own[inside]))
        sets, ranks, ids = (np.concatenate(x) for x in zip(*hits, strict=True))
        cells = sets * k + (mix(ids) % np.uint64(k)).astype(np.int64)
        late_first = np.argsort(-ranks, kind="stable")
        filled = np.zeros(n_sets * k, bool)
        filled[cells] = True
        flat = np.zeros(n_sets * k, np.uint64)
        flat[cells[late_first]] = ids[late_first]  # the earliest dart is written last
        whole = filled.reshape(n_sets, k).all(1)
        done = open_sets[whole[open_sets]]
        signature[done] = flat.reshape(n_sets, k)[done]
        open_sets, darts = open_sets[~whole[open_sets]], 2 * darts
    return signature


def _band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), rows.shape[:2]).copy()
    for r in range(rows.shape[2]):
        key = mix(key * _BAND_STEP + rows[:, :, r])
    return key


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """row (a number of the input row), id, key, set_1 and set_2 (digest of the shingle set), n, shingles, buckets."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            for k in range(0, len(batch), _ROWS_AT_ONCE):
                part = batch.slice(k, _ROWS_AT_ONCE)
                sets = shingle_sets(part.column("text"), width)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                buckets = np.zeros((len(sets), bands), np.uint64)
                if len(full):
                    elements = np.concatenate([sets[i] for i in full])
                    owner = np.repeat(np.arange(len(full)), sizes[full])
                    signature = dart_minhash(elements, np.ones(len(elements)), owner, len(full), bands * rows)
                    buckets[full] = _band_keys(signature, bands)
                short = [np.unique((s >> np.uint64(32)).astype(np.uint32).view(np.int32)) for s in sets]
                digests = np.array([_two_halves(s) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                bounds = np.concatenate([[0], np.cumsum([len(s) for s in short])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(len(sets))),
                        part.column("id"),
                        part.column("key"),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(short))),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(buckets.view(np.int64).ravel())
                        ),
                    ],
                    names=["row", "id", "key", "set_1", "set_2", "n", "shingles", "buckets"],
                )
                row += len(sets)
            pa.default_memory_pool().release_unused()

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    columns = f"row long, id {kind}, key string, set_1 long, set_2 long, n int, shingles array<int>, buckets array<long>"
    named = docs.select(F.col(id_col).alias("id"), text_key(F.col(id_col), F.col(text_col)).alias("key"), text.alias("text"))
    return named.mapInArrow(sign, columns)


def _two_halves(shingles: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return digest >> 64, digest & (2**64 - 1)


def _similar_size(one: str, other: str, threshold: float) -> Column:
    return F.least(one, other) >= F.lit(threshold) * F.greatest(one, other) - 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b: the pairs whose exact Jaccard similarity reaches the threshold.

    The set of b, which may stand in many pairs, is joined first: only ids are
    then dealt by b, and what carries a set is dealt by a.
    """
    pairs = cut(pairs.distinct(), "near-pairs")
    left = sets.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("shingles_a"))
    right = sets.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("shingles_b"))
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    alike = common >= F.lit(threshold) * (F.col("n_a") + F.col("n_b") - common) - 1e-9
    return cut(pairs.join(right, "b").join(left, "a").where(alike).select("a", "b"), "near-links")


def _central(members: DataFrame) -> DataFrame:
    """band, bucket, centre, centre_n, centre_component: the member with the most shared places, the largest of equals."""
    top = F.max(F.struct("places", "node", "n", "component")).alias("top")
    found = members.groupBy("band", "bucket").agg(top)
    return found.select(
        "band", "bucket", F.col("top.node").alias("centre"), F.col("top.n").alias("centre_n"), F.col("top.component").alias("centre_component")
    )


def _with_centre(members: DataFrame, centres: DataFrame, threshold: float) -> DataFrame:
    """a, b: each member with its bucket's centre, unless they are connected already or differ too much in size."""
    met = members.join(cut(centres, "near-centres"), ["band", "bucket"])
    apart = F.col("component") != F.col("centre_component")
    return met.where(apart & _similar_size("n", "centre_n", threshold)).select(F.col("node").alias("a"), F.col("centre").alias("b"))


def _largest_components(members: DataFrame) -> DataFrame:
    """band, bucket, largest: of the buckets that span several components, the one with most members."""
    sizes = members.groupBy("band", "bucket", "component").agg(F.count(F.lit(1)).alias("nodes"))
    top = F.max(F.struct("nodes", "component")).alias("top")
    found = sizes.groupBy("band", "bucket").agg(top, F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return cut(found.select("band", "bucket", F.col("top.component").alias("largest")), "near-spanned")


def _across(members: DataFrame, threshold: float) -> DataFrame:
    """a, b: pairs of members of one bucket in different components and near enough in size."""
    one = members.select("band", "bucket", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"), "largest")
    other = members.select("band", "bucket", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
    met = one.where("c_a <> largest").join(other, ["band", "bucket"])
    once = (F.col("c_b") == F.col("largest")) | (F.col("a") < F.col("b"))
    return met.where((F.col("c_a") != F.col("c_b")) & once & _similar_size("n_a", "n_b", threshold)).select("a", "b")


def _index_links(threshold: float):
    """Links between the sets of two blocks, from counts of common shingles by an index over the second."""

    def link(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(one) and len(other):
            sizes = other["n"].to_numpy(np.int64)
            shingles = np.concatenate(other["shingles"].to_list())
            order = np.argsort(shingles, kind="stable")
            shingles, owner = shingles[order], np.repeat(np.arange(len(other)), sizes)[order]
            nodes, parts = other["node"].to_numpy(), other["component"].to_numpy()
            for node, n, part, own in zip(one["node"], one["n"], one["component"], one["shingles"], strict=True):
                low, high = np.searchsorted(shingles, own, "left"), np.searchsorted(shingles, own, "right")
                runs = high - low
                at = np.arange(runs.sum()) + np.repeat(low - (np.cumsum(runs) - runs), runs)
                common = np.bincount(owner[at], minlength=len(other))
                alike = (common >= threshold * (n + sizes - common) - 1e-9) & (parts != part)
                found.append((np.full(alike.sum(), node), nodes[alike]))
        return pd.DataFrame({"a": np.concatenate([a for a, _ in found]), "b": np.concatenate([b for _, b in found])})

    return link


def _blockwise(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """a, b: links of members outside the largest component of their bucket with all others of the bucket."""
    blocks = F.ceil(F.col("size") / _BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    held = members.join(sets.select(F.col("row").alias("node"), "shingles"), "node")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    key = ["band", "bucket", "i", "j"]
    # New names for the same columns, as both sides come from one table.
    columns = [F.col(c).alias(c) for c in (*key, "node", "n", "component", "shingles")]
    one = held.where("component <> largest").withColumn("i", own).withColumn("j", every).select(columns)
    other = held.withColumn("j", own).withColumn("i", every).select(columns)
    return one.groupBy(key).cogroup(other.groupBy(key)).applyInPandas(_index_links(threshold), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    width: int = 5,
    bands: int = 16,
    rows: int = 4,
) -> DataFrame:
    """One row per input row: id, class_id, class_size, kept, key (`common.text_key` of the row).

    Words are what stands between ASCII white space, A-Z lower-cased; sets of
    `width` consecutive words are compared by Jaccard similarity (on 32-bit
    hashes), and classes are what links of at least `threshold` connect.
    `class_id` is the smallest id of the class, and one row of it is kept: one
    with that id. Texts with fewer words are one shingle; texts without words
    (NULL, empty, blank) are classes of their own. A NULL id comes after all
    others; repeated rows share a class. Other columns are not looked at. An
    empty table gives an empty result.
    """
    with small_batches(docs.sparkSession):
        signed = cut(signatures(docs, id_col, text_col, width, bands, rows), "near-signatures")
    nodes = signed.where("n > 0").groupBy("set_1", "set_2").agg(F.min("row").alias("node"))
    nodes = cut(nodes, "near-nodes")
    whole = signed.select("row", "n", "buckets").join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    members = cut(
        whole.select(F.col("row").alias("node"), "n", F.posexplode("buckets").alias("band", "bucket")), "near-members"
    )
    sizes = members.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = cut(members.join(cut(sizes, "near-buckets"), ["band", "bucket"]), "near-shared")
    places = shared.groupBy("node").agg(F.sum("size").alias("places"))
    shared = cut(shared.join(places, "node").withColumn("component", F.col("node")), "near-places")
    # The list of nodes grows with the corpus: never broadcast, so every size runs the same plan.
    listed = places.select(F.col("node").alias("row")).hint("merge")
    sets = cut(signed.select("row", "n", "shingles").join(listed, "row", "left_semi"), "near-sets")
    links = _verified(_with_centre(shared, _central(shared), threshold), sets, threshold)

    found = components(links, "a", "b")
    placed = shared.drop("component").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = cut(placed, "near-placed")
    spanned = cut(placed.join(_largest_components(placed), ["band", "bucket"]), "near-across")
    direct = _across(spanned.where(F.col("size") <= _SHORT_BUCKET), threshold)
    crowded = _blockwise(spanned.where(F.col("size") > _SHORT_BUCKET), sets, threshold)
    more = _verified(direct, sets, threshold).unionByName(cut(crowded, "near-crowded"))

    found = components(links.unionByName(more), "a", "b")
    own = signed.select("row", "id", "key", "set_1", "set_2", "n").join(nodes, ["set_1", "set_2"], "left")
    node = F.when(F.col("n") > 0, F.col("node")).otherwise(F.col("row"))
    own = own.withColumn("node", node).join(found, "node", "left")
    own = cut(own.select("row", "id", "key", F.coalesce("component", "node").alias("component")), "near-classes")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "row"))
    classes = own.groupBy("component").agg(first.alias("first"), F.count(F.lit(1)).alias("class_size"))
    classes = cut(classes.select("component", "first.id", "first.row", "class_size").toDF("component", "class_id", "keep_row", "class_size"), "near-class-ids")
    return own.join(classes, "component").select(
        F.col("id").alias(id_col), "class_id", "class_size", (F.col("row") == F.col("keep_row")).alias("kept"), "key"
    )


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """The documents that stay, one of each class, with all their columns."""
    return once(docs, text_key(F.col(id_col), F.col(text_col)), cut(near_duplicates(docs, id_col, text_col, **options).where("kept"), "near-kept"))
