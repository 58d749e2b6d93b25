"""Manifest of a data set as a persistent Merkle tree.

Every row is a leaf. The leaves of a source, in the order of their ids, form a
tree of runs of sixteen; the subroots of the sources form the tree above. A
tampered leaf makes a version of the tree that shares every node off its path
with the original: only the leaf's ancestors are copied.

No tree is ever in one task. Two levels make an aligned block of at most 256
nodes, one row that holds all its digests, and a block's root is a node of the
next, 256 times smaller band of blocks. Going up, bands are written one after
another; going down, each block hands its members the siblings on their way to
the root, so that a leaf's proof, and the copied ancestors of its version, are
made where the leaf lies, however many versions a source has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.numbering import numbered
from gavelframe.session import cut

FAN = 16
BLOCK = FAN * FAN


def sealed(*fields: Column) -> Column:
    """Digest of a row: each field as `-` if NULL, else its UTF-8 byte count, a colon and itself."""
    values = [field.cast("string") for field in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def _levels(size: Column) -> Column:
    """Levels that a block stands for, in a tree of so many nodes at this height."""
    return F.when(size <= 1, 0).when(size <= FAN, 1).otherwise(2)


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """tree, block, size, digest, runs (array of run, digest and its nodes) of nodes (tree, position, size, digest, note)."""
    block, run = F.floor(F.col("position") / BLOCK), F.floor(F.col("position") / FAN)
    dealt = nodes.withColumns({"block": block, "run": run}).repartition("tree", "block")
    runs = dealt.groupBy("tree", "block", "run", "size").agg(
        F.array_sort(F.collect_list(F.struct("position", "digest", "note"))).alias("nodes")
    )
    lone = F.element_at("nodes", 1)["digest"]
    runs = runs.withColumn("digest", F.when(F.col("size") <= 1, lone).otherwise(F.sha2(_joined(F.col("nodes")), 256)))
    whole = runs.groupBy("tree", "block", "size").agg(F.array_sort(F.collect_list(F.struct("run", "digest", "nodes"))).alias("runs"))
    lone = F.element_at("runs", 1)["digest"]
    digest = F.when(F.col("size") <= FAN, lone).otherwise(F.sha2(_joined(F.col("runs")), 256))
    return cut(whole.withColumn("digest", digest), name)


def grow(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Bands of blocks from the leaves up, and the root of each tree (tree, digest).

    `nodes` has tree (never NULL), position (from 0 without a gap), size (nodes
    of the tree), digest, and a note that travels with the leaf.
    """
    bands: list[DataFrame] = []
    most = nodes.agg(F.max("size").alias("n")).head()["n"] or 0
    while most > 1:
        band = _blocks(nodes, f"merkle-{name}-{len(bands)}")
        bands.append(band)
        fewer = F.ceil(F.col("size") / F.pow(F.lit(FAN), _levels(F.col("size")))).cast("long")
        nodes = band.select("tree", F.col("block").alias("position"), fewer.alias("size"), "digest", F.lit(None).cast("string").alias("note"))
        most = -(-most // BLOCK)
    return bands, nodes.select("tree", "digest", "note")


def _siblings(nodes: Column, own: Column, key: str) -> Column:
    """What stands left and right of a node in its run, as joined digests."""
    return F.struct(
        _joined(F.filter(nodes, lambda x: x[key] < own)).alias("left"),
        _joined(F.filter(nodes, lambda x: x[key] > own)).alias("right"),
    )


def descend(bands: list[DataFrame], ways: DataFrame) -> DataFrame:
    """Way of every leaf to the root: tree, position, digest, note, and the columns of `ways`, which has one row per tree.

    `ways` has tree, way (array of siblings, nearest level first) and what else
    is to be handed down; blocks put their own levels before it.
    """
    kept = [c for c in ways.columns if c not in ("tree", "way", "position")]
    for k, band in reversed(list(enumerate(bands))):
        top = k == len(bands) - 1
        handed, keys = (ways, ["tree"]) if top else (ways.withColumnRenamed("position", "block"), ["tree", "block"])
        members = (
            band.drop("digest")
            .join(handed, keys)
            .select("tree", "size", "way", *kept, "runs", F.explode("runs").alias("at"))
            .withColumn("second", _siblings(F.col("runs"), F.col("at.run"), "run"))
            .drop("runs")
            .select("*", F.explode("at.nodes").alias("node"))
        )
        first = _siblings(F.col("at.nodes"), F.col("node.position"), "position")
        own = F.when(F.col("size") <= 1, F.array().cast(ways.schema["way"].dataType))
        own = own.when(F.col("size") <= FAN, F.array(first)).otherwise(F.array(first, F.col("second")))
        ways = members.select(
            "tree",
            F.col("node.position").alias("position"),
            F.concat(own, F.col("way")).alias("way"),
            *kept,
            *([F.col("node.digest").alias("leaf"), F.col("node.note").alias("note")] if k == 0 else []),
        )
    return ways


def copied(leaf: Column, way: Column) -> Column:
    """Digests of the ancestors that a version with this leaf copies, from the leaf's run up to the root."""
    start = F.array(leaf)
    climb = F.aggregate(
        way, start, lambda made, x: F.concat(made, F.array(F.sha2(F.concat(x["left"], F.element_at(made, -1), x["right"]), 256)))
    )
    return F.slice(climb, 2, F.size(way))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    source_col: str = "source",
    tampered: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, leaf, subroot, root, proof_sha256, forged_leaf, copies, folded_root, verified.

    `tampered` replaces columns in the rows where `where` holds; forged_leaf is
    NULL elsewhere. `copies` are the ancestors that the row's version does not
    share with the original, from the leaf up, and folded_root is the last of
    them (or the leaf, where it is the root). NULL fields are told from empty
    ones. A NULL source is a source of its own, before all others; NULL ids come
    first in theirs. Rows of one source that repeat an id are ordered by their
    digests, so equal rows are interchangeable. Texts of any length are hashed
    whole. Columns that are not in `fields` are not looked at, whatever their
    names. An empty table gives an empty result.
    """
    forged = F.lit(None).cast("string")
    if tampered:
        changed = sealed(*[tampered.get(c, F.col(c)) for c in fields])
        forged = F.when(where if where is not None else F.lit(True), changed)
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("tree"),
        sealed(*[F.col(c) for c in fields]).alias("digest"),
        F.struct(F.col(id_col).alias("id"), forged.alias("forged")).alias("note"),
    )
    in_place = numbered(leaves, ["tree"], [F.col("note.id").asc_nulls_first(), F.col("digest")], "merkle-leaves")
    nodes = cut(in_place.withColumnRenamed("members", "size"), "merkle-nodes")
    bands, subroots = grow(nodes, "sources")
    crown = numbered(subroots.select("tree", "digest"), [], [F.col("tree")], "merkle-subroots").select(
        F.lit("").alias("tree"), "position", F.col("members").alias("size"), "digest", F.col("tree").alias("note")
    )
    crown = cut(crown, "merkle-crown")
    upper, root = grow(crown, "crown")
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    if upper:
        top = root.select("tree", nothing.alias("way"), F.col("digest").alias("root"))
        ways = descend(upper, top).select(F.col("note").alias("tree"), "way", F.col("leaf").alias("subroot"), "root")
    else:
        ways = root.select(F.col("note").alias("tree"), nothing.alias("way"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    if bands:
        found = descend(bands, cut(ways, "merkle-ways"))
    else:
        found = nodes.withColumnRenamed("digest", "leaf").join(ways, "tree")
    siblings = F.array_join(F.transform("way", lambda x: F.concat(x["left"], x["right"])), "")
    start = F.coalesce(F.col("note.forged"), F.col("leaf"))
    return (
        found.withColumn("copies", copied(start, F.col("way")))
        .withColumn("folded_root", F.when(F.size("copies") > 0, F.element_at("copies", -1)).otherwise(start))
        .select(
            F.col("note.id").alias(id_col),
            "leaf",
            "subroot",
            "root",
            F.sha2(siblings, 256).alias("proof_sha256"),
            F.col("note.forged").alias("forged_leaf"),
            "copies",
            "folded_root",
            (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )
