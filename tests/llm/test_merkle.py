import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gavelframe.llm import queries
from gavelframe.llm.merkle import manifest, sealed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int, note string, root string"
TEXTS = ["Blue Door", "", None, "été À", "x" * 150_000 + "Y", "same"]


def rows_of(n, source, first=0, step=1):
    return [(first + step * i, TEXTS[i % len(TEXTS)], "en" if i % 4 else None, source, i if i % 3 else None) for i in range(n)]


ROWS = (
    rows_of(300, "big", first=10)
    + rows_of(17, None, step=-1)
    + rows_of(16, "", first=50)
    + rows_of(1, "lone", first=25)
    + rows_of(2, "été", first=3)
    + [(None, "No id", None, "big", 1), (None, None, None, None, None)]
    + [(11, "Blue Door", "en", "big", 1)] * 5
)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    fields = [None if x is None else str(x) for x in (doc_id, source, lang, n_chars, text)]
    return h(*["-" if x is None else f"{len(x.encode())}:{x}" for x in fields])


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
    return levels


def fold(levels, place, digest):
    proof, copies = "", []
    for nodes in levels[:-1]:
        run = nodes[place // 16 * 16 : place // 16 * 16 + 16]
        k = place % 16
        proof += "".join(run[:k] + run[k + 1 :])
        digest = h(*run[:k], digest, *run[k + 1 :])
        copies.append(digest)
        place //= 16
    return proof, digest, copies


def brute(rows):
    trees = {}
    for row in rows:
        key = (row[3] is not None, (row[3] or "").encode())
        trees.setdefault(key, []).append(row)
    order = sorted(trees)
    placed = {k: sorted(trees[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))) for k in order}
    levels = {k: climb([leaf_of(*r) for r in placed[k]]) for k in order}
    crown = climb([levels[k][-1][0] for k in order])
    out = []
    for at, k in enumerate(order):
        for place, r in enumerate(placed[k]):
            leaf, forged = leaf_of(*r), None
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                forged = leaf_of(r[0], lowered(r[1]), *r[2:])
            lower, digest, copies = fold(levels[k], place, forged or leaf)
            upper, digest, more = fold(crown, at, digest)
            root = crown[-1][0]
            out.append((r[0], leaf, levels[k][-1][0], root, h(lower, upper), forged, copies + more, digest, digest == root))
    return sorted(out, key=str)


@pytest.fixture
def tampered():
    return {"text": F.when(F.col("text").isNotNull(), F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))}


def run(spark, rows, tampered, parts=5):
    docs = spark.createDataFrame([(*r, "leaf", 1, None, "r") for r in rows], SCHEMA).repartition(parts)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return sorted((tuple(r) for r in manifest(docs, tampered=tampered, where=chosen).collect()), key=str)


def test_matches_brute_force(spark, tampered):
    got = run(spark, ROWS, tampered)
    assert got == brute(ROWS)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [ROWS[:1], ROWS[:16], [(1, "A", "en", "a", 1), (2, None, None, None, 2)]])
def test_small_trees(spark, tampered, rows):
    assert run(spark, rows, tampered) == brute(rows)


def test_a_version_copies_nothing_but_ancestors(spark, tampered):
    """Every copied node stands beside untouched siblings: rebuilding the whole tampered tree gives the same root."""
    rows = rows_of(40, "a")
    got = [r for r in run(spark, rows, tampered) if r[5] is not None and r[5] != r[1]]
    assert got
    for doc_id, *_, folded, _ in got:
        whole = [r if r[0] != doc_id else (r[0], lowered(r[1]), *r[2:]) for r in rows]
        assert climb(climb([leaf_of(*r) for r in sorted(whole)])[-1])[-1] == [folded]


def test_fields_cannot_run_into_each_other(spark):
    pairs = [("a", "b:"), ("ab", ":"), ("", "ab:"), (None, "ab:"), ("-", None)]
    df = spark.createDataFrame(pairs, "x string, y string").select(sealed(F.col("x"), F.col("y")).alias("d"))
    assert df.distinct().count() == len(pairs)


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_keeps_the_contract_columns(spark):
    out = queries.op12_merkle_manifest(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
