import hashlib

import pytest
from pyspark.sql import functions as F

from gavelframe.llm.exact_dedup import exact_dedup, keep_rows

ROWS = [
    (1, "Blue Door", "a"),
    (2, "blue door", "b"),
    (3, "BLUE DOOR", None),
    (4, None, "a"),
    (5, "", "a"),
    (6, "Été", "a"),
    (7, "été", "a"),
    (8, "x" * 200_000, "a"),
    (9, "X" * 200_000, "a"),
    (None, "lone", "a"),
    (None, "gone", "b"),
    (11, "twin", "c"),
    (11, "twin", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, keep_id string").repartition(5)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    best, size = {}, {}
    for doc_id, text, _ in rows:
        t = lowered(text)
        size[t] = size.get(t, 0) + 1
        best[t] = max((x for x in (best.get(t), doc_id) if x is not None), default=None)
    return sorted(
        ((d, best[lowered(t)], size[lowered(t)], d == best[lowered(t)], hashlib.sha256(lowered(t).encode()).hexdigest()) for d, t, _ in rows),
        key=str,
    )


def test_matches_brute_force(docs):
    got = sorted((tuple(r) for r in exact_dedup(docs, salts=3).collect()), key=str)
    assert got == brute(ROWS)


def test_clashing_digests_do_not_merge(docs):
    short = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    got = sorted((tuple(r) for r in exact_dedup(docs, salts=3, digest=short).collect()), key=str)
    assert got == brute(ROWS)


def test_kept_rows_keep_columns_and_repeat_nothing(docs):
    kept = keep_rows(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.keep_id) for r in kept.collect()), key=str)
    assert got == sorted([(3, None), (5, "a"), (6, "a"), (7, "a"), (9, "a"), (11, "c"), (None, "a"), (None, "b")], key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup(empty).count() == 0
    assert keep_rows(empty).count() == 0
