import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavelframe.llm.vptree import build, nearest, search

SCHEMA = "vec_id long, embedding array<float>, rank int, shard string"


def vectors(n, dim=6, seed=2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 2) for _ in range(dim)] for _ in range(5)]
    return [[c + rng.gauss(0, 0.6) for c in rng.choice(centres)] for _ in range(n)]


def brute(rows, k, asked):
    sound = {}
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v) or len(v) != 6:
            continue
        sound.setdefault(vec_id, []).append(np.array(v, np.float32).astype(float))
    out = []
    for q, own in sound.items():
        if not asked(q):
            continue
        scored = []
        for i, copies in sound.items():
            scored += [(-sum(float(x) * float(y) for x, y in zip(own[0], v, strict=True)), i) for v in copies if i != q]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def test_exact_with_factor_one(spark):
    rows = list(enumerate(vectors(1500)))
    rows += [(2000 + i, rows[40][1]) for i in range(200)]
    rows += [(3000, None), (3020, [0.0] * 6), (3040, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (3060, [math.nan] * 6), (3080, [math.inf] * 6)]
    rows += [(3100, []), (3120, [1.0] * 5), (None, [1.0] * 6), (60, rows[60][1])]
    docs = spark.createDataFrame([(i, v, 0, None) for i, v in rows], SCHEMA).repartition(4)
    got = nearest(docs, F.col("vec_id") % 20 == 0, k=7, shard_rows=400, block_rows=30)
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())
    want = brute(rows, 7, lambda q: q % 20 == 0)
    assert [x[:3] for x in found] == [x[:3] for x in want]
    assert [x[3] for x in found] == pytest.approx([x[3] for x in want], rel=1e-12)


def test_fewer_candidates_than_k(spark):
    docs = spark.createDataFrame([(0, [1.0, 2.0], 0, None), (1, [1.0, 0.0], 0, None)], SCHEMA)
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in nearest(docs, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]


def test_empty_table(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_larger_factors_look_at_less_and_still_find_most():
    data = np.array(vectors(4000, seed=9))
    radius = math.sqrt((data**2).sum(1).max())
    tree = build(np.arange(4000), data, radius, 1)
    queries, ids = data[::40], np.arange(0, 4000, 40)
    exact = search(tree, ids, queries, radius, 10, 1.0).id
    loose = search(tree, ids, queries, radius, 10, 1.15).id
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact.tolist(), loose.tolist(), strict=True)])
    assert 0.9 <= recall
