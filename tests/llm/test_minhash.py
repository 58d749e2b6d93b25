import itertools
import random

import numpy as np

from gavelframe.llm.components import components
from gavelframe.llm.minhash import dart_minhash, near_duplicates

SCHEMA = "doc_id long, text string, node string, class_id int"


def prose(rng, words):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(words)]


def shingles(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, threshold=0.8):
    sets, parent = [shingles(t) for _, t, *_ in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
            parent[root(j)] = root(i)
    classes = {}
    for i, (doc_id, *_) in enumerate(rows):
        classes.setdefault(root(i), []).append(doc_id)
    named = {r: (min((d for d in m if d is not None), default=None), len(m)) for r, m in classes.items()}
    return sorted(((d, *named[root(i)]) for i, (d, *_) in enumerate(rows)), key=str)


def rows_of(docs, **options):
    found = near_duplicates(docs, **options).collect()
    assert sum(r.kept for r in found) == len({(r.class_id, r.class_size) for r in found if r.class_id is not None}) + sum(
        r.kept for r in found if r.class_id is None
    )
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in found), key=str)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = "".join(rng.choice("qrstuvwxyz") for _ in range(6))
    return words


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.uniform(0.1, 9, 300), rng.uniform(0.1, 9, 300)
    b[:150] = a[:150]
    b[290:] = 1e-3
    elements, weights = np.concatenate([items, items]), np.concatenate([a, b])
    owner = np.repeat([0, 1], 300)
    signature = dart_minhash(elements, weights, owner, 2, 4096)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((signature[0] == signature[1]).mean() - true) < 0.03


def test_signature_depends_on_the_set_alone():
    rng = np.random.default_rng(2)
    items = rng.integers(0, 2**63, 5000).astype(np.uint64)
    alone = dart_minhash(items[:3], np.ones(3), np.zeros(3, int), 1, 64)
    mixed = dart_minhash(items, np.ones(5000), np.repeat([0, 1], [3, 4997]), 2, 64)
    assert (alone[0] == mixed[0]).all()


def test_matches_brute_force_on_planted_copies(spark):
    rng, rows = random.Random(7), []
    for i in range(60):
        base = prose(rng, rng.randint(3, 300))
        rows.append((3 * i, " ".join(base), None, 1))
        for c in range(rng.randint(0, 3)):
            rows.append((3 * i + 1 + c % 2, " ".join(edited(rng, base, rng.randint(0, len(base) // 60 + 1))), "x", 1))
    passage = prose(rng, 100)
    rows += [(1000 + i, " ".join(prose(rng, 30) + passage + prose(rng, 20)), None, 1) for i in range(80)]
    rows += [(2000, None, None, 1), (2001, "", None, 1), (2002, " \n", None, 1), (2003, "Two  words", None, 1), (2004, "two\twords", None, 1)]
    rows += [(None, "two words", None, 1), (2005, "é " * 20_000, None, 1), (2006, "é " * 30_000, None, 1), (0, rows[0][1], None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert rows_of(docs) == brute(rows)


def test_large_group_of_near_copies_and_crowded_buckets(spark):
    rng = random.Random(8)
    base = prose(rng, 250)
    rows = [(i, " ".join(edited(rng, base, 2 + i % 3)), None, 1) for i in range(150)]
    rows += [(500 + i, " ".join(edited(rng, base, 9 + i)), None, 1) for i in range(8)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert rows_of(docs) == brute(rows)


def test_components_of_a_path_a_star_and_a_loop(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(5, i) for i in range(100, 140)] + [(7, 7), (8, 9), (9, 8)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {i: 20 for i in range(20, 61)} | {i: 5 for i in [5, *range(100, 140)]} | {8: 8, 9: 8}


def test_empty_and_wordless_tables(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(1, None, None, 1), (2, " ", None, 1)], SCHEMA)
    assert rows_of(docs) == [(1, 1, 1), (2, 2, 1)]
