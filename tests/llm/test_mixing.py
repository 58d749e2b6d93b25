import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gavelframe.llm.mixing import mix, mixed_rows

SCHEMA = "doc_id long, text string, source string, target string"


def corpus(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["hot"] * 6 + ["b", "c", "Z", None, "tiny"] if i > 5 else ["tiny"])
        rows.append((i, " ".join("w" for _ in range(rng.randint(0, 40))), source, "x"))
    rows += [(5, None, "hot", None), (6, "", None, None), (7, " \t\n ", "void", None), (None, "a b c", "b", None), (3, "w w", "c", None), (3, "w w", "c", None)]
    rows.append((999, "long " * 20_000, "b", None))
    return spark.createDataFrame(rows, SCHEMA).repartition(7), rows


def brute_targets(rows):
    size = defaultdict(int)
    for _, text, source, _ in rows:
        size[source] += len((text or "").split())
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, held = sum(size.values()), {}
    while True:
        free = [s for s in order if s not in held]
        left = total - sum(held.values())
        over = [s for s in free if left * weight[s] / sum(weight[f] for f in free) >= 3 * size[s]]
        if not over:
            return size, held | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        held |= {s: 3 * size[s] for s in over}


def test_targets_and_words(spark):
    docs, rows = corpus(spark)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    size, want = brute_targets(rows)
    by_size = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_size[(r.source_size, round(r.target, 6))] += r.taken
    assert {(size[s], round(want[s], 6)) for s in size} == set(by_size)
    for (_, target), taken in by_size.items():
        assert abs(taken - target) <= 2


def test_reruns_agree_under_other_partitions(spark):
    docs, _ = corpus(spark)
    rows = lambda df: sorted((str(r) for r in mix(df).collect()))
    assert rows(docs) == rows(docs.repartition(3))


def test_inclusion_follows_the_share_and_the_affinity(spark):
    rows = [(i, "w w w w", "a" if i < 4000 else "b", 3.0 if i % 2 else 1.0) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, likes double")
    plain = {r.doc_id: r.taken for r in mix(docs).collect() if r.doc_id < 4000}
    share = sum(t > 0 for t in plain.values()) / 4000
    assert abs(share - 2 / 3) < 0.01
    odd = sum(plain[i] > 0 for i in plain if i % 2) / 2000
    assert abs(odd - share) < 0.04
    tilted = {r.doc_id: r.taken for r in mix(docs, affinity_col="likes").collect() if r.doc_id < 4000}
    assert sum(tilted[i] > 0 for i in tilted if i % 2) > 1.5 * sum(tilted[i] > 0 for i in tilted if not i % 2)


def test_longer_texts_are_likelier_and_the_target_is_met(spark):
    rows = [(i, "w " * (3 if i % 2 else 100), "a" if i < 4000 else "b") for i in range(8000)]
    got = [r for r in mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect() if r.doc_id < 4000]
    taken = {odd: sum(r.taken > 0 for r in got if r.doc_id % 2 == odd) / 2000 for odd in (0, 1)}
    assert taken[0] > 1.5 * taken[1]
    assert abs(sum(r.taken for r in got) - got[0].target) <= 1


def test_mixed_rows_are_whole_texts_near_the_target(spark):
    docs, rows = corpus(spark)
    out = mixed_rows(docs.withColumn("copies", F.lit("x")).withColumn("affinity", F.lit("y")))
    assert out.columns == [*docs.columns, "copies", "affinity"]
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert set(got) <= {(i, text) for i, text, _, _ in rows}
    taken = mix(docs, whole_texts=True).collect()
    assert sum(n * len((text or "").split()) for (_, text), n in got.items()) == sum(r.taken for r in taken)
    assert all(r.taken == r.copies * r.size for r in taken)
    parts, off = mix(docs).collect(), defaultdict(lambda: [0, 0])
    for r in taken:
        off[r.source_size, r.target][0] += r.taken
    for r in parts:
        if r.taken != r.copies * r.size:
            off[r.source_size, r.target][1] += r.size
    assert all(abs(words - target) <= last / 2 + 2 for (_, target), (words, last) in off.items())


def test_empty_and_wordless_tables(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    void = spark.createDataFrame([(1, None, "a", None), (2, " ", "b", None)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mix(void).collect()] == [(0, 0.0, 0)] * 2
    assert mixed_rows(void).count() == 0
