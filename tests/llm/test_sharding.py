import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gavelframe.llm import queries
from gavelframe.llm.sharding import Rooms, assign, best_fit, level, size_class, with_shard

SCHEMA = "doc_id long, text string, shard string, key int, slot long, size string"


def naive(groups, capacity):
    """Best fit, one group after the other, looking at every bin."""
    rooms, content = [], []
    for size in sorted(groups, reverse=True):
        fits = [(room, k) for k, room in enumerate(rooms) if room >= size]
        if fits:
            k = min(fits)[1]
        else:
            k = len(rooms)
            rooms.append(max(capacity, size))
            content.append([])
        rooms[k] -= size
        content[k].append(size)
    return content


def histogram(groups):
    return sorted(Counter(groups).items(), reverse=True)


def bins_of(runs):
    out = defaultdict(list)
    for run in runs:
        out[run.bin] += [run.size] * (run.last - run.first)
    return [out[k] for k in sorted(out)]


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_sizes_fill_bins_as_single_groups_do(seed):
    r = random.Random(seed)
    groups = [r.choice([r.randint(1, 9), r.randint(1, 60), r.randint(1, 300)]) for _ in range(r.randint(0, 400))]
    capacity = r.randint(50, 400)
    runs, bins = best_fit(histogram(groups), capacity)
    assert bins_of(runs) == naive(groups, capacity)
    assert bins == len(bins_of(runs))


@pytest.mark.parametrize("seed", range(30))
def test_levelled_runs_hold_every_group_once(seed):
    r = random.Random(seed)
    groups = [r.choice([1, 5, r.randint(1, 2000)]) for _ in range(r.randint(0, 2000))] + [90_000] * r.randint(0, 3)
    runs = level(histogram(groups), 7)
    numbers = defaultdict(list)
    for run in runs:
        numbers[run.size] += range(run.first, run.last)
    assert {s: sorted(n) for s, n in numbers.items()} == {s: list(range(n)) for s, n in histogram(groups)}
    assert len(bins_of(runs)) <= 7
    if len(groups) > 500:
        shared = [sum(x) for x in bins_of(runs) if len(x) > 1]
        assert max(shared) - min(shared) <= 0.01 * max(shared) + 2


def test_tree_stays_balanced_and_finds_the_tightest():
    r, rooms, plain = random.Random(1), Rooms(), []
    for k in range(3000):
        room = r.randint(1, 500) if k % 3 else k
        rooms.add(room, k)
        plain.append((room, k))
        if k % 2:
            size = r.randint(1, 700)
            fits = [x for x in plain if x[0] >= size]
            assert rooms.take_tightest(size) == (min(fits) if fits else None)
            if fits:
                plain.remove(min(fits))
    assert rooms._root.height <= 1.45 * len(plain).bit_length() + 2


def docs_of(spark, texts, parts=4):
    rows = [(None if k == 3 else k % 90, t, "s", k, k, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def check(rows, texts, shards):
    assert Counter((r.size, r.text_crc32) for r in rows) == Counter(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts
    )
    homes, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        homes[r.size, r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(x) == 1 for x in homes.values())
    assert set(slots) <= set(range(shards))
    for x in slots.values():
        assert sorted(x) == list(range(len(x)))


TEXTS = [None, "", "été", "x" * 20_000, *["copy of a text"] * 300, *[f"text {k} " * (k % 40) for k in range(1500)]]


def test_every_row_has_a_slot_and_shards_are_level(spark):
    rows = assign(docs_of(spark, TEXTS), shards=8).collect()
    check(rows, TEXTS, 8)
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert len(loads) == 8
    assert max(loads.values()) <= 1.001 * min(loads.values()) + 2


def test_a_hot_group_fills_a_shard_alone(spark):
    texts = ["the hot text"] * 2000 + [f"other {k}" for k in range(1000)]
    rows = assign(docs_of(spark, texts), shards=4).collect()
    check(rows, texts, 4)
    by_shard = defaultdict(Counter)
    for r in rows:
        by_shard[r.shard][r.size] += 1
    assert sorted(sum(s * n for s, n in c.items()) for c in by_shard.values())[-1] == 2000 * 13


def test_capacity_bounds_shards(spark):
    rows = assign(docs_of(spark, TEXTS), shards=None, capacity=50_000).collect()
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) <= 50_000
    check(rows, TEXTS, len(loads))
    distinct = Counter(t or "" for t in TEXTS)
    groups = [(len(t.encode()) + 1) * n for t, n in distinct.items()]
    assert sorted(loads.values()) == sorted(map(sum, naive(groups, 50_000)))


@pytest.mark.parametrize("texts", [[], ["one"], [None, "", None], ["a", "a", "b"]])
def test_small_tables(spark, texts):
    rows = assign(docs_of(spark, texts), shards=16).collect()
    assert len(rows) == len(texts)
    check(rows, texts, 16)


def test_sizes_are_exact_up_to_sixteen_bits_and_never_too_small(spark):
    sizes = [1, 65_535, 65_536, 65_537, 1_000_001, 2**40 + 1]
    got = spark.createDataFrame([(s,) for s in sizes], "s long").select(size_class(F.col("s"))).collect()
    for s, (c,) in zip(sizes, got, strict=True):
        assert s <= c <= s * (1 + 2**-15) and (c == s or s > 65_535)


def test_whole_rows_keep_their_columns(spark):
    docs = docs_of(spark, TEXTS[:50])
    out = with_shard(docs, shards=3)
    assert out.select("row.*").columns == docs.columns
    assert out.count() == 50 and {r.shard for r in out.collect()} <= {0, 1, 2}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op11_best_fit_shards(spark, sf).collect()
    check(rows, [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], 16)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
