import math
import random
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from gavelframe.llm import context_mixing as cm
from gavelframe.session import shared_folder

SCHEMA = "doc_id long, text string, row string, score int"


def prose(rng, words):
    return " ".join(rng.choice(["the", "of", "Stone", "river,", "light", "café", "über", "runs."]) for _ in range(words))


def corpus():
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randint(1, 120)), None, 1) for i in range(150)]
    rows += [(200, None, None, 1), (201, "", None, 1), (202, " \n\t", "x", 1), (None, "river of light", None, 1), (3, rows[3][1], None, 1)]
    rows += [(203, "zq" * 60_000, None, 1), (204, "once-only words", None, 1)]
    return rows


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base(rows):
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [[*lowered(t).split(), "\n"] for _, t, *_ in rows]
    c = Counter(w for (i, *_), ws in zip(rows, tokens, strict=True) if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    score = lambda w: math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1)))
    return [(i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, sum(map(score, ws))) for (i, *_), ws in zip(rows, tokens, strict=True)]


@pytest.mark.parametrize("heavy_parts", [20, 500_000])
def test_baseline_matches_brute_force(spark, heavy_parts):
    rows = corpus()
    got = cm.score_texts(spark.createDataFrame(rows, SCHEMA).repartition(4), heavy_parts=heavy_parts, max_windows=2000).collect()
    key = lambda r: (str(r[0]), r[2], r[5])
    found = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    want = sorted(base(rows), key=key)
    assert [f[:5] for f in found] == [w[:5] for w in want]
    assert [f[5] for f in found] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert all(r.score < 0 for r in got)
    same = [r.score for r in got if r.doc_id == 3]
    assert same[0] == pytest.approx(same[1])


def test_windows_stay_within_their_text():
    key, bounds = cm.windows(pa.array(["ab", "", "é"]))
    assert bounds.tolist() == [0, 3, 4, 7]
    low = (key & np.uint64(0xFF)).tolist()
    assert low == [97, 98, 255, 255, 195, 169, 255]
    assert ((key[3:5] >> np.uint64(8)) == key[0] >> np.uint64(8)).all()


def test_bytes_after_a_context_sum_to_one():
    rng = np.random.default_rng(3)
    table = rng.integers(0, 50, (cm._SLOTS, 2))
    mixer = cm.Mixer.fresh()
    mixer.learn(table, rng.integers(0, 2**48, 3000).astype(np.uint64), np.ones(3000, int))
    stretched, known = np.clip(cm._stretch(table), -8, 8), table.sum(1) > 0
    window = np.uint64(0x6162636465) * np.uint64(256) + np.arange(256, dtype=np.uint64)
    assert np.sum(10 ** mixer.log10(stretched, known, window)) == pytest.approx(1)


def test_counts_are_exact_however_many_windows():
    rng = np.random.default_rng(5)
    drawn = np.unique(rng.integers(0, 2**48, 600_000).astype(np.uint64))
    counts = cm.Counts(drawn, np.ones(len(drawn), int), (5,))
    other = rng.integers(0, 2**48, 2000).astype(np.uint64)
    other = other[~np.isin(other >> np.uint64(8), drawn >> np.uint64(8))]
    for bit in (0, 7):
        assert not counts.seen(other, bit).any()  # hashed slots would share those of others
        assert (counts.seen(drawn[:2000], bit).sum(2) >= 1).all()


def test_rare_last_bytes_are_learnt_from(spark):
    rng = random.Random(13)
    rows = [(i, prose(rng, 40), True) for i in range(3000)] + [(3000, "\u0436" * 40, True)]
    run, kind = cm._units(64, "bigint")
    units = spark.createDataFrame(rows, "id long, text string, learn boolean").repartition(4).select("id", "learn", "text").mapInArrow(run, kind)
    counted = cm.count_windows(units.where(units.shard < cm._DOCS))
    mixer = cm.fit_mixer(counted, cm._low_windows(counted), 2)
    for byte in "\u0436".encode():
        assert (mixer.refined[byte] != cm.Mixer.fresh().refined[byte]).any()


def test_model_learns_held_out_text(spark):
    rng = random.Random(12)
    syllables = ["ka", "to", "mi", "ren", "lo", "sha", "vi", "dun"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 6)))
    rows = [(i, " ".join(word() for _ in range(200)), None, 1) for i in range(400)]
    got = [r for r in cm.score_texts(spark.createDataFrame(rows, SCHEMA)).collect() if r.held_out]
    assert sum(r.bits_per_byte for r in got) / len(got) < 1.7  # the syllables alone hold about 1.3


def test_empty_table(spark):
    assert cm.score_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_unit_is_unpacked_within_bounds():
    rng, pieces, size = np.random.default_rng(3), 8, 100_000
    window = rng.permutation(np.arange(pieces * size, dtype=np.uint64))
    value = rng.random(pieces * size).astype(np.float32)
    parts = [np.sort(part) for part in np.split(window, pieces)]
    packed = [(size, cm._packed_windows(p), cm._packed(value[p.astype(np.int64)])) for p in parts]
    tracemalloc.start()
    found, values = cm._answers(packed)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == np.arange(pieces * size, dtype=np.uint64)).all() and (values == value).all()
    assert not packed and peak < 34 * pieces * size


def test_only_tables_of_the_result_stay(spark):
    name, folder = "spark.sql.execution.arrow.maxBytesPerBatch", Path(shared_folder(spark))
    before, there = spark.conf.get(name), set(folder.iterdir())
    scored = cm.score_texts(spark.createDataFrame(corpus(), SCHEMA), max_windows=2000)
    assert sorted(p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - there) == ["lm-scored", "lm-token-counts"]
    assert spark.conf.get(name) == before
    assert scored.count() == len(corpus())


def test_windows_are_sorted_once_for_all_bits(monkeypatch):
    """Counts after each context from one sort per length, and distinct windows by sorting values alone."""
    rng = np.random.default_rng(7)
    window = np.unique(rng.integers(0, 1 << 20, 500).astype(np.uint64) * np.uint64(0x10003) & np.uint64((1 << 48) - 1))
    n, sorts = rng.integers(0, 4, len(window)), []
    argsort = np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    counts = cm.Counts(window, n, cm.ORDERS)
    assert len(sorts) == len(cm.ORDERS)
    for bit in range(8):
        seen = counts.seen(window, bit)
        for k, order in enumerate(cm.ORDERS):
            key, value = cm.Counts._key(window, order, bit)
            brute = [[n[(key == x) & (value == v)].sum() for v in (0, 1)] for x in key]
            assert (seen[k] == brute).all()
    many, learnt = rng.choice(window, 3000), rng.random(3000) < 0.6
    distinct, times = cm._distinct(many, learnt)
    assert len(sorts) == len(cm.ORDERS)
    assert distinct.tolist() == sorted(set(many.tolist()))
    assert times.tolist() == [int(learnt[many == x].sum()) for x in distinct]
    assert cm.Counts(window[:0], n[:0], cm.ORDERS).seen(window, 3).sum() == 0
