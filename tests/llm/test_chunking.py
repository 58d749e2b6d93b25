import random
from collections import defaultdict

import numpy as np
import xxhash

from gavelframe.llm.chunking import chunk_ends, repeated_runs

SCHEMA = "doc_id long, text string, row string, digest int"


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghijklmnoprstuvwzé") for _ in range(rng.randint(2, 9))) for _ in range(words))


def ends_of(text, mean=20, gap=8, longest=1024):
    data = np.frombuffer(text.encode(), np.uint8)
    return chunk_ends(data, np.zeros(1, np.int64), mean, gap, longest)


def test_insertions_move_no_later_chunk():
    rng = random.Random(3)
    text = prose(rng, 2000)
    moved = "inserted words " + text
    before, after = ({*(len(t.encode()) - ends_of(t)).tolist()} for t in (text, moved))
    assert len(before - after) <= 2
    assert len(before) > len(text.encode()) / 60


def test_documents_in_one_slice_do_not_touch():
    rng = random.Random(4)
    texts = [prose(rng, 60), "é", prose(rng, 90)]
    data = [t.encode() for t in texts]
    starts = np.cumsum([0] + [len(d) for d in data])[:-1]
    together = chunk_ends(np.frombuffer(b"".join(data), np.uint8), starts, 20, 8, 1024)
    alone = np.concatenate([s + ends_of(t) for s, t in zip(starts, texts, strict=True)])
    assert together.tolist() == alone.tolist()


def test_long_chunks_are_cut_between_characters():
    ends = ends_of("é" * 5000, longest=101)
    assert all(e % 2 == 0 for e in ends) and np.diff(ends, prepend=0).max() <= 101


def brute(rows, min_bytes):
    own, holders, smallest = [], defaultdict(set), {}
    for n, (doc_id, text, *_) in enumerate(rows):
        data, a, mine = (text or "").encode(), 0, []
        for b in ends_of(text or "").tolist():
            key = (xxhash.xxh64_intdigest(data[a:b]), b - a)
            mine.append((a, b, key))
            holders[key].add(n)
            old = smallest.get(key)
            smallest[key] = doc_id if old is None else old if doc_id is None else min(old, doc_id)
            a = b
        own.append(mine)
    out = []
    for (doc_id, *_), mine in zip(rows, own, strict=True):
        run = []
        for piece in [*mine, None]:
            if piece and len(holders[piece[2]]) > 1:
                run.append(piece)
                continue
            n_bytes = sum(b - a for a, b, _ in run)
            if run and n_bytes >= min_bytes:
                firsts = [smallest[k] for *_, k in run]
                least = min((x for x in firsts if x is not None), default=None)
                again = sum(b - a for (a, b, k) in run if smallest[k] != doc_id)
                out.append((doc_id, run[0][0], n_bytes, len(run), least, again))
            run = []
    return sorted(map(str, out))


def test_planted_passages_are_found_and_nothing_else(spark):
    rng = random.Random(5)
    passages = [prose(rng, 55) for _ in range(4)]
    rows = []
    for i in range(120):
        text = prose(rng, rng.randint(5, 400))
        if i % 3 == 0:
            text = prose(rng, 20) + " " + passages[i % 4] + " " + text
        rows.append((i, text, None, 1))
    clean = {i for i in range(120) if i % 3}
    rows += [(200, None, None, 1), (201, "", None, 1), (202, "z" * 300_000, None, 1), (203, "and " * 3000, None, 1)]
    rows += [(None, passages[0] + " tail", None, 1), (204, rows[1][1] * 2, "x", 2), (204, rows[1][1] * 2, "x", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = repeated_runs(docs)
    found = sorted(str(tuple(r)) for r in got.select("doc_id", "start_byte", "n_bytes", "n_chunks", "first_id", "repeat_bytes").collect())
    assert found == brute(rows, 128)
    flagged = {r.doc_id for r in got.collect()}
    assert {i for i in range(0, 120, 3)} <= flagged
    assert not flagged & (clean - {1})
    assert 203 not in flagged and 202 not in flagged


def test_chunks_of_many_documents_make_no_passage(spark):
    rng = random.Random(9)
    text = prose(rng, 300)
    data = text.encode()
    ends = ends_of(text).tolist()
    rows = [(0, text, None, 1)]
    for a, b in zip([0, *ends], ends, strict=False):
        if b - a <= 80:  # each chunk with what sets its start: less than 128 bytes in a row
            piece = data[max(0, a - 40) : b].decode("utf-8", "ignore")
            rows.append((len(rows), prose(rng, 30) + " " + piece + " " + prose(rng, 30), None, 1))
    assert any(run.startswith("(0,") for run in brute(rows, 128))  # by single chunks, there would be a run
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert repeated_runs(docs).count() == 0
    whole = repeated_runs(docs.union(spark.createDataFrame([(999, text[900:1400], None, 1)], SCHEMA)))
    assert {r.doc_id for r in whole.collect() if r.n_bytes > 300} == {0, 999}


def test_empty_table(spark):
    assert repeated_runs(spark.createDataFrame([], SCHEMA)).count() == 0
