import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gavelframe.llm import collocations as module
from gavelframe.llm.collocations import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, rank int, n string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, top, least):
    """All counts of all phrases, as the operator defines them."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for m in (1, 2, 3, 4):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        swallowed = {
            p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= 80 * f[p[i:j]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in swallowed:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def run(spark, rows, parts=4, **options):
    docs = spark.createDataFrame([(k, t, g, "x", 1, "n") for k, (t, g) in enumerate(rows)], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in collocations(docs, **options).collect())


def made_up(seed, n=300):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(30)] + ["Été", "été", "İ", "x-y"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    fixed = ["new york city hall", "as well as", "of course", "a a a a a", "one two three four five"]
    texts = []
    for _ in range(n):
        words = r.choices(vocabulary, weights, k=r.randint(0, 40))
        for _ in range(r.randint(0, 3)):
            words.insert(r.randint(0, len(words)), r.choice(fixed))
        text = r.choice([" ", "  ", "\t", " "]).join(words)
        texts.append(re.sub(r" (w\d) ", r", \1 ", text, count=r.randint(0, 4)))
    return texts


@pytest.mark.parametrize("top, least, batch", [(2000, 5, 20_000), (25, 5, 150)])
def test_matches_brute_force(spark, top, least, batch):
    rows = [(t, "en") for t in made_up(1)] + [(t, None) for t in made_up(2, 80)] + [(t, "und") for t in made_up(3, 80)]
    rows += [(None, "en"), ("", "fr"), ("...", None), ("one", "de"), (" \t ", "en")]
    assert run(spark, rows, top=top, least=least, batch=batch) == brute(rows, top, least)


def test_ties_at_the_end_are_settled(spark):
    """All phrases score alike: the first ones in byte order must come out, whichever were expanded first."""
    words = [f"{c}{k}" for c in "zyxéa" for k in range(10)]
    rows = [(f"{a} {a}b.", "en") for a in words for _ in range(6)]
    got = run(spark, rows, top=9, least=5, batch=20)
    assert got == brute(rows, 9, 5)


def test_repeated_rows_and_hot_phrases(spark):
    rows = [("the hot phrase of all rows", "en")] * 2000 + [(f"some rare words {k}", "en") for k in range(40)]
    assert run(spark, rows, top=50, least=30) == brute(rows, 50, 30)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    text = "alpha beta gamma, delta alpha beta. " * 12_000
    portions = list(module._portions(text * 12))
    assert "".join(portions) == text * 12 and len(portions) > 1
    assert all(p[-1] in ",." for p in portions[:-1])
    rows = [(text, "en"), ("alpha beta " * 500, "en")]
    assert run(spark, rows, top=20, least=30) == brute(rows, 20, 30)


def test_counts_beyond_64_bits_divide_exactly(spark):
    row = spark.createDataFrame([(9_000_000_000_001, 17_000_000_000_003)], "a long, b long")
    got = row.select(module._quotient(row.a, row.b)).head()[0]
    assert got == 2_000_000 * 9_000_000_000_001 // 17_000_000_000_003


def test_empty_table(spark):
    assert run(spark, []) == []


def slices(spark, rows):
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    return module.encoded(docs).select("lang", "n_words", "words", "codes")


def decoded(table):
    batches = pa.Table.from_pylist([r.asDict() for r in table.collect()]).to_batches()
    return [(lang, words.to_pylist(), codes.tolist()) for lang, words, codes in module._slices(batches)]


def test_slices_are_passed_on_whole_and_come_back_as_they_were(spark):
    """No array is taken apart, and a row group holds few rows, so neither grows with the input of a task."""
    rows = [("one two, one", "en"), ("...", "fr"), ("été 中", "de")]
    table = slices(spark, rows)
    assert dict(table.dtypes) == {"lang": "string", "n_words": "bigint", "words": "string", "codes": "binary"}
    of_de, of_en, of_fr = sorted(decoded(table))
    assert (of_de, of_en) == (("de", ["été", "中"], [1, 2, 0]), ("en", ["one", "two"], [1, 2, 0, 1, 0]))
    assert of_fr[1] == [] and set(of_fr[2]) == {0}
    many = slices(spark, [("one two", f"l{k}") for k in range(30)])
    (file,) = [f for f in many.inputFiles()]
    found = pq.ParquetFile(file.removeprefix("file:"))
    assert max(found.metadata.row_group(k).num_rows for k in range(found.num_row_groups)) <= 4


def test_many_different_words_have_wide_numbers(spark):
    text = " ".join(f"w{k}" for k in range(70_000))
    ((_, words, codes),) = decoded(slices(spark, [(text, "en")]))
    assert (len(words), codes) == (70_000, [*range(1, 70_001), 0])


def test_many_languages_are_held_in_bounded_bytes(monkeypatch):
    """Each language is far below a slice; all together are put out on the way."""
    monkeypatch.setattr(module, "_HELD_BYTES", 1000)
    batch = pa.RecordBatch.from_pydict({"lang": [f"l{k}" for k in range(50)], "text": pa.array(["x" * 100] * 50)})
    drawn = []

    def one_by_one():
        for k in range(50):
            drawn.append(k)
            yield batch.slice(k, 1)

    out = module._encode(one_by_one())
    next(out)
    assert len(drawn) == 10
    assert len(list(out)) == 49
