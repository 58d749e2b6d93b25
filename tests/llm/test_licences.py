import re

from gavelframe.llm.licences import TEMPLATES, Template, scan_licences

SCHEMA = "doc_id long, text string, hits string, words int"
ROWS = [
    (1, "Released under the MIT License.", None, 1),
    (2, "under the mit licence", None, 1),
    (3, "Under-the\nMIT;license, and again under the mit license / CC BY-NC 4.0", "x", 1),
    (4, None, None, None),
    (5, "", None, None),
    (6, "mit " * 5000 + "apache license, version 2.0 é apache license version é2", None, 2),
    (7, "Licensed under the Apache License, Version 2.0", None, 2),
    (7, "Licensed under the Apache License, Version 2.0", None, 2),
    (None, "the GNU General Public License, version 3; all rights reserved", None, 2),
    (8, "Éunder the mit license", None, 3),
]
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def brute(text, templates=TEMPLATES):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    base, base_labels, labels, score = [], set(), set(), 0.0
    for t in templates:
        key = t.key.split()
        for i in range(len(words) - len(key) + 1):
            if words[i : i + len(key)] != key:
                continue
            labels.add(t.label)
            if t.base:
                base.append(i)
                base_labels.add(t.label)
            right = sum(0 <= i + o < len(words) and words[i + o] == w for o, w in t.places)
            score = max(score, right / len(t.places))
    first, last = (min(base), max(base)) if base else (None, None)
    return len(words), len(base), first, last, ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


def test_matches_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = sorted(map(str, (tuple(r) for r in scan_licences(docs).collect())))
    assert got == sorted(str((i, *brute(t))) for i, t, _, _ in ROWS)


def test_base_labels_are_those_of_the_fixed_phrases():
    assert {t.key: t.label for t in TEMPLATES if t.base} == BASE


def test_key_with_a_repeated_word(spark):
    own = (Template("twice", "no no never", base=True),)
    docs = spark.createDataFrame([(1, "no no no never no never"), (2, "no never no")], "doc_id long, text string")
    got = {r.doc_id: (r.n_base, r.first_word) for r in scan_licences(docs, templates=own).collect()}
    assert got == {1: (1, 1), 2: (0, None)}


def test_empty_table(spark):
    assert scan_licences(spark.createDataFrame([], SCHEMA)).count() == 0
