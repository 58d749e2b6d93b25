"""Licence scan by a positional index of rare words.

Each file keeps the places of its licence words (words of any template). How
many files hold a word gives its IDF. A template is looked up through its
highest-IDF key word: where a file lacks it, nothing else is evaluated. Where
it is present, the template's postings are shifted by their relative positions
and intersected from the rarest word on; what is left are the places where the
mandatory key phrase stands word for word. The words of the template around the
key phrase only raise the score.

All of this happens within a row. Only the document frequencies of the template
words, a table no longer than the list of templates, are gathered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.common import ascii_lower
from gavelframe.session import cut

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """`key` must stand word for word; `before` and `after` are what usually surrounds it."""

    label: str
    key: str
    before: str = ""
    after: str = ""
    base: bool = False

    @property
    def places(self) -> list[tuple[int, str]]:
        """Every word with its position relative to the start of the key phrase."""
        lead = self.before.split()
        return list(enumerate([*lead, *self.key.split(), *self.after.split()], -len(lead)))


# Labels and wordings of licence notices.
TEMPLATES = (
    Template("mit", "under the mit license", before="released", base=True),
    Template("apache-2", "apache license version 2", before="licensed under the", after="0", base=True),
    Template("cc-by-nc", "cc by nc", before="licensed under", after="4 0", base=True),
    Template("agpl-3", "gnu affero general public license version 3", before="licensed under the"),
    Template("all-rights-reserved", "all rights reserved"),
    Template("bsd", "redistribution and use in source and binary forms", after="with or without modification"),
    Template("cc-by-sa", "cc by sa", before="licensed under", after="4 0"),
    Template("cc0", "cc0 1 0", after="universal"),
    Template("gpl-2", "gnu general public license version 2", before="licensed under the"),
    Template("gpl-3", "gnu general public license version 3", before="licensed under the"),
    Template("isc", "permission to use copy modify and or distribute this software", after="for any purpose"),
    Template("lgpl-3", "gnu lesser general public license version 3", before="licensed under the"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", after="of this software"),
    Template("mpl-2", "mozilla public license version 2", before="subject to the terms of the", after="0"),
    Template("unlicense", "free and unencumbered software released into the public domain", before="this is"),
)


def _hits(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """id, n_words, hits: the licence words of each row with their places."""
    words = F.regexp_extract_all(ascii_lower(F.col(text_col)), F.lit(WORD), F.lit(0))
    found = F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("w"), i.alias("i"))))
    return docs.select(F.col(id_col).alias("id"), words.alias("words")).select(
        "id", F.size("words").cast("long").alias("n_words"), F.array_compact(found).alias("hits")
    )


def _shifted(word: str, offset: int) -> Column:
    """Starts of the key phrase that places of `word` vote for."""
    own = F.filter("hits", lambda h: h["w"] == word)
    return F.transform(own, lambda h: h["i"] - F.lit(offset))


def _starts(template: Template, idf: dict[str, float]) -> Column:
    keys = [(offset, w) for offset, w in template.places if 0 <= offset < len(template.key.split())]
    keys.sort(key=lambda place: (-idf[place[1]], place))
    voted = reduce(F.array_intersect, [_shifted(w, offset) for offset, w in keys])
    rarest = F.exists("hits", lambda h: h["w"] == keys[0][1])
    return F.when(rarest, F.array_sort(voted)).otherwise(F.array().cast("array<int>"))


def _share(template: Template, starts: Column) -> Column:
    """Best share of the template's words that stand where they should, over all starts."""
    places, n_key = template.places, len(template.key.split())
    around = [(offset, w) for offset, w in places if not 0 <= offset < n_key]

    def share(start: Column) -> Column:
        more = [F.array_contains(_shifted(w, offset), start).cast("int") for offset, w in around]
        return (reduce(lambda a, b: a + b, more, F.lit(n_key)) / F.lit(len(places))).cast("double")

    return F.array_max(F.transform(starts, share))


def scan_licences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Texts are lower-cased (A-Z) and read as words; NULL counts as empty.
    `n_base` counts the places of all base key phrases, `first_word` and
    `last_word` are the smallest and largest of them (NULL without any), the
    labels are distinct, sorted and comma-joined, and `score` is the best share
    of a template whose key phrase is present, else 0. Rows are independent:
    repeated or NULL ids and other columns change nothing.
    """
    vocabulary = sorted({w for t in templates for _, w in t.places})
    hits = cut(_hits(docs, id_col, text_col, vocabulary), "licence-hits")
    n_files = hits.count()
    held = hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
    frequency = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    idf = {w: math.log((n_files + 1) / (frequency.get(w, 0) + 1)) for w in vocabulary}

    placed = hits.select("*", *[_starts(t, idf).alias(f"starts_{k}") for k, t in enumerate(templates)])
    starts = [F.col(f"starts_{k}") for k in range(len(templates))]
    base = F.array_sort(F.concat(*[s for s, t in zip(starts, templates, strict=True) if t.base]))

    def labels(of: list[tuple[Column, Template]]) -> Column:
        present = [F.when(F.size(s) > 0, F.lit(t.label)) for s, t in of]
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*present)))), ",")

    pairs = list(zip(starts, templates, strict=True))
    shares = [F.when(F.size(s) > 0, _share(t, s)).otherwise(F.lit(0.0)) for s, t in pairs]
    return placed.withColumn("base", base).select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base").cast("long").alias("first_word"),
        F.array_max("base").cast("long").alias("last_word"),
        labels([(s, t) for s, t in pairs if t.base]).alias("base_labels"),
        labels(pairs).alias("labels"),
        F.array_max(F.array(*shares)).alias("score"),
    )


def oracle(templates: tuple[Template, ...] = TEMPLATES, lower: str = "text") -> str:
    """The same rows in DuckDB SQL, from the whole word list of each document."""

    def here(t: Template) -> str:
        key = t.key.split()
        return f"list_filter(spots, lambda i: words[i + 1] = '{key[0]}' AND words[i + 1:i + {len(key)}] = {key})"

    def share(k: int, t: Template) -> str:
        n_key = len(t.key.split())
        around = [
            f"CASE WHEN i + {o} >= 0 AND words[i + {o} + 1] = '{w}' THEN 1 ELSE 0 END" for o, w in t.places if not 0 <= o < n_key
        ]
        total = " + ".join([str(n_key), *around])
        return f"coalesce(list_max(list_transform(s{k}, lambda i: ({total})::DOUBLE / {len(t.places)})), 0)"

    def labels(pairs: list[tuple[int, Template]]) -> str:
        cases = ", ".join(f"CASE WHEN len(s{k}) > 0 THEN '{t.label}' END" for k, t in pairs)
        return f"array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',')"

    every = list(enumerate(templates))
    base = " || ".join(f"s{k}" for k, t in every if t.base)
    return rf"""
    WITH w AS (SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
    p AS (SELECT *, range(len(words)) AS spots FROM w),
    s AS (SELECT doc_id, words, {", ".join(f"{here(t)} AS s{k}" for k, t in every)} FROM p),
    b AS (SELECT *, {base} AS base FROM s)
    SELECT doc_id, len(words)::BIGINT AS n_words, len(base)::BIGINT AS n_base,
           list_min(base)::BIGINT AS first_word, list_max(base)::BIGINT AS last_word,
           {labels([x for x in every if x[1].base])} AS base_labels, {labels(every)} AS labels,
           list_max([{", ".join(share(k, t) for k, t in every)}]) AS score
    FROM b
    """
