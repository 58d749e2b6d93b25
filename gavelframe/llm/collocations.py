"""Phrases whose words stand together more often than their parts, per language, by best-first growth.

A phrase scores by its least favourable cut into two parts: a / (l + r), with a,
l and r the counts of the phrase and of the parts. A phrase that is longer by a
word is at most as frequent, so with the counts of a prefix P alone, no phrase
that begins with P can score above the least of a / (l + a) over the beginnings
of P, a being P's own count. This bound orders the work:

1. one pass counts words and pairs, of which only those of at least `least`
   occurrences can be part of a phrase that has them;
2. rounds take the phrases with the highest bounds, and one pass over the
   corpus counts what they become with a word before or behind. That gives the
   longer phrases, and tells which of those expanded are swallowed by them;
3. as soon as `top` phrases of a language are settled (scored exactly and
   expanded without being swallowed), only bounds that reach the last one's
   score, ties included, are still expanded. Nothing is left out: when no bound
   reaches it, no uncounted phrase can.

A round holds at most `batch` phrases, so what tasks are given is bounded at
any size; more rounds do the rest. Texts are encoded once: a row holds the
words of some four megabytes of one language and the text as their numbers,
as one string and one block of bytes. Spark passes these on whole; arrays it
would take apart and put together again, element by element, and hold several
times over. A row group of that table has few such rows, as a reader holds all
rows of one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.llm.common import small_batches
from gavelframe.session import bounded_batches, cut

_SCALE = 2_000_000
_BREAKS = r"[.,;:!?\x0A-\x0D]"
_BREAK = re.compile(_BREAKS)
_SLICE_BYTES = 4 << 20
_HELD_BYTES = 4 * _SLICE_BYTES
_SLICES_AT_ONCE = 2
_ROWS_AT_ONCE = 100_000
_PARTS = 32
_ENCODED = "lang string, n_words long, words string, codes binary"
# A writer looks at sizes after a hundred rows only, so the rows are what is bounded.
_FEW_ROWS = {"parquet.block.row.count.limit": "4", "parquet.page.row.count.limit": "1", "parquet.enable.dictionary": "false"}


def _portions(text: str) -> Iterator[str]:
    """The text, cut after breaks into portions of about a slice, so that a very long one is never encoded at once."""
    start = 0
    while len(text) - start > _SLICE_BYTES:
        found = _BREAK.search(text, start + _SLICE_BYTES)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:]


def _encode_texts(texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words, and the texts as their numbers from 1, with 0 between pieces."""
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), pattern=_BREAKS + "+", replacement=" . ")
    split = pc.ascii_split_whitespace(marked)
    coded = split.values.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    # A break character is never in a word; empty strings stand only at the ends of texts.
    is_word = np.array([w not in (".", "") for w in distinct], bool)
    number = np.where(is_word, np.cumsum(is_word), 0).astype(np.int32)
    codes = number[coded.indices.to_numpy()] if len(distinct) else np.empty(0, np.int32)
    codes = np.insert(codes, split.offsets.to_numpy()[1:], 0)
    return [w for w, word in zip(distinct, is_word, strict=True) if word], codes


def _narrow(n_words: int) -> str:
    """Type of the numbers of so many words, and of 0."""
    return "<u2" if n_words < 1 << 16 else "<i4"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each slice; what is held of all languages together is bounded, too."""
    held: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}

    def flushed(lang: str) -> pa.RecordBatch:
        words, codes = _encode_texts(pa.array(held.pop(lang), pa.large_string()))
        sizes.pop(lang)
        columns = [
            pa.array([lang], pa.string()),
            pa.array([np.count_nonzero(codes)], pa.int64()),
            pa.array(["\n".join(words)], pa.string()),
            pa.array([codes.astype(_narrow(len(words))).tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "n_words", "words", "codes"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for portion in _portions(text.as_py()):
                held.setdefault(lang, []).append(portion)
                sizes[lang] = sizes.get(lang, 0) + len(portion)
                if sizes[lang] >= _SLICE_BYTES:
                    yield flushed(lang)
                elif sum(sizes.values()) >= _HELD_BYTES:
                    yield flushed(max(sizes, key=sizes.__getitem__))
    for lang in list(held):
        yield flushed(lang)


def encoded(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    with small_batches(docs.sparkSession, 500), bounded_batches(docs.sparkSession):
        return cut(rows.mapInArrow(_encode, _ENCODED), "phrases-encoded", **_FEW_ROWS)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    for batch in batches:
        for k in range(len(batch)):
            lang, _, joined, codes = (batch.column(c)[k] for c in range(4))
            # Words have no line break; the empty string is that of no words.
            words = pc.split_pattern(pa.array([joined]), "\n").flatten() if joined.as_buffer().size else pa.array([], pa.string())
            yield lang.as_py(), words, np.frombuffer(codes.as_buffer(), _narrow(len(words)))


def _count_short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, first, second, n) of the words (second NULL) and pairs of each slice."""
    for lang, words, codes in _slices(batches):
        n = np.bincount(codes, minlength=len(words) + 1)[1:]
        both = (codes[:-1] > 0) & (codes[1:] > 0)
        pairs, times = np.unique(codes[:-1][both].astype(np.int64) * (len(words) + 1) + codes[1:][both], return_counts=True)
        first, second = np.divmod(pairs, len(words) + 1)
        columns = [
            pa.array([lang] * (len(n) + len(pairs)), pa.string()),
            pa.concat_arrays([words, words.take(pa.array(first - 1))]),
            pa.concat_arrays([pa.nulls(len(n), pa.string()), words.take(pa.array(second - 1))]),
            pa.array(np.concatenate([n, times]), pa.int64()),
        ]
        yield from _portioned(pa.RecordBatch.from_arrays(columns, names=["lang", "first", "second", "n"]))


def _portioned(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in batches that neither side of the exchange holds much memory for."""
    for k in range(0, len(rows), _ROWS_AT_ONCE):
        yield rows.slice(k, _ROWS_AT_ONCE)
    pa.default_memory_pool().release_unused()


class _Sought:
    """The phrases of a round in one language, by numbers of their words."""

    def __init__(self, phrases: list[str]) -> None:
        split = [p.split(" ") for p in phrases]
        self.phrases = phrases
        self.words = sorted({w for words in split for w in words})
        self.base = len(self.words) + 1
        number = {w: k + 1 for k, w in enumerate(self.words)}
        heads = np.array([number[w[0]] * self.base + number[w[1]] for w in split], np.int64)
        self.pairs = np.unique(heads)
        self.of_pair = np.full(len(self.pairs), -1, np.int64)
        triples, of_triple = [], []
        for k, words in enumerate(split):
            pair = int(np.searchsorted(self.pairs, heads[k]))
            if len(words) == 2:
                self.of_pair[pair] = k
            else:
                triples.append(pair * self.base + number[words[2]])
                of_triple.append(k)
        order = np.argsort(np.array(triples, np.int64))
        self.triples = np.array(triples, np.int64)[order]
        self.of_triple = np.array(of_triple, np.int64)[order]

    @staticmethod
    def _find(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of `keys` that are in `sought` (sorted), and where."""
        if not len(sought):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(sought, keys), len(sought) - 1)
        places = np.flatnonzero(sought[at] == keys)
        return places, at[places]

    def met(self, words: pa.Array, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, numbers and start places of the phrases that stand in a slice."""
        known = pc.fill_null(pc.index_in(words, value_set=pa.array(self.words, pa.string())), -1).to_numpy() + 1
        numbers = np.concatenate([[0], known]).astype(np.int64)[codes]
        starts = np.flatnonzero((numbers[:-1] > 0) & (numbers[1:] > 0))
        found, pair = self._find(numbers[starts] * self.base + numbers[starts + 1], self.pairs)
        starts = starts[found]
        wanted = self.of_pair[pair] >= 0
        yield 2, self.of_pair[pair[wanted]], starts[wanted]
        inside = starts + 2 < len(numbers)
        starts, pair = starts[inside], pair[inside]
        third = numbers[starts + 2]
        found, triple = self._find(pair * self.base + third, self.triples)
        sound = third[found] > 0
        yield 3, self.of_triple[triple[sound]], starts[found[sound]]


def _count_longer(sought: dict[str, _Sought]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, phrase, before, word, n): what the sought phrases become with a word before or behind."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _slices(batches):
            if lang not in sought or len(codes) < 2:
                continue
            of_lang, keys = sought[lang], []
            base = len(words) + 1
            for length, phrase, start in of_lang.met(words, codes):
                for before, place in ((1, start - 1), (0, start + length)):
                    inside = (place >= 0) & (place < len(codes))
                    beside = codes[place[inside]].astype(np.int64)
                    keys.append(((phrase[inside] * 2 + before) * base + beside)[beside > 0])
            each, times = np.unique(np.concatenate(keys), return_counts=True)
            task, word = np.divmod(each, base)
            columns = [
                pa.array([lang] * len(each), pa.string()),
                pa.array(of_lang.phrases, pa.string()).take(pa.array(task // 2)),
                pa.array(task % 2 == 1),
                words.take(pa.array(word - 1)),
                pa.array(times, pa.int64()),
            ]
            yield from _portioned(pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "before", "word", "n"]))

    return count


def _first_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def _last_words(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", -k)


def _counted(rows: DataFrame, counts: DataFrame, part: Column, name: str) -> DataFrame:
    """`rows` with the count of a part of their phrase, NULL where it is not in `counts`."""
    other = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("a").alias(name))
    return rows.join(other, (F.col("lang") == F.col("_lang")) & (part == F.col("_part")), "left").drop("_lang", "_part")


def _quotient(count: Column, parts: Column) -> Column:
    """floor(2,000,000 * count / parts), exact: the product can pass 64 bits."""
    whole = count.cast("decimal(19,0)") * F.lit(_SCALE).cast("decimal(8,0)")
    return F.call_function("div", whole, parts.cast("decimal(19,0)"))


def _scored(rows: DataFrame, counts: dict[int, DataFrame], m: int) -> DataFrame:
    """lang, phrase, m, a, l, r, score, bound, exact for phrases of m words.

    A part that is not counted yet occurs at least as often as the phrase; with
    that, score is the highest that it can still be, and exact is false.
    """
    exact = F.lit(True)
    for k in range(1, m):
        rows = _counted(rows, counts[k], _first_words(F.col("phrase"), k), f"head{k}")
        rows = _counted(rows, counts[k], _last_words(F.col("phrase"), k), f"tail{k}")
        exact = exact & F.col(f"head{k}").isNotNull() & F.col(f"tail{k}").isNotNull()
    head = {k: F.coalesce(F.col(f"head{k}"), F.col("a")) for k in range(1, m)}
    tail = {k: F.coalesce(F.col(f"tail{k}"), F.col("a")) for k in range(1, m)}
    cuts = [
        F.struct(
            _quotient(F.col("a"), head[k] + tail[m - k]).alias("score"),
            F.lit(k).alias("k"),
            head[k].alias("l"),
            tail[m - k].alias("r"),
        )
        for k in range(1, m)
    ]
    bounds = [_quotient(F.col("a"), head[k] + F.col("a")) for k in range(1, m)]
    found = rows.withColumns(
        {"worst": F.array_min(F.array(*cuts)), "bound": F.array_min(F.array(*bounds)), "exact": exact, "m": F.lit(m)}
    )
    return found.select("lang", "phrase", "m", "a", "worst.l", "worst.r", "worst.score", "bound", "exact")


def _top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first `n` rows of each language with their rank.

    Parts of a language are reduced to `n` rows each before they meet, so the
    last step has as many rows for a hot language whatever the corpus.
    """
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    for group in (["lang", part], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= n)
    return rows


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    top: int = 2000,
    least: int = 30,
    batch: int = 20_000,
) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are what stands between blanks and tabs in pieces without .,;:!? and
    line breaks, A-Z lower-cased; phrases are 2 to 4 words of one piece that
    occur at least `least` times, overlapping occurrences included. The lowest
    cut of a phrase counts, the earliest of equal ones. A phrase inside a longer
    one that has at least 80 % of its occurrences is dropped, whether the longer
    one is dropped or not. Ties in score rank by a, then by phrase in byte order.
    A NULL language is `und`, with the rows that are so named; NULL and empty
    texts have no words. Repeated rows count each time. Very long texts are cut
    after breaks, between pieces. Other columns are not looked at. An empty
    table gives an empty result. A round expands at most `batch` phrases of a
    language, and as many over all.
    """
    spark = docs.sparkSession
    texts = encoded(docs, text_col, lang_col)
    totals = texts.groupBy("lang").agg(F.sum("n_words").alias("n"))
    short = texts.mapInArrow(_count_short, "lang string, first string, second string, n long")
    # Slices are summed up where they are read. What a task could still merge is little beside the pairs it would hold.
    short = short.repartition("lang", "first", "second").groupBy("lang", "first", "second").agg(F.sum("n").alias("a"))
    with small_batches(spark, _SLICES_AT_ONCE):
        short = cut(short.where(F.col("a") >= least), "phrases-short")
    words = short.where("second IS NULL").select("lang", F.col("first").alias("phrase"), "a")
    pairs = short.where("second IS NOT NULL").select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a")
    of_two = cut(_scored(pairs, {1: words}, 2), "phrases-pairs")
    longer = spark.createDataFrame([], "lang string, phrase string, m int, a long")
    expanded = spark.createDataFrame([], "lang string, phrase string")

    while True:
        counts = {1: words, 2: of_two.select("lang", "phrase", "a")}
        known = {2: of_two}
        for m in (3, 4):
            counts[m] = longer.where(F.col("m") == m).select("lang", "phrase", "a")
            known[m] = _scored(counts[m], counts, m)
        swallowed = _swallowed(counts)
        everything = known[2].unionByName(known[3]).unionByName(known[4])
        state = everything.join(expanded.withColumn("grown", F.lit(True)), ["lang", "phrase"], "left").withColumn(
            "grown", F.col("grown").isNotNull()
        )
        state = cut(state, "phrases-state")
        settled = state.where("exact AND (grown OR m = 4)").join(swallowed, ["lang", "phrase"], "left_anti")
        settled = cut(_top(settled, top, F.desc("score"), F.desc("a"), F.asc("phrase")), "phrases-settled")
        limit = settled.where(F.col("rank") == top).select(F.col("lang").alias("_lang"), F.col("score").alias("limit"))
        reach = state.join(limit, F.col("lang") == F.col("_lang"), "left").where("limit IS NULL OR greatest(bound, score) >= limit")
        open_ = reach.where("NOT grown AND m < 4").select("lang", "phrase", "bound")
        # The counts that a phrase of four words lacks come from the pair in its middle.
        middle = _last_words(_first_words(F.col("phrase"), 3), 2)
        lacking = reach.where("m = 4 AND NOT exact").select("lang", middle.alias("phrase"), F.col("score").alias("bound"))
        lacking = lacking.join(expanded, ["lang", "phrase"], "left_anti")
        open_ = open_.unionByName(lacking).groupBy("lang", "phrase").agg(F.max("bound").alias("bound"))
        chosen = _top(open_, batch, F.desc("bound"), F.asc("phrase")).orderBy("rank", "lang").limit(batch).select("lang", "phrase").collect()
        if not chosen:
            break
        by_lang: dict[str, list[str]] = {}
        for lang, phrase in chosen:
            by_lang.setdefault(lang, []).append(phrase)
        sought = {lang: _Sought(phrases) for lang, phrases in by_lang.items()}
        more = texts.mapInArrow(_count_longer(sought), "lang string, phrase string, before boolean, word string, n long")
        more = more.groupBy("lang", "phrase", "before", "word").agg(F.sum("n").alias("a")).where(F.col("a") >= least)
        grown = F.when(F.col("before"), F.concat_ws(" ", "word", "phrase")).otherwise(F.concat_ws(" ", "phrase", "word"))
        more = more.select("lang", grown.alias("phrase"), "a").withColumn("m", F.size(F.split("phrase", " ")))
        with small_batches(spark, _SLICES_AT_ONCE):
            longer = cut(longer.unionByName(more).distinct(), "phrases-grown")
        done = pa.table({"lang": [x for x, _ in chosen], "phrase": [x for _, x in chosen]})
        expanded = cut(expanded.unionByName(spark.createDataFrame(done)), "phrases-expanded")

    return (
        settled.join(totals, "lang")
        .withColumn("rank", F.col("rank").cast("long"))
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _swallowed(counts: dict[int, DataFrame]) -> DataFrame:
    """Phrases inside one that is a word longer and at least 80 % as frequent.

    If a phrase is that frequent inside one of two words more, it is so inside
    one of one word more, too.
    """
    found = None
    for m in (3, 4):
        outer = counts[m].withColumn("inner", F.explode(F.array(_first_words(F.col("phrase"), m - 1), _last_words(F.col("phrase"), m - 1))))
        outer = outer.groupBy("lang", F.col("inner").alias("phrase")).agg(F.max("a").alias("most"))
        of_m = outer.join(counts[m - 1], ["lang", "phrase"]).where("5 * most >= 4 * a").select("lang", "phrase")
        found = of_m if found is None else found.unionByName(of_m)
    return found
