"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its weight's share of all words, at
most `cap` times its own, with the excess shared out again by weight. A source
takes all of its documents as many times as fit whole into its target. What is
then missing is drawn without replacement in Pareto order: documents rank by
odds(u) / odds(inclusion probability), u a hash of the id, and are taken in
that order until the words are complete. Inclusion probabilities differ within
a source: they grow with an affinity, by default the binary digits of the size,
and are scaled so that the expected words are those that are missing. The last
document counts in part, or, where texts must stay whole, is taken or left,
whichever brings the source nearer to its target.

The order is never sorted as a whole. Ranks fall into fixed buckets whose words
are summed per source; only the bucket in which the target is met is looked at
row by row. What comes out is one cut point per source, and each document reads
its share from its source's cut point, so texts are never moved to be ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelframe.llm.common import SPACE_WORD, packed
from gavelframe.session import cut

_HASH_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """One row per source: source, source_size, tilt, target, whole, rest.

    Sources are numbered by code point, NULL last, and weigh `weights` in turn.
    Sorted by cap per weight, a source is held at its cap if its share of what
    the earlier ones left exceeds it; this is the fixed point of sharing the
    excess again and again. The windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.try_divide(F.sum(F.col("size") * F.col("affinity")), F.sum("size").cast("double")).alias("tilt"),
    )
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = per_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    weighed = weighed.withColumn("most", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    capped = weighed.withColumn("capped", F.col("most") <= left / F.sum("weight").over(later) * F.col("weight"))
    level = F.try_divide(
        F.sum("source_size").over(everything) - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(everything),
        F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything),
    )
    found = capped.withColumn("target", F.when(F.col("capped"), F.col("most")).otherwise(level * F.col("weight")))
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(int(cap)))).otherwise(0)
    found = found.withColumn("whole", whole.cast("long"))
    rest = F.round("target").cast("long") - F.col("whole") * F.col("source_size")
    rest = F.when(F.col("whole") >= int(cap), F.lit(0)).otherwise(F.greatest(rest, F.lit(0)))
    return found.select("source", "source_size", "tilt", "target", "whole", rest.cast("long").alias("rest"))


def _rank(seed: str) -> Column:
    """Pareto rank in (0, 1): odds(u) / odds(p), brought to (0, 1) without changing the order."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.md5(name), 1, _HASH_DIGITS), 16, 10).cast("double")
    u = (digits + 0.5) / float(16**_HASH_DIGITS)
    p = F.col("rest") / F.col("source_size") * F.col("affinity") / F.col("tilt")
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = u / (1 - u) * ((1 - p) / p)
    return odds / (1 + odds)


def cut_points(sizes: DataFrame, weights: tuple[float, ...], cap: float, seed: str, buckets: int) -> DataFrame:
    """`targets` with the rank at which each source's draw ends: cut_rank, part (words from there), tied (words there)."""
    sources = cut(targets(sizes, weights, cap), "mix-targets")
    ranked = (
        sizes.join(sources.where("rest > 0").withColumnRenamed("source", "src"), F.expr("source <=> src"))
        .select("src", "size", _rank(seed).alias("rank"), "rest")
        .withColumn("bucket", F.floor(F.col("rank") * buckets))
    )
    sums = ranked.groupBy("src", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    running = F.sum("words").over(Window.partitionBy("src").orderBy("bucket"))
    met = (
        sums.withColumn("before", running - F.col("words"))
        .where("before < rest AND rest <= before + words")
        .select(F.col("src").alias("met_src"), F.col("bucket").alias("met_bucket"), "before")
    )
    inside = ranked.join(met, F.col("src").eqNullSafe(F.col("met_src")) & (F.col("bucket") == F.col("met_bucket")))
    steps = inside.groupBy("src", "rank", "rest", "before").agg(F.sum("size").alias("tied"))
    running = F.col("before") + F.sum("tied").over(Window.partitionBy("src").orderBy("rank"))
    ends = (
        steps.withColumn("start", running - F.col("tied"))
        .where("start < rest AND rest <= start + tied")
        .select("src", F.col("rank").alias("cut_rank"), (F.col("rest") - F.col("start")).alias("part"), "tied")
    )
    return cut(sources.join(ends, F.expr("source <=> src"), "left").drop("src"), "mix-cuts")


def _shares(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, affinity_col: str | None,
    weights: tuple[float, ...], cap: float, seed: str, buckets: int, whole_texts: bool,
) -> DataFrame:
    given = F.coalesce(F.col(affinity_col).cast("double"), F.lit(1.0)) if affinity_col else F.lit(None).cast("double")
    rows = packed(docs, id=F.col(id_col), source=F.col(source_col), size=word_count(F.col(text_col)), given=given)
    digits = F.length(F.bin("size")).cast("double")  # small whole numbers: their sums are exact in any order
    rows = rows.withColumn("affinity", F.coalesce("given", digits)).drop("given")
    points = cut_points(cut(rows.drop("row"), "mix-sizes"), weights, cap, seed, buckets)
    joined = rows.join(points.withColumnRenamed("source", "src"), F.expr("source <=> src")).drop("src")
    rank = F.when(F.col("rest") > 0, _rank(seed))
    once = F.coalesce((rank < F.col("cut_rank")).cast("long"), F.lit(0))
    last = F.coalesce(rank == F.col("cut_rank"), F.lit(False))
    if whole_texts:
        near = last & (F.col("part") * 2 >= F.col("tied"))
        return joined.withColumns({"copies": F.col("whole") + once + near.cast("long"), "extra": F.lit(0).cast("long")})
    part = F.when(last, F.floor(F.col("part") * F.col("size") / F.col("tied"))).otherwise(0)
    return joined.withColumns({"copies": F.col("whole") + once, "extra": part.cast("long")})


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    affinity_col: str | None = None,
    weights: tuple[float, ...] = (1, 2, 3),
    cap: float = 3.0,
    seed: str = "",
    buckets: int = 4096,
    whole_texts: bool = False,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies.

    Size counts the words of the whole text, however long, NULL as 0. NULL is a
    source of its own. Inclusion probabilities within a source are in
    proportion to `affinity_col` (NULL counts as 1), else to the binary digits
    of the size, up to 1. `taken` counts words with repeats: `copies` whole
    texts and, at the one rank where a draw ends, a part; with `whole_texts`
    that document is taken if this misses the target by less than leaving it.
    Rows that repeat an id and a size rank alike: they share a part by size, or
    are taken together. The hash depends on id and seed only, so reruns agree.
    Other columns are not looked at. An empty table gives an empty result.
    """
    shares = _shares(docs, id_col, text_col, source_col, affinity_col, weights, cap, seed, buckets, whole_texts)
    return shares.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size") + F.col("extra")).alias("taken"),
        "copies",
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself, with the columns of `docs`: a row per copy that `mix` takes with `whole_texts`. No text is shortened."""
    shares = _shares(docs, id_col, text_col, source_col, None, (1, 2, 3), 3.0, "", 4096, True)
    copies = F.array_repeat(F.lit(True), F.col("copies").cast("int"))
    return shares.select("row", F.explode(copies)).select("row.*")
