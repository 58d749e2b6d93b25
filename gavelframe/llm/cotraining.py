"""Quality classifier by co-training.

Two logistic views of a document learn from labelled rows: one sees its text
(shares of character classes, word shapes, repetition), the other its metadata
(how rows of its source and of its language were labelled, stated length). In
each round each view, calibrated by cross-fitting, hands all unlabelled rows
that it is sure of to the other as pseudo-labels. At the end the calibrated
views are added as log odds, with the prior counted once.

Only the labelled rows are a bounded sample: `max_labelled`, chosen by a hash
of the id. Unlabelled rows all count: each Newton step adds up their gradient
and Hessian in the tasks that hold them, a few hundred numbers, from a narrow
table of measures. The label rates of sources and languages come from all
labels and are smoothed towards the rate of all; a labelled row meets the rate
of the other folds only, so it never sees its own label. Every document is
then scored by one arithmetic expression, without Python. Its text moves only
if there are more labelled sources than the planner finds small enough to
broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavelframe.llm.common import SPACE_WORD, packed
from gavelframe.session import cut, settle

_SCALE = 1_000_000_007
_FOLDS = 5
_PLACES = ("source", "lang")
_SMOOTHING = 10.0  # labels that the rate of all counts for
_STEPS = 8
_SETTLED = 1e-3


def text_view(text: Column) -> dict[str, Column]:
    """Measures of the whole text, all between about 0 and 10."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.regexp_extract_all(text, F.lit(SPACE_WORD), F.lit(0))
    n_words = F.greatest(F.size("words"), F.lit(1))
    share = lambda pattern: F.regexp_count("text", F.lit(pattern)) / chars
    return {
        "text": text,
        "words": words,
        "t_upper": share(r"\p{Lu}"),
        "t_digits": share(r"\p{Nd}"),
        "t_stops": 10 * share(r"[.,;:?]"),
        "t_bangs": 10 * share(r"!"),
        "t_symbols": 10 * share(r"[^\p{L}\p{N}\s.,;:?!'\"()-]"),
        "t_lines": 10 * share(r"\n"),
        "t_word_length": chars / n_words / 10,
        "t_distinct": F.size(F.array_distinct("words")) / n_words,
        "t_repeats": F.size(F.filter(F.zip_with("words", F.slice("words", 2, n_words), lambda a, b: a == b), lambda same: same)) / n_words,
        "t_length": F.log1p(n_words.cast("double")),
    }


def metadata_view(docs: DataFrame) -> dict[str, Column]:
    """Source and language as never-NULL names, stated length on a log scale; absent columns and lengths that are no numbers count as NULL."""

    def column(name: str) -> Column:
        return (F.col(name) if name in docs.columns else F.lit(None)).cast("string")

    named = {f"at_{name}": F.coalesce(F.concat(F.lit("="), column(name)), F.lit("NULL")) for name in _PLACES}
    stated = column("n_chars").try_cast("double")
    length = F.when(~F.isnan(stated), F.least(F.greatest(stated, F.lit(0.0)), F.lit(1e18)))
    return named | {"m_length": F.log1p(F.coalesce(length, F.lit(0.0))), "m_unstated": length.isNull().cast("double")}


def _features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, the names of its places and the columns of both views but for the label rates."""
    text = text_view(F.col(text_col))
    rows = packed(docs, id=F.col(id_col), text=text.pop("text"), **metadata_view(docs))
    rows = rows.withColumn("words", text.pop("words"))
    return rows.withColumns(text).drop("text", "words")


def label_counts(learn: DataFrame, place: str) -> DataFrame:
    """Labelled rows and the sum of their labels per place and fold, as arrays."""
    label, folds = F.col("label").cast("double"), range(_FOLDS)
    return learn.where("label IS NOT NULL").groupBy(place).agg(
        F.array(*[F.count_if(F.col("fold") == f).cast("double") for f in folds]).alias(f"n_{place}"),
        F.array(*[F.sum(F.when(F.col("fold") == f, label).otherwise(0.0)) for f in folds]).alias(f"s_{place}"),
    )


def with_rates(rows: DataFrame, counts: dict[str, DataFrame], base: float, own_fold: Column) -> DataFrame:
    """Rows with the smoothed label rate of their places as log odds `m_<place>`; counts of `own_fold` are left out, none if it is NULL."""
    for place, counted in counts.items():
        rows = rows.join(counted, place, "left")
    nothing = F.array(*[F.lit(0.0)] * _FOLDS)

    def others(name: str) -> Column:
        values = F.coalesce(F.col(name), nothing)
        whole = F.aggregate(values, F.lit(0.0), lambda total, x: total + x)
        return whole - F.coalesce(F.get(values, own_fold), F.lit(0.0))

    for place in counts:
        n, s = others(f"n_{place}"), others(f"s_{place}")
        rows = rows.withColumn(f"m_{place}", F.log((s + _SMOOTHING * base) / (n - s + _SMOOTHING * (1 - base))))
    return rows.drop(*counts, *[f"{x}_{place}" for place in counts for x in "ns"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


Sums = tuple[np.ndarray, np.ndarray]


@dataclass
class Logistic:
    """Log odds as an affine function."""

    slope: np.ndarray
    offset: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.slope + self.offset

    def scaled(self, by: Logistic) -> Logistic:
        """This view with its log odds put through a one-dimensional calibration."""
        return Logistic(self.slope * by.slope[0], self.offset * by.slope[0] + by.offset)

    def column(self, names: list[str]) -> Column:
        return reduce(lambda a, b: a + b, [F.col(n) * F.lit(float(w)) for n, w in zip(names, self.slope, strict=True)], F.lit(self.offset))


def newton_sums(x: np.ndarray, y: np.ndarray, at: Logistic) -> Sums:
    """Gradient and negative Hessian of the log likelihood, by slope and offset; both add up over rows."""
    design, p = np.hstack([x, np.ones((len(x), 1))]), _sigmoid(at(x))
    return design.T @ (y - p), (design * (p * (1 - p))[:, None]).T @ design


def told_sums(views: list[np.ndarray], tellers: list[Logistic], learners: list[Logistic], sure: float) -> list[Sums]:
    """`newton_sums` of both learners over the rows of which the other view is sure, with what it says of them as labels."""
    least, out = np.log(sure / (1 - sure)), []
    for k, learner in enumerate(learners):
        told = tellers[1 - k](views[1 - k])
        confident = np.abs(told) >= least
        out.append(newton_sums(views[k][confident], (told[confident] > 0).astype(float), learner))
    return out


Pool = Callable[[list[Logistic], list[Logistic]], list[Sums]]


class _View:
    """A view in training: labelled rows, what the pool adds, and the coefficients on columns of mean 0 and spread 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        mean, spread = x.mean(0), x.std(0)
        spread[spread < 1e-9] = 1.0
        self.x, self.y, size = (x - mean) / spread, y, x.shape[1] + 1
        self.to_raw = np.diag([*1 / spread, 1.0])  # raw coefficients from own ones; sums go the other way
        self.to_raw[-1, :-1] = -mean / spread
        self.penalty = np.full(size, ridge)
        self.penalty[-1] = 1e-3  # keeps a single class finite
        self.beta, self.told, self.told_at = np.zeros(size), (np.zeros(size), np.zeros((size, size))), np.zeros(size)

    def raw(self, beta: np.ndarray | None = None) -> Logistic:
        slope = self.to_raw @ (self.beta if beta is None else beta)
        return Logistic(slope[:-1], float(slope[-1]))

    def tell(self, sums: Sums) -> None:
        """What the pool says at the present coefficients; near them it is a quadratic."""
        self.told, self.told_at = (self.to_raw.T @ sums[0], self.to_raw.T @ sums[1] @ self.to_raw), self.beta.copy()

    def step(self, beta: np.ndarray, rows: np.ndarray) -> np.ndarray:
        gradient, hessian = newton_sums(self.x[rows], self.y[rows], Logistic(beta[:-1], float(beta[-1])))
        gradient = gradient + self.told[0] - self.told[1] @ (beta - self.told_at) - self.penalty * beta
        step = np.linalg.solve(hessian + self.told[1] + np.diag(self.penalty), gradient)
        return step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))

    def settled(self, rows: np.ndarray, steps: int = 30) -> np.ndarray:
        beta = self.beta.copy()
        for _ in range(steps):
            step = self.step(beta, rows)
            beta += step
            if np.abs(step).max() < 1e-8:
                break
        return beta

    def calibrated(self, fold: np.ndarray) -> Logistic:
        """The view, brought to scale by the scores that labelled rows get from a fit without their fold."""
        apart = np.zeros(len(self.y))
        for f in np.unique(fold):
            beta = self.settled(fold != f)
            apart[fold == f] = self.x[fold == f] @ beta[:-1] + beta[-1]
        return self.raw().scaled(fit(apart[:, None], self.y))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
    """Ridge-penalised logistic regression by Newton steps."""
    view = _View(x, y, ridge)
    return view.raw(view.settled(np.ones(len(y), bool)))


def cotrain(views: list[np.ndarray], y: np.ndarray, fold: np.ndarray, pool: Pool, rounds: int = 3) -> tuple[list[Logistic], float]:
    """Calibrated views and the prior log odds. `pool` gives the sums of both learners over all unlabelled rows."""
    own = [_View(x, y) for x in views]
    everything = np.ones(len(y), bool)
    for view in own:
        view.beta = view.settled(everything)
    for _ in range(rounds):
        tellers = [view.calibrated(fold) for view in own]
        for _ in range(_STEPS):
            moved = 0.0
            for view, sums in zip(own, pool(tellers, [view.raw() for view in own]), strict=True):
                view.tell(sums)
                step = view.step(view.beta, everything)
                view.beta, moved = view.beta + step, max(moved, np.abs(step).max())
            if moved < _SETTLED:
                break
    base = (y.sum() + 0.5) / (len(y) + 1)
    return [view.calibrated(fold) for view in own], float(np.log(base / (1 - base)))


def pool_of(rows: DataFrame, names: list[list[str]], sure: float) -> Pool:
    """Sums over the rows of a written table; each task adds up its own, and only sums are shuffled."""
    sizes = [len(n) + 1 for n in names]
    ends = np.cumsum([0, *[part for n in sizes for part in (n, n * n)]])
    narrow = rows.select(*[c for n in names for c in n])

    def sums(tellers: list[Logistic], learners: list[Logistic]) -> list[Sums]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(ends[-1])
            for batch in batches:
                views = [np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in n]) for n in names]
                total += np.concatenate([part.ravel() for pair in told_sums(views, tellers, learners, sure) for part in pair])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "x"])

        added = narrow.mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
        flat = np.zeros(ends[-1])
        flat[added["at"].to_numpy(np.int64)] = added["x"].to_numpy(float)
        parts = np.split(flat, ends[1:-1])
        return [(parts[2 * k], parts[2 * k + 1].reshape(n, n)) for k, n in enumerate(sizes)]

    return sums


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = 20_000,
    rounds: int = 3,
    sure: float = 0.98,
    cutoff: float = 0.5,
) -> DataFrame:
    """One row per input row: its columns as struct `row`, text_score, metadata_score, score, kept.

    Scores are probabilities of label 1; a score at the cutoff is kept. They
    depend on the whole text, however long, and on source, lang and n_chars,
    whatever their type; other columns and their names do not matter.
    Conflicting labels of an id count as the smallest, NULL labels and ids are
    not learnt from, repeated rows count as often as they occur, and NULL texts
    count as empty. At most `max_labelled` labelled rows (on average) are
    fitted; label rates and pseudo-labels come from all rows. Without any label
    the scores are NULL and everything is kept. An empty table gives an empty
    result.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"))
    features = _features(docs, id_col, text_col)
    drawn = lambda salt: F.xxhash64(F.lit(salt), F.col("id"))
    learn = features.drop("row").where("id IS NOT NULL").join(known, "id", "left")
    learn = learn.withColumn("fold", F.pmod(drawn("fold"), F.lit(_FOLDS)).cast("int"))
    learn = cut(learn.withColumn("draw", F.pmod(drawn("sample"), F.lit(_SCALE)) / _SCALE).drop("id"), "quality-measures")
    met = learn.where("label IS NOT NULL").agg(F.count("*").alias("n"), F.sum("label").alias("good")).head()
    if not met["n"]:
        nothing = F.lit(None).cast("double")
        return docs.select(
            F.struct("*").alias("row"), nothing.alias("text_score"), nothing.alias("metadata_score"), nothing.alias("score"), F.lit(True).alias("kept")
        )
    base = (float(met["good"]) + 0.5) / (met["n"] + 1)
    counts = {f"at_{name}": cut(label_counts(learn, f"at_{name}"), f"quality-{name}") for name in _PLACES}
    rated = cut(with_rates(learn, counts, base, F.when(F.col("label").isNotNull(), F.col("fold"))), "quality-views")
    names = [[c for c in rated.columns if c.startswith(prefix)] for prefix in ("t_", "m_")]
    of_labelled = min(1.0, max_labelled / met["n"])
    sample = rated.where(F.col("label").isNotNull() & (F.col("draw") <= of_labelled)).toPandas()
    if sample.empty:
        raise ValueError("max_labelled leaves no labelled row to learn from")
    sample = sample.sort_values(["draw", *names[0], *names[1]], kind="stable")
    views = [sample[n].to_numpy(float) for n in names]
    pool = pool_of(rated.where("label IS NULL"), names, sure)
    (text, metadata), prior = cotrain(views, sample["label"].to_numpy(float), sample["fold"].to_numpy(), pool, rounds)

    whole = with_rates(features, counts, base, F.lit(None).cast("int"))
    odds = whole.select("row", text.column(names[0]).alias("text_odds"), metadata.column(names[1]).alias("metadata_odds"))
    odds = odds.withColumn("odds", F.col("text_odds") + F.col("metadata_odds") - F.lit(prior))
    # Settled, or a filter on the result would repeat the measures of the text within its own condition.
    chance = lambda c: 1 / (1 + F.exp(-F.least(F.greatest(F.col(c), F.lit(-50.0)), F.lit(50.0))))
    scored = odds.select(
        "row",
        chance("text_odds").alias("text_score"),
        chance("metadata_odds").alias("metadata_score"),
        chance("odds").alias("score"),
    )
    return settle(scored.withColumn("kept", F.col("score") >= cutoff))
