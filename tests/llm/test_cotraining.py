import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from gavelframe.llm.cotraining import Logistic, classify, cotrain, fit, label_counts, pool_of, told_sums, with_rates

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, t_upper string, row string"


def corpus(n=500):
    rng, docs, labels = random.Random(5), [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(["stone", "river", "light", "under", "cold"]) for _ in range(rng.randint(8, 60))]
        text = " ".join(words) + "." if good else rng.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join(w + "%$" for w in words)])
        docs.append((i, text, rng.choice(["en", "de", None]), f"s{rng.randint(0, 4)}", len(text), 1, "x", None))
        if i % 2:
            labels.append((i, int(good), 0))
    truth = {i: "|" not in d[1] and "!!" not in d[1] and "%$" not in d[1] for i, d in enumerate(docs)}
    docs += [(n, None, None, None, None, None, None, None), (n + 1, "", "en", "s1", 0, 1, None, None), (None, "plain words here.", None, None, None, 1, None, None)]
    docs += [(n + 2, "long words. " * 20_000, "en", "s1", None, 1, None, None), docs[0]]
    return docs, labels + [(1, 0, 0), (None, 1, 0), (3, None, 0), (9999, 1, 0)], truth


def test_held_out_accuracy_and_every_row_scored(spark):
    docs, labels, truth = corpus()
    table = spark.createDataFrame(docs, SCHEMA).repartition(4)
    scored = classify(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert scored.select("row.*").columns == table.columns
    got = scored.select("row.doc_id", "text_score", "metadata_score", "score", "kept").collect()
    assert len(got) == len(docs)
    assert all(0 <= s <= 1 for r in got for s in (r.text_score, r.metadata_score, r.score))
    unseen = [r for r in got if r.doc_id is not None and r.doc_id < 500 and r.doc_id % 2 == 0]
    assert sum(r.kept == truth[r.doc_id] for r in unseen) / len(unseen) > 0.97


def test_score_is_the_two_views_with_the_prior_once(spark):
    docs, labels, _ = corpus(300)
    got = classify(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    odds = lambda p: np.log(p / (1 - p))
    prior = [odds(r.text_score) + odds(r.metadata_score) - odds(r.score) for r in got if 1e-9 < r.text_score < 1 - 1e-9]
    assert np.ptp(prior) < 1e-5


def test_views_teach_each_other():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 4000).astype(float)
    one, other = (y[:, None] * 2 - 1) * 1.5 + rng.normal(size=(4000, 1)), (y[:, None] * 2 - 1) * 1.5 + rng.normal(size=(4000, 1))
    pool = [one[1500:2000], other[1500:2000]]
    (a, b), prior = cotrain([one[:1500], other[:1500]], y[:1500], np.arange(1500) % 5, lambda tell, learn: told_sums(pool, tell, learn, 0.98))
    both = a(one[2000:]) + b(other[2000:]) - prior
    assert ((both > 0) == y[2000:]).mean() > ((a(one[2000:]) > 0) == y[2000:]).mean()
    assert np.mean(1 / (1 + np.exp(-a(one[2000:])))) == pytest.approx(y[2000:].mean(), abs=0.05)


def test_single_class_stays_finite():
    fitted = fit(np.arange(20.0)[:, None], np.ones(20))
    assert np.isfinite(fitted(np.array([[1e3]]))).all() and (fitted(np.arange(20.0)[:, None]) > 0).all()


def brute_round(views, y, pool, tellers, sure=0.98):
    """The minimum that a round settles at, by plain gradient descent over labelled and confident rows together."""
    found = []
    for k, x in enumerate(views):
        told = tellers[1 - k](pool[1 - k])
        keep = np.abs(told) >= np.log(sure / (1 - sure))
        mean, spread = x.mean(0), x.std(0)
        rows = (np.vstack([x, pool[k][keep]]) - mean) / spread
        design, target = np.hstack([rows, np.ones((len(rows), 1))]), np.concatenate([y, told[keep] > 0])
        weight, penalty = np.zeros(design.shape[1]), np.array([1.0] * x.shape[1] + [1e-3])
        for _ in range(20_000):
            weight += 0.5 / len(rows) * (design.T @ (target - 1 / (1 + np.exp(-design @ weight))) - penalty * weight)
        found.append(Logistic(weight[:-1] / spread, weight[-1] - weight[:-1] @ (mean / spread)))
    return found


def test_a_round_over_the_distributed_pool_is_one_fit_of_all_rows(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 1200).astype(float)
    views = [(y[:, None] - 0.4) * 2.5 + rng.normal(size=(1200, d)) for d in (2, 3)]
    labelled, pool = [v[:200] for v in views], [v[200:] for v in views]
    rows = spark.createDataFrame(np.hstack(pool).tolist(), "t_a double, t_b double, m_a double, m_b double, m_c double").repartition(5)
    sums = pool_of(rows, [["t_a", "t_b"], ["m_a", "m_b", "m_c"]], 0.98)
    tellers = [fit(x, y[:200]) for x in labelled]
    for here, there in zip(sums(tellers, tellers), told_sums(pool, tellers, tellers, 0.98), strict=True):
        assert np.allclose(here[0], there[0]) and np.allclose(here[1], there[1])
    met = []

    def watching(tell, learn):
        met.append((tell, learn))
        return sums(tell, learn)

    cotrain(labelled, y[:200], np.arange(200) % 5, watching, rounds=1)
    for got, want in zip(met[-1][1], brute_round(labelled, y[:200], pool, met[-1][0]), strict=True):
        assert np.allclose([*got.slope, got.offset], [*want.slope, want.offset], atol=0.01)


def test_label_rates_leave_the_own_fold_out(spark):
    rows = [(f"s{i % 40}", i % 5, i % 3 % 2 if i % 4 else None) for i in range(400)] + [("unlabelled", 0, None)]
    learn = spark.createDataFrame(rows, "at_source string, fold int, label int")
    counts = {"at_source": label_counts(learn, "at_source")}
    got = with_rates(learn.withColumn("at", F.col("at_source")), counts, 0.3, F.when(F.col("label").isNotNull(), F.col("fold"))).collect()
    assert len(got) == len(rows)
    for r in got:
        others = [y for s, f, y in rows if s == r.at and y is not None and (r.label is None or f != r.fold)]
        good = sum(others)
        assert r.m_at_source == pytest.approx(np.log((good + 3) / (len(others) - good + 7)))


def test_hundreds_of_sources_are_told_apart(spark):
    rng = random.Random(2)
    docs = [(i, "same words in all texts", f"site{i % 300}") for i in range(6000)]
    labels = [(i, int(i % 300 % 2 == 0), 0) for i in range(6000) if rng.random() < 0.7]
    scored = classify(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = scored.select("row.doc_id", "kept").collect()
    assert sum(r.kept == (r.doc_id % 300 % 2 == 0) for r in got) / 6000 > 0.99


@pytest.mark.parametrize("n", [1, 2, 7])
def test_few_labels_follow_the_same_rule(spark, n):
    docs, labels, _ = corpus(60)
    got = classify(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels[:n], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)


def test_metadata_of_any_type(spark):
    docs, labels, _ = corpus(80)
    lengths = ["many", "NaN", "-3", "1e400", None, "12"]
    odd = [(d[0], d[1], [d[2] or ""], {"s": i % 3}, lengths[i % 6]) for i, d in enumerate(docs)]
    table = spark.createDataFrame(odd, "doc_id long, text string, lang array<string>, source map<string,int>, n_chars string")
    got = classify(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)


def test_without_labels_everything_stays(spark):
    docs, _, _ = corpus(5)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = classify(spark.createDataFrame(docs, SCHEMA), none).collect()
    assert all(r.kept and r.score is None for r in got) and len(got) == len(docs)
    assert classify(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_absent_metadata_columns(spark):
    docs, labels, _ = corpus(100)
    bare = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    assert classify(bare, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == len(docs)
