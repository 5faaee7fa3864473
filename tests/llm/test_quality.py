import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm.quality import FEATURES, _sample, features, fit_quality, fit_rows, keep_good, score_quality

ALL = "1 = 1"


@pytest.fixture
def labelled(documents, spark, prose, pick):
    rows, marks = [], []
    for i in range(300):
        good = pick.random() < 0.85
        text = prose(pick.randint(30, 200), 20)
        if not good:
            text = pick.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | "), " ".join(w + "$$$" for w in text.split()), "\n".join([text[:60]] * 30)])
        rows.append((i, text))
        if pick.random() < 0.5:
            marks.append((i, int(good)))
    truth = {i: int("!!" not in t and "|" not in t and "$$$" not in t and len(set(t.split("\n"))) > 1) for i, t in rows}
    return documents(rows), spark.createDataFrame(marks, "doc_id bigint, quality int"), truth


def test_unlabelled_rows_are_told_apart(labelled):
    docs, labels, truth = labelled
    held_out = F.col("_id") % 3 != 0
    model = fit_quality(docs, labels, held_out)
    found = {r["_id"]: r["score"] for r in score_quality(docs, model).collect()}
    unseen = [i for i in truth if i % 3 == 0]
    assert np.mean([(found[i] >= 0.5) == truth[i] for i in unseen]) > 0.95
    assert all(0 <= s <= 1 for s in found.values())
    assert 0.7 < model.prior < 0.95


def test_labels_outside_the_condition_do_not_matter(labelled):
    docs, labels, _ = labelled
    condition = F.col("_id") % 3 != 0
    turned = labels.withColumn("quality", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_quality(docs, labels, condition), fit_quality(docs, turned, condition)
    assert np.array_equal(a.weights, b.weights) and a.prior == b.prior


def test_rows_and_columns_are_kept(labelled, documents):
    docs, labels, _ = labelled
    model = fit_quality(docs, labels, ALL)
    odd = documents([(1, None), (1, None), (2, ""), (None, "x " * 100_000)])
    assert score_quality(odd, model).count() == 4
    scores = {r["_id"]: r["score"] for r in score_quality(odd, model).collect()}
    assert scores[1] == scores[2]
    kept = keep_good(docs, model)
    assert kept.columns == docs.columns
    good = {r["_id"] for r in score_quality(docs, model).where("score >= 0.5").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good


def test_sample_is_bounded_whatever_repeats(documents, prose, spark):
    """A third of the rows have one text, and as many one id and text."""
    hot, twin = prose(30), prose(40)
    rows = [(i, hot) for i in range(400)] + [(7, twin)] * 400 + [(1000 + i, prose(20)) for i in range(400)]
    texts = documents(rows).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    found = _sample(texts, 1200, 100)
    assert 0 < len(found) <= 100
    lone = _sample(texts.where("_id != 7 OR _id IS NULL"), 800, 200)
    share = (lone == features(pa.array([hot]))[0]).all(1).mean()
    assert len(lone) == 200 and 0.35 < share < 0.65
    assert np.array_equal(lone, _sample(texts.where("_id != 7").repartition(5), 800, 200))
    assert len(_sample(texts, 1200, 5000)) == 1200


def test_nothing_to_learn(documents, spark):
    docs = documents([(1, "a"), (2, None)])
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    model = fit_quality(docs, labels, ALL)
    assert model is None
    assert [r["score"] for r in score_quality(docs, model).collect()] == [1.0, 1.0]
    assert score_quality(docs.where("1 = 0"), model).collect() == []


def test_features_of_odd_texts():
    found = features(pa.array([None, "", " \n", "A b", "x"]))
    assert found.shape == (5, FEATURES)
    assert np.isfinite(found).all()
    assert not found[:2].any()


def test_risk_of_unlabelled_rows_stays_above_zero():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (20_000, 1)), rng.normal(5, 1, (6_000, 1))
    unlabelled = np.vstack([good[:14_000], bad])
    model = fit_rows(good[14_000:], unlabelled, 0.7)
    assert (model.scores(good) >= 0.5).mean() > 0.93
    assert (model.scores(bad) < 0.5).mean() > 0.93
