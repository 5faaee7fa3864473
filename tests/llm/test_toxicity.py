import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm.queries import op11_toxicity
from strata.llm.toxicity import CLEAR, Chance, _bin, _curve, fit_toxicity, score_toxicity, segments, word_scores


def brute_segments(scores):
    """The best segment, then the best ones on both sides of it, and so on."""
    best = None
    for a in range(len(scores)):
        total = 0
        for b in range(a + 1, len(scores) + 1):
            total += scores[b - 1]
            if total > 0 and (best is None or total > best[2] or (total == best[2] and b - a < best[1] - best[0])):
                best = (a, b, total)
    if best is None:
        return []
    a, b, _ = best
    right = [(x + b, y + b, s) for x, y, s in brute_segments(scores[b:])]
    return brute_segments(scores[:a]) + [best] + right


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-20, 20).map(lambda x: x + 0.0), max_size=25), st.randoms())
def test_segments_are_the_maximal_ones(scores, pick):
    # Distinct sums, so that the best segment is one.
    scores = [s + pick.random() / 1000 for s in scores]
    got = segments(np.array(scores))
    want = brute_segments(scores)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want])


def test_segments_of_a_long_text_take_one_pass():
    scores = np.where(np.arange(300_000) % 2, -1.0, 1.0) + np.linspace(0.4, -0.4, 300_000)
    assert 1 < len(segments(scores)) < 300_000


def test_words_score_by_class_and_number():
    scores = word_scores(np.array([0, 1, 10, 100, 10, 0]), np.array([0, 0, 0, 0, 90, 500]), 0.1)
    assert scores[0] == scores[1] == scores[4] == 0
    assert 0 < scores[2] < scores[3] and scores[5] < 0


def test_evidence_bins_follow_the_law(spark):
    chance = Chance(0.002, 1.3)
    scores = [[], [0.5], [1.0, 4.0], [2.0, 0.9, 30.0], [3.0] * 20]
    rows = spark.createDataFrame([(n, s) for n in (0, 7, 9000) for s in scores], "words bigint, scores array<double>")
    for r in rows.select("words", "scores", _bin(chance).alias("bin")).collect():
        seen = chance.evidence(r["words"], r["scores"])
        assert r["bin"] == min(int(seen / 0.25), 399)
    assert chance.evidence(10, [CLEAR - 0.01]) == 0


def test_the_curve_never_falls():
    bins = np.array([5.0, 0, 9, 20])
    x, shares = _curve(bins, np.array([10.0, 3, 1, 50]), np.array([20.0, 900, 10, 50]), 0.1)
    assert x.tolist() == [0, 0.25, 1.25, 2.5, 5, 5.25]
    assert shares.tolist() == pytest.approx([3.1 / 901] * 2 + [11.1 / 31] * 2 + [50.1 / 51] * 2)


def made(pick, n, toxic):
    words = ["w" + str(pick.randrange(300)) for _ in range(n)]
    if toxic:
        for i in range(2, n, 6):
            words[i] = pick.choice(["Vile", "NASTY", "awful!", "rotten##"])
    return " ".join(words)


def test_held_out_texts_and_their_passages(spark, tmp_path):
    pick = random.Random(2)
    rows = [(i, made(pick, pick.randrange(20, 60), i % 8 == 0)) for i in range(1200)]
    calm = " ".join("w" + str(i % 300) for i in range(5000))
    rows += [(5000, calm + " vile nasty awful rotten vile nasty " + calm), (5001, calm), (5002, ""), (5003, None)]
    rows += [(5004, "odd " * 400), (5005, rows[0][1]), (5005, rows[0][1]), (None, rows[8][1])]
    labels = [(i, 1, int(i % 8 == 0)) for i in range(1200)] + [(None, 1, 1), (3, 1, None), (7777, 0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    got = op11_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 1200:
            assert r["predicted"] == int(r["doc_id"] % 8 == 0)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5000]["predicted"] == by_id[5005]["predicted"] == by_id[None]["predicted"] == 1
    assert not by_id[None]["held_out"]
    assert by_id[5001]["predicted"] == by_id[5002]["predicted"] == by_id[5003]["predicted"] == by_id[5004]["predicted"] == 0
    model = fit_toxicity(docs, labels, F.crc32(F.col("_id").cast("string")) % 3 != 1)
    (found,) = score_toxicity(docs.where("doc_id = 5000"), model).first()["passages"]
    assert found["text"] == "vile nasty awful rotten vile nasty" and (found["begin"], found["words"]) == (5000, 6)
    assert found["expected"] < 0.01


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    none = spark.createDataFrame([(1, 0), (2, 0)], "doc_id bigint, toxic int")
    model = fit_toxicity(docs, none, F.lit(True))
    assert model is None
    assert [(r["score"], r["passages"]) for r in score_toxicity(docs, model).collect()] == [(0, [])] * 2
    assert score_toxicity(docs.limit(0), model).count() == 0
