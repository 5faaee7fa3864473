import pytest

from strata.llm.language_model import discounts, fit, score
from tests.llm import brute


def check(docs, train, rows, trained):
    found = {r["_id"]: r for r in score(docs, fit(train)).collect()}
    model = brute.KneserNey(trained, discounts)
    assert len(found) == len(rows)
    for i, text in rows:
        words = [*brute.blank_words(text), None]
        r = found[i]
        assert r["n_tokens"] == len(words)
        assert r["n_known"] == sum(w in model.words for w in words)
        assert r["train_tokens"] == model.total
        assert r["score"] == pytest.approx(model.score(text), abs=1e-8)
        assert r["base_score"] == pytest.approx(model.base(text), abs=1e-8)
    return model


def test_scores_equal_brute_force(documents, pick):
    words = "a b c d e f g A é , .".split()
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.randint(0, 40)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "new words a b"), (204, "a " * 5000)]
    df = documents(rows)
    train = [t for i, t in rows if i % 3]
    model = check(df, df.where("doc_id % 3 <> 0"), rows, train)
    for before in ("a", "begin", "unseen"):
        total = sum(model.chance(before, w) for w in model.words) + model.chance(before, "unseen")
        assert total == pytest.approx(1)


def test_counts_above_a_byte(documents):
    rows = [(i, "x y " * 100) for i in range(20)]
    df = documents(rows)
    check(df, df, rows, [t for _, t in rows])


def test_nothing_to_learn_from(documents):
    rows = [(1, "a b"), (2, None)]
    df = documents(rows)
    found = score(df, fit(df.where("1 = 0"))).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in found] == [(0, 0), (0, 0)]
    assert score(df.where("1 = 0"), fit(df)).collect() == []


def test_repeated_rows(documents):
    df = documents([(1, "a b a"), (1, "a b a"), (None, "b")])
    found = [(r["_id"], r["score"]) for r in score(df, fit(df)).collect()]
    assert len(found) == 3 and found[0] == found[1]
