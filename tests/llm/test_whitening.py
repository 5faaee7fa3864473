import math

import numpy as np
import pytest

from strata.llm.whitening import whiten


def table(spark, rows):
    kind = "vec_id bigint, embedding array<float>, label int, _row bigint, _x string"
    rows = [(i, v and [None if c is None else float(c) for c in v], 1, 7, "x") for i, v in rows]
    return spark.createDataFrame(rows, kind)


def brute(rows, components=4):
    x = [np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64) for _, v in rows]
    fit = np.unique(np.stack(x), axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    whitened = (np.stack(x) - sums / n) @ vectors[:, order] / np.sqrt(values[order])
    deviation = [int(sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums))) for v in x]
    return n, deviation, whitened, values[order] / values.sum()


def test_whitening_equals_a_dense_computation(spark):
    make = np.random.default_rng(3)
    rows = [(i, (make.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0.1] + 5).tolist()) for i in range(3000)]
    rows += [(i, rows[0][1]) for i in range(3000, 5000)]  # copies weigh nothing
    rows.append((9, rows[4][1]))
    bad = [(6000, None), (6001, [1.0, None, 0, 0, 0, 0]), (6002, [math.nan] * 6), (6003, [math.inf] * 6), (6004, [1.0])]
    found = whiten(table(spark, rows + bad)).toPandas()
    n, deviation, whitened, explained = brute(rows)
    assert len(found) == 4 * len(rows) and set(found["n"]) == {n}
    want = {}
    for (i, _), d, w in zip(rows, deviation, whitened):
        want.setdefault(i, []).append((d, w))
    signs = np.ones(4)
    for c in range(4):
        own = found[(found["component"] == c + 1) & (found["_id"] == 17)]["whitened"].iloc[0]
        signs[c] = np.sign(own) * np.sign(want[17][0][1][c])
    for i, c, d, w, e in found[["_id", "component", "deviation", "whitened", "explained"]].itertuples(index=False):
        assert e == pytest.approx(explained[c - 1], rel=1e-9)
        assert any(d == x and w == pytest.approx(y[c - 1] * signs[c - 1], abs=1e-9) for x, y in want[i])
    assert found["identity_error"].max() < 1e-9


def test_components_without_variance(spark):
    rows = [(None, [1.0, 2.0, 5.0]), (1, [2.0, 4.0, 5.0]), (1, [3.0, 6.0, 5.0])]
    found = whiten(table(spark, rows)).collect()
    assert len(found) == 9
    for r in found:
        if r["component"] == 1:
            assert r["explained"] == pytest.approx(1) and r["identity_error"] < 1e-9
        else:
            assert (r["whitened"], r["explained"]) == (0, 0)
    one = whiten(table(spark, rows[:1] * 3)).collect()
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, 0, 0, 0)}


def test_deviation_beyond_64_bits_is_null(spark):
    found = whiten(table(spark, [(1, [1e12, 1.0]), (2, [-1e12, 1.0])]))
    assert {r["deviation"] for r in found.collect()} == {None}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, []), (2, [])]):
        found = whiten(table(spark, rows))
        assert found.count() == 0 and found.columns[-1] == "identity_error"


def test_more_dimensions_than_a_block(spark, monkeypatch):
    monkeypatch.setattr("strata.llm.whitening.BLOCK_COLUMNS", 4)
    monkeypatch.setattr("strata.llm.whitening.BLOCK_ROWS", 16)
    make = np.random.default_rng(4)
    rows = [(i, (make.normal(size=10) * np.arange(1, 11)).tolist()) for i in range(100)]
    found = whiten(table(spark, rows)).toPandas()
    _, _, whitened, explained = brute(rows)
    for c in range(4):
        own = found[found["component"] == c + 1].sort_values("_id")
        side = np.sign(own["whitened"].iloc[0] * whitened[0, c])
        assert np.allclose(own["whitened"] * side, whitened[:, c], atol=1e-9)
        assert own["explained"].iloc[0] == pytest.approx(explained[c])
