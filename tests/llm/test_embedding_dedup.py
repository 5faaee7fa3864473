import numpy as np
import pytest

from strata.llm.embedding_dedup import ROOTS, link_embeddings, nearest


@pytest.fixture
def vectors(spark):
    def make(rows):
        kind = "vec_id bigint, embedding array<float>, label int, cls int, key string"
        return spark.createDataFrame([(i, v, label, 1, "k") for i, v, label in rows], kind)

    return make


def brute(rows):
    links = {i: set() for i in range(len(rows))}
    for a, (_, v, x) in enumerate(rows):
        for b, (_, w, y) in enumerate(rows[:a]):
            if x is None or x != y or v is None or w is None or len(v) != len(w):
                continue
            if any(c is None or not np.isfinite(c) for c in [*v, *w]) or not any(v) or not any(w):
                continue
            v64, w64 = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
            if v64 @ w64 / np.linalg.norm(v64) / np.linalg.norm(w64) >= 0.93:
                links[a].add(b)
                links[b].add(a)
    return links


def test_links_of_close_vectors_are_found(vectors):
    rng = np.random.default_rng(2)
    rows = []
    for label in (0, 1):
        for _ in range(25):
            base = rng.normal(size=24)
            for noise in (0, 0, 0.05, 0.15, 0.25):
                v = base + noise * rng.normal(size=24)
                rows.append((len(rows), [float(x) for x in v * rng.choice([1, 3])], label))
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] * 24, [1.0] * 8]
    rows += [(len(rows) + i, v, 0) for i, v in enumerate(odd)]
    rows += [(len(rows), rows[0][1], None), (len(rows) + 1, rows[0][1], 1)]
    links = brute(rows)
    found = {r["_id"]: r for r in link_embeddings(vectors(rows)).collect()}
    assert len(found) == len(rows)
    total, known = sum(map(len, links.values())), sum(r["n_links"] for r in found.values())
    assert 0.97 * total <= known <= total
    for i, mine in links.items():
        assert found[i]["n_links"] <= len(mine)
        assert (found[i]["component_id"] == i) == found[i]["kept"]
        if not mine:
            assert found[i]["kept"]


def test_large_groups_in_blocks(vectors, monkeypatch):
    import strata.llm.embedding_dedup as module

    monkeypatch.setattr(module, "BLOCK_ROWS", 4)
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = [(i, [float(x) for x in base + 0.01 * rng.normal(size=16)], 1) for i in range(30)]
    rows += [(30 + i, rows[0][1], 1) for i in range(10)]
    found = link_embeddings(vectors(rows)).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(39, 0)}


def test_missing_ids_and_empty_table(vectors):
    rows = [(None, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (7, [1.0, 0.0], 1), (None, None, 1)]
    found = [(r["_id"], r["n_links"], r["component_id"], r["kept"]) for r in link_embeddings(vectors(rows)).collect()]
    assert sorted(found, key=repr) == sorted(
        [(None, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (None, 0, None, True)], key=repr
    )
    assert link_embeddings(vectors(rows).where("1 = 0")).collect() == []


def test_nearest_points_are_nearest():
    assert len(ROOTS) == 240 and np.allclose((ROOTS**2).sum(1), 2)
    x = np.random.default_rng(4).normal(size=(200, 8)) * 3
    points = nearest(x)
    whole = np.rint(points * 2).astype(int)
    assert all(len(set(row % 2)) == 1 for row in whole) and not (whole.sum(1) % 4).any()
    own = ((x - points) ** 2).sum(1)
    around = ((x[:, None, :] - points[:, None, :] - ROOTS) ** 2).sum(2)
    assert (own[:, None] <= around + 1e-9).all()


def test_recall_at_the_threshold(vectors):
    """Pairs at a cosine just above the threshold, in 64 dimensions."""
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(150):
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        for v in (a, 0.931 * a + np.sqrt(1 - 0.931**2) * b):
            rows.append((len(rows), [float(x) for x in v], 1))
    found = link_embeddings(vectors(rows)).collect()
    assert sum(r["n_links"] > 0 for r in found) >= 0.95 * len(rows)
