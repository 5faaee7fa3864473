import random

from strata.llm.components import components
from tests.llm import brute


def test_components_equal_brute_force(spark):
    pick = random.Random(7)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 540)]
    links = {}
    for a, b in edges:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    roots = brute.components(540, links)
    rows = [*edges, (7, None), (None, None), (8, 8)]
    found = components(spark.createDataFrame(rows, "a int, b int")).collect()
    assert {(r["node"], r["root"]) for r in found} == {
        (i, roots[i]) for i in links if links[i] != {i}
    }
    assert len(found) == len({r["node"] for r in found})


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
