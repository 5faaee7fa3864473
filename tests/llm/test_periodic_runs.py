import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm.periodic_runs import find_runs, periodic_runs, word_ids
from strata.llm.queries import op13_periodic_runs


def brute_runs(words):
    """Every period tried at every place."""
    best = {}
    for period in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - period:
            if words[i] != words[i + period]:
                i += 1
                continue
            j = i
            while j < len(words) - period and words[j] == words[j + period]:
                j += 1
            if j - i + period >= max(6, 4 * period):
                best.setdefault((i, j - i + period), period)
            i = j
    return sorted((start, length, period) for (start, length), period in best.items())


def found(texts):
    ids, firsts = word_ids(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in find_runs(ids, firsts))):
        out[text].append(tuple(run))
    return out


pieces = st.lists(st.tuples(st.text("ab", min_size=1, max_size=5), st.integers(1, 9)), max_size=6)


@settings(max_examples=150, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=6))
def test_runs_of_random_texts_are_those_of_brute_force(texts):
    texts = [[c for piece, times in text for c in piece * times] for text in texts]
    assert found([" ".join(t) for t in texts]) == [brute_runs(t) for t in texts]


def test_nested_periods_and_overlapping_runs():
    inner = list("aaaaaaab") * 5 + list("xyz") * 4 + list("zyzyzyzyz")
    assert found([" ".join(inner)]) == [brute_runs(inner)]


def test_words_that_plain_polynomials_confuse():
    words = ["ab"[bin(i).count("1") % 2] for i in range(1 << 13)]
    assert found([" ".join(words)]) == [brute_runs(words[:64])] == [[]]


@pytest.mark.parametrize("period", [1, 3, 1000])
def test_a_very_long_text(period):
    words = [str(i % period) for i in range(60_000)]
    assert found([" ".join(words)]) == [[(0, 60_000, period)]]


def test_edges_of_texts(spark, documents):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a b a b a b a b"), (5, "a a a a a"), (6, "a a a a a a"), (6, "a a a a a a")]
    rows += [(7, "x\x0bx\x0cx\tx  x\rx y"), (8, "A a A a a a"), (9, "é é é é " * 3)]
    got = [
        (r["_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
        for r in periodic_runs(documents(rows)).collect()
    ]
    assert got == [
        (1, 0, [], ""),
        (2, 0, [], ""),
        (3, 0, [], ""),
        (None, 8, [(0, 8, 2)], "a b"),
        (5, 5, [], "a a a a a"),
        (6, 6, [(0, 6, 1)], "a"),
        (6, 6, [(0, 6, 1)], "a"),
        (7, 7, [(0, 6, 1)], "x y"),
        (8, 6, [], "A a A a a a"),
        (9, 6, [(0, 6, 1)], "é é"),
    ]
    assert periodic_runs(documents(rows).limit(0)).count() == 0


def contract(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    pick = random.Random(5)
    rows = [(None, "b b b b b b b")]
    for i in range(400):
        words = [pick.choice("abcdefgh") for _ in range(pick.randrange(1, 120))]
        if i % 3 == 0:
            words += (words[:7] * 30)[: pick.randrange(60)]
        rows.append((i, " ".join(words)))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((contract(*r) for r in rows), key=str)
    assert sum(r["n_runs"] > 0 for r in got) > 50
