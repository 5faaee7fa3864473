import pytest

from strata.llm.decontaminate import decontaminate
from tests.llm import brute


@pytest.fixture
def benchmark(spark):
    def make(rows):
        return spark.createDataFrame(rows, "item_id bigint, text string")

    return make


def check(df, rows, items, benchmark):
    found = decontaminate(df, benchmark(items)).collect()
    expected = []
    for i, text in rows:
        words, hit, ids = brute.contamination(text, items)
        expected.append((i, words, len(hit), ids))
    actual = [(r["_id"], r["n_words"], r["n_hit"], r["items"]) for r in found]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_windows_equal_brute_force(documents, prose, pick, benchmark):
    items = [(i, prose(pick.randint(10, 40))) for i in range(8)]
    items += [(20, prose(9)), (21, "Solo!"), (22, "two words"), (23, "a a a a a a a a a a a a"), (24, ""), (25, None), (26, "?!")]
    items += [(3, items[0][1]), (9, items[0][1])]
    rows = []
    for i in range(40):
        words = prose(pick.randint(0, 80)).split()
        at = pick.randint(0, len(words))
        source = (pick.choice(items)[1] or "").split()
        low = pick.randint(0, max(0, len(source) - 9))
        part = source[low : low + pick.randint(5, 30)]
        rows.append((i, " ".join(words[:at]) + " -- " + ",".join(part).upper() + " " + " ".join(words[at:])))
    rows += [(50, None), (51, ""), (52, "solo"), (53, "b " + "A " * 30 + "c"), (54, "ÉTÉ été " + items[0][1])]
    rows += [(0, rows[0][1]), (None, items[1][1]), (None, items[1][1]), (0, items[2][1])]
    check(documents(rows), rows, items, benchmark)


def test_many_windows_equal_brute_force(documents, prose, pick, benchmark, monkeypatch):
    """As if there were more windows than are broadcast."""
    monkeypatch.setattr("strata.llm.decontaminate.broadcast_if_small", lambda df, rows: df.hint("merge"))
    items = [(i, prose(pick.randint(4, 30))) for i in range(6)]
    rows = [(i, prose(20) + " " + items[i % 6][1] + " " + prose(pick.randint(0, 20))) for i in range(20)]
    rows += [(None, rows[0][1]), (None, rows[0][1]), (0, rows[1][1]), (0, rows[0][1]), (30, None), (31, prose(15))]
    check(documents(rows), rows, items, benchmark)


def test_no_words_are_shuffled(documents, prose, benchmark, monkeypatch):
    """A long text sends a few numbers a place, so twice the words are twice the rows."""
    monkeypatch.setattr("strata.llm.decontaminate.broadcast_if_small", lambda df, rows: df.hint("merge"))
    item = prose(12)
    rows = [(1, prose(40_000) + " " + item)]
    check(documents(rows), rows, [(1, item)], benchmark)


def test_only_ascii_letters_change_case(documents, benchmark):
    items = [(1, "ÉCOLE a b")]
    rows = [(1, "école a b"), (2, "ÉCOLE A B"), (3, "École a b")]
    check(documents(rows), rows, items, benchmark)


def test_very_long_text(documents, prose, benchmark):
    item = prose(12)
    rows = [(1, prose(30_000) + " " + item)]
    check(documents(rows), rows, [(1, item)], benchmark)


def test_empty_tables(documents, benchmark):
    assert decontaminate(documents([(1, "a b")]).where("1 = 0"), benchmark([(1, "a")])).collect() == []
    rows = [(1, "a b"), (2, None)]
    none = benchmark([(1, "a")]).where("1 = 0")
    assert [(r["n_words"], r["n_hit"]) for r in decontaminate(documents(rows), none).orderBy("_id").collect()] == [(2, 0), (0, 0)]
