import numpy as np
import pyarrow as pa

import strata.llm.similarity as similarity
from strata.llm.forest import Forest
from strata.llm.shingle_join import shingle_join
from strata.llm.similarity import Tables
from tests.llm import brute


def near(text, pick, changes):
    words = text.split(" ")
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


def rows_of(prose, pick):
    texts = [prose(pick.randint(1, 120)) for _ in range(30)]
    for base in texts[:10]:
        texts += [base, base.upper()]
        texts += [near(base, pick, pick.randint(1, 4)) for _ in range(5)]
    texts += [None, "", "  \n ", "one", "One", "x y", "a b c d e", "long " + prose(20_000)]
    return list(enumerate(texts))


def check(df, rows):
    found = {r["_id"]: r for r in shingle_join(df).collect()}
    links = brute.jaccard_links([t for _, t in rows])
    roots = brute.components(len(rows), links)
    assert len(found) == len(rows)
    for i, root in enumerate(roots):
        row = found[rows[i][0]]
        assert (row["n_links"], row["class_id"]) == (len(links.get(i, ())), root), i
        assert row["kept"] == (root == i)


def test_links_equal_brute_force(documents, prose, pick):
    rows = rows_of(prose, pick)
    check(documents(rows), rows)


def test_large_groups_are_cut_into_blocks(documents, prose, pick, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 3)
    base = prose(100)
    rows = list(enumerate([near(base, pick, 1) for _ in range(25)] + [base] * 5))
    check(documents(rows), rows)


def test_repeated_rows_and_missing_ids(documents, prose):
    a, b = prose(30), prose(30)
    df = documents([(5, a), (5, a), (None, a), (5, b), (None, None)])
    found = [(r["_id"], r["class_id"], r["n_links"], r["kept"]) for r in shingle_join(df).collect()]
    assert sorted(found, key=repr) == sorted(
        [(5, 5, 2, False), (5, 5, 2, False), (None, 5, 2, True), (5, 5, 0, True), (None, None, 0, True)],
        key=repr,
    )


def test_empty_table(documents):
    assert shingle_join(documents([]).where("1 = 0")).collect() == []


def test_prefixes_are_shortened_until_the_recall_is_met():
    assert Forest(12, 8, 0.9995).shortest == 3
    assert Tables(12, 3).recall(0.8) > 0.9995 > Tables(12, 4).recall(0.8)
    assert Forest(12, 8, 1.1).shortest == 1
    assert Forest(12, 8, 1.1).spare == 0
    forest = Forest(16, 8, 0.9999)
    assert (forest.shortest, forest.spare) == (3, 4)
    assert forest.missed(3, 4) <= 0.0001 < forest.missed(3, 5)


def met(spark, forest, signatures):
    """Pairs of names that some tree brings together."""
    rows = [
        (name.encode(), 9, [b"".join(bytes([0, 0, 0, m]) for m in tree) for tree in trees])
        for name, trees in signatures.items()
    ]
    keyed = forest.meeting(spark.createDataFrame(rows, "cls binary, n int, keys array<binary>"))
    groups = {}
    for r in keyed.collect():
        groups.setdefault((r["tree"], r["key"]), set()).add(bytes(r["cls"]).decode())
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_crowded_nodes_keep_longer_prefixes_in_spare_trees(spark):
    forest = Forest(2, 3, 0.8, crowd=2)
    assert (forest.shortest, forest.spare) == (2, 1)
    # In tree 0 four texts share two minima, a and b all three; in tree 1 only c and d meet.
    signatures = {
        "a": [(1, 1, 1), (1, 2, 3)],
        "b": [(1, 1, 1), (2, 2, 3)],
        "c": [(1, 1, 2), (3, 3, 1)],
        "d": [(1, 1, 3), (3, 3, 2)],
    }
    assert met(spark, forest, signatures) == {frozenset("ab"), frozenset("cd")}
    assert met(spark, Forest(2, 3, 0.8, crowd=4), signatures) == {frozenset("abcd"), frozenset("cd")}
    # Crowded in both trees, each text needs one of them short: for all its texts.
    twice = {name: [trees[0], trees[0]] for name, trees in signatures.items()}
    assert frozenset("abcd") in met(spark, forest, twice)


def test_crowded_nodes_lose_no_link(documents, prose, pick, monkeypatch):
    import strata.llm.shingle_join as module

    small = lambda *given: Forest(*given, crowd=3)
    monkeypatch.setattr(module, "Forest", small)
    base = prose(100)
    rows = list(enumerate([near(base, pick, n % 3) for n in range(30)] + [prose(40) for _ in range(9)]))
    check(documents(rows), rows)


def test_small_groups_are_compared_many_at_once(pick, monkeypatch):
    """The pairs of many groups are a few steps over arrays; groups go over batches."""
    calls, roots = [], similarity.local_roots
    monkeypatch.setattr(similarity, "local_roots", lambda *a: calls.append(1) or roots(*a))
    monkeypatch.setattr(similarity, "SMALL_ROWS", 6)
    rows, wanted = [], []
    for bucket in range(1, 201):
        size = 9 if bucket == 77 else pick.randint(1, 6)
        base = [pick.getrandbits(64) for _ in range(30)]
        sets = [sorted({*base[: pick.randint(24, 30)], *(pick.getrandbits(64) for _ in range(pick.randrange(4)))}) for _ in range(size)]
        names = pick.sample(range(1000), size)
        block = [pick.randrange(2) for _ in sets]
        bi, bj = pick.choice([(0, 0), (0, 1)])
        block = block if bj else [0] * size
        # Some met in the table before, too.
        before = [pick.randrange(3) for _ in sets]
        near = {i: set() for i in range(size)}
        for i in range(size):
            for j in range(i):
                both = len({*sets[i]} & {*sets[j]})
                if both < 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9 or before[i] == before[j] != 0:
                    continue
                if bi == bj or block[i] != block[j]:
                    near[i].add(j)
                    near[j].add(i)
        order = sorted(range(size), key=lambda i: names[i])
        root = brute.components(size, {order.index(i): {order.index(j) for j in near[i]} for i in near})
        for i in range(size):
            places = [{"tree": 1, "bucket": bucket, "blocks": 2}]
            places += [{"tree": 0, "bucket": before[i], "blocks": 2}] if before[i] else []
            rows.append(
                {
                    "cls": names[i].to_bytes(4, "big"), "places": places, "copies": 1 + i, "tree": 1, "bucket": bucket,
                    "found": np.array(sets[i], np.uint64).tobytes(), "block": block[i], "bi": bi, "bj": bj,
                }
            )
            if near[i]:
                top = names[order[root[order.index(i)]]]
                wanted.append((names[i].to_bytes(4, "big"), top.to_bytes(4, "big"), sum(1 + j for j in near[i])))
    kinds = {"tree": pa.int32(), "block": pa.int32(), "bi": pa.int32(), "bj": pa.int32()}
    place = pa.list_(pa.struct([("tree", pa.int32()), ("bucket", pa.int64()), ("blocks", pa.int32())]))
    table = pa.Table.from_pylist(rows)
    for name, kind in {**kinds, "places": place}.items():
        table = table.set_column(table.column_names.index(name), name, table.column(name).cast(kind))
    found = []
    for out in similarity._verify(0.8, 2)(iter(table.to_batches(max_chunksize=100))):
        found += [tuple(r.values()) for r in out.to_pylist()]
    assert sorted(found) == sorted(wanted) and len(wanted) > 100
    assert len(calls) < 20
