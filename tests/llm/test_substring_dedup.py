import pyarrow as pa

import strata.llm.substring_dedup as substring_dedup
from strata.llm.substring_dedup import remove_passages, tune_bands
from strata.llm.similarity import Tables
from tests.llm import brute


def result(df):
    return {r["doc_id"]: r for r in remove_passages(df).collect()}


def test_bands_reach_the_recall():
    bands, rows = tune_bands(0.8)
    assert bands <= 8 and Tables(bands, rows).recall(0.8) >= 0.99
    assert tune_bands(1.0)[0] == 1


def test_passages_inside_other_text_stay_once(documents, prose):
    passage = prose(60)
    rows = [(i, f"{prose(40)} {passage} {prose(40)}") for i in range(6)]
    rows += [(10, f"{prose(15)}\n{passage}\n{prose(15)}"), (11, passage)]
    clean = [(20 + i, prose(80, 20)) for i in range(10)]
    found = result(documents(rows + clean))
    middle = " ".join(passage.split()[15:45])
    assert [i for i, _ in rows if middle in found[i]["text"]] == [0]
    for i, text in rows:
        words = set(text.split()) - set(passage.split())
        assert words <= set(found[i]["text"].split())
    assert all(found[i]["text"] == t and not found[i]["_removed"] for i, t in clean)


def test_near_copies_of_paragraphs_go(documents, prose):
    words = prose(90).split()
    other = [*words]
    other[40] = "changed"
    first, second = prose(12) + "\n" + " ".join(words), prose(12) + "\n" + " ".join(other) + "\n" + prose(12)
    found = result(documents([(1, first), (2, second)]))
    assert found[1]["text"] == first
    assert found[2]["text"] == "\n".join(second.split("\n")[::2])
    assert found[2]["_removed"] == 90 and found[2]["_spans"] == 1


def test_short_lines_in_common_stay(documents, prose):
    line = "All rights reserved by the makers of this page."
    rows = [(i, f"{line}\n{prose(50)}\n{line}") for i in range(20)]
    found = result(documents(rows))
    assert all(found[i]["text"] == t for i, t in rows)


def test_repeats_within_a_text(documents, prose):
    line = prose(30)
    found = result(documents([(1, f"{line}\n{line}\n{line}\nend")]))
    assert found[1]["text"] == f"{line}\nend"


def test_odd_rows(documents, prose):
    a = prose(50)
    df = documents([(1, None), (1, None), (2, ""), (3, " \n\n "), (5, a), (5, a), (None, a), (9, prose(20_000)), (8, "é " * 5000)])
    out = remove_passages(df)
    assert out.columns == [*df.columns, "_spans", "_removed"]
    found = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    assert len(found) == 9
    assert found.count((None, a)) == 1 and found.count((5, "")) == 2
    assert found.count((1, None)) == 2 and found.count((2, "")) == 1 and found.count((3, " \n\n ")) == 1
    assert remove_passages(df.where("1 = 0")).collect() == []


def test_runs_equal_brute_force(documents, prose, pick):
    """Passages of 20 to 60 words in the middle of long lines, with common phrases inside."""
    phrase = prose(8).split()
    rows = [(0, f"{prose(30)} {' '.join(phrase)} {prose(30)}")]
    for n in [20, 24, 25, 26, 30, 41, 45, *range(51, 61)] * 3:
        words = prose(n).split()
        at = pick.randrange(n - 8)
        words[at : at + 8] = phrase
        for part in (words, words, words[: n - 5]):
            rows.append((len(rows), f"{prose(45)} {' '.join(part)} {prose(45)}"))
    found = result(documents(rows))
    for (i, _), kept in zip(rows, brute.without_runs([t for _, t in rows], 25)):
        assert found[i]["text"].lower().split() == kept


def test_wrapped_passages_go(documents, prose):
    words = prose(200).split()

    def wrapped(n):
        return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))

    rows = [(i, f"{prose(30)}\n{wrapped(n)}\n{prose(30)}") for i, n in enumerate([12, 7, 17, 38, 300])]
    found = result(documents(rows))
    assert found[0]["text"] == rows[0][1]
    assert all(found[i]["_removed"] == 200 and found[i]["_spans"] == 1 for i in range(1, 5))


def test_words_said_over_and_over_stay_once(documents):
    found = result(documents([(1, "ha " * 100)]))
    assert found[1]["text"].split() == ["ha"] * 25


def test_a_batch_is_cut_into_words_once(prose, monkeypatch):
    """A batch of texts is a few steps over arrays, however many of them are marked."""
    calls, find = [], substring_dedup.find_words
    monkeypatch.setattr(substring_dedup, "find_words", lambda *a: calls.append(1) or find(*a))
    texts = [f"head {prose(30)} {i}\n  {prose(30)} \n tail{i} end" for i in range(200)] + [None, "", "as it is"]
    # Words 1 to 30 of even texts, the second line of every third.
    spans = [[1 << 32 | 28, 3 << 32 | 28] if t and i < 200 and i % 2 == 0 else None for i, t in enumerate(texts)]
    lines = [[1] if t and i < 200 and i % 3 == 0 else None for i, t in enumerate(texts)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(texts), pa.array(lines, pa.list_(pa.int32())), pa.array(spans, pa.list_(pa.int64()))],
        names=["text", "_lines", "_at"],
    )
    (out,) = substring_dedup._clean(["text"], "text", 25)(iter([batch]))
    assert len(calls) == 1
    for i, (text, kept, number, words) in enumerate(zip(texts, *(c.to_pylist() for c in out.columns))):
        marked = (i % 2 == 0, i % 3 == 0) if i < 200 else (False, False)
        assert (number, words) == (sum(marked), 30 * sum(marked))
        if not any(marked):
            assert kept == text
            continue
        first, second, last = text.split("\n")
        first = f"head {i}" if marked[0] else first
        assert kept == "\n".join([first, last] if marked[1] else [first, second, last])
