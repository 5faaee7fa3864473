"""The pipeline against plain versions, stage by stage, on documents with planted cases."""

import pytest
import sentencepiece

import corpus_pipeline
from strata.llm.pieces import MODEL
from tests.llm import brute


@pytest.fixture
def folder(spark, tmp_path, prose, pick):
    rows, labels = [], []

    def add(text, quality=None):
        rows.append((len(rows), text, "en", "s", None if text is None else len(text)))
        if quality is not None:
            labels.append((len(rows) - 1, quality, 0))

    for _ in range(150):
        add(prose(pick.randint(40, 120), 15), 1 if pick.random() < 0.6 else None)
    for _ in range(30):
        text = prose(60, 15)
        add(pick.choice([text.upper().replace(" ", "!! "), text.replace(" ", " | ")]), 0)
    items = [(i, prose(25)) for i in range(5)]
    for i, passage in items[:3]:
        add(f"{prose(30, 15)} {passage}\n{prose(30, 15)}")
    for base in [r[1] for r in rows[:10]]:
        add(base)
        words = base.split(" ")
        words[10] = "changed"
        add(" ".join(words))
    passage = prose(60, 20)
    for _ in range(4):
        add(f"{prose(45, 15)}\n{passage}\n{prose(45, 15)}")
    add(None)
    add("")
    rows += [rows[0], rows[0], (None, rows[5][1], "en", "s", 1)]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    return str(tmp_path), rows, items, passage


def test_every_stage(spark, folder, tmp_path):
    path, rows, items, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, outputs = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, path).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        outputs[name] = docs.collect()
        if name != "token_ids":
            assert docs.columns == columns

    good = outputs["quality"]
    kept = {r["doc_id"] for r in good}
    clean = [r for r in rows if r[1] and "!!" not in r[1] and " | " not in r[1]]
    assert {r[0] for r in clean} <= kept
    assert sum("!!" in (r["text"] or "") or " | " in (r["text"] or "") for r in good) <= 3

    texts = sorted(((r["doc_id"], r["text"]) for r in good), key=lambda r: (r[0] is not None, r[0]))
    roots = brute.components(len(texts), brute.jaccard_links([t for _, t in texts]))
    expected = {texts[i] for i, root in enumerate(roots) if i == root}
    distinct = [(r["doc_id"], r["text"]) for r in outputs["near_copies"]]
    assert len(distinct) == len(set(distinct)) and set(distinct) == expected

    before = dict(distinct)
    after = {r["doc_id"]: r for r in outputs["passages"]}
    assert after.keys() == before.keys()
    holders = [i for i, t in before.items() if passage in (t or "")]
    assert len(holders) == 4
    assert [i for i in holders if passage in after[i]["text"]] == [min(holders)]
    for i, r in after.items():
        if i not in holders:
            assert r["text"] == before[i]
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))

    clean = {i for i, r in after.items() if not brute.contamination(r["text"], items)[1]}
    assert {r["doc_id"] for r in outputs["benchmarks"]} == clean
    assert len(after) - len(clean) == 3

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = outputs["token_ids"]
    assert {r["doc_id"] for r in ids} == clean and all(r["round_trip"] for r in ids)
    for r in ids:
        text = after[r["doc_id"]]["text"]
        assert r["ids"] == (None if text is None else library.encode(text))


def test_run_is_all_stages(spark, folder):
    path = folder[0]
    found = corpus_pipeline.run(spark, path)
    assert found.columns == ["doc_id", "ids", "n_tokens", "round_trip"]
    assert found.where("NOT round_trip").count() == 0


def test_empty_documents(spark, tmp_path, folder):
    path = folder[0]
    empty = f"{tmp_path}/none"
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{path}/{name}.parquet")
        table.where("1 = 0").write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []
