import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from strata.llm.pieces import MODEL, decode, encode, load_pieces, _paths, piece_table, pretokens, segment
from strata.llm.token_counts import count_tokens
from tests.llm import brute

ODD = [
    "", " ", "   ", "a", "Hello  world", " lead", "trail ", "a\nb\n\n c", "tab\there", "　x", "é ﬁ ñ 漢字かな",
    "▁x ▁", "a▁b", "😀 \U0001F9D1‍\U0001F680", "====== " * 5, "word" * 60, "漢字" * 80, "x" * 300, "\r\n", "\x00\x01",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces read as a unigram model, by us and by the library."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = proto.trainer_spec.UNIGRAM
    path = str(tmp_path_factory.mktemp("model") / "unigram.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    return path


def texts_of(prose, pick):
    return [prose(pick.randint(1, 60), 7) for _ in range(40)] + ODD


def test_ids_are_those_of_the_library(documents, library, prose, pick):
    rows = list(enumerate(texts_of(prose, pick)))
    found = {r["doc_id"]: list(r["_ids"]) for r in encode(documents(rows).select("doc_id", "text")).collect()}
    for i, text in rows:
        if "▁" not in text:
            assert found[i] == library.encode(text), text[:50]


def test_long_runs_have_the_ids_of_the_library(documents, library, pick):
    """Words of one letter, of few letters and of letters at random, in linear time."""
    texts = ["a" * 100_000, "=" * 5_001, "".join(pick.choice("ab") for _ in range(3_000)), "x" * 61, "y" * 60]
    texts.append("".join(chr(97 + pick.randrange(26)) for _ in range(20_000)))
    rows = list(enumerate([*texts, texts[0], " ".join(texts[1:4])]))
    df = documents(rows).select("doc_id", "text")
    found = {r["doc_id"]: list(r["_ids"]) for r in encode(df).collect()}
    assert all(found[i] == library.encode(text) for i, text in rows)
    counts = {r["_id"]: r["n_tokens"] for r in count_tokens(df).collect()}
    assert all(counts[i] == len(found[i]) for i, _ in rows)


def test_decoding_gives_every_text_back(documents, prose, pick):
    rows = [*enumerate(texts_of(prose, pick)), (900, None), (900, None), (None, "a"), (901, prose(20_000))]
    texts = documents(rows).select("doc_id", "text")
    assert encode(texts, verify=True).where("_exact").count() == len(rows)
    found = decode(encode(texts)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["_decoded"] == r["text"]
        assert (r["_ids"] is None) == (r["text"] is None)


def test_unigram_ids_have_the_best_score(spark, unigram):
    pieces = load_pieces(unigram)
    assert not pieces.merges
    words = [" the", " theoretical", "aaaa", " x漢y", " unbelievably", "é", " " * 20, " 　", " the" * 40 + "漢" * 30, "ab" * 200]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    scores = dict(zip(pieces.texts, pieces.scores))
    ids = dict(zip(pieces.texts, pieces.ids))
    for r in segment(df, pieces).collect():
        _, parts = brute.best_segmentation(r["word"], scores, pieces.unknown)
        expected = []
        for part in parts:
            expected += [ids[part]] if part in ids else [pieces.first_byte + b for b in part.encode()]
        assert list(r["ids"]) == expected, r["word"]


def test_unigram_ids_are_those_of_the_library(documents, unigram, prose):
    library = sentencepiece.SentencePieceProcessor(model_file=unigram)
    # Short and of known characters, as the library adds single precision numbers.
    rows = [(i, prose(8)) for i in range(40)]
    pieces = load_pieces(unigram)
    df = documents(rows).select("doc_id", "text")
    found = {r["doc_id"]: list(r["_ids"]) for r in encode(df, pieces=pieces).collect()}
    assert all(found[i] == library.encode(t) for i, t in rows)
    counts = {r["_id"]: r["n_tokens"] for r in count_tokens(df, pieces=pieces).collect()}
    assert all(counts[i] == len(found[i]) for i, _ in rows)


def test_counts_are_those_of_the_library(documents, library, prose, pick):
    rows = [*enumerate(texts_of(prose, pick)), (900, None), (900, None), (None, "a")]
    found = [(r["_id"], r["n_tokens"]) for r in count_tokens(documents(rows)).collect()]
    ids = {r["doc_id"]: r["_ids"] for r in encode(documents(rows).select("doc_id", "text")).collect()}
    assert sorted(found, key=repr) == sorted(((i, len(ids[i] or ())) for i, _ in rows), key=repr)
    for i, text in rows[: len(rows) - 3]:
        if "▁" not in text:
            assert dict(found)[i] == len(library.encode(text)), text[:50]


def test_empty_table(documents):
    none = documents([(1, "a")]).where("1 = 0").select("doc_id", "text")
    assert decode(encode(none)).collect() == []
    assert count_tokens(none).collect() == []


def test_edges_need_no_shuffle_of_their_own(documents):
    pieces = load_pieces()
    words = pretokens(documents([(1, "a b")]), "text", pieces)
    plan = _paths(words, pieces)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # of short and long words
    assert piece_table(words.sparkSession, pieces).count() == len(pieces.texts)
