"""SentencePiece encoding and decoding: pre-tokens, their best segmentation in a lattice
that joins make, and the way between texts and piece ids."""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.shared import kept, parts, session
from strata.llm.store import HashStore, write_store
from strata.llm.words import buffers, byte_values, hash_spans

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_PIECES = (1 << 20) - 1  # of a vocabulary, which so is small enough to broadcast
LONG_BYTES = 64
BLOCK = 128
SHORT = 60
WORDS_PER_TASK = 30_000
HELD_CHARACTERS = 50_000  # of longer words whose paths leave Python at once

# Fixed: what an unknown character costs below the worst piece.
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Pieces:
    """The pieces of a model that may match text, with a space for its mark, and what
    follows from them: the cost of an unknown character, the id of byte 0, the bytes of
    each id for decoding, and whether they are merges (BPE) or scored (unigram)."""

    texts: list[str]
    ids: list[int]
    scores: list[float]
    longest: int
    unknown: float
    first_byte: int
    spelled: list[bytes]
    merges: bool

    @property
    def cuts(self) -> "Cuts":
        pairs = frozenset(t[i : i + 2] for t in self.texts for i in range(len(t) - 1))
        apart = np.zeros((256, 256), bool)
        for a in range(128):
            for b in range(128):
                apart[a, b] = chr(a) + chr(b) not in pairs
        return Cuts(pairs, apart)


@dataclass(frozen=True)
class Cuts:
    """Characters that are side by side in a piece, and for two bytes whether they are
    ASCII characters that are not."""

    pairs: frozenset[str]
    apart: np.ndarray


def load_pieces(path: str = MODEL) -> Pieces:
    """Read a SentencePiece model on the driver, of unigram or BPE type. Pieces must not reach over a space or a
    line end, and a byte must have a piece, as is usual; others raise ValueError."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto()).trainer_spec
    texts, ids, scores, spelled, first_byte = [], [], [], [], None
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            spelled.append(bytes([value]))
            first_byte = i if value == 0 else first_byte
            if first_byte is None or i - first_byte != value:
                raise ValueError("bytes have no pieces in a row")
            continue
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            spelled.append(b"")
            continue
        text = piece.replace("▁", " ")
        if " " in text.lstrip(" ") or "\n" in text:
            raise ValueError(f"the piece {piece!r} reaches over a space or line end")
        texts.append(text)
        ids.append(i)
        scores.append(model.get_score(i))
        spelled.append(text.encode())
    if first_byte is None:
        raise ValueError("bytes have no pieces")
    if len(spelled) > MOST_PIECES or max(map(len, texts)) > 31:
        raise ValueError("too many or too long pieces")
    return Pieces(
        texts,
        ids,
        scores,
        max(map(len, texts)),
        min(scores) - UNKNOWN_PENALTY,
        first_byte,
        spelled,
        kind.model_type == kind.BPE,
    )


def marked(texts: pa.Array) -> pa.Array:
    """Texts with the space that SentencePiece puts first; null and empty stay empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    spaced = pc.binary_join_element_wise(
        pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())
    )
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, spaced)


def find_pretokens(data: np.ndarray, begins: np.ndarray, cuts: Cuts):
    """Where pre-tokens begin and end, and each text's first. A cut lies before spaces,
    around line ends and between characters that no piece has side by side; beyond ASCII
    these are looked for in long runs only. No piece crosses a cut, so the best
    segmentation of a text is that of its parts.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(begins), np.int64)
    space, line = data == 32, data == 10
    opens = line.copy()
    opens[begins[begins < len(data)]] = True
    opens[1:] |= line[:-1] | (space[1:] & ~space[:-1]) | cuts.apart[data[:-1], data[1:]]
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(data))
    long = np.flatnonzero(ends - starts > LONG_BYTES)
    if len(long):
        more = [starts]
        for i in long.tolist():
            run = data[starts[i] : ends[i]].tobytes().decode()
            at, found = int(starts[i]), []
            for a, b in zip(run, run[1:]):
                at += len(a.encode())
                if a + b not in cuts.pairs:
                    found.append(at)
            more.append(np.array(found, np.int64))
        starts = np.sort(np.concatenate(more))
        ends = np.append(starts[1:], len(data))
    return starts, ends, np.searchsorted(starts, begins)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    size = ends - starts
    total = np.append(0, np.cumsum(size))
    place = np.arange(total[-1]) - np.repeat(total[:-1] - starts, size)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(total.astype(np.int64)), pa.py_buffer(data[place])
    ).cast(pa.string())


def _distinct(cuts: Cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(0, False)
        for batch in batches:
            data, begins = buffers(marked(batch.column("_text")))
            starts, ends, _ = find_pretokens(data, begins, cuts)
            _, at = np.unique(hash_spans(data, starts, ends, values), return_index=True)
            found = strings(data, starts[at], ends[at])
            yield pa.RecordBatch.from_arrays([found], names=["word"])

    return run


def pretokens(docs: DataFrame, text: str, pieces: Pieces) -> DataFrame:
    """The distinct pre-tokens of all texts, dealt out by ``word``."""
    session(docs)
    texts = docs.select(F.col(f"`{text}`").alias("_text"))
    return texts.mapInArrow(_distinct(pieces.cuts), "word string").distinct()


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """``rank`` is the place of the score among all, 0 for the best."""
    places = {score: i for i, score in enumerate(sorted(set(pieces.scores), reverse=True))}
    ranks = [places[score] for score in pieces.scores]
    rows = list(zip(pieces.texts, pieces.ids, pieces.scores, ranks))
    return spark.createDataFrame(rows, "piece string, id int, score double, rank int")


# From edges in order of end and start: the best score and the last edge for each end.
# The first edge wins a tie, that is the longest.
FOLD = """
aggregate(edges, named_struct('score', array(0D), 'back', array(0L)), (s, e) ->
  if(e.end = size(s.score),
     named_struct('score', concat(s.score, array(s.score[e.start] + e.score)),
                  'back', concat(s.back, array(e.code))),
     if(s.score[e.start] + e.score > s.score[e.end],
        named_struct('score', concat(slice(s.score, 1, e.end), array(s.score[e.start] + e.score)),
                     'back', concat(slice(s.back, 1, e.end), array(e.code))),
        s)))
"""

# The edges of the best path, from the end to the start.
WALK = """
aggregate(sequence(size(best.back) - 1, 1, -1),
  named_struct('at', size(best.back) - 1, 'path', cast(array() as array<bigint>)),
  (t, i) -> if(i = t.at,
    named_struct('at', cast(shiftright(best.back[i], 32) as int),
                 'path', concat(array(best.back[i]), t.path)),
    t),
  t -> t.path)
"""


# Edges as merges, the best rank first and from the left: an edge over just two of the parts
# that stand makes them one. A merge never ranks above the pieces it is made of, so the order
# of edges is the order of merges. For words of up to SHORT characters an edge is a number,
# of rank, start (6 bits), length (5 bits) and id (20 bits), and so are the places ``b`` where
# parts begin and end, a bit each. An edge applies if these are its ends and one between.
MERGED = """
aggregate(sorted, shiftleft(2L, last) - 1, (b, e) ->
  if(bit_count(shiftright(b, CAST(shiftright(e, 25) & 63 AS int))
               & (shiftleft(2L, CAST(shiftright(e, 20) & 31 AS int)) - 1)) = 3
     AND (shiftright(b, CAST(shiftright(e, 25) & 63 AS int))
          & (shiftleft(1L, CAST(shiftright(e, 20) & 31 AS int)) | 1))
         = (shiftleft(1L, CAST(shiftright(e, 20) & 31 AS int)) | 1),
     b & ~shiftleft(shiftleft(1L, CAST((shiftright(e, 20) & 31) - 1 AS int)) - 1,
                    CAST((shiftright(e, 25) & 63) + 1 AS int)),
     b))
"""

# Edges with both ends and nothing between stand in the end; from the left. The first test
# is implied by the second, but spares it, and with two uses of ``b`` the planner leaves its
# computation outside of the filter.
STANDING = """
array_sort(transform(
  filter(sorted, e -> (shiftright(b, CAST(shiftright(e, 25) & 63 AS int)) & 1) = 1
                      AND (shiftright(b, CAST(shiftright(e, 25) & 63 AS int))
                       & (shiftleft(2L, CAST(shiftright(e, 20) & 31 AS int)) - 1))
                      = (shiftleft(1L, CAST(shiftright(e, 20) & 31 AS int)) | 1)),
  e -> shiftleft(shiftright(e, 25) & 63, 32) | (e & 1048575)))
"""


def _merged(size: int, start: np.ndarray, end: np.ndarray, rank: np.ndarray, id_: np.ndarray, _):
    """The path of a longer word by merges: a list of neighbours, in which a merge takes out
    one part. Each edge is looked at once."""
    after = list(range(1, size + 1))
    owner = np.zeros(size, np.int64)
    single = end == start + 1
    owner[start[single]] = id_[single]
    stands = bytearray(b"\1") * size
    order = np.lexsort((start, rank))
    pairs = order[~single[order]]
    for s, e, i in zip(start[pairs].tolist(), end[pairs].tolist(), id_[pairs].tolist()):
        if stands[s]:
            middle = after[s]
            if middle < e and after[middle] == e:
                after[s] = e
                owner[s] = i
                stands[middle] = 0
    at = np.flatnonzero(np.frombuffer(stands, np.uint8))
    return at << 32 | owner[at]


def _scored(size: int, start: np.ndarray, end: np.ndarray, _, id_: np.ndarray, score: np.ndarray):
    """The path of a longer word with the best sum of scores. Edges come by start, so the
    first that reaches a place with the best sum is the longest."""
    best, back = [0.0] + [-np.inf] * size, [0] * (size + 1)
    rows = zip(start.tolist(), end.tolist(), score.tolist())
    for i, (s, e, value) in enumerate(rows):
        if best[s] + value > best[e]:
            best[e], back[e] = best[s] + value, i
    path, at = [], size
    while at:
        path.append(back[at])
        at = int(start[back[at]])
    chosen = np.array(path[::-1], np.int64)
    return start[chosen].astype(np.int64) << 32 | id_[chosen]


def _walked(path: Callable):
    """Paths of words from their edges, which come one word after the other and by start;
    the first edge of a word has its text. One word at a time is held."""
    names = ["start", "end", "rank", "id", "score"]

    def found(word: str, parts: list[list[np.ndarray]]) -> np.ndarray:
        columns = [np.concatenate(c) for c in zip(*parts)]
        start, end = columns[:2]
        if start[0] or end[-1] != len(word) or (np.diff(start) < 0).any():
            raise RuntimeError("the edges of a word are not in order")
        return path(len(word), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, parts = None, []
        words, paths, held = [], [], 0
        for batch in batches:
            columns = [batch.column(n).to_numpy() for n in names]
            texts = batch.column("word")
            first = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False)).tolist()
            low = 0
            for high in [*first, batch.num_rows]:
                if high > low:
                    parts.append([c[low:high] for c in columns])
                if high < batch.num_rows:
                    if word is not None:
                        words.append(word)
                        paths.append(found(word, parts))
                        held += len(word)
                    word, parts = texts[high].as_py(), []
                low = high
            if held > HELD_CHARACTERS:
                yield _as_paths(words, paths)
                words, paths, held = [], [], 0
        if word is not None:
            yield _as_paths([*words, word], [*paths, found(word, parts)])

    return run


def _as_paths(words: list[str], paths: list[np.ndarray]) -> pa.RecordBatch:
    lists = pa.array(paths, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(words), lists], names=["word", "path"])


def _edges(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word``, ``start``, ``end``, ``score`` and ``id`` of every piece in a word, and of
    every character without a piece, with id 0. Substrings meet the piece table, which is
    broadcast as a vocabulary is bounded."""
    table = F.broadcast(piece_table(words.sparkSession, pieces))
    size = F.length("word")
    whole = F.array(F.struct(F.lit(0).alias("base"), F.col("word").alias("part"), size.alias("own")))
    blocks = F.transform(
        F.sequence(F.lit(0), size - 1, F.lit(BLOCK)),
        lambda base: F.struct(
            base.alias("base"),
            F.substring("word", base + 1, F.lit(BLOCK + pieces.longest - 1)).alias("part"),
            F.least(F.lit(BLOCK), size - base).alias("own"),
        ),
    )
    starts = F.sequence(F.lit(0), F.col("b.own") - 1)
    lengths = F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.length("part") - F.col("at")))
    start = (F.col("base") + F.col("at")).alias("start")
    return (
        words.where(size > 0)
        .select("word", F.explode_outer(F.when(size <= BLOCK, whole).otherwise(blocks)).alias("b"))
        .select("word", "b.base", "b.part", F.explode_outer(starts).alias("at"))
        .withColumn("len", F.explode_outer(lengths))
        .withColumn("piece", F.substring("part", F.col("at") + 1, F.col("len")))
        .join(table, "piece", "left")
        .where("id IS NOT NULL OR len = 1")
        .select(
            "word",
            start,
            (start + F.col("len")).alias("end"),
            F.coalesce("score", F.lit(pieces.unknown)).alias("score"),
            F.coalesce("rank", F.lit(MOST_PIECES)).alias("rank"),
            F.coalesce("id", F.lit(0)).alias("id"),
        )
    )


def _paths(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word`` and ``path``: start, in the upper half, and id of each piece."""
    short_words = words.where(F.length("word") <= SHORT)
    long = _edges(words.where(F.length("word") > SHORT), pieces).select(
        F.when((F.col("start") == 0) & (F.col("end") == 1), F.col("word")).alias("word"),
        "start",
        "end",
        "rank",
        "id",
        "score",
    )
    walked = _walked(_merged if pieces.merges else _scored)
    long = long.mapInArrow(walked, "word string, path array<bigint>")
    if not pieces.merges:
        edge = F.struct(
            "end",
            "start",
            "score",
            F.shiftleft(F.col("start").cast("bigint"), 32).bitwiseOR(F.col("id")).alias("code"),
        )
        best = _edges(short_words, pieces).groupBy("word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
        best = best.select("word", F.expr(FOLD).alias("best"))
        return best.select("word", F.expr(WALK).alias("path")).union(long)
    size = F.col("end") - F.col("start")
    edge = (
        F.shiftleft(F.col("rank").cast("bigint"), 31)
        .bitwiseOR(F.shiftleft(F.col("start").cast("bigint"), 25))
        .bitwiseOR(F.shiftleft(size.cast("bigint"), 20))
        .bitwiseOR(F.col("id").cast("bigint"))
    )
    short = (
        _edges(short_words, pieces)
        .groupBy("word")
        .agg(F.sort_array(F.collect_list(edge)).alias("sorted"))
        .withColumn("last", F.length("word"))
        .withColumn("b", F.expr(MERGED))
        .select("word", F.expr(STANDING).alias("path"))
    )
    return short.union(long)


def segment(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word`` and ``ids`` of its segmentation: the one with the best sum of scores for a
    unigram model; that of the merges for a BPE model, whose scores are ranks.

    Substrings up to the longest piece meet the piece table; the edges of a word come
    together where the word is, without a shuffle, and are folded, for words of more than
    SHORT characters in Python, as they come. A character without a piece is an edge of its
    own and becomes its bytes. Words are dealt out so that a task
    groups WORDS_PER_TASK at a time in memory.
    """
    words = kept(words, "words")
    count = words.count()
    # Else grouping turns to sorting all edges after a few words.
    words.sparkSession.conf.set(
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(4 * WORDS_PER_TASK)
    )
    best = _paths(words.repartition(parts(count, WORDS_PER_TASK), "word"), pieces)
    piece = lambda p: p.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")

    def spelled(p):
        char = F.substring("word", F.shiftright(p, 32).cast("int") + 1, F.lit(1))
        byte = lambda k: F.conv(F.substring(F.hex(char), k * 2 - 1, F.lit(2)), 16, 10)
        return F.transform(
            F.sequence(F.lit(1), F.octet_length(char)),
            lambda k: byte(k).cast("int") + pieces.first_byte,
        )

    every = F.flatten(
        F.transform("path", lambda p: F.when(piece(p) == 0, spelled(p)).otherwise(F.array(piece(p))))
    )
    plain = F.transform("path", piece)
    ids = F.when(F.exists("path", lambda p: piece(p) == 0), every).otherwise(plain)
    return best.select("word", ids.alias("ids"))


def _hashed(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(seed, False)
        for batch in batches:
            data, begins = buffers(batch.column("word"))
            found = hash_spans(data, begins[:-1], begins[1:], values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), batch.column(1)], names=["hash", batch.schema.names[1]]
            )

    return run


def word_store(words: DataFrame, name: str, label: str) -> tuple[HashStore, int]:
    """A store from the hash of ``word`` to ``name``, and the seed with which no two of
    the words have one hash, so that what is looked up is exact."""
    words = kept(words.select("word", name), label)
    count = words.count()
    kind = words.schema[name].dataType.simpleString()
    for seed in range(8):
        rows = words.mapInArrow(_hashed(seed), f"hash bigint, {name} {kind}")
        store, twice = write_store(rows, name, count, label)
        if not twice:
            return store, seed
    raise RuntimeError("words keep clashing")


class _Speller:
    """The text of runs of piece ids."""

    def __init__(self, spelled: list[bytes]):
        self.size = np.array([len(s) for s in spelled])
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(spelled), np.uint8)

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Texts of ``counts`` ids each, without the space that stands first."""
        long = self.size[ids]
        end = np.cumsum(long)
        total = int(end[-1]) if len(end) else 0
        place = np.arange(total) - np.repeat(end - long - self.begin[ids], long)
        stop = np.append(0, end)[np.append(0, np.cumsum(counts))]
        low = np.minimum(stop[:-1] + 1, stop[1:])
        return strings(self.data[place], low, stop[1:])


def _encoded(
    store: HashStore, seed: int, names: list[str], text: str, cuts: Cuts, spelled: list[bytes] | None
):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(seed, False)
        speller = _Speller(spelled) if spelled else None
        for batch in batches:
            texts = batch.column(names.index(text))
            data, begins = buffers(marked(texts))
            starts, ends, firsts = find_pretokens(data, begins, cuts)
            words, back = np.unique(hash_spans(data, starts, ends, values), return_inverse=True)
            runs, at = store.runs(words, "ids")
            size = np.diff(at)[back]
            total = np.append(0, np.cumsum(size))
            place = np.arange(total[-1]) - np.repeat(total[:-1] - at[back], size)
            found, bounds = runs[place], total[firsts]
            ids = pa.ListArray.from_arrays(
                pa.array(bounds.astype(np.int32)), pa.array(found, pa.int32())
            )
            if texts.null_count:
                ids = pc.if_else(texts.is_valid(), ids, pa.scalar(None, ids.type))
            out, more = [*batch.columns, ids], ["_ids"]
            if speller:
                again = speller.texts(found, np.diff(bounds))
                out.append(pc.equal(again, pc.fill_null(texts.cast(pa.string()), "")))
                more.append("_exact")
            yield pa.RecordBatch.from_arrays(out, names=[*names, *more])

    return run


def encode(
    docs: DataFrame, text: str = "text", pieces: Pieces | None = None, verify: bool = False
) -> DataFrame:
    """``docs`` with ``_ids``, the piece ids of its text; columns must have distinct names.
    ``verify`` adds ``_exact``, whether the ids decode to the text (null counts as empty).

    Every distinct pre-token is segmented once, see ``segment``; the result is stored as
    sorted hash arrays, which the tasks that read the texts map and look up, so that
    texts and their words are never shuffled. A null text has null ids, an empty one
    none. Line ends and characters without a piece become bytes, among them the mark that
    SentencePiece uses for a space, so that every text can be decoded exactly.
    """
    pieces = pieces or load_pieces()
    words = segment(pretokens(docs, text, pieces), pieces)
    store, seed = word_store(words, "ids", "segmented")
    added = "_ids array<int>, _exact boolean" if verify else "_ids array<int>"
    schema = StructType([*docs.schema, *StructType.fromDDL(added)])
    spelled = pieces.spelled if verify else None
    run = _encoded(store, seed, docs.columns, text, pieces.cuts, spelled)
    return docs.mapInArrow(run, schema)


def _decoded(names: list[str], ids: str, spelled: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller = _Speller(spelled)
        for batch in batches:
            column = batch.column(names.index(ids))
            found = column.flatten().to_numpy().astype(np.int64)
            count = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
            texts = speller.texts(found, count)
            if column.null_count:
                texts = pc.if_else(column.is_valid(), texts, pa.scalar(None, texts.type))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*names, "_decoded"])

    return run


def decode(rows: DataFrame, ids: str = "_ids", pieces: Pieces | None = None) -> DataFrame:
    """``rows`` with ``_decoded``, the text of its piece ids; null ids give null, none an
    empty text. Ids of control pieces have no text."""
    session(rows)
    pieces = pieces or load_pieces()
    schema = StructType([*rows.schema, *StructType.fromDDL("_decoded string")])
    run: Callable = _decoded(rows.columns, ids, pieces.spelled)
    return rows.mapInArrow(run, schema)
