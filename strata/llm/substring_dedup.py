"""Repeated passages: paragraphs that copy others nearly, and runs of words that repeat
inside other text, are removed from all documents but one."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.shared import NUMBERS, broadcast_if_small, kept, kept_at, remove, row_key, session
from strata.llm.similarity import Tables, links
from strata.llm.store import HashStore, write_store
from strata.llm.words import (
    INVERSE,
    MULTIPLIER,
    buffers,
    byte_values,
    constants,
    find_words,
    hash_spans,
    mix,
    powers,
)

MOST_BANDS = 8
RECALL = 0.99
LEAST_WORDS = 25  # of a run that is removed
PARAGRAPH_WORDS = 10  # shorter paragraphs are no candidates for near copies
PIECE_WORDS = 3  # of a line that counts beside other marked words


def tune_bands(similarity: float, recall: float = RECALL, most: int = MOST_BANDS) -> tuple[int, int]:
    """Bands and rows: the most rows, so the fewest chance meetings, with which no more
    than ``most`` bands find pairs at the threshold with the wanted recall."""
    best = (most, 1)
    for rows in range(1, 33):
        chance = similarity**rows
        bands = 1 if chance == 1 else math.ceil(math.log(1 - recall) / math.log1p(-chance))
        if bands > most:
            break
        best = (bands, rows)
    return best


def _lines(data: np.ndarray, begins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word the number of its line, over all texts; a text begins a line."""
    if not len(data):
        return np.zeros(0, np.int64)
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    text = np.searchsorted(begins, starts, side="right")
    return line + text


class Spans:
    """Hashes of any words in a row, of sums that end at each word."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        with np.errstate(over="ignore"):
            self.sums = np.append(np.uint64(0), np.cumsum(hashes * powers(n)[:n], dtype=np.uint64))
        self.back = powers(n + 1, INVERSE)

    def hash(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            own = (self.sums[at + size] - self.sums[at]) * self.back[at]
            return mix(own + np.asarray(size).astype(np.uint64) * MULTIPLIER)


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every ``width`` values in a row is, the first of equal ones."""
    place, reach = np.arange(len(values)), 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = place[:-step], place[step:]
        place = np.where(values[a] <= values[b], a, b)
        reach += step
    return place


class Blocks:
    """Blocks of whole texts: text, first word in it, words, two hashes, and the hashes of
    the windows in each.

    A window is ``least`` words in a row, line ends or not, and its anchor the least hash
    of a few words in a row inside it. Windows in a row with the anchor at one place are a
    block. Equal windows have equal anchors, so a block without an anchor in common with
    others repeats nowhere. Shorter lines are blocks of their own, without windows; who
    needs windows only leaves them out, and the second hash, with ``whole=False``.
    """

    def __init__(self, texts: pa.Array, least: int, whole: bool = True):
        data, begins = buffers(texts)
        starts, ends, firsts = find_words(data, begins)
        n = len(starts)
        hashes = hash_spans(data, starts, ends, byte_values())
        spans = Spans(hashes)
        line = _lines(data, begins, starts)
        at = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if n else np.zeros(0, np.int64)
        size = np.diff(np.append(at, n))
        short = (size >= PIECE_WORDS) & (size < least) & whole
        at, size = at[short], size[short]
        with np.errstate(over="ignore"):
            anchor = mix(spans.hash(at, size) + MULTIPLIER)
        second = Spans(mix(hashes ^ constants(1, 23)[0])) if whole else spans
        check = second.hash(at, size)

        few = max(1, least // 3)
        window = np.zeros(0, np.int64)
        if n >= least:
            grams = spans.hash(np.arange(n - few + 1), few)
            place = _least_places(grams, least - few + 1)
            last = np.repeat(firsts[1:], np.diff(firsts))
            window = np.flatnonzero(np.arange(len(place)) + least <= last[: len(place)])
        if len(window):
            place = place[window]
            opens = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            count = np.diff(np.append(opens, len(window)))
            low = window[opens]
            self.windows = spans.hash(window, least)
            at, size = np.append(at, low), np.append(size, count + least - 1)
            anchor = np.append(anchor, grams[place[opens]])
            if whole:
                check = np.append(check, spans.hash(low, count + least - 1))
            self.counts = np.append(np.zeros(len(at) - len(low), np.int64), count)
        else:
            self.windows, self.counts = np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
        self.text = np.searchsorted(firsts, at, side="right") - 1
        self.low, self.size, self.anchor, self.check = at - firsts[self.text], size, anchor, check


BLOCK_LISTS = {"low": "int", "size": "int", "anchor": "bigint", "block": "bigint"}


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def _blocks(least: int):
    """All blocks of each text, as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = Blocks(batch.column("_text"), least)
            # Short lines come first, so order by text.
            order = np.argsort(blocks.text, kind="stable")
            ends = np.searchsorted(blocks.text[order], np.arange(batch.num_rows + 1))
            columns = [
                blocks.low[order].astype(np.int32),
                blocks.size[order].astype(np.int32),
                blocks.anchor[order].view(np.int64),
                blocks.check[order].view(np.int64),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), *(_lists(ends, c) for c in columns)],
                names=["_id", "_hash", *BLOCK_LISTS],
            )

    return run


def _known(store: HashStore, hashes: np.ndarray) -> np.ndarray:
    order = np.argsort(hashes)
    known = np.zeros(len(hashes), bool)
    known[order] = store.places(hashes[order]) >= 0
    return known


def _repeated(store: HashStore):
    """The blocks whose anchor is in the store, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(name) for name in BLOCK_LISTS]
            flat = [x.flatten() for x in lists]
            own = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists[0]).to_numpy())
            again = _known(store, flat[2].to_numpy().view(np.uint64))
            which, mask = pa.array(own[again]), pa.array(again)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(which),
                    batch.column("_hash").take(which),
                    *(x.filter(mask) for x in flat),
                ],
                names=["_id", "_hash", *BLOCK_LISTS],
            )

    return run


def _windows(texts: HashStore, anchors: HashStore, least: int):
    """The windows of blocks whose anchor is in the store, of texts whose row key is in
    another; no other text is looked into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_known(texts, batch.column("_row").to_numpy().view(np.uint64))))
            if not batch.num_rows:
                continue
            blocks = Blocks(batch.column("_text"), least, whole=False)
            again = _known(anchors, blocks.anchor)
            own = pa.array(blocks.text[again])
            ends = np.append(0, np.cumsum(blocks.counts[again]))
            windows = blocks.windows[np.repeat(again, blocks.counts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(own),
                    batch.column("_hash").take(own),
                    pa.array(blocks.low[again].astype(np.int32)),
                    pa.array(blocks.anchor[again].view(np.int64)),
                    _lists(ends, windows.view(np.int64)),
                ],
                names=["_id", "_hash", "low", "anchor", "windows"],
            )

    return run


def _with_first(rows: DataFrame, keys: list[str], least: int, label: str) -> DataFrame:
    """With ``gone``: whether the same words stand earlier, in a smaller id or before it in
    the same text, and do not overlap it. Written."""
    where = F.struct("_id", "_hash", "low")
    # Written, so that the join deals its rows anew and a key with many can be split.
    first, path = kept_at(rows.groupBy(*keys).agg(F.min(where).alias("first")), "firsts")
    here = F.col("first._id").eqNullSafe(F.col("_id")) & (F.col("first._hash") == F.col("_hash"))
    near = F.col("low") - F.col("first.low") < F.least("size", F.lit(least))
    out = kept(rows.join(first, keys).withColumn("gone", ~(here & near)).drop("first"), label)
    remove(rows.sparkSession, path)
    return out


def repeated_spans(source: DataFrame, least: int) -> DataFrame:
    """``_id``, ``_hash``, ``low`` and ``size`` in words of what also stands earlier: all
    windows of ``least`` words, and shorter whole lines.

    A block that stands earlier goes as a whole. Its windows are in its first copy too, so
    of the blocks that are left, those that share their anchor with other blocks are
    compared window by window.
    """
    kind = source.schema["_id"].dataType.simpleString()
    lists = ", ".join(f"{name} array<{of}>" for name, of in BLOCK_LISTS.items())
    packed = source.select("_id", "_hash", "_text").mapInArrow(_blocks(least), f"_id {kind}, _hash bigint, {lists}")
    packed, path = kept_at(packed, "blocks")
    counted = packed.select(F.explode("anchor").alias("hash")).groupBy("hash").agg(F.count("*").alias("times"))
    again = kept(counted.where("times > 1"), "repeated")
    store, _ = write_store(again, "times", again.count(), "repeated")
    flat = ", ".join(f"{name} {of}" for name, of in BLOCK_LISTS.items())
    rows = packed.mapInArrow(_repeated(store), f"_id {kind}, _hash bigint, {flat}")
    thin = _with_first(rows, ["anchor", "block"], least, "first_blocks")
    # All that is read from here on is written.
    remove(source.sparkSession, path)
    left = thin.where(f"NOT gone AND size >= {least}")
    shared = kept(
        left.groupBy("anchor").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a <> b").select("anchor"),
        "shared",
    )
    count = shared.count()
    left = left.join(broadcast_if_small(shared, count, NUMBERS), "anchor")
    left = left.select(F.col("_id").alias("i"), F.col("_hash").alias("h"), F.col("low").alias("l")).distinct()
    left = kept(left, "left_blocks")
    # Windows take most room, so they are made in a scan of their own, of these anchors and
    # the texts that have them only.
    anchors, _ = write_store(shared.select(F.col("anchor").alias("hash"), F.lit(1).alias("times")), "times", count, "shared")
    wanted = kept(left.select(F.xxhash64("i", "h").alias("hash"), F.lit(1).alias("times")).distinct(), "wanted")
    texts, _ = write_store(wanted, "times", wanted.count(), "wanted")
    rows = source.select("_id", "_hash", F.xxhash64("_id", "_hash").alias("_row"), "_text").mapInArrow(
        _windows(texts, anchors, least), f"_id {kind}, _hash bigint, low int, anchor bigint, windows array<bigint>"
    )
    a, b = rows.alias("a"), left.alias("b")
    same = F.col("a._id").eqNullSafe(F.col("b.i")) & (F.col("a._hash") == F.col("b.h")) & (F.col("a.low") == F.col("b.l"))
    single = a.join(b, same, "left_semi").select(
        "_id", "_hash", "anchor", F.col("low").alias("begin"), F.posexplode("windows").alias("place", "window")
    )
    single = single.select(
        "_id", "_hash", (F.col("begin") + F.col("place")).alias("low"), F.lit(least).alias("size"), "anchor", "window"
    )
    single, path = kept_at(single, "windows")
    span = ["_id", "_hash", "low", "size"]
    single = _with_first(single, ["anchor", "window"], least, "first_windows")
    remove(source.sparkSession, path)
    return thin.where("gone").select(*span).union(single.where("gone").select(*span))


def copied_paragraphs(source: DataFrame, similarity: float, words: int, recall: float) -> DataFrame:
    """``_id``, ``_hash`` and ``line`` of every paragraph of a component but its first."""
    bands, rows = tune_bands(similarity, recall)
    lines = source.select("_id", "_hash", F.posexplode(F.split("_text", "\n")).alias("line", "_text"))
    least = max(PARAGRAPH_WORDS - words + 1, 1)
    found = links(lines, ["_id", "_hash", "line"], Tables(bands, rows, words, similarity, least))
    first = found.classes.groupBy("root").agg(F.min("first").alias("winner"))
    copied = found.classes.where("n_links > 0").join(first, "root").select("cls", "winner")
    return (
        found.rows.join(copied, "cls")
        .where(~F.col("winner").eqNullSafe(F.struct("_id", "_hash", "line")))
        .select("_id", "_hash", "line")
    )


def _runs(texts: pa.Array, spans: pa.Array, lines: pa.Array, least: int):
    """Removed spans of texts: text, first byte, byte after the last, words. Marked are
    spans of words (first word and number of them, see ``_span``) and whole lines, which
    hold words; they join where only white space lies between, and stay unless they hold
    enough words."""
    data, begins = buffers(texts)
    starts, ends, firsts = find_words(data, begins)
    n = len(starts)
    own = np.arange(len(texts))
    span = spans.flatten().to_numpy()
    at = firsts[np.repeat(own, _sizes(spans))] + (span >> 32)
    edges = np.bincount(at, minlength=n + 1) - np.bincount(at + (span & 0xFFFFFFFF), minlength=n + 1)
    inside = np.cumsum(edges[:n]) > 0

    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, begins[:-1])
    line = _lines(data, begins, starts)
    wanted = np.zeros(len(breaks) + len(texts) + 1, bool)
    of = np.repeat(own, _sizes(lines))
    wanted[before[of] + of + 1 + lines.flatten().to_numpy()] = True
    whole = wanted[line]
    inside |= whole

    opens, closes = inside.copy(), inside.copy()
    new = np.zeros(n + 1, bool)
    new[firsts] = True
    opens[1:] &= ~inside[:-1] | new[1:n]
    closes[:-1] &= ~inside[1:] | new[1:n]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes)
    enough = b - a + 1 >= least
    a, b = a[enough], b[enough]
    text = np.searchsorted(firsts, a, side="right") - 1
    # A whole line goes with the white space at its ends.
    edge = np.append(breaks, len(data))
    low = np.maximum(begins[text], np.append(-1, breaks)[np.searchsorted(breaks, starts[a])] + 1)
    high = np.minimum(begins[text + 1], edge[np.searchsorted(breaks, starts[b])])
    low, high = np.where(whole[a], low, starts[a]), np.where(whole[b], high, ends[b])
    return text, low - begins[text], high - begins[text], b - a + 1


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy()


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The rest of a text; a line that is emptied goes with its line end."""
    out, at = b"", 0
    for low, high in spans:
        out += text[at:low]
        at = high
        if not out or out.endswith(b"\n"):
            while text[at : at + 1] == b" ":
                at += 1
            if text[at : at + 1] == b"\n":
                at += 1
        elif out.endswith(b" "):
            while text[at : at + 1] == b" ":
                at += 1
    return out + text[at:]


def _clean(names: list[str], text: str, least: int):
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            spans, lines = columns.pop(), columns.pop()
            texts = columns[at]
            number, removed = np.zeros((2, len(texts)), np.int64)
            marked = pc.or_(spans.is_valid(), lines.is_valid())
            rows = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
            if len(rows):
                some = texts.filter(marked)
                of, low, high, size = _runs(some, spans.filter(marked), lines.filter(marked), least)
                np.add.at(number, rows[of], 1)
                np.add.at(removed, rows[of], size)
                cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist() if len(of) else []
                runs = list(zip(low.tolist(), high.tolist()))
                rest = [
                    _without(some[int(of[a])].as_py().encode(), runs[a:b]).decode()
                    for a, b in zip(cuts, [*cuts[1:], len(of)])
                ]
                columns[at] = pc.replace_with_mask(texts, pa.array(number > 0), pa.array(rest, texts.type))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(number), pa.array(removed)], names=[*names, "_spans", "_removed"]
            )

    return run


def _span(low: str, size: str) -> Column:
    """First word and number of words as one number."""
    return F.shiftleft(F.col(low).cast("bigint"), 32) + F.col(size)


def remove_passages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = 0.8,
    words: int = 5,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """The rows and columns of ``docs``, with repeated passages taken out of the text, and
    ``_spans`` and ``_removed``, the number of passages and words taken out.

    Paragraphs are lines. Those of PARAGRAPH_WORDS words or more link if their shingles'
    exact Jaccard reaches ``similarity``; candidates come from MinHash bands tuned to
    ``recall``. Of each component only the first paragraph, by id and place, stays. Of
    passages inside other text, however wrapped, every word goes that lies in
    ``least_words`` words in a row that stand earlier, and not overlapping, without regard
    to case and white space; so do shorter whole lines that stand earlier. What is marked
    is removed if ``least_words`` words or more stand together, so that short lines in
    common, such as names and licences, stay.

    Null and empty texts stay as they are. Repeated rows of one id and text stay alike. A
    missing id comes first. A text may become empty; no row is dropped.
    """
    session(docs)
    source = docs.select(*row_key(doc_id, text), F.col(f"`{text}`").alias("_text"))
    source = source.where(F.col("_text").isNotNull())
    spans = repeated_spans(source, least_words).groupBy("_id", "_hash").agg(
        F.collect_set(_span("low", "size")).alias("_at"), F.lit(None).cast("array<int>").alias("_lines")
    )
    lines = copied_paragraphs(source, similarity, words, recall).groupBy("_id", "_hash").agg(
        F.lit(None).cast(spans.schema["_at"].dataType).alias("_at"), F.collect_set("line").alias("_lines")
    )
    marks = kept(
        spans.union(lines)
        .groupBy("_id", "_hash")
        .agg(F.max("_lines").alias("_lines"), F.max_by("_at", F.size("_at")).alias("_at")),
        "marks",
    )
    names = docs.columns
    keyed = docs.select(F.struct("*").alias("_row"), *row_key(doc_id, text)).alias("d")
    # Texts are shuffled once, at any size: marks grow with the texts.
    m = marks.hint("merge").alias("m")
    same = F.col("d._id").eqNullSafe(F.col("m._id")) & (F.col("d._hash") == F.col("m._hash"))
    joined = keyed.join(m, same, "left").select("_row.*", "m._lines", "m._at")
    more = StructType.fromDDL("_spans bigint, _removed bigint")
    schema = StructType([*docs.schema, *more])
    return joined.mapInArrow(_clean(names, text, least_words), schema)
