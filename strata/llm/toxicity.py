"""Toxic passages: maximum-scoring segments of words' log-odds, and what they prove.

Of every word it is counted in how many labelled texts of each class it stands. Its score
is the log-odds of the classes under a Dirichlet prior, as far as it is certain; its k-th
occurrence in a text tells little more and scores 1/k^2 of that. A small cost per word
makes segments end. All maximal segments of a text are found in one pass.
What segments come about by chance follows an extreme-value law, whose two numbers are
those of texts labelled clean; by it a text's segments become one piece of evidence, and
evidence becomes a probability by a curve that never falls, over all labelled texts.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import broadcast_if_small, kept, row_key, session
from strata.llm.store import HashStore, write_store
from strata.llm.words import buffers, byte_values, find_words, hash_spans

PRIOR = 3.0  # texts, of the classes' shares, that a word is taken to have been in before
SURE = 1.64  # standard errors that a score must pass, and is lowered by
COST = 0.05  # of each word in a segment
CLEAR = 1.0  # segments of this score and more show the law of chance
SIGNIFICANT = 0.01  # chance segments of this score and more in a text's length
BINS = 400  # of evidence, for the curve
STEP = 0.25  # of evidence a bin
TILT = 0.001
HELD_WORDS = 500_000  # distinct words of a task before it hands over counts

# Fixed: what is part of no word.
BREAKS = np.zeros(256, bool)
BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
BREAKS[65:91] = False  # capitals count as small letters


def _words(texts: pa.Array):
    """Hash of each word, where words begin and end, each text's first, and the bytes."""
    data, begins = buffers(texts)
    starts, ends, firsts = find_words(data, begins, BREAKS)
    return hash_spans(data, starts, ends, byte_values()), starts, ends, firsts, begins


def _per_text(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct word of each text, and its text."""
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with the texts of each class that hold them; toxic ones in the upper bits."""
    held, weights, size = [], [], 0

    def flush():
        words, back = np.unique(np.concatenate(held), return_inverse=True)
        weight = np.concatenate(weights)
        counts = [np.bincount(back, weight == w, len(words)).astype(np.int64) for w in (1, 0)]
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), *map(pa.array, counts)], names=["hash", "toxic", "clean"]
        )

    for batch in batches:
        hashes, _, _, firsts, _ = _words(batch.column("_text"))
        words, owner = _per_text(hashes, firsts)
        held.append(words)
        weights.append(batch.column("_toxic").to_numpy()[owner])
        size += len(words)
        if size > HELD_WORDS:
            yield flush()
            held, weights, size = [], [], 0
    if held:
        yield flush()


def word_scores(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Log-odds of the classes given a word in so many texts of each, moved towards 0 by
    SURE standard errors; 0 if that passes 0. ``share`` of all texts are toxic."""
    a, b = toxic + PRIOR * share, clean + PRIOR * (1 - share)
    odds = np.log(a / share) - np.log(b / (1 - share))
    sure = np.abs(odds) - SURE * np.sqrt(1 / a + 1 / b)
    return np.where(sure > 0, np.copysign(sure, odds), 0.0)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments of positive score: begin, end and score, from left to right.

    Candidates are kept with the sums before and after them. A new one takes in those back
    to the last that began lower, if it ends higher than that one, and so on; each is
    looked at once per step that removes another, so the time is linear.
    """
    sums = np.cumsum(scores)
    out: list[tuple[int, int, float, float]] = []
    links: list[int] = []  # the last candidate that began lower
    for i in np.flatnonzero(scores > 0).tolist():
        begin, low, high = i, float(sums[i] - scores[i]), float(sums[i])
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= low:
                j = links[j]
            if j < 0 or out[j][3] >= high:
                out.append((begin, i + 1, low, high))
                links.append(j)
                break
            begin, low = out[j][0], out[j][2]
            del out[j:], links[j:]
    return [(a, b, high - low) for a, b, low, high in out]


@dataclass(frozen=True)
class Chance:
    """Segments of score s or more that clean words show by chance: a word rate times
    exp(-slope s)."""

    rate: float
    slope: float

    def expected(self, words: np.ndarray | int, score: np.ndarray | float):
        return self.rate * np.maximum(words, 1) * np.exp(-self.slope * np.asarray(score, float))

    def evidence(self, words: int, scores: list[float]) -> float:
        """By how much a text's clear segments together pass the score above which a text of
        its length shows one by chance, in logarithms of that chance."""
        beyond = self.slope * np.array([s for s in scores if s >= CLEAR]) - np.log(self.rate * max(words, 1))
        return float(np.maximum(beyond, 0).sum())


@dataclass(frozen=True)
class Model:
    store: HashStore
    share: float
    chance: Chance
    evidence: np.ndarray
    shares: np.ndarray

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        # Within a pool, too, more evidence ranks higher.
        tilt = evidence / (evidence + 1)
        return (1 - TILT) * np.interp(evidence, self.evidence, self.shares) + TILT * tilt


def _packed(toxic: str, clean: str) -> Column:
    return F.shiftleft(toxic, 32) + F.col(clean)


def _occurrence(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which occurrence of its word in its text each is, from 1."""
    order = np.lexsort((word, text))
    new = np.append(True, (np.diff(word[order]) != 0) | (np.diff(text[order]) != 0))[: len(word)]
    place = np.arange(len(word))
    out = np.empty(len(word), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0)) + 1
    return out


def _scored(store: HashStore, share: float, texts: pa.Array, own: np.ndarray | None = None):
    """For every text its number of words, its segments and where words begin and end. With
    ``own``, the class of each text, a text's own part is taken out of the counts."""
    hashes, starts, ends, firsts, begins = _words(texts)
    words, back = np.unique(hashes, return_inverse=True)
    counts = store.numbers(words, "counts")
    known = np.flatnonzero(counts[back])
    packed = counts[back[known]]
    toxic, clean = packed >> 32, packed & 0xFFFFFFFF
    if own is not None:
        mine = own[np.searchsorted(firsts, known, side="right") - 1]
        toxic, clean = toxic - (mine == 1), clean - (mine == 0)
    odds = word_scores(toxic, clean, share)
    known, odds = known[odds != 0], odds[odds != 0]
    scores = np.full(len(hashes), -COST)
    scores[known] += odds / _occurrence(back[known], np.searchsorted(firsts, known, side="right")) ** 2
    positive = np.flatnonzero(scores > 0)
    found: list[list[tuple[int, int, float]]] = [[] for _ in range(len(firsts) - 1)]
    for i in np.unique(np.searchsorted(firsts, positive, side="right") - 1).tolist():
        found[i] = segments(scores[firsts[i] : firsts[i + 1]])
    return np.diff(firsts), found, starts, ends, firsts, begins


def _segments(store: HashStore, share: float):
    """Of labelled texts: class, number of words, and scores of all segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("_toxic")
            words, found, *_ = _scored(store, share, batch.column("_text"), own.to_numpy())
            scores = pa.array([[x[2] for x in f] for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([own, pa.array(words), scores], names=["toxic", "words", "scores"])

    return run


def _law(seen: DataFrame) -> Chance:
    """The law of chance of clean texts. One more segment, as steep as log-odds are by
    themselves, keeps it finite."""
    clear = F.filter("scores", lambda s: s >= CLEAR)
    beyond = F.aggregate(clear, F.lit(0.0), lambda total, s: total + s - CLEAR)
    length, many, more = (
        seen.where("toxic = 0")
        .agg(F.sum("words"), F.sum(F.size(clear)), F.sum(beyond))
        .first()
    )
    slope = (many + 1) / (more + 1)
    return Chance(float((many + 1) / max(length, 1) * np.exp(slope * CLEAR)), float(slope))


def _bin(chance: Chance) -> Column:
    """The bin of a text's evidence, as ``Chance`` has it."""
    level = F.log(F.greatest("words", F.lit(1)) * chance.rate)
    clear = F.filter("scores", lambda s: s >= CLEAR)
    sums = F.aggregate(
        clear, F.lit(0.0), lambda total, s: total + F.greatest(s * chance.slope - level, F.lit(0.0))
    )
    return F.least(F.floor(sums / STEP), F.lit(BINS - 1)).cast("int")


def _curve(bins: np.ndarray, toxic: np.ndarray, size: np.ndarray, share: float):
    """Evidence and the share of toxic texts there, which never falls. Neighbouring bins
    whose shares fall are pooled; each pool has one text more, as all texts are."""
    pools: list[list[float]] = []
    for i in np.argsort(bins).tolist():
        pools.append([toxic[i], size[i], bins[i], bins[i] + 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    shares = np.maximum.accumulate([(t + share) / (n + 1) for t, n, _, _ in pools])
    ends = np.array([(low, high) for _, _, low, high in pools], float)
    return ends.ravel() * STEP, np.repeat(shares, 2)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model | None:
    """Fit on the rows of ``docs`` and ``labels`` whose id satisfies ``learn``, a condition
    on a column ``_id``. All of them count, each distinct text once, as toxic if half of its
    labels or more are 1. In the fit of chance and of the curve, a text's own part is taken
    out of the counts that score it. None if one of the classes has no text.
    """
    session(docs)
    ids = docs.select(*row_key(doc_id, text)).where(learn)
    marks = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("_label"))
    marks = marks.where("_id IS NOT NULL AND _label IS NOT NULL").where(learn)
    marks = marks.groupBy("_id").agg(F.avg("_label").alias("_label"))
    # One id stands for all copies of a text.
    texts = ids.join(marks, "_id").groupBy("_hash").agg(
        F.min("_id").alias("_id"), (F.avg("_label") >= 0.5).cast("bigint").alias("_toxic")
    )
    texts = kept(texts, "labelled")
    many, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("_toxic"), F.lit(0))).first()
    if not toxic or toxic == many:
        return None
    rows = docs.select(*row_key(doc_id, text), F.col(f"`{text}`").alias("_text")).where(learn)
    rows = kept(rows.join(broadcast_if_small(texts, many), ["_id", "_hash"]), "labelled_texts")
    if rows.count() > many:
        # Repeated rows of one id.
        rows = kept(rows.dropDuplicates(["_id", "_hash"]), "labelled_texts")
    rows = rows.select("_text", "_toxic")
    share = toxic / many
    words = rows.mapInArrow(_count, "hash bigint, toxic bigint, clean bigint")
    words = words.groupBy("hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = kept(words.where(_telling(share)), "words")
    store, _ = write_store(
        words.select("hash", _packed("toxic", "clean").alias("counts")), "counts", words.count(), "toxic_words"
    )
    seen = rows.mapInArrow(_segments(store, share), "toxic bigint, words bigint, scores array<double>")
    seen = kept(seen, "segments")
    chance = _law(seen)
    seen = seen.groupBy(_bin(chance).alias("bin"))
    # BINS rows at most.
    seen = seen.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).collect()
    bins, ones, size = (np.array([r[c] for r in seen], float) for c in ("bin", "toxic", "all"))
    return Model(store, share, chance, *_curve(bins, ones, size, share))


def _telling(share: float) -> Column:
    """Whether a word may have a score, also without one of its texts."""
    a = [F.greatest(F.col("toxic") + PRIOR * share - i, F.lit(1e-9)) for i in (0, 1)]
    b = [F.greatest(F.col("clean") + PRIOR * (1 - share) - i, F.lit(1e-9)) for i in (0, 1)]

    def sure(x: Column, y: Column) -> Column:
        odds = F.log(x / share) - F.log(y / (1 - share))
        return F.abs(odds) > SURE * F.sqrt(1 / x + 1 / y)

    whole = sure(a[0], b[0])
    return whole | ((F.col("toxic") > 0) & sure(a[1], b[0])) | ((F.col("clean") > 0) & sure(a[0], b[1]))


def _judged(model: Model | None):
    kind = pa.struct(
        [("begin", pa.int64()), ("words", pa.int64()), ("score", pa.float64()), ("expected", pa.float64()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            if model is None:
                scores, passages = np.zeros(len(texts)), [[]] * len(texts)
            else:
                words, found, starts, ends, firsts, begins = _scored(model.store, model.share, texts)
                seen = [model.chance.evidence(n, [x[2] for x in f]) for n, f in zip(words.tolist(), found)]
                scores = model.probability(np.array(seen))
                passages = []
                for i, rows in enumerate(found):
                    own = []
                    for a, b, score in rows:
                        expected = float(model.chance.expected(int(words[i]), score))
                        if expected <= SIGNIFICANT:
                            at = starts[firsts[i] + a] - begins[i], ends[firsts[i] + b - 1] - begins[i]
                            own.append((a, b - a, score, expected, at))
                    if own:
                        whole = texts[i].as_py().encode()
                        own = [(*x[:4], whole[x[4][0] : x[4][1]].decode()) for x in own]
                    passages.append([dict(zip(("begin", "words", "score", "expected", "text"), x)) for x in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(scores, pa.float64()), pa.array(passages, pa.list_(kind))],
                names=["_id", "score", "passages"],
            )

    return run


def score_toxicity(
    docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``_id``, ``score`` and ``passages`` of every row.

    ``score`` is the probability, 0 to 1, that the text is toxic. ``passages`` are its
    significant segments, from left to right: first word (from 0), number of words, score,
    how many such segments chance would show in a text of its length, and the passage.
    Words are runs of ASCII letters and digits and of all other characters, without regard
    to case of A-Z; the text alone counts.

    Null and empty texts have no passages and the score of a text without evidence; if
    nothing could be learnt, all scores are 0. Repeated rows have equal results; a missing
    id stays missing; other columns are not read. Texts are scored whole, in one pass.
    """
    session(docs)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        _judged(model),
        f"_id {kind}, score double, passages array<struct<begin:bigint,words:bigint,score:double,"
        "expected:double,text:string>>",
    )
