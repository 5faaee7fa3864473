"""Quality classifier from trusted positives and unlabelled text."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import session
from strata.llm.words import buffers, byte_values, find_words, hash_spans, shingles

# Rows of each kind, positive and unlabelled, that the model is fitted on, at most.
SAMPLE_ROWS = 20_000
CUTS = [0.001, 0.005, 0.02, 0.1, 0.25, 0.5, 0.75, 0.9, 0.98, 0.995, 0.999]
ROUNDS = 800
STEP = 0.05
SHRINK = 0.2  # shared by all positives
LEAST_BEYOND = 5  # positives below the first edge and above the last

# Kinds of bytes: letters, digits, blanks, then marks that prose uses rarely.
KINDS = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\r\x0b\x0c",
    b"\n",
    b".,;:'-\"()?",
    b"!",
    b"|",
    b"#$%&*@^~_+=<>/\\[]{}`",
]
KIND = np.full(256, len(KINDS), np.uint8)
for number, kind in enumerate(KINDS):
    KIND[list(kind)] = number
KIND[128:] = len(KINDS) + 1
MANY_KINDS = len(KINDS) + 2
FEATURES = MANY_KINDS + 8


def features(texts: pa.Array) -> np.ndarray:
    """Shares of kinds of bytes, and of words and runs of words, over whole texts.
    Nothing but the text is read; null counts as empty, which has zeros."""
    data, begins = buffers(texts)
    n = len(begins) - 1
    size = np.diff(begins)
    place = np.repeat(np.arange(n) * MANY_KINDS, size)
    counts = np.bincount(place + KIND[data], minlength=n * MANY_KINDS).reshape(n, MANY_KINDS)
    starts, ends, firsts = find_words(data, begins)
    words = np.diff(firsts)
    owner = np.repeat(np.arange(n), words)

    def share(flag: np.ndarray, of: np.ndarray, by: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=flag, minlength=n) / np.maximum(by, 1)

    hashes = hash_spans(data, starts, ends, byte_values())
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    runs, first_runs = shingles(hashes, firsts, 3)
    run_owner = np.repeat(np.arange(n), np.diff(first_runs))
    order = np.lexsort((runs, run_owner))
    again = np.zeros(len(runs), bool)
    again[1:] = (runs[order][1:] == runs[order][:-1]) & (run_owner[order][1:] == run_owner[order][:-1])
    length = ends - starts
    out = [
        counts / np.maximum(size, 1)[:, None],
        np.log1p(words),
        share(length, owner, words),
        share(same, owner, words),
        share(again, run_owner[order], np.diff(first_runs)),
        share(length <= 3, owner, words),
        share(KIND[data[starts]] == 1, owner, words),
        share(KIND[data[np.maximum(ends, 1) - 1]] >= 6, owner, words),
        share(length >= 12, owner, words),
    ]
    return np.column_stack(out)


@dataclass(frozen=True)
class Model:
    """A weight per feature and bin; a score is the logistic of their sum."""

    edges: np.ndarray
    weights: np.ndarray
    offset: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = self.weights[np.arange(rows.shape[1]), _bins(rows, self.edges)].sum(1)
        return 1 / (1 + np.exp(-np.clip(total + self.offset, -30, 30)))


def _bins(rows: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack(
        [np.searchsorted(e, rows[:, i], side="right") for i, e in enumerate(edges)], axis=1
    )


def fit_rows(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative unbiased risk with the logistic loss.

    The risk of unlabelled rows as negatives, less the positives' share of it, is an
    unbiased estimate for true negatives; it cannot be below zero, so where it falls
    below, steps go the other way for it.
    """
    both = np.vstack([positive, unlabelled])
    # Edges follow the positives, so that what they hardly ever show has bins of its own.
    margin = min(LEAST_BEYOND / len(positive), 0.5)
    cuts = np.clip(CUTS, margin, 1 - margin)
    edges = np.quantile(positive, cuts, axis=0).T
    edges[:, len(CUTS) // 2 :] = np.nextafter(edges[:, len(CUTS) // 2 :], np.inf)
    bins = _bins(both, edges)
    width = edges.shape[1] + 1
    flat = bins + np.arange(bins.shape[1]) * width
    weights = np.zeros(bins.shape[1] * width)
    offset = 0.0
    n = len(positive)
    moment = np.zeros(len(weights) + 1)
    square = np.zeros(len(weights) + 1)
    for step in range(1, ROUNDS + 1):
        total = weights[flat].sum(1) + offset
        chance = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        loss_negative = -np.log(np.maximum(1 - chance, 1e-12))
        negative = loss_negative[n:].mean() - prior * loss_negative[:n].mean()
        pull = np.empty(len(both))
        if negative >= 0:
            pull[:n] = prior * ((chance[:n] - 1) - chance[:n]) / n
            pull[n:] = chance[n:] / len(unlabelled)
        else:
            pull[:n] = prior * chance[:n] / n
            pull[n:] = -chance[n:] / len(unlabelled)
        slope = np.bincount(flat.ravel(), np.repeat(pull, flat.shape[1]), len(weights))
        slope = np.append(slope + SHRINK / n * weights, pull.sum())
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = STEP * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        weights = weights - move[:-1]
        offset -= move[-1]
    return Model(edges, weights.reshape(-1, width), float(offset), prior)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = features(batch.column("_text"))
        ends = pa.array(np.arange(0, found.size + 1, FEATURES, dtype=np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("_hash"), lists], names=["_hash", "features"])


def _sample(rows: DataFrame, count: int, wanted: int) -> np.ndarray:
    """Features of ``wanted`` rows at most, or of all if there are fewer: those of the least hashes
    of id and text, so that copies of a text are chosen each on its own. Only rows below a
    hash that leaves some more than wanted are measured, and only their numbers are sorted."""
    rows = rows.select("_text", F.xxhash64("_id", "_text", F.lit(5)).alias("_hash"))
    if count > wanted:
        part = int((wanted + 6 * wanted**0.5) / count * 1_000_000) + 1
        rows = rows.where(F.pmod("_hash", F.lit(1_000_000)) < part)
    found = rows.mapInArrow(_measure, "_hash bigint, features array<double>")
    found = found.orderBy("_hash", "features").limit(wanted).select("features").collect()
    return np.array([r[0] for r in found], float).reshape(-1, FEATURES)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Fit on the rows of ``docs`` and ``labels`` whose id satisfies ``learn``, a
    condition on a column ``_id``. Positives are documents all of whose labels are 1;
    the unlabelled are all documents, labelled or not. Their share of positives is
    estimated as that among labelled ids. At most ``sample_rows`` rows of each kind,
    chosen by a hash, reach the driver, as numbers. None if there are no positives.
    """
    session(docs)
    texts = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    texts = texts.where(learn)
    marks = (
        labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").alias("_label"))
        .where("_id IS NOT NULL AND _label IS NOT NULL")
        .where(learn)
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"))
    )
    known, good = marks.agg(F.count("*"), F.count_if(F.col("_label") == 1)).first()
    if not good:
        return None
    positive = texts.join(marks.where("_label = 1").select("_id"), "_id", "left_semi")
    prior = min(max(good / known, 0.01), 0.99) if good < known else 0.9
    first = _sample(positive, good, sample_rows)
    rest = _sample(texts, texts.count(), sample_rows)
    return fit_rows(first, rest, prior) if len(first) and len(rest) else None


def _score(model: Model | None, names: list[str], text: str, least: float | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text))
            found = np.ones(len(texts)) if model is None else model.scores(features(texts))
            if least is None:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(found)], names=[*names, "score"]
                )
            else:
                yield batch.filter(pa.array(found >= least))

    return run


def score_quality(
    docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``_id`` and ``score``, 0 to 1, of every row; likelier good if higher. The score
    depends on the text alone. Null and empty texts have the score of an empty one; all
    scores are 1 if nothing could be learnt."""
    session(docs)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    schema = rows.withColumn("score", F.lit(0.0)).schema
    scored = rows.mapInArrow(_score(model, ["_id", "_text"], "_text", None), schema)
    return scored.select("_id", "score")


def keep_good(
    docs: DataFrame, model: Model | None, text: str = "text", least: float = 0.5
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``least`` or more."""
    session(docs)
    return docs.mapInArrow(_score(model, docs.columns, text, least), docs.schema)
