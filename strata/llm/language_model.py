"""Bigram language model with interpolated modified Kneser-Ney smoothing.

Words are numbered by the order of their hashes. Counts lie in sorted arrays in the shared
folder, in shards that tasks write and other tasks map, see ``store``: words with their
counts, pairs of words with theirs, and per first word what smoothing needs. The driver
holds a few numbers per shard.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import grouped, kept, session
from strata.llm.store import HashStore, load, mounted_folder, save, shard_bits, shard_of, write_store
from strata.llm.words import buffers, byte_values, find_words, hash_spans, mix

END = np.uint64(0x9D39247E33776D41)
PAIRS_PER_SHARD = 1_000_000
HELD_PAIRS = 3_000_000
SMALL = 255  # counts are kept in bytes, larger ones beside them


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text and of one end after them, and each text's first."""
    data, begins = buffers(texts)
    starts, ends, firsts = find_words(data, begins)
    hashes = hash_spans(data, starts, ends, byte_values())
    return np.insert(hashes, firsts[1:], END), firsts + np.arange(len(firsts))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, times = np.unique(tokens(batch.column("_text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(times)], names=["hash", "times"]
        )


def numbered(store: HashStore, hashes: np.ndarray) -> np.ndarray:
    words, back = np.unique(hashes, return_inverse=True)
    return store.places(words)[back]


def pairs_of(numbers: np.ndarray, firsts: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """The number before each token, ``begin`` at the start of a text, and its own."""
    before = np.append(begin, numbers[:-1]) if len(numbers) else numbers
    before[firsts[:-1]] = begin
    return before, numbers


def _pair(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return (before.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)


def pair_shard(keys: np.ndarray, hot: np.ndarray, bits: int) -> np.ndarray:
    """By the first word; pairs of a very common first word are spread over all shards."""
    first = keys >> np.uint64(32)
    spread = np.where(np.isin(first, hot), mix(keys), mix(first))
    return shard_of(spread, bits)


def _count_pairs(store: HashStore, begin: int, hot: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def flush():
            k, c = merged(np.concatenate(keys), np.concatenate(counts))
            shards = pair_shard(k, hot, bits)
            order = np.argsort(shards, kind="stable")
            k, c, shards = k[order], c[order], shards[order]
            cuts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1]))
            ends = np.append(cuts[1:], len(k))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(shards[cuts].astype(np.int32)),
                    pa.array([k[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array(
                        [c[a:b].astype(np.int64).tobytes() for a, b in zip(cuts, ends)], pa.binary()
                    ),
                ],
                names=["shard", "keys", "counts"],
            )

        for batch in batches:
            hashes, firsts = tokens(batch.column("_text"))
            before, after = pairs_of(numbered(store, hashes), firsts, begin)
            k, c = np.unique(_pair(before, after), return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > HELD_PAIRS:
                yield flush()
                keys, counts, held = [], [], 0
        if held:
            yield flush()

    return run


def _spread(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


def _gather(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts, held = [], [], 0
    for k, c in zip(table.column("keys"), table.column("counts")):
        keys.append(np.frombuffer(k.as_py(), np.uint64))
        counts.append(np.frombuffer(c.as_py(), np.int64))
        held += len(keys[-1])
        if held > 8 * PAIRS_PER_SHARD:
            k, c = merged(np.concatenate(keys), np.concatenate(counts))
            keys, counts, held = [k], [c], 0
    return merged(np.concatenate(keys), np.concatenate(counts))


def _store_pairs(folder: str, store: HashStore, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["shard"]):
            shard = table.column("shard")[0].as_py()
            keys, counts = _gather(table)
            save(folder, shard, "pair", keys)
            save(folder, shard, "count", np.minimum(counts, SMALL).astype(np.uint8))
            large = counts >= SMALL
            save(folder, shard, "large_pair", keys[large])
            save(folder, shard, "large_count", counts[large])
            before = (keys >> np.uint64(32)).astype(np.int64)
            first = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
            facts = np.stack(
                [np.add.reduceat(x.astype(np.int64), first) for x in (counts, counts == 1, counts == 2, counts > 2)]
            )
            save(folder, shard, "first", before[first])
            save(folder, shard, "facts", facts.astype(np.uint32 if facts.max() < 1 << 32 else np.int64))
            split = np.isin(before[first], hot)
            after, times = merged(keys & np.uint64(0xFFFFFFFF), np.ones(len(keys), np.int64))
            part = np.searchsorted(store.bases, after.astype(np.int64), side="right") - 1
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            ends = np.append(cuts[1:], len(part))
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([*part[cuts].tolist(), -1], pa.int32()),
                    "keys": pa.array(
                        [*(after[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, ends)), None],
                        pa.binary(),
                    ),
                    "counts": pa.array(
                        [*(times[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts, ends)), None],
                        pa.binary(),
                    ),
                    "spread": pa.array(
                        [*[None] * len(cuts), [*_spread(counts), len(counts)]], pa.list_(pa.int64())
                    ),
                    "hot": pa.array(
                        [
                            *[None] * len(cuts),
                            np.vstack([before[first], facts])[:, split].T.tolist(),
                        ],
                        pa.list_(pa.list_(pa.int64())),
                    ),
                }
            )

    return run


def _store_backs(store: HashStore):
    """How many different words come before each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["part"]):
            part = table.column("part")[0].as_py()
            backs = np.zeros(store.sizes[part], np.int64)
            for k, c in zip(table.column("keys"), table.column("counts")):
                place = np.frombuffer(k.as_py(), np.uint32).astype(np.int64) - store.bases[part]
                np.add.at(backs, place, np.frombuffer(c.as_py(), np.uint32))
            save(store.folder, part, "backs", backs)
            more = int((backs > 2).sum())
            yield pa.RecordBatch.from_pydict(
                {"spread": pa.array([[*_spread(backs), more]], pa.list_(pa.int64()))}
            )

    return run


def discounts(spread: list[int]) -> list[float]:
    """What is taken from counts of 1, 2 and more, from how many counts are 1, 2, 3, 4.
    Where one of these is missing, half of the count."""
    n = [float(x) for x in spread[:4]]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    out = []
    for i in (1, 2, 3):
        off = i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] and n[i] else i / 2
        out.append(min(max(off, 0.0), float(i)))
    return out


@dataclass
class Model:
    """Where the counts lie and the few numbers that belong to all."""

    store: HashStore
    folder: str
    bits: int
    total: int
    words: int
    hot: np.ndarray
    hot_facts: np.ndarray
    off_pair: list[float]
    off_back: list[float]
    backs: int
    back_spread: list[int]
    held: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "held": {}}

    def _part(self, shard: int, name: str):
        if (shard, name) not in self.held:
            self.held[shard, name] = load(self.folder, shard, name)
        return self.held[shard, name]

    def _off(self, counts: np.ndarray, off: list[float]) -> np.ndarray:
        return np.array([0.0, *off])[np.minimum(counts, 3)]

    def word_facts(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each word and how many different ones come before it."""
        words, back = np.unique(numbers, return_inverse=True)
        counts, backs = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        shards = np.searchsorted(self.store.bases, words, side="right") - 1
        for shard in np.unique(shards[words >= 0]).tolist():
            own = (shards == shard) & (words >= 0)
            at = words[own] - self.store.bases[shard]
            counts[own] = self.store.part(shard, "count")[at]
            backs[own] = self.store.part(shard, "backs")[at]
        return counts[back], backs[back]

    def lower(self, backs: np.ndarray) -> np.ndarray:
        """Probability of words by what comes before them, mixed with an even one."""
        even = 1 / (self.words + 1)
        if not self.backs:
            return np.full(len(backs), even)
        one, two, _, _, more = self.back_spread
        left = np.dot(self.off_back, [one, two, more]) / self.backs
        own = np.maximum(backs - self._off(backs, self.off_back), 0) / self.backs
        return own + left * even

    def first_facts(self, before: np.ndarray) -> np.ndarray:
        """Per first word: its pairs, and the different ones seen once, twice, more often."""
        firsts, back = np.unique(before, return_inverse=True)
        out = np.zeros((4, len(firsts)), np.int64)
        shards = shard_of(mix(firsts.astype(np.uint64)), self.bits)
        for shard in np.unique(shards).tolist():
            known = self._part(shard, "first")
            if known is None:
                continue
            own = np.flatnonzero(shards == shard)
            at = np.minimum(np.searchsorted(known, firsts[own]), len(known) - 1)
            there = known[at] == firsts[own]
            out[:, own[there]] = self._part(shard, "facts")[:, at[there]]
        if len(self.hot):
            place = np.minimum(np.searchsorted(self.hot, firsts), len(self.hot) - 1)
            there = self.hot[place] == firsts
            out[:, there] = self.hot_facts[:, place[there]]
        return out[:, back]

    def pair_counts(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        keys = _pair(before, after)
        shards = pair_shard(keys, self.hot, self.bits)
        order = np.lexsort((keys, shards))
        keys, shards = keys[order], shards[order]
        found = np.zeros(len(keys), np.int64)
        cuts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(keys) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(keys)) if len(keys) else []):
            shard = int(shards[a])
            known = self._part(shard, "pair")
            if known is None:
                continue
            at = np.minimum(np.searchsorted(known, keys[a:b]), len(known) - 1)
            count = np.where(known[at] == keys[a:b], self._part(shard, "count")[at], 0).astype(np.int64)
            large = np.flatnonzero(count == SMALL)
            if len(large):
                at = np.searchsorted(self._part(shard, "large_pair"), keys[a:b][large])
                count[large] = self._part(shard, "large_count")[at]
            found[a:b] = count
        out = np.zeros(len(keys), np.int64)
        out[order] = found
        return out

    def probabilities(self, before: np.ndarray, after: np.ndarray, backs: np.ndarray) -> np.ndarray:
        """Of each word after the one before; ``begin`` and unknown words may be before."""
        low = self.lower(backs)
        facts = np.zeros((4, len(before)), np.int64)
        known = before >= 0
        facts[:, known] = self.first_facts(before[known])
        seen = facts[0] > 0
        counts = np.zeros(len(before), np.int64)
        both = seen & (after >= 0)
        counts[both] = self.pair_counts(before[both], after[both])
        total = np.maximum(facts[0], 1)
        left = np.array(self.off_pair) @ facts[1:] / total
        own = np.maximum(counts - self._off(counts, self.off_pair), 0) / total
        return np.where(seen, own + left * low, low)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Count all words and pairs of ``docs``. Null texts are empty and have an end only."""
    spark = session(docs)
    texts = docs.select(F.col(f"`{text}`").alias("_text"))
    found = texts.mapInArrow(_words, "hash bigint, times bigint").groupBy("hash")
    words = kept(found.agg(F.sum("times").alias("count")), "words")
    total, distinct = words.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    if distinct >= 1 << 32:
        raise ValueError("more words than numbers of 32 bits")
    store, _ = write_store(words, "count", distinct, "vocabulary")
    bits = shard_bits(total, PAIRS_PER_SHARD)
    # At most as many as shards.
    common = words.where(F.col("count") > max(total >> bits, 1000)).select("hash").collect()
    hashes = np.sort(np.array([r["hash"] for r in common], np.int64).view(np.uint64))
    hot = np.sort(np.append(store.places(hashes), distinct))
    folder = mounted_folder(spark, "pairs")
    counted = texts.mapInArrow(
        _count_pairs(store, distinct, hot, bits), "shard int, keys binary, counts binary"
    )
    dealt = counted.repartition(1 << bits, "shard").sortWithinPartitions("shard")
    kind = "part int, keys binary, counts binary, spread array<bigint>, hot array<array<bigint>>"
    pairs = kept(dealt.mapInArrow(_store_pairs(folder, store, hot), kind), "pairs")
    own = pairs.where("part < 0")
    *spread, distinct_pairs = _sums(own)
    rows = own.select(F.explode("hot").alias("f")).groupBy(F.col("f")[0].alias("first"))
    rows = rows.agg(*[F.sum(F.col("f")[i]).alias(f"x{i}") for i in range(1, 5)]).collect()
    facts = {r["first"]: [r[f"x{i}"] for i in range(1, 5)] for r in rows}
    hot_facts = np.array([facts.get(int(h), [0] * 4) for h in hot], np.int64).T
    backs = pairs.where("part >= 0").select("part", "keys", "counts")
    backs = backs.repartition(len(store.sizes), "part").sortWithinPartitions("part")
    back_spread = _sums(backs.mapInArrow(_store_backs(store), "spread array<bigint>"))
    return Model(
        store,
        folder,
        bits,
        total,
        distinct,
        hot,
        hot_facts,
        discounts(spread),
        discounts(back_spread),
        distinct_pairs,
        back_spread,
    )


def _sums(rows: DataFrame, n: int = 5) -> list[int]:
    columns = [F.coalesce(F.sum(F.col("spread")[i]), F.lit(0)) for i in range(n)]
    return list(rows.agg(*columns).first())


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, firsts = tokens(batch.column("_text"))
            numbers = numbered(model.store, hashes)
            counts, backs = model.word_facts(numbers)
            before, after = pairs_of(numbers, firsts, model.words)
            logs = np.log10(model.probabilities(before, after, backs))
            base = np.log10((counts + 1) / (model.total + model.words + 1))
            at = firsts[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(np.diff(firsts)),
                    pa.array(np.add.reduceat((counts > 0).astype(np.int64), at)),
                    pa.array(np.full(len(at), model.total, np.int64)),
                    pa.array(np.add.reduceat(base, at)),
                    pa.array(np.add.reduceat(logs, at)),
                ],
                names=["_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``,
    the log10 probability of the words of a text and its end, of every row. A null or empty
    text is its end alone. Repeated rows have equal results; other columns are not read."""
    session(docs)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        _scored(model),
        f"_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
