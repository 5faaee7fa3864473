"""Runs of words that repeat with a period, found in the grammar of each text.

The word ids of a text are compressed by Re-Pair: pairs of neighbouring symbols that occur
again become rules, most frequent ones (by powers of two) first, and what is left without
repeated pairs is the text's start rule, read as a balanced tree. A run has a lowest rule
that derives it whole, and crosses the boundary between that rule's two parts. So runs are
computed once per rule, around its boundary, then moved to every place the rule derives.
All texts of a batch are compressed side by side; no rule is shared between texts.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import session
from strata.llm.words import SPACES, buffers, constants, find_words, mix

LEAST_WORDS = 6  # of a run
LEAST_PERIODS = 4  # of a run
PRIMES = (2147483629, 2147483587)  # the two before 2^31 - 1
TESTS = 1 << 20  # pairs of rule and period that are held at once


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words, equal for equal words of a batch, and each text's first."""
    data, begins = buffers(texts)
    starts, ends, firsts = find_words(data, begins)
    inside = data[~SPACES[data]] if len(data) else data
    offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(inside)]
    )
    return words.dictionary_encode().indices.to_numpy().astype(np.int64), firsts


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers 0.. of the distinct values, and how often each occurs."""
    order = np.argsort(values)
    ordered = values[order]
    first = np.append(True, ordered[1:] != ordered[:-1]) if len(values) else np.zeros(0, bool)
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(first) - 1
    return number, np.diff(np.append(np.flatnonzero(first), len(values)))


@dataclass
class Grammar:
    """Rules in the order they were made: a rule's parts are words or earlier rules.

    Symbols below ``words`` are words of one text each, the others rules. ``at`` is a place
    of the rule's expansion in all words of the batch, ``middle`` where its right part
    begins there, and ``end`` where it ends. Rules of one round lie between two ``rounds``.
    Each text has one of the ``roots``, which begin at ``root_at``.
    """

    words: int
    left: np.ndarray
    right: np.ndarray
    at: np.ndarray
    middle: np.ndarray
    end: np.ndarray
    rounds: np.ndarray
    roots: np.ndarray
    root_at: np.ndarray


def _disjoint(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which of the pairs at ``place`` are replaced: no two that share a symbol, and no
    pair is left out that shares none with a replaced one. Higher ranks go first; of equal
    neighbours, as in a run of one symbol, every other."""
    alive = np.arange(len(place))
    taken = np.zeros(len(place), bool)
    while len(alive):
        p, r = place[alive], rank[alive]
        near = p[1:] == p[:-1] + 1
        # Neighbours of equal rank are a plateau, which is higher or lower as a whole.
        same = near & (r[1:] == r[:-1])
        opens = np.append(True, ~same)
        number = np.cumsum(opens) - 1
        low = np.flatnonzero(opens)
        high = np.append(low[1:], len(p)) - 1
        before = np.append(False, near)[low] & (r[np.maximum(low - 1, 0)] > r[low])
        after = np.append(near, False)[high] & (r[np.minimum(high + 1, len(p) - 1)] > r[high])
        best = ~(before | after)
        chosen = best[number] & ((np.arange(len(p)) - low[number]) % 2 == 0)
        taken[alive[chosen]] = True
        gone = chosen.copy()
        gone[1:] |= near & chosen[:-1]
        gone[:-1] |= near & chosen[1:]
        alive = alive[~gone]
    return taken


def compress(ids: np.ndarray, firsts: np.ndarray) -> Grammar:
    """Re-Pair of every text, with a balanced tree over each text's last sequence."""
    n = len(ids)
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    # A word of another text is another symbol, so no pair repeats across texts.
    symbols, counts = _dense(owner * (int(ids.max()) + 1) + ids) if n else (ids, ids)
    words = len(counts)
    made = words
    at = np.arange(n)
    rules: list[tuple[np.ndarray, ...]] = []

    def rule(place: np.ndarray, number: np.ndarray, sequence: np.ndarray, begins: np.ndarray):
        """New rules for the pairs at ``place``; equal numbers are one rule."""
        _, one = np.unique(number, return_index=True)
        p = place[one]
        ends = np.append(begins, n)
        rules.append((sequence[p], sequence[p + 1], begins[p], begins[p + 1], ends[p + 2]))
        return len(one)

    # Pairs that may repeat: at first those of two symbols that occur again, later those
    # that hold a new symbol. The counts of all others only fall.
    again = counts[symbols] > 1 if n else np.zeros(0, bool)
    place = np.flatnonzero(again[:-1] & again[1:] & (owner[1:] == owner[:-1])) if n else at
    while len(place):
        keys = (symbols[place] << 32) | symbols[place + 1]
        number, counts = _dense(keys)
        often = counts[number] > 1
        place, number = place[often], number[often]
        if not len(place):
            break
        rank = (np.log2(counts).astype(np.uint64) << np.uint64(58)) | (
            mix(np.arange(len(counts), dtype=np.uint64) + np.uint64(made)) >> np.uint64(6)
        )
        taken = _disjoint(rank[number], place)
        place, number = place[taken], _dense(number[taken])[0]
        fresh = rule(place, number, symbols, at)
        symbols[place] = made + number
        stays = np.ones(len(symbols), bool)
        stays[place + 1] = False
        symbols, at = symbols[stays], at[stays]
        new = symbols >= made
        made += fresh
        own = owner[at]
        place = np.flatnonzero((new[:-1] | new[1:]) & (own[1:] == own[:-1]))
    while True:
        own = owner[at]
        first = np.searchsorted(own, own, side="left")
        even = (np.arange(len(own)) - first) % 2 == 0
        place = np.flatnonzero(even[:-1] & (own[1:] == own[:-1])) if len(own) else at
        if not len(place):
            break
        rule(place, np.arange(len(place)), symbols, at)
        symbols[place] = made + np.arange(len(place))
        made += len(place)
        stays = np.ones(len(symbols), bool)
        stays[place + 1] = False
        symbols, at = symbols[stays], at[stays]
    parts = [np.concatenate(x) for x in zip(*rules)] if rules else [np.zeros(0, np.int64)] * 5
    rounds = np.append(0, np.cumsum([len(x[0]) for x in rules])).astype(np.int64)
    return Grammar(words, *parts, rounds, symbols, at)


class Fingerprints:
    """Compares any two stretches of words by their polynomials modulo two primes."""

    def __init__(self, ids: np.ndarray, seed: int):
        self.ids = ids
        self.sums, self.powers = [], []
        for i, prime in enumerate(PRIMES):
            base = int(constants(2, 90 + 2 * seed + i)[1]) % (prime - 3) + 2
            power = np.ones(1, np.uint64)
            while len(power) <= len(ids):
                step = np.uint64(pow(base, len(power), prime))
                power = np.concatenate([power, power * step % np.uint64(prime)])
            power = power[: len(ids) + 1]
            values = mix(ids.astype(np.uint64) + constants(1, 40 + seed)[0]) % np.uint64(prime)
            sums = np.cumsum(values * power[:-1] % np.uint64(prime), dtype=np.uint64)
            self.sums.append(np.append(np.uint64(0), sums))
            self.powers.append(power)

    def _equal(self, which: int, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        sums, power, prime = self.sums[which], self.powers[which], np.uint64(PRIMES[which])
        first = (sums[a + size] - sums[a]) % prime * power[b - a] % prime
        return first == (sums[b + size] - sums[b]) % prime

    def equal(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words, one at least, at ``a`` and, behind, at ``b`` are the same."""
        out = self.ids[a] == self.ids[b]
        for which in range(len(PRIMES)):
            maybe = np.flatnonzero(out)
            out[maybe] = self._equal(which, a[maybe], b[maybe], size[maybe])
        return out

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on, or before them, are the same."""
        low, high = np.zeros_like(most), most.copy()
        while len(open_ := np.flatnonzero(low < high)):
            size = (low[open_] + high[open_] + 1) // 2
            shift = size if back else 0
            same = self.equal(a[open_] - shift, b[open_] - shift, size)
            low[open_[same]] = size[same]
            high[open_[~same]] = size[~same] - 1
        return low


def _slices(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index and number 1..count of each of the counts, so many at a time. One count alone
    may be longer than that, as its text is."""
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(counts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + TESTS, side="right")))
        part = counts[begin:end]
        which = np.repeat(np.arange(begin, end), part)
        yield which, np.arange(len(which)) - np.repeat(np.cumsum(part) - part, part) + 1
        begin = end


def runs_at_boundaries(grammar: Grammar, prints: Fingerprints) -> tuple[np.ndarray, ...]:
    """Rule, first word (from the rule's begin), length and period of every run inside a
    rule's expansion that reaches its boundary.

    A run that crosses a boundary has two periods at least on one side of it. So a period
    is in question if the period's words next to the boundary are the same as the ones
    beyond them, on either side; its run is as far as words a period apart are equal.
    """
    long = np.flatnonzero(grammar.end - grammar.at >= LEAST_WORDS)
    begin, middle, end = grammar.at[long], grammar.middle[long], grammar.end[long]
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 4]
    for right in (True, False):
        side = (end - middle if right else middle - begin) // 2
        most = np.minimum(side, (end - begin) // LEAST_PERIODS)
        for which, period in _slices(most):
            at = middle[which] if right else middle[which] - 2 * period
            again = prints.equal(at, at + period, period)
            which, period, at = which[again], period[again], at[again]
            low, high = begin[which], end[which]
            more = prints.reach(at + period, at + 2 * period, high - at - 2 * period, False)
            less = prints.reach(at, at + period, at - low, True)
            length = 2 * period + more + less
            enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
            found.append(
                (long[which[enough]], (at - less - low)[enough], length[enough], period[enough])
            )
    rule, first, length, period = (np.concatenate(x) for x in zip(*found))
    # A multiple of a run's smallest period finds the same run.
    order = np.lexsort((period, length, first, rule))
    rule, first, length, period = rule[order], first[order], length[order], period[order]
    new = np.append(
        True, (rule[1:] != rule[:-1]) | (first[1:] != first[:-1]) | (length[1:] != length[:-1])
    )[: len(rule)]
    return rule[new], first[new], length[new], period[new]


def _places(grammar: Grammar, rule: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All rules below the roots that have runs, and where the texts derive them, a level
    of the derivation at a time. Branches without runs are not walked."""
    wanted = np.zeros(grammar.words + len(grammar.left), bool)
    wanted[grammar.words + rule] = True
    own = wanted.copy()
    for a, b in zip(grammar.rounds[:-1], grammar.rounds[1:]):
        some = wanted[grammar.left[a:b]] | wanted[grammar.right[a:b]]
        wanted[grammar.words + a : grammar.words + b] |= some
    symbol, at = grammar.roots, grammar.root_at
    while len(symbol):
        stays = wanted[symbol]
        symbol, at = symbol[stays], at[stays]
        yield symbol[own[symbol]] - grammar.words, at[own[symbol]]
        inner = symbol - grammar.words
        size = grammar.middle[inner] - grammar.at[inner]
        symbol = np.concatenate([grammar.left[inner], grammar.right[inner]])
        at = np.concatenate([at, at + size])


def _merged(first: np.ndarray, last: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of one period that have a period of words in common are one run."""
    order = np.lexsort((last, first, period))
    first, last, period = first[order], last[order], period[order]
    # Ends so far within a period: periods are set apart by more than any place.
    apart = period * (int(last.max(initial=0)) + 1)
    reach = np.maximum.accumulate(last + apart) - apart if len(first) else last
    new = np.append(True, (period[1:] != period[:-1]) | (first[1:] > reach[:-1] - period[1:]))
    opens = np.flatnonzero(new[: len(first)])
    ends = np.maximum.reduceat(last, opens) if len(opens) else last
    return first[opens], ends, period[opens]


def _verified(ids: np.ndarray, first: np.ndarray, last: np.ndarray, period: np.ndarray) -> bool:
    """Whether words a period apart are the same in all runs, word by word."""
    for which, number in _slices(last - first - period):
        place = first[which] + number - 1
        if (ids[place] != ids[place + period[which]]).any():
            return False
    return True


def find_runs(ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in it, length and period of every run, by text, start, period."""
    grammar = compress(ids, firsts)
    for seed in range(100):
        prints = Fingerprints(ids, seed)
        rule, begin, length, period = runs_at_boundaries(grammar, prints)
        # A rule's runs lie together.
        opens = np.searchsorted(rule, np.arange(len(grammar.left) + 1))
        parts = [(np.zeros(0, np.int64),) * 3]
        for where, at in _places(grammar, rule):
            count = opens[where + 1] - opens[where]
            which = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            which += np.repeat(opens[where], count)
            start = np.repeat(at, count) + begin[which]
            parts.append(_merged(start, start + length[which], period[which]))
        start, last, period = _merged(*(np.concatenate(x) for x in zip(*parts)))
        if _verified(ids, start, last, period):
            text = np.searchsorted(firsts, start, side="right") - 1
            order = np.lexsort((period, start))
            text, start, last, period = text[order], start[order], last[order], period[order]
            return text, start - firsts[text], last - start, period
    raise RuntimeError("equal fingerprints of different words, whatever the base")


Order = Callable[[list, np.ndarray], list[np.ndarray | None]]


def _described(names: list[str], id_name: str, text_name: str, order: Order | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index(text_name))
            ids, firsts = word_ids(texts)
            orders = (
                order(batch.column(names.index(id_name)).to_pylist(), np.diff(firsts))
                if order
                else [None] * len(texts)
            )
            for i, places in enumerate(orders):
                if places is not None:
                    own = ids[firsts[i] : firsts[i + 1]]
                    ids[firsts[i] : firsts[i + 1]] = own[places]
            text, start, length, period = find_runs(ids, firsts)
            opens = np.searchsorted(text, np.arange(len(texts) + 1))
            rest = []
            for i, whole in enumerate(texts.to_pylist()):
                words = (whole or "").encode().split()
                if orders[i] is not None:
                    words = [words[j] for j in orders[i].tolist()]
                a, b = opens[i], opens[i + 1]
                if b > a:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, start[a:b] + period[a:b], 1)
                    np.add.at(edges, start[a:b] + length[a:b], -1)
                    stays = np.cumsum(edges[:-1]) == 0
                    words = [words[j] for j in np.flatnonzero(stays).tolist()]
                rest.append(b" ".join(words).decode())
            offsets = pa.array(opens.astype(np.int32))
            values = pa.StructArray.from_arrays(
                [pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(names.index(id_name)),
                    pa.array(np.diff(firsts)),
                    pa.ListArray.from_arrays(offsets, values),
                    pa.array(rest, pa.string()),
                ],
                names=["_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: Order | None = None
) -> DataFrame:
    """``_id``, ``n_words``, ``runs`` and ``collapsed`` of every row of ``docs``.

    Words are what stands between white space, compared exactly. ``runs`` has start (word
    number from 0), length and period, in words, of every run: LEAST_WORDS words or more,
    LEAST_PERIODS periods or more, of the smallest period, as far as the period goes; by
    start, then period. ``collapsed`` is the text without those words of runs that lie
    after the first period of a run, words joined by one space.

    ``order`` may give, for a batch's ids and numbers of words, the places from which each
    text takes its words, or None to leave a text as it is.

    Null and empty texts have no words, no runs and an empty rest. Repeated rows have equal
    results; other columns are not read. A text is worked on whole, in its one row, in time
    that grows as n log n whatever it repeats.
    """
    session(docs)
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        _described(["_id", "_text"], "_id", "_text", order),
        f"_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
        "collapsed string",
    )
