"""Words of texts and their 64-bit hashes, whole Arrow batches at a time."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
WINDOW_BYTES = 1 << 16

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit values that depend on the seed only."""
    with np.errstate(over="ignore"):
        start = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * MULTIPLIER
        return mix(start) | np.uint64(1)


def powers(n: int, base: np.uint64 = MULTIPLIER) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def byte_values(seed: int = 0, fold_case: bool = True) -> np.ndarray:
    """A random value per byte; A-Z have those of a-z if case is folded."""
    values = constants(256, 7 + seed)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, one after another, and where each begins; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    begins = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or begins[-1] == begins[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[begins[0] : begins[-1]]
    return data, begins - begins[0]


def find_words(data: np.ndarray, begins: np.ndarray, spaces: np.ndarray = SPACES):
    """Where words of non-space bytes begin and end, and each text's first word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(begins), np.int64)
    inside = ~spaces[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begins] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside
    ends = ends & np.append(~inside[1:] | edge[1:-1], True)
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, begins)


def hash_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """A hash of the bytes of each span, a window of bytes at a time. Spans come in order
    and do not overlap."""
    sizes = ends - starts
    out = np.empty(len(starts), np.uint64)
    if not len(starts):
        return out
    cuts = np.searchsorted(starts, np.arange(starts[0], starts[-1] + 1, WINDOW_BYTES))
    cuts = np.unique(np.append(cuts, len(starts)))
    windows = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
    most = max(int(ends[b - 1] - starts[a]) for a, b in windows)
    power, back = powers(most), powers(most + 1, INVERSE)
    sums = np.zeros(most + 1, np.uint64)
    with np.errstate(over="ignore"):
        for a, b in windows:
            base, size = starts[a], sizes[a:b]
            terms = values[data[base : ends[b - 1]]]
            terms *= power[: len(terms)]
            np.cumsum(terms, out=sums[1 : len(terms) + 1])
            low = starts[a:b] - base
            own = (sums[low + size] - sums[low]) * back[low]
            out[a:b] = mix(own + size.astype(np.uint64) * MULTIPLIER)
    return out


def order_within(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The order by owner, which the rows are in already, and value. One sort by the owner
    and the upper bits of the value finds it, unless two values of one owner share these."""
    bits = int(owner[-1]).bit_length() if len(owner) else 0
    if not bits:
        return np.argsort(values)
    keys = (owner.astype(np.uint64) << np.uint64(64 - bits)) | (values >> np.uint64(bits))
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if (values[order[same]] != values[order[same + 1]]).any():
        return np.lexsort((values, owner))
    return order


def shingles(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row, within texts, and each text's first; a text of
    fewer words, but not none, has one of all its words."""
    counts = np.diff(firsts)
    sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    begins = np.append(0, np.cumsum(sizes))
    total = int(begins[-1])
    place = np.arange(total) - np.repeat(begins[:-1], sizes) + np.repeat(firsts[:-1], sizes)
    last = np.repeat(firsts[1:], sizes)
    padded = np.append(hashes, np.zeros(n, np.uint64))
    out = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for j, factor in enumerate(constants(n, 3)):
            word = np.where(place + j < last, padded[np.minimum(place + j, len(hashes))], np.uint64(0))
            out += word * factor
        return mix(out), begins
