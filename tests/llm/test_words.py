import numpy as np
import pyarrow as pa

import strata.llm.words as words
from strata.llm.words import buffers, byte_values, find_words, hash_spans, order_within

MASK = (1 << 64) - 1


def plain_hash(word, values):
    total, power = 0, 1
    for byte in word:
        total = (total + int(values[byte]) * power) & MASK
        power = power * int(words.MULTIPLIER) & MASK
    x = np.array([(total + len(word) * int(words.MULTIPLIER)) & MASK], np.uint64)
    with np.errstate(over="ignore"):
        return int(words.mix(x)[0])


def test_hashes_of_spans_equal_plain_sums(prose, monkeypatch):
    values = byte_values()
    texts = pa.array([prose(50), None, "", " x ", "y" * 300, prose(7, 2)])
    data, begins = buffers(texts)
    starts, ends, _ = find_words(data, begins)
    wanted = [plain_hash(data[a:b].tobytes(), values) for a, b in zip(starts, ends)]
    for size in (1, 16, 1 << 16):
        monkeypatch.setattr(words, "WINDOW_BYTES", size)
        assert hash_spans(data, starts, ends, values).tolist() == wanted
    # Whole texts, some of them empty.
    whole = [plain_hash((t or "").encode(), values) for t in texts.to_pylist()]
    assert hash_spans(data, begins[:-1], begins[1:], values).tolist() == whole


def test_order_within_owners(pick):
    owner = np.sort(np.array([pick.randrange(9) for _ in range(400)]))
    far = np.array([pick.getrandbits(64) for _ in range(400)], np.uint64)
    # Values that differ in their last bits only.
    near = far >> np.uint64(60)
    for values in (far, near, far[:0]):
        order = order_within(owner[: len(values)], values)
        assert values[order].tolist() == [v for _, v in sorted(zip(owner.tolist(), values.tolist()))]
        assert (owner[order] == owner[: len(values)]).all()
