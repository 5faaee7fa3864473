"""Token counts from one pass over the trie of all distinct pre-tokens."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.pieces import Cuts, Pieces, find_pretokens, load_pieces, marked, pretokens, word_store
from strata.llm.store import HashStore
from strata.llm.words import buffers, byte_values, hash_spans


class _Merges:
    """Which piece ends the merges of a prefix, for models of BPE type.

    Merges happen in order of rank, and from the left among equals. A piece ``after`` that
    follows ``before`` stays apart from it if no merge takes place over the boundary: at
    no time do the part that then ends ``before`` and the part that then begins ``after``
    form a piece of lower rank than the merges that consume them.
    """

    def __init__(self, pieces: Pieces):
        self.ranks = {t: -s for t, s in zip(pieces.texts, pieces.scores)}
        self.ends: dict[str, list[tuple[str, float]]] = {}
        self.begins: dict[str, list[tuple[str, float]]] = {}

    def _halves(self, piece: str) -> list[str]:
        """The two parts that the last merge of a piece joins; more if none makes it."""
        parts = list(piece)
        while len(parts) > 2:
            ranked = [
                (self.ranks[a + b], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.ranks
            ]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def chains(self, piece: str) -> bool:
        """Learn the parts at both edges of a piece over time; false if no merges make it."""
        if piece in self.ends:
            return bool(self.ends[piece])
        right, left = [(piece, float("inf"))], [(piece, float("inf"))]
        halves = self._halves(piece) if len(piece) > 1 else []
        made = len(halves) in (0, 2) and all(self.chains(h) for h in halves)
        if made and halves:
            rank = self.ranks[piece]
            right += [(t, min(r, rank)) for t, r in self.ends[halves[1]]]
            left += [(t, min(r, rank)) for t, r in self.begins[halves[0]]]
        self.ends[piece], self.begins[piece] = (right, left) if made else ([], [])
        return made

    def apart(self, before: str, after: str) -> bool:
        for a, gone in self.ends[before]:
            for b, taken in self.begins[after]:
                rank = self.ranks.get(a + b)
                if rank is not None and rank < gone and rank <= taken:
                    return False
        return True


def _trie(pieces: Pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = dict(zip(pieces.texts, pieces.scores))
        longest, unknown = pieces.longest, pieces.unknown
        merges = _Merges(pieces) if pieces.merges else None
        # The path from the root to the node of the last word: best score and its pieces,
        # and for merges the last piece.
        path, scores, counts, lasts = "", [0.0], [0], [""]
        apart: dict[tuple[str, str], bool] = {}
        for batch in batches:
            found = []
            if len(apart) > 500_000:
                apart.clear()
            for word in batch.column("word").to_pylist():
                shared = 0
                for a, b in zip(path, word):
                    if a != b:
                        break
                    shared += 1
                del scores[shared + 1 :], counts[shared + 1 :], lasts[shared + 1 :]
                for end in range(shared + 1, len(word) + 1):
                    best, count, last = None, 0, ""
                    for start in range(max(0, end - longest), end):
                        piece = word[start:end]
                        score = table.get(piece)
                        if score is None:
                            if start < end - 1:
                                continue
                            score, more = unknown, len(piece.encode())
                        else:
                            more = 1
                        if merges:
                            pair = (lasts[start], piece)
                            fits = apart.get(pair)
                            if fits is None:
                                fits = apart[pair] = merges.chains(piece) and (
                                    not pair[0] or merges.apart(*pair)
                                )
                            if fits:  # no other piece can end here
                                best, count, last = 0.0, counts[start] + more, piece
                                break
                            continue
                        score += scores[start]
                        if best is None or score > best:
                            best, count = score, counts[start] + more
                    scores.append(best)
                    counts.append(count)
                    lasts.append(last)
                path = word
                found.append(counts[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(found, pa.int32())], names=["word", "tokens"]
            )

    return run


def count_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """``word`` and ``tokens``, the pieces of its segmentation: the one with the best score
    for a unigram model, that of the merges for a BPE model.

    Tasks walk their words in order, which is the walk of a trie from left to right: the
    forward scores of a prefix are computed once for all words that follow with it, and
    what is held is one path, not the trie. The rules are those of ``pieces.segment``.
    """
    return words.sortWithinPartitions("word").mapInArrow(_trie(pieces), "word string, tokens int")


def _counted(store: HashStore, seed: int, cuts: Cuts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = byte_values(seed, False)
        for batch in batches:
            data, begins = buffers(marked(batch.column("_text")))
            starts, ends, firsts = find_pretokens(data, begins, cuts)
            words, back = np.unique(hash_spans(data, starts, ends, values), return_inverse=True)
            total = np.append(0, np.cumsum(store.numbers(words, "tokens")[back]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(total[firsts[1:]] - total[firsts[:-1]]),
                    pa.array(np.diff(firsts)),
                ],
                names=["_id", "n_tokens", "n_pretokens"],
            )

    return run


def count_tokens(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", pieces: Pieces | None = None
) -> DataFrame:
    """``_id``, ``n_tokens`` and ``n_pretokens`` of every row. Null and empty texts have
    none; rows are never dropped or merged, and other columns are not read."""
    pieces = pieces or load_pieces()
    store, seed = word_store(count_words(pretokens(docs, text, pieces), pieces), "tokens", "counted")
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        _counted(store, seed, pieces.cuts), f"_id {kind}, n_tokens bigint, n_pretokens bigint"
    )
