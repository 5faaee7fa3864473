"""MinHash LSH forest: signatures as byte strings, whose order is that of a trie's leaves,
and prefixes of them that are as short as the wanted recall asks for."""

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import NUMBERS, broadcast_if_small, kept
from strata.llm.words import constants, mix

# Bytes of a minimum in a signature.
WIDTH = 4

# A node with more texts is crowded.
CROWD = 256


@dataclass(frozen=True)
class Forest:
    """``trees`` tries of signatures of ``depth`` minima each. Two texts meet in a tree if
    they share the prefix that is wanted there; a text of fewer than ``least`` shingles is
    left out.

    Prefixes are shortened from whole signatures to ``shortest`` minima, at which pairs at
    ``similarity`` share one in some tree with the wanted ``recall``. In ``spare`` trees a
    text may keep longer ones and the recall still holds, so that it does in the trees
    where most others share its short prefix. A node is shortened for all its texts if
    for any, and pairs of texts therefore lose no more than these trees.
    """

    trees: int
    depth: int
    recall: float
    words: int = 5
    similarity: float = 0.8
    least: int = 1
    crowd: int = CROWD

    @property
    def tables(self) -> int:
        return self.trees

    @property
    def key_type(self) -> str:
        return "array<binary>"

    def missed(self, prefix: int, longer: int = 0) -> float:
        """Share of pairs at the threshold that no tree brings together, if ``longer``
        trees have whole signatures and the others prefixes of that length."""
        short = 1 - self.similarity**prefix
        whole = 1 - self.similarity**self.depth
        return short ** (self.trees - longer) * whole**longer

    @property
    def shortest(self) -> int:
        """The longest prefix with the wanted recall in all trees, one minimum at least."""
        at = self.depth
        while at > 1 and self.missed(at) > 1 - self.recall:
            at -= 1
        return at

    @property
    def spare(self) -> int:
        """Trees in which a text's prefix may be longer than the shortest one."""
        trees = 0
        while trees < self.trees and self.missed(self.shortest, trees + 1) <= 1 - self.recall:
            trees += 1
        return trees

    def signed(self, found: np.ndarray, firsts: np.ndarray) -> pa.Array:
        """Per text its signature in each tree."""
        count = len(firsts) - 1
        full = np.flatnonzero(np.diff(firsts) > 0)
        minima = np.zeros((count, self.trees * self.depth), ">u4")
        if len(full):
            with np.errstate(over="ignore"):
                for i, factor in enumerate(constants(self.trees * self.depth, 11)):
                    spread = found * factor
                    spread ^= spread >> np.uint64(29)
                    least = mix(np.minimum.reduceat(spread, firsts[full]))
                    minima[full, i] = (least >> np.uint64(32)).astype(np.uint32)
        total = count * self.trees
        ends = np.arange(total + 1, dtype=np.int32) * (self.depth * WIDTH)
        each = pa.Array.from_buffers(
            pa.binary(), total, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(minima.tobytes())]
        )
        return pa.ListArray.from_arrays(pa.array(np.arange(0, total + 1, self.trees, dtype=np.int32)), each)

    def meeting(self, classes: DataFrame) -> DataFrame:
        """cls, n, tree and key of the prefixes that ``classes`` share with others."""
        leaves = classes.select("cls", "n", F.posexplode("keys").alias("tree", "leaf"))
        short = leaves.withColumn("key", _prefix(F.lit(self.shortest)))
        shared = kept(
            short.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "nodes"
        )
        short = kept(short.join(broadcast_if_small(shared, shared.count(), NUMBERS), "key"), "short")
        crowded = short.where(F.col("members") > self.crowd)
        most = F.sort_array(F.collect_list(F.struct("members", "key")), asc=False)
        # No more than one node a tree and class.
        needed = (
            crowded.groupBy("cls")
            .agg(most.alias("nodes"))
            .select(F.explode(F.slice("nodes", self.spare + 1, self.trees)).alias("node"))
            .select("node.key")
        )
        needed = kept(needed.distinct(), "needed")
        small = broadcast_if_small(needed, needed.count(), NUMBERS)
        long = kept(crowded.join(small, "key", "left_anti"), "long")
        stay = long.select("key").distinct()
        lengths = F.sequence(F.lit(min(self.shortest + 1, self.depth)), F.lit(self.depth))
        tried = long.select("cls", "n", "tree", "leaf", F.explode(lengths).alias("length"))
        tried = tried.withColumn("key", _prefix(F.col("length")))
        fitting = (
            tried.groupBy("key", "length")
            .agg(F.count(F.lit(1)).alias("members"))
            .where((F.col("members") <= self.crowd) | (F.col("length") == self.depth))
            .select("key")
        )
        longer = (
            tried.join(fitting, "key")
            .groupBy("cls", "n", "tree")
            .agg(F.min_by("key", "length").alias("key"))
        )
        stays = broadcast_if_small(stay, stay.count(), NUMBERS)
        columns = ["cls", "n", "tree", "key"]
        return short.join(stays, "key", "left_anti").select(columns).union(longer.select(columns))


def _prefix(length: Column) -> Column:
    return F.xxhash64("tree", F.substring("leaf", F.lit(1), length * WIDTH))
