"""Near copies by MinHash: texts to classes of equal shingle sets, candidates from
tables of signatures, exact Jaccard within blocks, links counted without listing pairs."""

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.components import components
from strata.llm.forest import Forest
from strata.llm.shared import NUMBERS, broadcast_if_small, kept, session
from strata.llm.words import (
    MULTIPLIER,
    buffers,
    byte_values,
    constants,
    find_words,
    hash_spans,
    mix,
    order_within,
    shingles,
)

# A group is compared in blocks of so many rows and shingles at most.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1_000_000
COLUMNS = 4_096

# Groups of no more rows are compared many at once.
SMALL_ROWS = 32


@dataclass(frozen=True)
class Tables:
    """``tables`` keys of ``rows`` minima each; a text of fewer than ``least`` shingles
    is left out."""

    tables: int
    rows: int
    words: int = 5
    similarity: float = 0.8
    least: int = 1

    @property
    def key_type(self) -> str:
        return "array<bigint>"

    def recall(self, similarity: float) -> float:
        """Share of pairs of that similarity which some table brings together."""
        return 1 - (1 - similarity**self.rows) ** self.tables

    def signed(self, found: np.ndarray, firsts: np.ndarray) -> pa.Array:
        """A key per text and table, from the minima of ``rows`` hash functions. Keys of
        different tables differ."""
        full = np.flatnonzero(np.diff(firsts) > 0)
        keys = np.zeros((len(firsts) - 1, self.tables), np.uint64)
        if len(full):
            factors = constants(self.tables * self.rows, 11)
            order = constants(self.rows, 13)
            with np.errstate(over="ignore"):
                for i, factor in enumerate(factors):
                    table, row = divmod(i, self.rows)
                    spread = found * factor
                    spread ^= spread >> np.uint64(29)
                    least = np.minimum.reduceat(spread, firsts[full])
                    keys[full, table] += mix(least) * order[row]
                numbers = np.arange(1, self.tables + 1, dtype=np.uint64) * MULTIPLIER
                keys = mix(keys + numbers) | np.uint64(1)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(0, keys.size + 1, self.tables, dtype=np.int32)),
            pa.array(keys.view(np.int64).ravel()),
        )

    def meeting(self, classes: DataFrame) -> DataFrame:
        """cls, n, tree and key of the keys that ``classes`` share with others."""
        keyed = classes.select("cls", "n", F.posexplode("keys").alias("tree", "key"))
        shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = kept(shared.select("key"), "met")
        return keyed.join(broadcast_if_small(shared, shared.count(), NUMBERS), "key")


@dataclass(frozen=True)
class Links:
    """``rows``: the given columns and cls; ``classes``: cls, copies, the first row (a
    missing value comes first), the lowest value of the first column (a missing one does
    not count), n_links of one copy, root of the component."""

    rows: DataFrame
    classes: DataFrame


def _sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each text, sorted and distinct, and each text's first."""
    data, begins = buffers(texts)
    starts, ends, firsts = find_words(data, begins)
    found, firsts = shingles(hash_spans(data, starts, ends, byte_values()), firsts, words)
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    found = found[order_within(owner, found)]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(firsts)))


def _class(found: np.ndarray) -> bytes:
    return hashlib.md5(found.tobytes()).digest()


def _signatures(columns: list[str], schema: list[str], spec: Tables | Forest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, firsts = _sets(batch.column("_text"), spec.words)
            sizes = np.diff(firsts)
            enough = sizes >= max(spec.least, 1)
            names = [
                _class(found[a:b]) if ok else None
                for a, b, ok in zip(firsts[:-1], firsts[1:], enough)
            ]
            out = [batch.column(c) for c in columns]
            out += [pa.array(names, pa.binary()), pa.array(sizes.astype(np.int32)), spec.signed(found, firsts)]
            yield pa.RecordBatch.from_arrays(out, names=schema)

    return run


def _payloads(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, firsts = _sets(batch.column("_text"), words)
            parts = [found[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_class(p) for p in parts], pa.binary()),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["cls", "found"],
            )

    return run


def in_blocks(members: DataFrame, node: str, blocks: str, keys: list[str]) -> DataFrame:
    """Deal the members of each group, named by ``keys``, to pairs of blocks. Every two
    members meet in exactly one pair, which holds no more than two blocks. Rows of a pair
    come together and in order: keys, bi, bj; ``block`` says which block a row is from.
    """
    count = F.col(blocks)
    own = F.pmod(F.xxhash64(node, F.lit(17)), count).cast("int")
    dealt = members.withColumn("block", own).withColumn(
        "_with", F.explode(F.sequence(F.lit(0), (count - 1).cast("int")))
    )
    dealt = dealt.withColumn("bi", F.least("block", "_with")).withColumn(
        "bj", F.greatest("block", "_with")
    )
    order = [*keys, "bi", "bj"]
    return dealt.drop("_with", blocks).repartition(*order).sortWithinPartitions(*order)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links left[i]-right[i]."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def sides(block: np.ndarray, bi: int, bj: int) -> tuple[np.ndarray, np.ndarray]:
    if bi == bj:
        every = np.arange(len(block))
        return every, every
    return np.flatnonzero(block == bi), np.flatnonzero(block == bj)


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections, from products over the shingles that repeat."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((len(left), len(right)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held[left] @ held[right].T
    return out


def _common(found: np.ndarray, owner: np.ndarray, group: np.ndarray, last: np.ndarray):
    """All pairs of rows of a group, the earlier first, and the sizes of the
    intersections. ``found`` are the shingles, ``owner`` their rows, ``group`` the group of
    each row and ``last`` the end of its rows."""
    n = len(group)
    later = last - np.arange(n) - 1
    begins = np.cumsum(later) - later
    a = np.repeat(np.arange(n), later)
    b = np.arange(len(a)) - np.repeat(begins, later) + a + 1
    sizes = np.zeros(len(a), np.int64)
    order = order_within(group[owner], found)
    found, owner = found[order], owner[order]
    # Rows in order among those with an equal shingle.
    same = np.append(False, (found[1:] == found[:-1]) & (group[owner[1:]] == group[owner[:-1]]))
    at, step = np.flatnonzero(same), 1
    while len(at):
        x, y = owner[at - step], owner[at]
        x, y = np.minimum(x, y), np.maximum(x, y)
        sizes += np.bincount(begins[x] + y - x - 1, minlength=len(a))
        # The one before that is equal too.
        at, step = at[same[at - step]], step + 1
    return a, b, sizes


def _shingles(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all rows, one after another, and their number in each."""
    sizes = pc.binary_length(found).to_numpy().astype(np.int64) // 8
    return np.frombuffer(b"".join(found.to_pylist()), np.uint64), sizes


def _places(rows: pa.Table, tables: int) -> np.ndarray:
    """Bucket of each row in each table; 0 if it has none."""
    lists = rows.column("places").combine_chunks()
    each = lists.flatten()
    out = np.zeros((len(lists), tables), np.int64)
    own = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    out[own, pc.struct_field(each, "tree").to_numpy()] = pc.struct_field(each, "bucket").to_numpy()
    return out


def _pairs_of_small(rows: pa.Table, ends: np.ndarray, similarity: float):
    """Linked pairs within groups, which end at ``ends``."""
    found, sizes = _shingles(rows.column("found").combine_chunks())
    size = np.diff(np.append(0, ends))
    group = np.repeat(np.arange(len(ends)), size)
    a, b, common = _common(found, np.repeat(np.arange(len(group)), sizes), group, np.repeat(ends, size))
    block, bi, bj = (rows.column(c).to_numpy() for c in ("block", "bi", "bj"))
    across = (bi[a] == bj[a]) | (block[a] != block[b])
    linked = across & (common >= similarity * (sizes[a] + sizes[b] - common) - 1e-9)
    return a[linked], b[linked]


def _pairs_of_large(rows: pa.Table, similarity: float):
    """Linked pairs of one group."""
    found, sizes = _shingles(rows.column("found").combine_chunks())
    left, right = sides(rows.column("block").to_numpy(), rows.column("bi")[0].as_py(), rows.column("bj")[0].as_py())
    if not len(left) or not len(right):
        return left[:0], right[:0]
    common = _overlaps(np.split(found, np.cumsum(sizes)[:-1]), left, right)
    either = sizes[left][:, None] + sizes[right][None, :] - common
    linked = common >= similarity * either - 1e-9
    if left is right:
        linked = np.triu(linked, 1)
    a, b = np.nonzero(linked)
    return left[a], right[b]


def _linked(rows: pa.Table, a: np.ndarray, b: np.ndarray, tables: int) -> pa.RecordBatch:
    """Roots and links of the rows from their linked pairs, but for pairs that meet in an
    earlier table."""
    if len(a):
        places = _places(rows, tables)
        mine, theirs = places[a], places[b]
        before = np.arange(tables) < rows.column("tree").to_numpy()[a][:, None]
        new = ~(before & (mine == theirs) & (mine != 0)).any(axis=1)
        a, b = a[new], b[new]
    names, copies = rows.column("cls").combine_chunks(), rows.column("copies").to_numpy()
    rank = pc.rank(names, sort_keys="ascending", tiebreaker="first").to_numpy().astype(np.int64) - 1
    by_rank = np.argsort(rank)
    root = by_rank[local_roots(len(names), rank[a], rank[b])][rank]
    links = np.zeros(len(names), np.int64)
    np.add.at(links, a, copies[b])
    np.add.at(links, b, copies[a])
    some = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(some)), names.take(pa.array(root[some])), pa.array(links[some])],
        names=["cls", "root", "links"],
    )


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows, cut between groups of equal keys, and where the groups end. No more is
    held than a batch and a group."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool):
        rows = pa.Table.from_batches(held)
        new = np.zeros(rows.num_rows - 1, bool)
        for k in keys:
            values = rows.column(k).to_numpy()
            new |= values[1:] != values[:-1]
        ends = np.flatnonzero(new) + 1
        return rows, np.append(ends, rows.num_rows) if last else ends

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        # While one group goes on, it is only added to.
        if len(held) > 1 and all(held[0].column(k)[0] == batch.column(k)[-1] for k in keys):
            continue
        rows, ends = cut(False)
        if len(ends):
            yield rows.slice(0, int(ends[-1])), ends
            held = rows.slice(int(ends[-1])).to_batches()
    if held:
        yield cut(True)


def _verify(similarity: float, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, ends in _whole(batches, ["bucket", "bi", "bj"]):
            size = np.diff(np.append(0, ends))
            for i in np.flatnonzero(size > SMALL_ROWS).tolist():
                large = rows.slice(int(ends[i] - size[i]), int(size[i]))
                yield _linked(large, *_pairs_of_large(large, similarity), tables)
            few = size <= SMALL_ROWS
            small, ends = rows.filter(pa.array(np.repeat(few, size))), np.cumsum(size[few])
            total = pc.sum(pc.binary_length(small.column("found"))).as_py() or 0
            # Groups of long texts are fewer at once.
            for part in np.array_split(np.arange(len(ends)), min(max(len(ends), 1), 1 + total // (8 * BLOCK_SHINGLES))):
                if len(part):
                    low = int(ends[part[0] - 1]) if part[0] else 0
                    some = small.slice(low, int(ends[part[-1]]) - low)
                    yield _linked(some, *_pairs_of_small(some, ends[part] - low, similarity), tables)

    return run


def links(source: DataFrame, columns: list[str], spec: Tables | Forest) -> Links:
    """Link the texts ``_text`` of ``source`` whose shingle sets are similar enough.
    ``columns`` name a row. A text without enough words has no class and no link.

    Equal sets are one class, however many rows have them. Classes that share a key in
    a table, or a prefix in a tree, meet in a group; a group with the very members of another is dropped, and a
    pair is counted in the first table that brings it together. Large groups are cut
    into blocks, so that a task holds two blocks, and only sums leave them.
    """
    session(source)
    more = StructType.fromDDL(f"cls binary, n int, keys {spec.key_type}")
    schema = StructType([*(source.schema[c] for c in columns), *more])
    names = [*columns, "cls", "n", "keys"]
    rows = kept(
        source.select(*columns, "_text").mapInArrow(_signatures(columns, names, spec), schema),
        "signatures",
    )
    first = F.min(F.struct(*columns)).alias("first")
    classes = kept(
        rows.where("cls IS NOT NULL")
        .groupBy("cls", "n", "keys")
        .agg(F.count(F.lit(1)).alias("copies"), first, F.min(columns[0]).alias("lowest")),
        "classes",
    )
    # Keys alone find out which meet at all; most do not, and only the rest goes on.
    keyed = kept(spec.meeting(classes), "keyed")
    member = F.xxhash64("cls")
    groups = (
        keyed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("n").alias("total"),
            F.bit_xor(member).alias("members"),
            F.min("cls").alias("low"),
        )
        .where("rows > 1")
        .groupBy("rows", "total", "members", "low")
        .agg(F.min("key").alias("key"))
    )
    blocks = F.ceil(F.greatest(F.col("rows") / BLOCK_ROWS, F.col("total") / BLOCK_SHINGLES))
    groups = groups.select("key", blocks.cast("int").alias("blocks"))
    place = F.struct("tree", F.col("key").alias("bucket"), "blocks")
    places = kept(
        keyed.join(groups, "key")
        .groupBy("cls")
        .agg(F.sort_array(F.collect_list(place)).alias("places"))
        .join(classes.select("cls", "copies", "first"), "cls"),
        "places",
    )
    wanted = places.select("first.*").distinct()
    same = _same(columns)
    again = (
        source.select(*columns, "_text")
        .alias("s")
        .join(broadcast_if_small(wanted, places.count()).alias("w"), same, "left_semi")
        .select("_text")
        .mapInArrow(_payloads(spec.words), "cls binary, found binary")
        .dropDuplicates(["cls"])
    )
    members = (
        places.drop("first")
        .join(again, "cls")
        .withColumn("_place", F.explode("places"))
        .select("*", "_place.*")
        .drop("_place")
    )
    found = kept(
        in_blocks(members, "cls", "blocks", ["bucket"]).mapInArrow(
            _verify(spec.similarity, spec.tables), "cls binary, root binary, links bigint"
        ),
        "links",
    )
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    described = (
        classes.select("cls", "copies", "first", "lowest")
        .join(counts, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .select(
            "cls",
            "copies",
            "first",
            "lowest",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "cls").alias("root"),
        )
    )
    return Links(rows.drop("n", "keys"), described)


def _same(columns: list[str]) -> Column:
    out: Callable = lambda c: F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}"))
    same = out(columns[0])
    for c in columns[1:]:
        same = same & out(c)
    return same
