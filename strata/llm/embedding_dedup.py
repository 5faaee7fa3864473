"""Near copies of embeddings: random projections decoded to points of the E8 lattice, with
probes of neighbouring points, and exact cosine within blocks."""

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.shared import NUMBERS, broadcast_if_small, grouped, kept, session
from strata.llm.similarity import BLOCK_ROWS, in_blocks, local_roots, sides
from strata.llm.words import MULTIPLIER, constants, mix

# With these, two vectors at a cosine of 0.93 share a point or a probe in one table with a
# chance of 0.57, so in some table with 0.99.
TABLES = 6
PROBES = 4
SCALE = 0.8
SEED = 41


def lattice_roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of 1 or -1, or all of a half with an
    even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            out.append(v)
    halves = itertools.product((0.5, -0.5), repeat=8)
    out += [np.array(h) for h in halves if sum(x < 0 for x in h) % 2 == 0]
    return np.array(out)


ROOTS = lattice_roots()


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where rounding makes it odd, the worst
    coordinate is rounded the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is the even points and these moved by a half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def _point_keys(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hashes of lattice points, (..., 8), with a salt per row."""
    whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
    with np.errstate(over="ignore"):
        total = salt.copy()
        for i, factor in enumerate(constants(8, 31)):
            total = mix(total + whole[..., i] * factor)
    return total | np.uint64(1)


def point_keys(units: np.ndarray, salt: np.ndarray, tables: int, probes: int, scale: float):
    """Per row and table the key of its point, and those of the nearest points around it."""
    size = units.shape[1]
    maps = np.random.default_rng(SEED).normal(size=(tables, size, 8)) * scale
    own = np.empty((len(units), tables), np.uint64)
    near = np.empty((len(units), tables, probes), np.uint64)
    with np.errstate(over="ignore"):
        for t in range(tables):
            x = units @ maps[t]
            point = nearest(x)
            cost = -2 * (x - point) @ ROOTS.T + (ROOTS**2).sum(1)
            around = np.argpartition(cost, probes, axis=1)[:, :probes]
            salted = salt + np.uint64(t + 1) * MULTIPLIER
            own[:, t] = _point_keys(point, salted)
            moved = point[:, None, :] + ROOTS[around]
            near[:, t] = _point_keys(moved, np.repeat(salted[:, None], probes, 1))
    return own, near


def _keys(tables: int, probes: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("_label").to_pylist()
            rows = batch.column("_vector").to_pylist()
            vectors: dict[int, list[int]] = {}
            parsed = [None] * len(rows)
            for i, (label, row) in enumerate(zip(labels, rows)):
                if label is None or not row or None in row:
                    continue
                vector = np.array(row, float)
                if np.isfinite(vector).all() and vector.any():
                    parsed[i] = vector
                    vectors.setdefault(len(row), []).append(i)
            names, keys = [None] * len(rows), [None] * len(rows)
            for size, places in vectors.items():
                stacked = np.stack([parsed[i] for i in places])
                stacked = stacked / np.abs(stacked).max(1)[:, None]
                units = stacked / np.linalg.norm(stacked, axis=1)[:, None]
                marks = [repr((labels[i], size)).encode() for i in places]
                salt = np.array(
                    [int.from_bytes(hashlib.md5(m).digest()[:8], "little") for m in marks], np.uint64
                )
                own, near = point_keys(units, salt, tables, probes, scale)
                every = np.concatenate([own[:, :, None], near], 2).reshape(len(places), -1)
                for i, mark, found in zip(places, marks, every.view(np.int64)):
                    names[i] = hashlib.md5(mark + parsed[i].tobytes()).digest()
                    keys[i] = found
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(names, pa.binary()),
                    pa.array([None if x is None else x.tobytes() for x in parsed], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["_id", "cls", "vector", "keys"],
            )

    return run


def _verify(cosine: float, tables: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, ["key", "bi", "bj"]):
            left, right = sides(
                rows.column("block").to_numpy(), rows.column("bi")[0].as_py(), rows.column("bj")[0].as_py()
            )
            if not len(left) or not len(right):
                continue
            names = np.array(rows.column("cls").to_pylist(), object)
            copies = rows.column("copies").to_numpy()
            vectors = np.stack([np.frombuffer(x.as_py(), float) for x in rows.column("vector")])
            vectors = vectors / np.abs(vectors).max(1)[:, None]
            units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
            linked = units[left] @ units[right].T >= cosine
            if left is right:
                linked = np.triu(linked, 1)
            if not linked.any():
                continue
            a, b = np.nonzero(linked)
            keys = np.stack([np.array(x) for x in rows.column("keys").to_pylist()])
            keys = keys.reshape(len(names), tables, probes + 1)
            mine, theirs = keys[left[a]], keys[right[b]]
            # The key by which a pair counts: of the first table that brings it together.
            first = np.zeros(len(a), np.int64)
            for t in reversed(range(tables)):
                p, q = mine[:, t, :1], theirs[:, t, :1]
                to_p = (p == theirs[:, t]).any(1)
                to_q = (q == mine[:, t]).any(1)
                both = np.where(to_p & to_q, np.minimum(p[:, 0], q[:, 0]), np.where(to_p, p[:, 0], q[:, 0]))
                first = np.where(to_p | to_q, both, first)
            here = first == rows.column("key")[0].as_py()
            if not here.any():
                continue
            a, b = left[a[here]], right[b[here]]
            order = np.argsort(names)
            rank = np.empty(len(names), np.int64)
            rank[order] = np.arange(len(names))
            root = names[order][local_roots(len(names), rank[a], rank[b])][rank]
            links = np.zeros(len(names), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[some].tolist(), pa.binary()),
                    pa.array(root[some].tolist(), pa.binary()),
                    pa.array(links[some]),
                ],
                names=["cls", "root", "links"],
            )

    return run


def link_embeddings(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = 0.93,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
) -> DataFrame:
    """Per row: ``_id``, ``n_links``, the number of other rows linked directly,
    ``component_id``, the smallest id reachable, and ``kept``, whether it is the row's own.

    Rows link if their labels are equal and their cosine, in double precision, reaches
    ``cosine``. Candidates share a lattice point in one of the tables, or one has the
    other's point among its ``probes`` nearest. Equal vectors of a label are one class, so
    copies cost nothing; large groups are compared in blocks, and only sums leave them.

    A vector that is null, empty, zero, or has null or non-finite parts links with nothing,
    nor does one without label; it is its own component. Vectors of different length do not
    link. A row without id is never a component's smallest unless all lack one. Repeated
    rows are links of each other. Other columns are not read.
    """
    session(vectors)
    source = vectors.select(
        F.col(f"`{vec_id}`").alias("_id"),
        F.col(f"`{label}`").cast("string").alias("_label"),
        F.col(f"`{vector}`").alias("_vector"),
    )
    kind = source.schema["_id"].dataType.simpleString()
    rows = kept(
        source.mapInArrow(
            _keys(tables, probes, scale),
            f"_id {kind}, cls binary, vector binary, keys array<bigint>",
        ),
        "lattice",
    )
    classes = kept(
        rows.where("cls IS NOT NULL")
        .groupBy("cls", "vector", "keys")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("first")),
        "vectors",
    )
    keyed = classes.select("cls", F.posexplode("keys").alias("place", "key"))
    own = (F.col("place") % (probes + 1) == 0).cast("int")
    met = (
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.max(own).alias("own"))
        .where("n > 1 AND own = 1")
    )
    met = kept(
        met.select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "points"
    )
    members = (
        classes.select("cls", "copies", "vector", "keys", F.explode("keys").alias("key"))
        .join(broadcast_if_small(met, met.count(), NUMBERS), "key")
        .select("key", "cls", "copies", "vector", "keys", "blocks")
    )
    found = kept(
        in_blocks(members, "cls", "blocks", ["key"]).mapInArrow(
            _verify(cosine, tables, probes), "cls binary, root binary, links bigint"
        ),
        "links",
    )
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    described = (
        classes.select("cls", "copies", "first")
        .join(counts, "cls", "left")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    lowest = described.groupBy("root").agg(F.min("first").alias("lowest"))
    known = described.join(lowest, "root").select(
        "cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "lowest"
    )
    component = F.when(F.col("cls").isNull(), F.col("_id")).otherwise(F.col("lowest"))
    return (
        rows.select("_id", "cls")
        .join(known, "cls", "left")
        .select("_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.col("_id").eqNullSafe(F.col("component_id")))
    )
