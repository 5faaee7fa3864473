"""Sorted hash arrays in the shared folder, memory-mapped by the tasks that look up.

A store has shards by the upper bits of a hash. A shard is a few flat files: sorted
hashes and, in their order, values. Tasks write a shard under a name of their own and
rename it, so a retry or a second attempt leaves whole files only. Readers map the files
and so need the shared folder mounted; pages that are not used cost no memory.
"""

import os
import uuid
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import fresh_path


def mounted_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a path that tasks can open."""
    parsed = urlparse(fresh_path(spark, label))
    if parsed.scheme not in ("", "file"):
        raise ValueError(
            f"spark.checkpoint.dir is {parsed.scheme}://; files to be memory-mapped need a mounted folder"
        )
    return unquote(parsed.path)


def save(folder: str, shard: int, name: str, values: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    own = f"{folder}/{name}-{shard:06d}.{uuid.uuid4().hex}.part"
    with open(own, "wb") as f:
        np.save(f, values)
    os.replace(own, f"{folder}/{name}-{shard:06d}.npy")


def load(folder: str, shard: int, name: str) -> np.ndarray | None:
    path = Path(f"{folder}/{name}-{shard:06d}.npy")
    if not path.exists():
        return None
    values = np.load(path, mmap_mode="r")
    return values if len(values) else None


def shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def shard_column(hash_column: str, bits: int):
    """The same for a bigint column that holds the bits of the hash."""
    return F.shiftrightunsigned(hash_column, 64 - bits).cast("int") if bits else F.lit(0)


def shard_bits(rows: int, per_shard: int = 1_000_000) -> int:
    bits = 0
    while (rows >> bits) > per_shard:
        bits += 1
    return bits


class HashStore:
    """Looks up hashes; a value may be a number or a run of numbers."""

    def __init__(self, folder: str, bits: int, sizes: np.ndarray):
        self.folder, self.bits, self.sizes = folder, bits, sizes
        self.bases = np.append(0, np.cumsum(sizes))
        self.held: dict[tuple[int, str], np.ndarray | None] = {}

    def __getstate__(self):
        return {**self.__dict__, "held": {}}

    def part(self, shard: int, name: str) -> np.ndarray | None:
        if (shard, name) not in self.held:
            values = load(self.folder, shard, name)
            if values is None and name == "hash" and self.sizes[shard]:
                raise FileNotFoundError(
                    f"shard {shard} of {self.folder} has {self.sizes[shard]} hashes but no file here; "
                    "spark.checkpoint.dir must be mounted on every executor"
                )
            self.held[shard, name] = values
        return self.held[shard, name]

    def find(self, hashes: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """For sorted hashes, shard by shard: its number, the slice of hashes, where they
        are in the shard, and whether they are there."""
        shards = shard_of(hashes, self.bits)
        cuts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(hashes) else []
        ends = np.append(cuts[1:], len(hashes)) if len(hashes) else []
        for a, b in zip(cuts, ends):
            known = self.part(int(shards[a]), "hash")
            if known is None:
                continue
            at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
            yield int(shards[a]), slice(a, b), at, known[at] == hashes[a:b]

    def numbers(self, hashes: np.ndarray, name: str, missing: int = 0) -> np.ndarray:
        """The number of each of the sorted hashes."""
        out = np.full(len(hashes), missing, np.int64)
        for shard, where, at, there in self.find(hashes):
            out[where] = np.where(there, self.part(shard, name)[at], missing)
        return out

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each of the sorted hashes among all of the store; -1 if missing."""
        out = np.full(len(hashes), -1, np.int64)
        for shard, where, at, there in self.find(hashes):
            out[where] = np.where(there, at + self.bases[shard], -1)
        return out

    def runs(self, hashes: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray]:
        """All runs of the sorted hashes, one after another, and the first of each."""
        parts = [np.zeros(0, np.int32)]
        sizes = np.zeros(len(hashes), np.int64)
        for shard, where, at, there in self.find(hashes):
            begins, values = self.part(shard, f"{name}_begin"), self.part(shard, name)
            low = begins[at]
            size = np.where(there, begins[at + 1] - low, 0)
            sizes[where] = size
            total = np.cumsum(size)
            place = np.arange(total[-1]) - np.repeat(total - size, size) + np.repeat(low, size)
            parts.append(values[place] if values is not None else np.zeros(0, np.int32))
        return np.concatenate(parts), np.append(0, np.cumsum(sizes))


def _write(folder: str, name: str, runs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def flush():
            table = pa.Table.from_batches(held).combine_chunks()
            hashes = table.column("hash").to_numpy().view(np.uint64)
            column = table.column(name).combine_chunks()
            save(folder, last, "hash", hashes)
            if runs:
                begins = column.offsets.to_numpy().astype(np.int64)
                save(folder, last, f"{name}_begin", begins - begins[0])
                save(folder, last, name, column.flatten().to_numpy())
            else:
                save(folder, last, name, column.to_numpy())
            same = int((hashes[1:] == hashes[:-1]).sum())
            return pa.RecordBatch.from_pydict(
                {"shard": pa.array([last], pa.int32()), "rows": [len(hashes)], "same": [same]}
            )

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(shards) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(shards)) if len(shards) else []):
                if last is not None and shards[a] != last:
                    yield flush()
                    held = []
                last = int(shards[a])
                held.append(batch.slice(int(a), int(b - a)))
        if held:
            yield flush()

    return run


def write_store(rows: DataFrame, name: str, count: int, label: str) -> tuple[HashStore, int]:
    """Write ``hash`` and the column ``name`` (a number or an array of them), and say how
    many hashes are there twice. Tasks hold a shard at a time."""
    bits = shard_bits(count)
    folder = mounted_folder(rows.sparkSession, label)
    runs = rows.schema[name].dataType.typeName() == "array"
    dealt = rows.select("hash", name, shard_column("hash", bits).alias("shard")).repartition(
        max(1, 1 << bits), "shard"
    )
    # Unsigned order: the sign bit set sorts last.
    dealt = dealt.sortWithinPartitions("shard", F.col("hash") < 0, "hash")
    done = dealt.mapInArrow(_write(folder, name, runs), "shard int, rows bigint, same bigint")
    # One row per shard.
    found = {r["shard"]: r for r in done.collect()}
    sizes = np.array([found[i]["rows"] if i in found else 0 for i in range(1 << bits)], np.int64)
    return HashStore(folder, bits, sizes), sum(r["same"] for r in found.values())
