import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.store import write_store


def test_places_and_numbers(spark):
    rows = spark.range(50).select(F.xxhash64("id").alias("hash"), F.col("id").alias("n"))
    store, twice = write_store(rows, "n", 50, "some")
    known = {r["hash"]: r["n"] for r in rows.collect()}
    hashes = np.sort(np.array([*known, 12345], np.int64).view(np.uint64))
    found = store.numbers(hashes, "n", -1)
    assert twice == 0
    assert found.tolist() == [known.get(int(h), -1) for h in hashes.view(np.int64)]
    assert (store.places(hashes) >= 0).tolist() == [int(h) in known for h in hashes.view(np.int64)]


def test_a_lost_shard_is_an_error(spark):
    store, _ = write_store(spark.range(3).select(F.col("id").alias("hash"), "id"), "id", 3, "lost")
    store.folder += "-elsewhere"
    with pytest.raises(FileNotFoundError, match="mounted"):
        store.places(np.arange(3, dtype=np.uint64))
    empty, _ = write_store(spark.range(0).select(F.col("id").alias("hash"), "id"), "id", 0, "none")
    assert empty.places(np.arange(3, dtype=np.uint64)).tolist() == [-1] * 3
