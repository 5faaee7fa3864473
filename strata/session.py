"""Session settings and the shared folder for data written between steps."""

import contextlib
import contextvars
import functools
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SCRATCH = "strata_scratch"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def start(name: str = "strata", master: str | None = None, **settings: str) -> SparkSession:
    """Start a session; sizes (cores, memory, shuffle partitions) stay the cluster's."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="strata-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read, named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# SQL that clears what was made in a ``scratch`` scope, with its session.
_to_drop: contextvars.ContextVar[list[tuple[SparkSession, str]] | None] = contextvars.ContextVar(
    "to_drop", default=None
)


def _at_end(spark: SparkSession, sql: str) -> None:
    left = _to_drop.get()
    if left is not None:
        left.append((spark, sql))


def scratch_database(spark: SparkSession) -> str:
    """A database below the shared folder; another folder has another one."""
    folder = shared_folder(spark)
    name = f"{SCRATCH}_{hashlib.md5(folder.encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder}/{name}'")
    return name


def new_database(spark: SparkSession, label: str) -> str:
    """A database of its own below the shared folder, dropped with the scope."""
    name = f"{label}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark)}/{name}'")
    _at_end(spark, f"DROP DATABASE IF EXISTS {name} CASCADE")
    return name


def scratch_table(spark: SparkSession, label: str) -> str:
    """The name of a table to be made, dropped with the scope."""
    name = f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex}"
    _at_end(spark, f"DROP TABLE IF EXISTS {name}")
    return name


# Tables are written once and read a few times, so size counts for more than speed.
PACKED = {"compression": "zstd"}


def written(df: DataFrame, label: str, kind: str = "parquet", by: str | None = None) -> DataFrame:
    """Write the rows once as a table in the shared folder and read them back, so
    that later steps and retries see the same rows and values without running the
    plan before them again.

    ``by`` deals them into buckets by a column, as many as shuffle partitions: steps that
    group or join by it then read the rows where they lie. Rows that are not yet dealt by
    it, as a join by it leaves them, should be before."""
    spark = df.sparkSession
    name = scratch_table(spark, label)
    writer = df.write.format(kind)
    if kind == "parquet":
        writer = writer.options(**PACKED)
    if by:
        writer = writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), by).sortBy(by)
    writer.saveAsTable(name)
    return spark.table(name)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """Drop the tables and databases that are made inside, when their results are saved.
    Results that are used later need a scope around their use too; without a scope
    nothing is dropped."""
    left: list[tuple[SparkSession, str]] = []
    token = _to_drop.set(left)
    try:
        yield
    finally:
        _to_drop.reset(token)
        for spark, sql in left:
            spark.sql(sql)
