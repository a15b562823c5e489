"""Sinks: appended, merged, replaced and exported tables, and binary objects."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina.sources.tables import StoredTable


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names; a local one only on a local master that names none."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("name a shared folder in spark.checkpoint.dir: executors don't see each other's files")
        root = tempfile.mkdtemp(prefix="vetrina-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whether a query's shuffle files go as it ends; else they stay until the driver happens to collect its garbage.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table that is written inside go when it is written, as nothing reads them again."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: its readers share one computation, which outlives lost executors."""
    path = shared_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    if not _KEPT:
        atexit.register(clear_kept, df.sparkSession)
    _KEPT.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Tables that kept() has written and nobody has cleared.
_KEPT: list[str] = []


def clear_kept(spark: SparkSession, but: int = 0) -> int:
    """Deletes the tables of kept() except the first ones: frames that read them are of no use afterwards. Called as the driver ends."""
    gone = 0
    while len(_KEPT) > but:
        with contextlib.suppress(Exception):  # the session's JVM may have ended before
            path = spark._jvm.org.apache.hadoop.fs.Path(_KEPT[-1])
            gone += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
        _KEPT.pop()
    return gone


@contextlib.contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """The tables that kept() writes inside are deleted on leaving, as for a stream's batch, whose result is then written."""
    before = len(_KEPT)
    try:
        yield
    finally:
        clear_kept(spark, before)


def settled(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """make()'s frame as kept(), without the tables that kept() writes in making it: these go once it is written."""
    before = len(_KEPT)
    out = kept(make(), name)
    path = _KEPT.pop()
    clear_kept(spark, before)
    _KEPT.append(path)
    return out


def append(df: DataFrame, path: str, stamp: str | None = "created_at", label: str | None = None) -> bool:
    """Appends rows in one commit, with the time of writing where stamp names a column that df lacks; a label is committed once."""
    return StoredTable(df.sparkSession, path).append(df, label, stamp)


def unseen(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The rows to insert: one a key that the target lacks; the least row of a key by its columns."""
    rest = [c for c in incoming.columns if c != key]
    first = incoming.groupBy(key).agg(F.min(F.struct(*rest)).alias("x")).select(key, "x.*") if rest else incoming.distinct()
    return first.join(target.select(key), key, "left_anti")


def insert_counts(incoming: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """One row: inserted and duplicate rows of a merge."""
    new = unseen(incoming, target, key).agg(F.count("*"))
    return incoming.agg(F.count("*").alias("n"), new.scalar().alias("inserted")).select("inserted", (F.col("n") - F.col("inserted")).alias("duplicates"))


def insert_absent(df: DataFrame, path: str, key: str, label: str | None = None) -> bool:
    """Inserts the rows whose key the table lacks, in one commit."""
    return StoredTable(df.sparkSession, path).insert_absent(df, key, label)


def replace(df: DataFrame, path: str, label: str | None = None) -> bool:
    """Replaces a table's rows in one commit."""
    return StoredTable(df.sparkSession, path).replace(df, label)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last commit."""
    return StoredTable(spark, path).read()


def binary_objects(spark: SparkSession, path: str, wanted: DataFrame, key: str = "name", part: int = -1) -> DataFrame:
    """wanted with length and content of its objects, named by a part of their path; missing ones have nulls and their content is never read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path).select(
        F.element_at(F.split("path", "/"), part).alias(key), "length", "content")
    return wanted.join(found, key, "left")
