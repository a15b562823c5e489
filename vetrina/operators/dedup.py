"""De-duplication, ranking and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.operators.price import with_key
from vetrina.operators.ranks import ranked


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key; null keys are equal to each other."""
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_i") == 1).drop("_i")


def removed_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows that a de-duplication by keys removes."""
    return df.groupBy(*keys).count().agg(F.sum(F.col("count") - 1).alias("removed"))


def oldest_per(df: DataFrame, key: str, at: str, rest: list[str]) -> DataFrame:
    return df.groupBy(key).agg(F.min(F.struct(at, *rest)).alias("x")).select(key, "x.*")


def seeded_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """n rows, the same for one seed at any partitioning."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key).limit(n)


def chunks(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """Adds ``chunk``: batches of n rows of each key, in its order.

    A key's rows are ranked by ranges of (key, order) over the whole table, so that many tasks share a large key; a rank
    less the key's first gives the chunk.
    """
    rows = ranked(df, [key, *order], "_i")
    first = rows.groupBy(key).agg(F.min("_i").alias("_first"))
    return with_key(rows, first, key).withColumn("chunk", F.floor((F.col("_i") - F.col("_first")) / n).cast("int")).drop("_i", "_first")


def any_rows(*frames: DataFrame) -> DataFrame:
    """One row: whether any of the frames has a row; at most one of each is read."""
    out = None
    for df in frames:
        one = df.limit(1).select(F.lit(1).alias("x"))
        out = one if out is None else out.union(one)
    return out.agg((F.count("*") > 0).alias("found"))
