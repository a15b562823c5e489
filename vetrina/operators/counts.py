"""Operational counts over tasks, resources, states and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def status_counts(tasks: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return tasks.groupBy("status").pivot("kind", list(kinds)).count().na.fill(0)


def pool_counts(pool: DataFrame) -> DataFrame:
    return pool.agg(F.count_if(~F.col("is_blocked") & ~F.col("is_in_use")).alias("available"), F.count_if(F.col("is_in_use") & ~F.col("is_blocked")).alias("in_use"),
                    F.count_if("is_blocked").alias("blocked"), F.count("*").alias("total"))


def state_counts(keys: DataFrame) -> DataFrame:
    """A row a state, and the total with a null state."""
    return keys.rollup("state").agg(F.count("*").alias("n"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("stage").agg(F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_rejected"))


def active_workers(tasks: DataFrame) -> DataFrame:
    """Distinct workers of each kind, and of all kinds (kind is null)."""
    return tasks.where("status = 'processing'").rollup("kind").agg(F.count_distinct("worker_id").alias("workers"))


def cardinalities(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, rows, keys) of each table by its key column."""
    out = None
    for name, (df, key) in tables.items():
        one = df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys")).select(F.lit(name).alias("name"), "n_rows", "n_keys")
        out = one if out is None else out.unionByName(one)
    return out


def coverage(keys: DataFrame, rows: DataFrame, items: Column) -> DataFrame:
    """(key, n_rows, n_with_items) of every key; items is an array column of rows."""
    per = rows.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.size(items), F.lit(0)) > 0).alias("w"))
    return keys.join(per, "key", "left").select("key", F.coalesce("n", F.lit(0)).alias("n_rows"), F.coalesce("w", F.lit(0)).alias("n_with_items"))


def readiness(wanted: DataFrame, known: DataFrame, cover: DataFrame) -> DataFrame:
    """(bucket, n) of the listed keys."""
    rows = wanted.join(known.select("key", F.lit(True).alias("k")), "key", "left").join(cover, "key", "left")
    bucket = F.when(F.col("k").isNull(), "not_in_table").when(F.coalesce("n_rows", F.lit(0)) == 0, "not_collected").when(F.col("n_with_items") == 0, "no_images").otherwise("ready")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def impact(keys: DataFrame, dependants: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(name, n): rows of each dependent table that belong to the keys."""
    out = None
    for name, (df, col) in dependants.items():
        one = df.join(keys.select(F.col("key").alias(col)), col, "left_semi").agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def class_counts(rows: DataFrame, col: str, domain: tuple[str, ...]) -> DataFrame:
    """Counts of all classes of a domain, absent ones with 0."""
    classes = rows.sparkSession.createDataFrame([(c,) for c in domain], f"{col} string")
    return F.broadcast(classes).join(rows.groupBy(col).agg(F.count("*").alias("n")), col, "left").select(col, F.coalesce("n", F.lit(0)).alias("n"))
