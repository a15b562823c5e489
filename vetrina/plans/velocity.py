"""View velocity of items that are measured again and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 3.6e9


def view_velocity(rows: DataFrame, keep_all: bool = False) -> DataFrame:
    """Items with two measurements at least, in one aggregate without a self-join: the first price, the views at both ends, their difference and rate."""
    ends = rows.groupBy("item_id").agg(
        F.count("*").alias("n"), F.min("parsed_at").alias("first_at"), F.max("parsed_at").alias("last_at"), F.min_by("price", "parsed_at").alias("price"),
        F.min_by(F.struct("views"), "parsed_at").alias("a"), F.max_by(F.struct("views"), "parsed_at").alias("b")).where("n >= 2")
    hours = hours_between(F.col("first_at"), F.col("last_at"))
    diff = F.col("b.views") - F.col("a.views")
    out = ends.select("item_id", "n", "first_at", "last_at", "price", F.col("a.views").alias("first_views"), F.col("b.views").alias("last_views"), diff.alias("views_diff"), hours.alias("hours"),
                      F.when(hours > 0, diff / hours).alias("views_per_hour"))
    return out if keep_all else out.where("first_views is not null and last_views is not null")


def quality_flags(velocity: DataFrame) -> DataFrame:
    """(item_id, issue) of a velocity frame with all rows."""
    checks = (("null_views", F.col("first_views").isNull() | F.col("last_views").isNull()), ("zero_interval", F.col("hours") == 0), ("negative_diff", F.col("views_diff") < 0))
    return velocity.select("item_id", F.explode(F.array_compact(F.array(*(F.when(c, n) for n, c in checks)))).alias("issue"))


def velocity_stats(velocity: DataFrame) -> DataFrame:
    v = F.col("views_per_hour")
    return velocity.agg(F.count("*").alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.count_if(v.isNull()).alias("n_null"))


def keys_per_item(rows: DataFrame) -> DataFrame:
    return rows.select("item_id", "key").distinct().groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("key")), ", ").alias("keys"))


def multiplicity(rows: DataFrame) -> DataFrame:
    per = rows.groupBy("item_id").agg(F.count("*").alias("n"))
    return per.agg(F.count_if(F.col("n") >= 2).alias("n_many"), F.count_if(F.col("n") == 1).alias("n_one"))


def reparse_candidates(rows: DataFrame, items: DataFrame, keys: DataFrame, active: DataFrame, as_of: str, hours: int) -> DataFrame:
    """One pair an item, that with the oldest last measurement, of those stale for so many hours with no active task.

    items and keys are filters; if both are empty, all measured items are candidates.
    """
    pairs = rows.groupBy("item_id", "key").agg(F.max("parsed_at").alias("last_at"))
    if not (items.isEmpty() and keys.isEmpty()):
        wanted = items.select("item_id").union(rows.join(keys, "key", "left_semi").select("item_id")).distinct()
        pairs = pairs.join(wanted, "item_id", "left_semi")
    stale = pairs.where(hours_between(F.col("last_at"), F.lit(as_of).cast("timestamp_ntz")) >= hours).join(active, "item_id", "left_anti")
    return stale.groupBy("item_id").agg(F.min(F.struct("last_at", "key")).alias("x")).select("item_id", "x.key", "x.last_at")
