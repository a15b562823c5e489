"""Existence operators over keyed tables."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def existence_split(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """keys with ``found``."""
    known = table.select(key).distinct().withColumn("_f", F.lit(True))
    return keys.join(known, key, "left").withColumn("found", F.coalesce("_f", F.lit(False))).drop("_f")


def passed_without_failure(verdicts: DataFrame, stage: str, on: list[str]) -> DataFrame:
    """Items that passed a stage and failed none."""
    passed = verdicts.where((F.col("stage") == stage) & F.col("passed")).select(*on).distinct()
    return passed.join(verdicts.where(~F.col("passed")).select(*on), on, "left_anti")


def endpoints(rows: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """(key, n, first and last value and time): both ends of each series in one aggregate."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"),
                                 F.min_by(value, at).alias("first_value"), F.max_by(value, at).alias("last_value"))


def all_stages_passed(verdicts: DataFrame, existing: DataFrame, strict: bool = False) -> DataFrame:
    """(key, item_id) whose passed stages are those required; the model's stage is required where the key has any of its rows."""
    has_ai = verdicts.groupBy("key").agg(F.bool_or(F.col("stage") == "ai").alias("has_ai"))
    passed = verdicts.where("passed").groupBy("key", "item_id").agg(F.array_sort(F.collect_set("stage")).alias("stages"))
    need = F.when(F.col("has_ai"), F.array(*map(F.lit, ("ai", "mechanical", "price_filter")))).otherwise(F.array(*map(F.lit, ("mechanical", "price_filter"))))
    out = passed.join(has_ai, "key").where(F.col("stages") == need).select("key", "item_id")
    if strict:
        out = out.join(verdicts.where(~F.col("passed")).select("key", "item_id"), ["key", "item_id"], "left_anti")
    return out.join(existing.select("item_id"), "item_id", "left_anti").select("key", "item_id")


#: Groups at most that can hold more than 1 / HOT of all rows.
HOT = 1_000


def with_group(rows: DataFrame, groups: DataFrame, by: list[str], size: str, spread: Column, part: Column | None = None) -> DataFrame:
    """rows with the other columns of their group, null where they have none or part is false; null is a value of by.

    groups has a row for each by, with its number of rows in size. Groups of more than a thousandth of all grouped rows are
    among at most HOT ones, so they are broadcast to their rows; rows that have met theirs, or take no part, are then dealt
    by spread, and only the others by their group.
    """
    have = [c for c in groups.columns if c not in by]
    hot = F.col(size) * HOT > groups.agg(F.coalesce(F.sum(size), F.lit(0))).scalar()
    names = lambda df, tag: df.select(*(F.col(c).alias(f"{tag}{i}") for i, c in enumerate(by)), *(F.col(c).alias(f"{tag}_{c}") for c in have))
    same = lambda tag: [F.col(c).eqNullSafe(F.col(f"{tag}{i}")) for i, c in enumerate(by)]
    on = lambda *conds: functools.reduce(lambda a, b: a & b, conds)
    takes = F.lit(True) if part is None else F.coalesce(part, F.lit(False))
    met = rows.withColumn("_takes", takes).join(F.broadcast(names(groups.where(hot), "_h")), on(F.col("_takes"), *same("_h")), "left")
    slot = F.when(F.col("_takes") & F.col(f"_h_{size}").isNull(), F.lit(0)).otherwise(1 + F.pmod(spread, F.lit(1 << 20)))
    few = names(groups.where(~hot), "_f").withColumn("_fslot", F.lit(0).cast("long"))
    out = met.withColumn("_slot", slot.cast("long")).join(few, on(F.col("_slot") == F.col("_fslot"), *same("_f")), "left")
    return out.select(*rows.columns, *(F.coalesce(f"_h_{c}", f"_f_{c}").alias(c) for c in have))
