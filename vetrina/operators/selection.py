"""Exact order statistics of every key, however many rows and distinct values one key has.

Values are counted by (key, value) first. A key of few distinct values is one row with the sorted
counts, in which ranks and counts are found by one pass. The values of the other keys are dealt into
sampled ranges of (key, value), so that many tasks share a key; each range is counted, the counts of
the ranges before it give every value its rank in the key, and a rank is the least value whose rank
reaches it, by an aggregate that starts in each task. No task gathers a key.

A plan is a list of steps, in SQL: values are looked up at ranks and under bounds, then columns are
computed from them, which the next step's ranks and bounds may use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.operators.ranks import WITHIN
from vetrina.sources.sinks import kept

#: Distinct values up to which a key's counts are one row.
SPLIT = 10_000
#: Keys of more values that are broadcast to their values; beyond these they are joined by shuffle.
BROADCAST_KEYS = 100_000


@dataclass
class Step:
    """ranks: the value at a rank from 1 on, null beyond the last; counts: how many rows have a value {p} for which a rule holds;
    then: columns computed afterwards, each of which may use those before it."""

    ranks: dict[str, str] = field(default_factory=dict)
    counts: dict[str, str] = field(default_factory=dict)
    then: dict[str, str] = field(default_factory=dict)

    def computed(self) -> list[str]:
        return [f"{sql} AS {name}" for name, sql in self.then.items()]


def counts(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, _p, _m): how often each key has each value, written once; a key without values has a row with a null."""
    return kept(df.select(key, value.alias("_p")).groupBy(key, "_p").agg(F.count("_p").alias("_m")), "counts")


def by_key(counted: DataFrame, key: str, steps: list[Step], wanted: list[str], split: int = SPLIT) -> DataFrame:
    """(key, wanted): what the steps give for each key of counts(); they start from ``n``, the key's number of values."""
    sizes = counted.groupBy(key).agg(F.count("_p").alias("_d"), F.sum("_m").alias("n"))
    if (sizes.agg(F.max("_d")).first()[0] or 0) <= split:
        return _in_row(counted, key, steps).select(key, *wanted)
    large = kept(sizes.where(F.col("_d") > split).select(key, "n"), "large")
    many = large.count()
    sides = large.select(F.col(key).alias("_key"))
    sides = F.broadcast(sides) if many <= BROADCAST_KEYS else sides
    same = F.col(key).eqNullSafe(F.col("_key"))
    small = _in_row(counted.join(sides, same, "left_anti"), key, steps).select(key, *wanted)
    return small.unionByName(_in_ranges(counted.where("_p is not null").join(sides, same, "left_semi"), large, many, key, steps).select(key, *wanted))


def _in_row(counted: DataFrame, key: str, steps: list[Step]) -> DataFrame:
    kind = counted.schema["_p"].dataType.simpleString()
    rows = counted.groupBy(key).agg(F.expr("sort_array(collect_list(if(_p is null, null, struct(_p as p, _m as m))))").alias("_ps"), F.sum("_m").alias("n"))
    for step in steps:
        start = [f"'{c}', cast(null as {kind})" for c in step.ranks] + [f"'{c}', 0L" for c in step.counts]
        onward = [f"'{c}', coalesce(acc.{c}, if(acc._r + x.m >= {at}, x.p, null))" for c, at in step.ranks.items()] + [
            f"'{c}', acc.{c} + if({rule.format(p='x.p')}, x.m, 0L)" for c, rule in step.counts.items()]
        pass_over = f"aggregate(_ps, named_struct('_r', 0L, {', '.join(start)}), (acc, x) -> named_struct('_r', acc._r + x.m, {', '.join(onward)})) AS _found"
        looked = [f"_found.{c} AS {c}" for c in (*step.ranks, *step.counts)]
        rows = rows.selectExpr("*", pass_over).selectExpr(*rows.columns, *looked, *step.computed())
    return rows.drop("_ps")


def _in_ranges(counted: DataFrame, large: DataFrame, many: int, key: str, steps: list[Step]) -> DataFrame:
    order = [key, "_p"]
    rows = kept(counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.shiftright(F.monotonically_increasing_id(), WITHIN)), "ranges")
    sizes = rows.groupBy(key, "_range").agg(F.sum("_m").alias("m"))
    pieces = sizes.groupBy(F.col(key).alias("_key")).agg(F.collect_list(F.struct("_range", "m")).alias("_sizes"))  # a piece for each range that a key is in
    before = F.expr("aggregate(filter(_sizes, x -> x._range < _range), 0L, (a, x) -> a + x.m)")
    starts = kept(sizes.join(pieces, F.col(key).eqNullSafe(F.col("_key"))).select(F.col("_key"), F.col("_range").alias("_at"), before.alias("_start")), "starts")
    upto = Window.partitionBy("_range", key).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = kept(rows.withColumn("_r", F.sum("_m").over(upto)).join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_at"))).select(
        key, "_p", "_m", (F.col("_r") + F.col("_start")).alias("_r")), "ranks")
    known = large
    for step in steps:
        have = [c for c in known.columns if c != key]
        sides = known.withColumnRenamed(key, "_key")
        looked = [F.expr(f"min(if(_r >= {at}, _p, null))").alias(c) for c, at in step.ranks.items()] + [
            F.expr(f"coalesce(sum(if({rule.format(p='_p')}, _m, 0L)), 0L)").alias(c) for c, rule in step.counts.items()]
        found = rows.join(F.broadcast(sides) if many <= BROADCAST_KEYS else sides, F.col(key).eqNullSafe(F.col("_key"))).groupBy(key).agg(
            *(F.any_value(c).alias(c) for c in have), *looked)
        known = found.selectExpr("*", *step.computed())
    return known
