"""Ranks of a table's rows in one order, found by ranges: no task sees more than its range, however few the keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.sources.sinks import kept

#: Rows of a partition that monotonically_increasing_id can count.
WITHIN = 33


def ranked(df: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """df with each row's place, from 1, in a table in the shared folder.

    Rows are dealt into ranges of the order by Spark's sampled bounds, sorted and written once with their place in their
    partition; a partition's rows are counted, and the sums of those before it are added. Rows that are equal in the whole
    order can't be told apart by a range, so the order should end with a column of many values.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = kept(ordered.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_at", WITHIN)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row a partition
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_at") - F.shiftleft("_part", WITHIN) + 1).select(*df.columns, name)
