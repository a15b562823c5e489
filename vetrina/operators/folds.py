"""Ordered folds of a key's rows, in pieces that many tasks share.

Rows are ranked over the whole table by (key, order). A key's rows in a block of ranks are folded to a
summary; summaries of neighbouring blocks are merged, level by level, until one is left a key. No group
of any level has more than SIZE entries, however many rows a key has. All in expressions of the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.operators.ranks import ranked

#: Rows of a piece, and pieces that are merged at once.
SIZE = 1_000


def pieces(df: DataFrame, key: str, order: list[str], fold: Callable[[Column], Column], size: int = SIZE) -> tuple[DataFrame, int]:
    """((key, _b, s), the rows' number): fold of the ordered array of each piece's rows as structs; pieces of a key are in order of _b."""
    rest = [c for c in df.columns if c != key]
    by = [F.asc_nulls_last(c) for c in (key, *order, *(c for c in rest if c not in order))]
    rows = ranked(df, by, "_i")
    out = rows.groupBy(key, F.floor(F.col("_i") / size).alias("_b")).agg(F.array_sort(F.collect_list(F.struct("_i", *rest))).alias("_x")).select(key, "_b", fold(F.col("_x")).alias("s"))
    return out, rows.count()


def fold(df: DataFrame, key: str, order: list[str], piece: Callable[[Column], Column], merge: Callable[[Column], Column], size: int = SIZE) -> DataFrame:
    """(key, s): piece makes a summary of an ordered array of rows, merge one of an ordered array of summaries."""
    out, n = pieces(df, key, order, piece, size)
    width = size
    while width <= n:
        width *= size
        found = F.transform(F.array_sort(F.collect_list(F.struct("_b", "s"))), lambda x: x["s"])
        out = out.groupBy(key, F.floor(F.col("_b") / size).alias("_b")).agg(found.alias("_x")).select(key, "_b", merge(F.col("_x")).alias("s"))
    return out.select(key, "s")


# runs of failures: (size, lead, trail, longest), the rows and the leading, trailing and longest run


def _run(size: Column, lead: Column, trail: Column, longest: Column) -> Column:
    return F.struct(size.alias("size"), lead.alias("lead"), trail.alias("trail"), longest.alias("longest"))


def _none() -> Column:
    zero = F.lit(0).cast("long")
    return _run(zero, zero, zero, zero)


def join_runs(a: Column, b: Column) -> Column:
    """The runs of rows a followed by rows b."""
    return _run(a["size"] + b["size"], F.when(a["lead"] == a["size"], a["size"] + b["lead"]).otherwise(a["lead"]),
                F.when(b["trail"] == b["size"], a["trail"] + b["size"]).otherwise(b["trail"]), F.greatest(a["longest"], b["longest"], a["trail"] + b["lead"]))


def runs_of(rows: Column) -> Column:
    """The runs in an array of rows with ``failed``; a null is no row."""
    def one(x: Column) -> Column:
        n, bad = F.when(x["failed"].isNull(), 0).otherwise(1).cast("long"), F.when(x["failed"], 1).otherwise(0).cast("long")
        return _run(n, bad, bad, bad)

    return F.aggregate(rows, _none(), lambda acc, x: join_runs(acc, one(x)))


def merged_runs(summaries: Column) -> Column:
    return F.aggregate(summaries, _none(), join_runs)


# guarded updates: for each state that a request expects, what becomes of it and how many requests were applied


def _applied(moves: Column, v: Column, n: Column) -> Column:
    hit = F.get(F.filter(moves, lambda m: m["source"] == v), F.lit(0))
    return F.struct(F.when(hit.isNull(), v).otherwise(hit["v"]).alias("v"), (n + F.coalesce(hit["n"], F.lit(0).cast("long"))).alias("n"))


def updates_of(rows: Column) -> Column:
    """array<struct<source, v, n>> from an ordered array of rows with ``expected`` and ``new``."""
    def step(acc: Column, x: Column) -> Column:
        return F.when(acc["v"] == x["expected"], F.struct(x["new"].alias("v"), (acc["n"] + 1).alias("n"))).otherwise(acc)

    sources = F.array_distinct(F.filter(F.transform(rows, lambda x: x["expected"]), lambda s: s.isNotNull()))
    return F.transform(sources, lambda s: _entry(s, F.aggregate(rows, F.struct(s.alias("v"), F.lit(0).cast("long").alias("n")), step)))


def merged_updates(summaries: Column) -> Column:
    sources = F.array_distinct(F.flatten(F.transform(summaries, lambda moves: F.transform(moves, lambda m: m["source"]))))
    return F.transform(sources, lambda s: _entry(s, F.aggregate(summaries, F.struct(s.alias("v"), F.lit(0).cast("long").alias("n")), lambda acc, moves: _applied(moves, acc["v"], acc["n"]))))


def _entry(source: Column, after: Column) -> Column:
    return F.element_at(F.transform(F.array(after), lambda a: F.struct(source.alias("source"), a["v"].alias("v"), a["n"].alias("n"))), 1)


def update(value: Column, moves: Column) -> Column:
    """struct<v, n> of a value after the updates that moves sum up; without moves it stays."""
    zero = F.lit(0).cast("long")
    return F.when(moves.isNull(), F.struct(value.alias("v"), zero.alias("n"))).otherwise(_applied(moves, value, zero))
