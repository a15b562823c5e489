"""Shards of near equal bytes by sampled splitters.

Rows are ordered by (fingerprint of the text, key), so that copies lie side by side, and dealt
into consecutive ranges, which grow in number with the rows. The splitters are quantiles of a key
sample in which a row's chance is its share of all bytes. A range that still holds too much is
sampled more densely and subdivided. Each range is sorted in one task; with the ranges' totals, a
row knows its place in the whole order and how many bytes come before it. A shard ends where its
share of the bytes does; a border inside a group of equal texts moves to the nearer end of the
group, unless the group holds more than ``TOGETHER`` of a shard. The sample only balances the work
and never changes the result.

Defined cases: a null text has no bytes, crc32 0 and comes before all texts, as one group; a null
key comes first among equal texts; integral keys are ordered as numbers, others by a hash, then by
themselves. Rows that repeat wholly are dealt like others, any of them first; a range can't divide
them. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from vetrina.llm.common import cut

SHARDS = 24
OVERHEAD = 8
#: Least number of ranges, rows a range, sampled keys a range (in expectation), how much more than its share a range may hold, and rounds of subdivision.
RANGES, ROWS, SAMPLES, OVERFULL, ROUNDS = 192, 1_000_000, 32, 2.0, 3
#: The part of a shard that a group of equal texts may hold without being cut.
TOGETHER = 0.02
LEAST = -(1 << 63)


def _ordered(docs: DataFrame, key: str, text: str) -> Column:
    """One string a row, in the order of (fingerprint of the text, key)."""
    number = F.col(key).cast("long") if isinstance(docs.schema[key].dataType, IntegralType) else F.xxhash64(key)
    place = F.when(F.col(key).isNull(), F.lit("")).otherwise(F.lpad(F.hex(number.bitwiseXOR(F.lit(LEAST))), 16, "0"))
    return F.concat(F.coalesce(F.md5(F.col(text)), F.lit("-" * 32)), place)


def _splitters(rows: DataFrame, share: float) -> list[str]:
    """About SAMPLES keys a range reach the driver."""
    chance = F.pmod(F.xxhash64("k", F.lit(share)), F.lit(1 << 40)) / float(1 << 40)
    weight = F.col("size") * share
    picked = rows.where(chance < weight).select("k", F.greatest(F.lit(1.0), weight).alias("w")).collect()
    picked.sort(key=lambda r: r["k"])
    bounds, run = [], 0.0
    for r in picked:
        run += r["w"]
        if run >= SAMPLES:
            bounds.append(r["k"])
            run = 0.0
    return sorted(set(bounds))


def _ranged(rows: DataFrame, bounds: list[str]) -> DataFrame:
    """rows with the number of bounds that aren't above k, by halving."""
    listed = F.split(F.lit(",".join(bounds)), ",") if bounds else F.array().cast("array<string>")
    steps = F.array(*(F.lit(1 << p) for p in reversed(range(len(bounds).bit_length() or 1))))
    return rows.withColumn("range", F.aggregate(
        steps, F.lit(0), lambda at, p: F.when(F.get(listed, at + p - 1) <= F.col("k"), at + p).otherwise(at)))


def _balanced(rows: DataFrame, n: int, total: int) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """rows with their range, and each range's rows and bytes before it."""
    ranges = max(RANGES, -(-n // ROWS))
    share = ranges * SAMPLES / max(1, total)
    bounds = _splitters(rows, share)
    for turn in range(ROUNDS + 1):
        dealt = _ranged(rows, bounds)
        sums = sorted(tuple(r) for r in dealt.groupBy("range").agg(F.sum("size"), F.count("*")).collect())  # a row a range
        over = [k for k, b, c in sums if b > OVERFULL * total / ranges or c > OVERFULL * max(64, n / ranges)]
        if turn == ROUNDS or not over:
            break
        share *= 8
        more = sorted({*bounds, *_splitters(dealt.where(F.col("range").isin(over)), share)})
        if more == bounds:
            break
        bounds = more
    starts, at_b, at_n = [], 0, 0
    for k, b, c in sums:
        starts.append((k, at_b, at_n))
        at_b, at_n = at_b + b, at_n + c
    return dealt, starts


def _borders(placed: DataFrame, shards: int, n: int, total: int) -> list[int]:
    """The place of the first row of each shard but the first."""
    by_bytes = F.least(F.lit(shards - 1), F.floor(F.col("before") * shards / F.lit(max(1, total)))).cast("int")
    first = {r["shard"]: r["first"] for r in placed.groupBy(by_bytes.alias("shard")).agg(F.min(F.struct("at", "h")).alias("first")).collect()}  # a row a shard
    cuts: list[tuple[int, str | None]] = []
    for s in reversed(range(1, shards)):
        cuts.append(tuple(first[s]) if s in first else cuts[-1] if cuts else (n, None))
    texts = sorted({h for _, h in cuts if h is not None})
    groups = {r["h"]: r for r in placed.where(F.col("h").isin(texts)).groupBy("h").agg(  # a row a border
        F.sum("size").alias("b"), F.min("at").alias("start"), (F.max("at") + 1).alias("end")).collect()} if texts else {}
    moved = []
    for at, h in reversed(cuts):
        g = groups.get(h)
        if g and g["b"] <= TOGETHER * total / shards:
            at = g["start"] if at - g["start"] <= g["end"] - at else g["end"]
        moved.append(at)
    return moved


def deal(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot)."""
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = cut(docs.select(
        F.col(key), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), _ordered(docs, key, text).alias("k")))
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    dealt, starts = _balanced(rows, n, total)
    offsets = docs.sparkSession.createDataFrame(starts, "range int, b0 long, n0 long")
    order = Window.partitionBy("range").orderBy("k", key).rowsBetween(Window.unboundedPreceding, 0)
    sums = dealt.withColumns({"b": F.sum("size").over(order) - F.col("size"), "c": F.count("*").over(order) - 1})
    placed = cut(sums.join(F.broadcast(offsets), "range").select(
        key, "size", "text_crc32", F.substring("k", 1, 32).alias("h"), (F.col("b0") + F.col("b")).alias("before"), (F.col("n0") + F.col("c")).alias("at")))
    passed = F.filter(F.array(F.lit(0).cast("long"), *(F.lit(b).cast("long") for b in _borders(placed, shards, n, total))), lambda b: b <= F.col("at"))
    return placed.select(key, "size", "text_crc32", (F.size(passed) - 1).alias("shard"), (F.col("at") - F.array_max(passed)).alias("slot"))


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    return deal(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
