"""Importance resampling towards a target text collection, by hashed n-grams.

Texts are taken a block at a time through Arrow kernels: lower case, split, flatten, dictionary. An
n-gram is a dictionary index shifted by one word at a time, so only the distinct pairs of an
(n-1)-gram and a word are hashed; a CRC goes on from that of the shorter n-gram. Counts of both
collections by bucket give each bucket's gain; the gains of a document's n-grams are taken by
index and reduced by segments. A Gumbel number by hash of the key is added, so that the highest
scores are a draw without replacement by importance, the same at any partitioning.

To the driver come the counts of the buckets only. Ranks are found by ranges of the order.

Defined cases: a null text has no words; a document without words has weight 0; documents of fewer
than ``LEAST_WORDS`` words are scored and never drawn; a null key counts as an empty one for the
hash and is last among ties; rows that repeat are scored and ranked one by one, in any order among
themselves; empty collections give gains of empty counts; an empty table gives an empty result.
Only the key and the text are read. Texts are taken whole.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import Scratch, blocks, cut
from vetrina.operators.ranks import ranked

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7


class Grams:
    """The n-grams of a block of texts: for each length the texts they are in, and their buckets."""

    def __init__(self, texts: pa.Array, longest: int = LONGEST, buckets: int = BUCKETS) -> None:
        lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), SEPARATORS)
        flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
        some = pc.not_equal(flat, "")
        words = flat.filter(some).dictionary_encode()
        row, at = row.filter(some).to_numpy(), words.indices.to_numpy().astype(np.int64)
        names = words.dictionary.cast(pa.binary()).to_pylist()
        self.rows = len(texts)
        self.n_words = np.bincount(row, minlength=self.rows)
        crcs, tails, size, word = [zlib.crc32(w) for w in names], [b" " + w for w in names], max(1, len(names)), at
        self.found = [(row, at, self._bucket(crcs, buckets))]
        for n in range(2, longest + 1):
            same = row[: -(n - 1)] == row[n - 1 :]  # rows are in order
            pairs = at[: len(same)] * size + word[n - 1 :]
            coded = pa.array(np.where(same, pairs, -1)).dictionary_encode()
            pair = coded.dictionary.to_numpy()
            crcs = [zlib.crc32(tails[w], crcs[g]) if g >= 0 else 0 for g, w in zip((pair // size).tolist(), (pair % size).tolist())]
            at = coded.indices.to_numpy().astype(np.int64)
            self.found.append((row[: len(same)][same], at[same], self._bucket(crcs, buckets)))

    @staticmethod
    def _bucket(crcs: list[int], buckets: int) -> np.ndarray:
        return np.array(crcs, dtype=np.int64) % buckets

    def counts(self, buckets: int = BUCKETS) -> np.ndarray:
        return sum(np.bincount(bucket[at], minlength=buckets) for _, at, bucket in self.found)

    def n_features(self) -> np.ndarray:
        return sum(np.bincount(row, minlength=self.rows) for row, _, _ in self.found)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """The sum of the gains of each text's n-grams."""
        total = np.zeros(self.rows, dtype=np.int64)
        for row, at, bucket in self.found:
            if len(row):
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                total[row[starts]] += np.add.reduceat(gains[bucket][at], starts)
        return total


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams of the whole collection are in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for x in blocks(batch, "t"):
                total += Grams(x["t"], longest, buckets).counts(buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    counted = docs.select(F.col(text).alias("t")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket 1000 times the log of its share in the target to that in the source, floored; one is added to each count."""
    s, t, b = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b)))) for x, y in zip(source.tolist(), target.tolist())], dtype=np.int64)


def gumbel(key: str, seed: int = SEED) -> int:
    """1000 times a Gumbel number, floored, from a hash of seed and key."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """(key, mark, n_words, n_features, weight, score) of every row; mark is a fingerprint of the text."""
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"), F.col(text).alias("t"))
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in blocks(batch, "t"):
                g = Grams(x["t"], longest, len(gains))
                n = g.n_features()
                weight = g.sums(gains) // np.maximum(n, 1)
                score = weight + np.array([gumbel(k, seed) for k in x["name"].to_pylist()], dtype=np.int64)
                marks = [hashlib.md5(t.encode()).digest() for t in pc.fill_null(x["t"], "").to_pylist()]
                yield pa.RecordBatch.from_arrays([x["k"], pa.array(marks, pa.binary()), *(pa.array(c, pa.int64()) for c in (g.n_words, n, weight, score))],
                                                 ["k", "mark", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, f"k {kind}, mark binary, n_words long, n_features long, weight long, score long").withColumnRenamed("k", key)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", longest: int = LONGEST,
             buckets: int = BUCKETS, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The columns of scores() and rank, of every row: so many percent of the rows with enough words are drawn and ranked."""
    gains = gains_of(bucket_counts(docs, text, longest, buckets), bucket_counts(target, "text", longest, buckets))
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.keep(scores(docs, gains, key, text, longest, seed).withColumn("_row", F.monotonically_increasing_id()), "scores")
        enough = F.col("n_words") >= least_words
        drawn = rows.where(enough).count() * percent // 100
        order = ranked(rows.where(enough), [F.desc("score"), F.asc_nulls_last(key), F.asc("_row")])
        out = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))
        return cut(out.drop("_row"))


def sample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows drawn, with all their columns. Rows that repeat with one key and text are drawn together once one of them is."""
    packed = docs.select(F.col(key).alias("k"), F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("m"), F.struct(*docs.columns).alias("row"))
    drawn = resample(docs, target, percent, key, text).where("rank is not null").select(F.col(key).alias("dk"), F.col("mark").alias("dm")).distinct()
    return packed.join(drawn, F.col("k").eqNullSafe(F.col("dk")) & (F.col("m") == F.col("dm")), "left_semi").select("row.*")


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")
