"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts of the word-based operators define it.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), lambda w: w != "")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; one of our own only on a local master that names none."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("name a shared folder in spark.checkpoint.dir: executors don't see each other's files")
        named = tempfile.mkdtemp(prefix="vetrina-")
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint, which survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Bytes, as Spark expects them of files, up to which a table of many rows is broadcast: at most some 250,000 rows with a key of 64 bits.
BROADCAST_BYTES = 2 << 20
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@contextlib.contextmanager
def small_broadcasts(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark broadcasts no larger tables of itself: one takes the driver ten times its file and more, and a query makes several at once."""
    before = spark.conf.get(THRESHOLD, None)
    spark.conf.set(THRESHOLD, str(min(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold(), BROADCAST_BYTES)))
    try:
        yield
    finally:
        spark.conf.unset(THRESHOLD) if before is None else spark.conf.set(THRESHOLD, before)


class Scratch:
    """Parquet tables in the shared folder, removed on leaving: results must be cut() before."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.steps = 0
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/vetrina-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def keep(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path, compression=compression)
        return self.spark.read.schema(df.schema).parquet(path)

    def step(self, df: DataFrame) -> DataFrame:
        """As keep, for the many small tables of a loop: the sizes that Spark expects of a table's readers are those of its files,
        while those that a checkpoint hands on multiply with every join of the loop."""
        self.steps += 1
        return self.keep(df, f"step{self.steps}")

    def drop(self, name: str = "") -> None:
        """Removes a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __exit__(self, *_: object) -> None:
        self.drop()


#: Bytes of text that a task holds at once in its own arrays, a single longer text apart.
BLOCK_BYTES = 8 << 20


def blocks(batch: pa.RecordBatch, text: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of so many bytes of text, of one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at, done = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, end - at)
        at, done = end, int(ends[end - 1])


def no_spans(context: bool = False) -> Column:
    return F.expr(f"cast(array() as array<struct<s:bigint,e:bigint,m:string{',b:string,a:string' if context else ''}>>)")


#: Lengths that are summed up at once to place the matches in a text.
RUN = 256


def _sum(lengths: Column, start: Column | int, n: Column | int) -> Column:
    return F.aggregate(F.slice(lengths, start, n), F.lit(0).cast("long"), lambda a, x: a + x)


#: Matches and the texts before them that make up the context of a match, so that it is as long as asked for where matches are dense.
BACK = 4


def spans_of(text: Column, pattern: str, group: int = 0, around: int = 0) -> Column:
    """Leftmost non-overlapping matches as array<struct<s, e, m>>, in code points, end exclusive; m is the group.

    pattern must not match the empty string: the texts between the matches then give the offsets. These are sums over all
    matches before, in two steps: of whole runs of matches, and within a run. With around, a match has that many characters
    before it (b), or those of the last few matches and texts before it if these are fewer, and the one after it (a).
    """
    def placed(x: Column) -> Column:
        lengths = F.transform(x["found"], lambda f, i: (F.length(f) + F.length(F.get(x["between"], i))).cast("long"))
        return let(lengths, lambda ls: let(_bases(ls), lambda bases: F.transform(x["found"], lambda f, i: let(
            F.get(bases, F.floor(i / RUN).cast("int")) + _sum(ls, i - i % RUN + 1, i % RUN + 1), lambda e: F.struct(
                (e - F.length(f)).alias("s"), e.alias("e"), F.get(x["part"], i).alias("m"), *(_context(x, i) if around else []))))))

    def _context(x: Column, i: Column) -> list[Column]:
        part = lambda k: F.coalesce(F.concat(F.get(x["between"], i - k), F.get(x["found"], i - k)), F.lit(""))
        before = F.concat(*(F.when(i >= k, part(k)).otherwise("") for k in range(BACK, 0, -1)), F.get(x["between"], i))
        after = F.concat(F.get(x["between"], i + 1), F.coalesce(F.get(x["found"], i + 1), F.lit("")))
        return [F.right(before, F.lit(around)).alias("b"), F.left(after, F.lit(1)).alias("a")]

    def _bases(ls: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(ls) - 1, F.lit(RUN))
        return let(F.transform(starts, lambda at: _sum(ls, at + 1, F.lit(RUN))), lambda sums: F.transform(starts, lambda _, k: _sum(sums, F.lit(1), k)))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    return F.when(F.regexp_like(text, F.lit(pattern)), let(
        F.struct(F.split(text, pattern, -1).alias("between"), found.alias("found"), part.alias("part")), placed)).otherwise(no_spans(around > 0))


def first_that(sorted_array: Column, rule: Callable[[Column], Column]) -> Column:
    """The place, from 0, of the first element for which a rule holds that holds for all after it too; the size if there is none."""
    def half(a: Column, _: Column) -> Column:
        def step(mid: Column) -> Column:
            return F.when(a["low"] >= a["high"], a).when(rule(F.get(sorted_array, mid)), F.struct(a["low"].alias("low"), mid.alias("high"))).otherwise(
                F.struct((mid + 1).alias("low"), a["high"].alias("high")))

        return let(F.floor((a["low"] + a["high"]) / 2).cast("int"), step)

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_array) + 1.0)).cast("int") + 1)
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(sorted_array).alias("high")), half)["low"]
