"""Removal of repeated line runs by a suffix array over line ids.

The lines of all documents are one table (document, place, line). Prefix doubling ranks the
suffixes that start at each place: rank 0 is the line's place among all repeated lines, and the
rank of the first 2^(j+1) lines is the place of the pair (rank j here, rank j 2^j lines on) among
all such pairs that occur twice or more. Ranks are global and keep the order of the suffixes, so
those with one rank are an interval of the suffix array whose longest common prefix is at least
2^j lines; a suffix without a rank shares that many lines with none and is followed no further.
Two overlapping ranks give the interval of any number of lines between two powers.

A run counts from ``min_words`` words on. Every line of a maximal repeated run lies in a run
that has the fewest lines with that many words from its start on, or up to its end, so it is
enough to look up these: ``min_words`` lines at most, hence log2(min_words) rounds. In each
interval the run that comes first by (key, text, line) stays and later copies are deleted;
the union of the deleted runs is that of all maximal repeated runs.

Ranks are given to distinct pairs, after counting, so that a line in a third of all documents is
one row of the sort. Only lines that stand next to enough other repeated ones take part in it.

Defined cases: lines without a word are in no run and stay. A null text stays null and an empty
one empty. Rows that repeat with one key and text are one document and get the same result; null
keys come first. Keys are of any type with an order. Other columns are passed through by ``dedup``; one that
is named as its result is replaced. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.llm.common import BLANKS, BLANK_RUN, Scratch, cut, let

MIN_WORDS = 50
#: A document here: its key, the fingerprints of its text and, as keys may be null, of both.
DOC = ("u", "k", "d")


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _worded(lines: Column) -> Column:
    """Ids and word counts of the lines that have a word."""
    return F.filter(F.transform(lines, lambda x: let(F.trim(x, F.lit(BLANKS)), lambda t: F.struct(
        F.xxhash64(x).alias("h"), F.when(t != "", F.size(F.split(t, BLANK_RUN))).otherwise(0).alias("w")))), lambda x: x["w"] > 0)


def _ranked(names: DataFrame, columns: list[str], scratch: Scratch, rank: str) -> DataFrame:
    """names (distinct rows) with their places in the order of columns, from 0: dealt by ranges, and each range knows how many come before."""
    part = scratch.step(names.select(*columns).repartitionByRange(*columns).withColumn("part", F.spark_partition_id()))
    sizes = sorted((r["part"], r["n"]) for r in part.groupBy("part").agg(F.count("*").alias("n")).collect())  # a row a partition
    before, starts = 0, [0] * (sizes[-1][0] + 1 if sizes else 1)
    for p, n in sizes:
        starts[p] = before
        before += n
    own = F.row_number().over(Window.partitionBy("part").orderBy(*columns)) - 1
    return part.select(*columns, (F.get(F.array(*(F.lit(x).cast("long") for x in starts)), "part") + own).alias(rank))


def _repeated(docs: DataFrame, min_words: int, key: str, text: str, scratch: Scratch) -> DataFrame:
    """(u, k, d, at, w, run, r0): the repeated lines, by place among those with a word, that stand in a run of such of min_words and more."""
    found = docs.where(F.col(text).isNotNull()).select(F.xxhash64(key, text).alias("u"), F.col(key).alias("k"), F.xxhash64(text).alias("d"), _lines(F.col(text)).alias("lines")).select(
        *DOC, _worded(F.col("lines")).alias("worded"))
    lines = scratch.keep(found.select(*DOC, F.posexplode("worded").alias("at", "x")).select(*DOC, "at", "x.h", "x.w"), "lines")
    names = _ranked(lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), ["h"], scratch, "r0")
    known = lines.join(names, "h").select(*DOC, "at", "w", "r0").dropDuplicates(["u", "at"])  # rows that repeat wholly are one document
    by_doc = Window.partitionBy("u").orderBy("at")
    placed = known.withColumn("run", F.col("at") - F.row_number().over(by_doc))
    words = F.sum("w").over(Window.partitionBy("u", "run"))
    return scratch.keep(placed.withColumn("words", words).where(F.col("words") >= min_words).drop("words"), "repeated")


def _suffixes(lines: DataFrame, min_words: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """lines with r1, r2 and so on: the ranks of the first 2, 4 and so on lines, as far as a run can need them; and how many ranks there are."""
    by_doc, n = Window.partitionBy("u").orderBy("at"), 1
    while 1 << n <= min_words:
        half = 1 << (n - 1)
        pairs = lines.withColumn("a", F.col(f"r{n - 1}")).withColumn("b", F.first(f"r{n - 1}").over(by_doc.rangeBetween(half, half)))
        twice = pairs.where("a is not null and b is not null").groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
        names = _ranked(twice, ["a", "b"], scratch, f"r{n}")
        lines = scratch.step(pairs.join(names, ["a", "b"], "left").drop("a", "b"))
        n += 1
    return lines, n


def _shapes(lines: DataFrame, min_words: int) -> DataFrame:
    """(k, d, at, n): the shortest runs from each line on, and up to each line."""
    def shortest(part: Column) -> Column:
        # lines until min_words are reached; 0: never
        return F.aggregate(part, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n")), lambda acc, w: F.struct(
            (acc["sum"] + w).alias("sum"), (acc["n"] + F.when(acc["sum"] < min_words, 1).otherwise(0)).alias("n")),
            lambda acc: F.when(acc["sum"] >= min_words, acc["n"]).otherwise(0))

    runs = lines.groupBy(*DOC, "run").agg(F.min("at").alias("from"), F.transform(F.sort_array(F.collect_list(F.struct("at", "w"))), lambda x: x["w"]).alias("ws"))  # of one text
    most, ws = F.lit(min_words), F.col("ws")
    onward = F.transform(ws, lambda _, s: let(shortest(F.slice(ws, s + 1, most)), lambda n: F.struct((F.col("from") + s).alias("at"), n.alias("n"))))
    upto = F.transform(ws, lambda _, e: let(
        shortest(F.reverse(F.slice(ws, F.greatest(F.lit(1), e + 2 - most), F.least(e + 1, most)))),
        lambda n: F.struct((F.col("from") + e + 1 - n).alias("at"), n.alias("n"))))
    return runs.select(*DOC, F.explode(F.concat(onward, upto)).alias("x")).select(*DOC, "x.at", "x.n").where("n > 0").distinct()


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, d, cut): for a document, of key k and the text's fingerprint d, the places among its worded lines that later copies cover."""
    with Scratch(docs.sparkSession) as scratch:
        lines, n = _suffixes(_repeated(docs, min_words, key, text, scratch), min_words, scratch)
        ranks = lines.select("u", "at", F.array(*(F.col(f"r{i}") for i in range(n))).alias("ranks"))
        level = F.least(F.lit(n - 1), F.floor(F.log2("n") + 1e-9).cast("int"))
        # the run's first and last 2^level lines
        runs = _shapes(lines, min_words).withColumn("level", level).join(ranks, ["u", "at"]).select(
            *DOC, "at", "n", "level", F.get("ranks", "level").alias("a"), (F.col("at") + F.col("n") - F.expr("shiftleft(1, level)")).alias("to")).where("a is not null")
        runs = runs.join(ranks.withColumnRenamed("at", "to"), ["u", "to"]).select(*DOC, "at", "n", "a", F.get("ranks", "level").alias("b")).where("b is not null")
        runs = scratch.step(runs.select(*DOC, "at", "n", F.struct("n", "a", "b").alias("interval")))
        place = F.struct("k", "d", "at")
        first = runs.groupBy("interval").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("not (first <=> last)").select("interval", "first")
        later = runs.join(first, "interval").where(~place.eqNullSafe(F.col("first")))
        return cut(later.groupBy(*DOC).agg(F.collect_set(F.struct("at", "n")).alias("runs")).select(
            "k", "d", F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["at"], r["at"] + r["n"] - 1)))).alias("cut")))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text", out: str = "line_dedup") -> DataFrame:
    """docs with the later copies gone from the text, and a struct out of n_lines, n_removed and removed (places of the lines, from 0)."""
    gone = later_copies(docs, min_words, key, text).select(F.col("k").alias("k2"), F.col("d").alias("d2"), "cut")
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("d"))
    rows = packed.join(gone, F.col("k").eqNullSafe(F.col("k2")) & (F.col("d") == F.col("d2")), "left")
    none = F.expr("cast(array() as array<int>)")

    def places(lines: Column) -> Column:
        worded = F.filter(F.transform(lines, lambda x, i: F.when(F.trim(x, F.lit(BLANKS)) != "", i)), lambda i: i.isNotNull())
        return let(worded, lambda at: F.sort_array(F.transform("cut", lambda o: F.get(at, o))))

    def rebuilt(lines: Column) -> Column:
        return let(F.coalesce(F.when(F.col("cut").isNotNull(), places(lines)), none), lambda removed: F.struct(
            F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"), F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"),
            F.when(F.size(removed) > 0, F.array_join(F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed), lambda i: F.get(lines, i)), "\n")).otherwise(F.col("t")).alias("text")))

    done = rows.select("row", let(_lines(F.col("t")), rebuilt).alias("x"))
    kept = [F.col("x.text").alias(text) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns if c != out]
    return done.select(*kept, F.struct("x.n_lines", "x.n_removed", "x.removed").alias(out))


def digest(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    out = dedup(docs.select("doc_id", "text"), min_words)
    x = F.col("line_dedup")
    return out.select("doc_id", x["n_lines"].alias("n_lines"), x["n_removed"].alias("n_removed"),
                      F.array_join(F.transform(x["removed"], lambda i: i.cast("string")), ",").alias("removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
