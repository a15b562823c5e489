"""Benchmark decontamination through a positional inverted index.

A test window is 13 consecutive words of a benchmark item, or a whole shorter item. The corpus
frequency of each test term gives the rarest terms of a window, its anchors. The index holds the
training postings (term, document, position) of the anchors. Adjusted by the anchors' offsets in
the window, the lists of one window and document intersect in the starts of possible phrases;
starts of different anchors that are a little apart are proximity matches. A phrase is exact if
the words at its start are those of the window.

Defined cases: null or wordless texts have no words, no hits and are not contaminated; wordless
items have no window; items that share a window all count. Documents that repeat with one key
are judged by their own texts. Empty tables give empty results, an empty benchmark no hits.
Other columns are not read. Texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.llm.common import cut, let, lower_ascii
from vetrina.llm.url_filter import salted_join

WINDOW = 13
ANCHORS = 2
#: How far a proximity match's anchors may be from their places in the window.
SLACK = 3
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Test terms, or anchor rows, up to which that side of a join is broadcast: about 64 MB.
BROADCAST_ROWS = 500_000
#: Bits a listed term of the table that longer lists are told by, and all of its bits.
BITS_EACH, TABLE_BITS = 64, 1 << 26


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def _fits(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _small(df: DataFrame) -> DataFrame:
    """df, broadcast if a count says that it may be."""
    return F.broadcast(df) if _fits(df) else df


def windows(items: DataFrame, size: int = WINDOW, key: str = "item_id", text: str = "text") -> DataFrame:
    """(wid, words, items): the distinct windows with the items that have them."""
    listed = items.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))
    return listed.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words")).groupBy("words").agg(
        F.collect_set("item").alias("items")).select(F.sha2(F.array_join("words", " "), 256).alias("wid"), "words", "items")


def _listed(words: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of words (term, ...) whose term is listed and, as the filter is hashed, a few others; nothing is moved.

    For lists too large to be broadcast: a bit table of their hashes is, of TABLE_BITS at most.
    """
    n = terms.count()
    bits = max(1 << 12, min(TABLE_BITS, 1 << (BITS_EACH * n).bit_length()))
    place = F.pmod(F.xxhash64("term"), F.lit(bits))
    table = terms.select(place.alias("_b")).groupBy(F.expr("_b div 64").alias("_w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_b % 64 as int))")).alias("_m"))
    hit = words.withColumn("_b", place).withColumn("_w", F.expr("_b div 64")).join(F.broadcast(table), "_w")
    return hit.where("shiftright(_m, cast(_b % 64 as int)) & 1 = 1").drop("_w", "_b", "_m")


def term_counts(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): occurrences in the corpus of the terms listed."""
    words = docs.select(F.explode(words_of(F.col(text))).alias("term"))
    # where the terms can't be broadcast, the words that may be among them are counted before they are moved
    seen = (words.join(F.broadcast(terms), "term") if _fits(terms) else _listed(words, terms)).groupBy("term").count()
    return terms.join(seen, "term", "left").select("term", F.coalesce("count", F.lit(0)).alias("n"))


def anchors(wins: DataFrame, counts: DataFrame, n: int = ANCHORS) -> DataFrame:
    """(wid, rank, term, off): the rarest terms of each window; ties go to the earlier place."""
    # 13 rows a window at most
    placed = wins.select("wid", F.posexplode("words").alias("off", "term")).join(counts, "term")
    order = Window.partitionBy("wid").orderBy("n", "off")
    return placed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("wid", "rank", "term", "off")


def postings(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: (key, pos, columns of terms) for each place of a listed term."""
    words = docs.select(F.col(key), F.posexplode(words_of(F.col(text))).alias("pos", "term"))
    if _fits(terms):
        return words.join(F.broadcast(terms), "term")
    return salted_join(_listed(words, terms), terms, "term", F.xxhash64(key, "pos")).where("wid is not null")


def phrase_starts(docs: DataFrame, wins: DataFrame, slack: int = SLACK, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, wid, starts, near): where all anchors agree, and whether some agree but for 1 to slack places."""
    marks = cut(anchors(wins, term_counts(docs, wins.select(F.explode("words").alias("term")).distinct(), text)))
    rows = postings(docs, marks, key, text).select(key, "wid", "rank", (F.col("pos") - F.col("off")).alias("start"))
    lists = rows.groupBy(key, "wid").agg(*(F.collect_set(F.when(F.col("rank") == r, F.col("start"))).alias(f"s{r}") for r in range(1, ANCHORS + 1)))
    first = F.col("s1")
    size = marks.groupBy("wid").agg(F.max("rank").alias("n"))
    both, near = first, F.lit(False)
    for r in range(2, ANCHORS + 1):
        other = F.col(f"s{r}")
        both = F.when(F.col("n") >= r, F.array_intersect(both, other)).otherwise(both)
        for d in [x for x in range(-slack, slack + 1) if x]:
            near = near | F.arrays_overlap(_moved(first, d), other)
    out = lists.join(_small(size), "wid").select(key, "wid", F.filter(both, lambda s: s >= 0).alias("starts"), near.alias("near"))
    return out.where((F.size("starts") > 0) | F.col("near"))


def _moved(starts: Column, by: int) -> Column:
    return F.transform(starts, lambda s: s + by)


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, hits, near): hits is array<struct<start, words, items>> of exact phrases, near lists windows with a proximity match."""
    wins = cut(windows(items))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(key, text).alias("row"))  # ids may repeat with other texts
    found = phrase_starts(rows, wins, key="row", text="t").join(_small(wins), "wid")
    listed = found.groupBy("row").agg(
        F.collect_list(F.struct("starts", "words", "items")).alias("found"),
        F.collect_set(F.when(F.col("near"), F.col("wid"))).alias("near"))
    rows = rows.join(listed, "row", "left")

    def exact(words: Column) -> Column:
        hits = F.flatten(F.transform("found", lambda x: F.transform(F.filter(
            x["starts"], lambda s: F.slice(words, s + 1, F.size(x["words"])) == x["words"]),
            lambda s: F.struct(s.alias("start"), F.size(x["words"]).alias("n"), x["items"].alias("items")))))
        return F.struct(F.size(words).cast("long").alias("n_words"), hits.alias("hits"))

    return rows.select(F.col("k").alias(key), let(words_of(F.col("t")), exact).alias("x"), F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near")).select(
        key, "x.n_words", "x.hits", "n_near")


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, n_near, contaminated)."""
    def facts(hits: Column) -> Column:
        places = F.flatten(F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1)))
        return F.struct(F.size(F.array_distinct(places)).cast("long").alias("n_hit"),
                        F.sort_array(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["items"])))).alias("items"))

    none = F.expr("cast(array() as array<struct<start:int,n:int,items:array<string>>>)")
    rows = matches(docs, items, key, text).select(key, "n_words", "n_near", let(F.coalesce("hits", none), facts).alias("f"))
    return rows.select(key, "n_words", "f.n_hit", F.size("f.items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("f.items", ","), 256).alias("items_sha256"), "n_near",
                       ((F.col("f.n_hit") > 0) & (20 * F.col("f.n_hit") >= F.col("n_words"))).alias("contaminated"))
