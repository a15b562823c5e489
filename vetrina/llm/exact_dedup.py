"""Exact de-duplication by 128-bit hashes of normalised texts, with bytes compared inside groups.

Rows are counted by hash before they move. Of the groups of two and more, each task keeps the least
and the greatest text it has of a group: a group is of equal texts where the two are equal over all
tasks, so its rows need never meet, and a group of very many rows moves one text a task. A hash
whose texts differ (a collision) is divided by the texts themselves.

A group that holds more than a thousandth of all rows is among at most ``HOT`` such groups, so these
are broadcast to their rows; all others are joined by hash.

Defined cases: a null text counts as empty; the row with the greatest key stays, and a null key is
less than any; of rows that repeat with that key one stays; ``keep_id`` is null where no row of a
group has a key; an empty table gives an empty result. Only the key and the text are read, the
names of other columns don't matter. Texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import Scratch, cut, lower_ascii

#: Groups at most that can hold more than 1 / HOT of all rows.
HOT = 1_000
#: Hashes of repeated texts that are broadcast; beyond these the texts of all rows are compared, pre-aggregated like the others.
BROADCAST_ROWS = 1_000_000


def normal(text: Column) -> Column:
    """A-Z in lower case; null is empty. Most texts need no look at each character."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(lower_ascii(t))


def md5(text: Column) -> Column:
    return F.unhex(F.md5(text))


def label(docs: DataFrame, key: str = "doc_id", text: str = "text", hashed: Callable[[Column], Column] = md5, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, keep_id, group_size, kept, sha) of every row; sha is the SHA-256 of the normalised text."""
    with Scratch(docs.sparkSession) as scratch:
        texts = docs.select(F.col(key).alias("k"), normal(F.col(text)).alias("t")).select("k", "t", hashed(F.col("t")).alias("h"))
        rows = scratch.keep(texts.select("k", "h", F.unhex(F.sha2("t", 256)).alias("sha"), F.monotonically_increasing_id().alias("row")), "rows")
        groups = scratch.keep(_groups(rows, "h"), "groups")
        clash = scratch.keep(_clashes(texts, groups, broadcast_rows), "clash")
        parts = [_placed(rows, groups, ["h"])]
        if not clash.isEmpty():
            parts[0] = _placed(rows.join(clash, "h", "left_anti"), groups, ["h"])
            mixed = scratch.keep(texts.join(clash, "h", "left_semi").withColumn("row", F.monotonically_increasing_id()), "mixed")
            parts.append(_placed(mixed.withColumn("sha", F.unhex(F.sha2("t", 256))), scratch.keep(_groups(mixed, "h", "t"), "apart"), ["h", "t"]))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return cut(out.select(F.col("k").alias(key), *(c for c in out.columns if c != "k")))


def _groups(rows: DataFrame, *by: str) -> DataFrame:
    """(by, n, best): the rows of each group and the one that stays."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.max(F.struct("k", "row")).alias("best"))


def _clashes(texts: DataFrame, groups: DataFrame, broadcast_rows: int) -> DataFrame:
    """(h): hashes whose texts differ."""
    twice = groups.where("n > 1").select("h")
    if twice.count() <= broadcast_rows:
        texts = texts.join(F.broadcast(twice), "h", "left_semi")
    return texts.groupBy("h").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("h")


def _placed(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Each row with its group's size and whether it stays."""
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    large = F.col("n") * HOT > total
    hot, few = F.broadcast(groups.where(large)), groups.where(~large)
    found = rows.join(hot, by).unionByName(rows.join(F.broadcast(groups.where(large).select(*by)), by, "left_anti").join(few, by))
    return found.select("k", F.col("best.k").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("best.row")).alias("kept"), "sha")


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    packed = docs.select(F.col(key).alias("k"), F.unhex(F.sha2(normal(F.col(text)), 256)).alias("s"), F.struct(*docs.columns).alias("row"))
    stay = label(docs, key, text).where("kept").select(F.col(key).alias("kk"), F.col("sha").alias("ks"))
    found = packed.join(stay, F.col("k").eqNullSafe(F.col("kk")) & (F.col("s") == F.col("ks")), "left_semi")
    again = packed.groupBy("k", "s").count().where("count > 1").select(F.col("k").alias("kk"), F.col("s").alias("ks"))
    same = F.col("k").eqNullSafe(F.col("kk")) & (F.col("s") == F.col("ks"))
    one = found.join(again, same, "left_semi").groupBy("k", "s").agg(F.first("row").alias("row"))
    return found.join(again, same, "left_anti").select("row.*").unionByName(one.select("row.*"))


def digest(docs: DataFrame) -> DataFrame:
    return label(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))
