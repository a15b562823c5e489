"""Sources of key lists and delimited records, from text lines (a column ``value``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _judged(rows: DataFrame, comment: str | None, least: int, most: int) -> DataFrame:
    key = F.trim(F.col("value"))
    skipped = F.when(key == "", "blank")
    if comment:
        skipped = skipped.when(key.startswith(comment), "comment")
    return rows.select(key.alias("key"), skipped.when(F.length(key) < least, "short").when(F.length(key) > most, "long").alias("skipped"))


def key_list(rows: DataFrame, comment: str | None = "#", least: int = 1, most: int = 255) -> DataFrame:
    """(key): trimmed, distinct, without blanks, comments and keys of a wrong length."""
    return _judged(rows, comment, least, most).where("skipped is null").select("key").distinct()


def key_list_counts(rows: DataFrame, comment: str | None = "#", least: int = 1, most: int = 255) -> DataFrame:
    """One row: lines, skipped and duplicate lines."""
    return _judged(rows, comment, least, most).groupBy("key", "skipped").count().agg(
        F.sum("count").alias("lines"), F.coalesce(F.sum(F.when(F.col("skipped").isNotNull(), F.col("count"))), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(F.col("skipped").isNull(), F.col("count") - 1)), F.lit(0)).alias("duplicates"))


def numeric_ids(rows: DataFrame) -> DataFrame:
    """(id, good): distinct non-blank lines; good if all digits."""
    key = F.trim(F.col("value"))
    return rows.select(key.alias("id")).where("id <> ''").distinct().withColumn("good", F.col("id").rlike("^[0-9]+$"))


def delimited_records(rows: DataFrame) -> DataFrame:
    """(host, port, username, secret, valid) of a:b[:c[:d]] lines; the port is an integer from 1 to 65535."""
    parts = F.split(F.trim(F.col("value")), ":", 4)
    port = F.get(parts, F.lit(1)).try_cast("int")
    fields = rows.select(F.get(parts, F.lit(0)).alias("host"), port.alias("port"), F.get(parts, F.lit(2)).alias("username"), F.get(parts, F.lit(3)).alias("secret"))
    return fields.withColumn("valid", (F.col("host") != "") & F.coalesce(F.col("port").between(1, 65535), F.lit(False)))


def masked(value: Column) -> Column:
    """The record with its fourth field hidden."""
    parts = F.split(value, ":", 4)
    return F.when(F.size(parts) >= 4, F.concat_ws(":", F.slice(parts, 1, 3), F.lit("****"))).otherwise(value)
