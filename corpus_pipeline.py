"""A corpus pipeline over ``documents``: five stages, each one operator of vetrina.llm.

Every stage reads all that its predecessor kept, written as Parquet. A stage takes
(spark, docs, sf_dir); all but the last return the columns of ``documents``. Null or blank texts
are rejected by the first stage; empty tables give empty results; rows that repeat with one
doc_id stay together until the near-duplicate stage, which keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina.llm import bpe, decontamination, jaccard, line_dedup, quality
from vetrina.llm.common import BLANKS, Scratch, cut, table
from vetrina.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the standard policy go."""
    return quality.keep(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words and more go; so does a document of which no word is left."""
    name = "line_dedup" + "_" * max((len(c) for c in docs.columns), default=0)  # a column that the documents haven't
    out = line_dedup.dedup(docs, out=name)
    changed, blank = F.col(name)["n_removed"] > 0, F.trim(F.col("text"), F.lit(BLANKS)) == ""
    return out.where(~(changed & blank)).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a fingerprint of id and text in a column that they haven't: ids may be null or repeat with other texts."""
    name = "row_id" + "_" * max((len(c) for c in docs.columns), default=0)
    return docs.withColumn(name, F.xxhash64("doc_id", "text")), name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents linked by a Jaccard similarity of 0.8 the one with the least doc_id stays, once."""
    rows, row = _named(docs)
    found = jaccard.classes(rows, key=row)
    best = found.join(rows.select("doc_id", row).distinct(), row).groupBy("component_id").agg(F.min(F.struct("doc_id", row)).alias("best"))
    single = rows.join(best.select(F.col("best")[row].alias(row)), row, "left_semi")
    twice = found.where("n_shingles > 0").groupBy(row).count().where("count > 1").select(row)
    if not twice.isEmpty():
        again = single.join(twice, row, "left_semi").dropDuplicates([row])
        single = single.join(twice, row, "left_anti").unionByName(again)
    return single.select(*docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    rows, row = _named(docs)
    found = decontamination.report(rows, table(spark, sf_dir, "benchmark"), key=row).where("contaminated").select(row).distinct()
    return rows.join(found, row, "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of each document's BPE tokens."""
    return bpe.digests(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("tokens", tokens),
]

#: BPE can't be said in SQL: the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark) as scratch:
        for name, stage in STAGES:
            docs = scratch.keep(stage(spark, docs, sf_dir), name)
        return cut(docs)
