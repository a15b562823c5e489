"""Streaming queries, each driven once over the test table as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina.queries import query
from vetrina.queries.lifecycle import _RUNS
from vetrina.sources.sinks import shared_path
from vetrina.streaming import jobs as J


#: Rows of a file of the copy.
ROWS = 1_000_000


def events(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of two micro-batches: always a copy of the table in two parts by time, each in equally many files."""
    table = spark.read.parquet(f"{d}/events.parquet")
    path = shared_path(spark, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    found = table.agg(F.percentile_approx(at, 0.5).alias("m"), F.count("*").alias("n")).first()
    files = max(1, -(-found["n"] // (2 * ROWS)))
    early = F.coalesce(at < F.lit(found["m"]), F.lit(False))
    for part in (table.where(early), table.where(~early)):
        part.repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)


@query("stream_velocity", "SELECT user_id::VARCHAR AS item_id, count(*) AS n, min(ts) AS first_at, max(ts) AS last_at, arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_value FROM events GROUP BY user_id")
def stream_velocity(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).selectExpr("cast(user_id as string) as item_id", "ts as parsed_at", "value as price")
    return J.latest(J.run_once(J.velocity(rows), shared_path(spark, "velocity"), "update"), ["item_id"])


@query("stream_consecutive_errors", _RUNS)
def stream_errors(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).selectExpr("user_id as id", "ts", "event_id as seq", "event_type = 'error' as failed")
    return J.consecutive_errors(rows, shared_path(spark, "errors"))


@query("stream_status_counts", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_status(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    out = J.latest(J.run_once(J.status_counts(rows, "ts", "event_type"), shared_path(spark, "status"), "update"), ["start", "event_type"])
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_dedup", "SELECT DISTINCT user_id FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return J.run_once(J.first_seen(rows, "user_id", "ts", "365 days"), shared_path(spark, "dedup")).select("user_id")


@query("stream_silence_alert", """SELECT user_id AS id, date_trunc('milliseconds', max(ts)) AS silent_since FROM events GROUP BY user_id
  HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""")
def stream_silence(spark: SparkSession, d: str) -> DataFrame:
    rows = events(spark, d).select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    return J.run_once(J.silence_alert(rows, 6 * 3600), shared_path(spark, "silence")).select("id", F.col("silent_since").cast("timestamp_ntz").alias("silent_since"))
