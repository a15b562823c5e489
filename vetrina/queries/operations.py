"""Queries of operational counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.operators import counts as C
from vetrina.queries import query

t = X.table
_T = X.sql(X.TASKS)


@query("task_status_counts", _T + "SELECT status, count(*) FILTER (kind = 'catalog') AS catalog, count(*) FILTER (kind = 'object') AS object FROM tasks GROUP BY status")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.status_counts(X.tasks(spark, d), ("catalog", "object"))


@query("pool_counts", "SELECT count(*) FILTER (NOT b AND NOT u) AS available, count(*) FILTER (u AND NOT b) AS in_use, count(*) FILTER (b) AS blocked, count(*) AS total FROM (SELECT c_acctbal < 0 AS b, c_custkey % 3 = 0 AS u FROM customer)")
def pool(spark: SparkSession, d: str) -> DataFrame:
    return C.pool_counts(t(spark, d, "customer").selectExpr("c_acctbal < 0 as is_blocked", "c_custkey % 3 = 0 as is_in_use"))


@query("state_counts_total", X.sql(X.KEYS) + "SELECT state, count(*) AS n FROM keys GROUP BY ROLLUP (state)")
def states(spark: SparkSession, d: str) -> DataFrame:
    return C.state_counts(X.keys(spark, d))


@query("verdict_counts", X.sql(X.LISTINGS, X.VERDICTS) + "SELECT stage, count(*) FILTER (passed) AS n_passed, count(*) FILTER (NOT passed) AS n_rejected FROM verdicts GROUP BY stage")
def verdict_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.verdict_counts(X.verdicts(spark, d))


@query("active_workers", _T + "SELECT kind, count(DISTINCT worker_id) AS workers FROM tasks WHERE status = 'processing' GROUP BY ROLLUP (kind)")
def workers(spark: SparkSession, d: str) -> DataFrame:
    return C.active_workers(X.tasks(spark, d))


@query("table_cardinalities", "SELECT 'lineitem' AS name, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_keys FROM lineitem UNION ALL SELECT 'orders', count(*), count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events")
def cardinalities(spark: SparkSession, d: str) -> DataFrame:
    return C.cardinalities({n: (t(spark, d, n), k) for n, k in (("lineitem", "l_partkey"), ("orders", "o_custkey"), ("events", "user_id"))})


@query("backlog_keys", X.sql(X.KEYS, X.LISTINGS) + "SELECT key, count(*) OVER () AS n FROM keys WHERE state = 'VALIDATED' AND key IN (SELECT key FROM listings WHERE price > 90000)")
def backlog(spark: SparkSession, d: str) -> DataFrame:
    keys = X.keys(spark, d).where("state = 'VALIDATED'").join(X.listings(spark, d).where("price > 90000"), "key", "left_semi").select("key")
    return keys.withColumn("n", keys.agg(F.count("*")).scalar())


_COV = "cov AS (SELECT k.key, count(l.item_id) AS n_rows, count(*) FILTER (images_count > 0 AND price > 60000) AS n_with_items FROM keys k LEFT JOIN (SELECT * FROM listings WHERE price > 40000) l ON l.key = k.key GROUP BY k.key)"


def cover(spark: SparkSession, d: str) -> DataFrame:
    rows = X.listings(spark, d).where("price > 40000").selectExpr("key", "case when price > 60000 then slice(array(1, 2, 3, 4, 5), 1, images_count) end as images")
    return C.coverage(X.keys(spark, d).select("key"), rows, F.col("images"))


@query("coverage_by_key", X.sql(X.KEYS, X.LISTINGS, _COV) + "SELECT * FROM cov")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    return cover(spark, d)


@query("readiness_buckets", X.sql(X.KEYS, X.LISTINGS, _COV) + """SELECT CASE WHEN c.key IS NULL THEN 'not_in_table' WHEN n_rows = 0 THEN 'not_collected' WHEN n_with_items = 0 THEN 'no_images' ELSE 'ready' END AS bucket, count(*) AS n
  FROM (SELECT (p_partkey * 3)::VARCHAR AS key FROM part) w LEFT JOIN cov c ON c.key = w.key GROUP BY 1""")
def readiness(spark: SparkSession, d: str) -> DataFrame:
    return C.readiness(t(spark, d, "part").selectExpr("cast(p_partkey * 3 as string) as key"), X.keys(spark, d), cover(spark, d))


@query("impact_counts", "SELECT 'lineitem' AS name, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 7) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey IN (SELECT p_partkey FROM part WHERE p_size = 7)")
def impact(spark: SparkSession, d: str) -> DataFrame:
    keys = t(spark, d, "part").where("p_size = 7").selectExpr("p_partkey as key")
    return C.impact(keys, {"lineitem": (t(spark, d, "lineitem"), "l_partkey"), "orders": (t(spark, d, "orders"), "o_custkey")})


@query("class_counts", "SELECT c AS event_type, count(event_type) AS n FROM (SELECT unnest(['click', 'view', 'absent']) AS c) LEFT JOIN events ON event_type = c GROUP BY c")
def class_counts(spark: SparkSession, d: str) -> DataFrame:
    return C.class_counts(t(spark, d, "events"), "event_type", ("click", "view", "absent"))
