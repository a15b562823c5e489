"""Queries of states, tasks and leases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.operators import lifecycle as L
from vetrina.queries import query

t = X.table
_EDGES = (("signup", "view"), ("view", "click"), ("click", "purchase"), ("click", "error"), ("error", "view"))
_E = "SELECT user_id, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS source, event_type AS target FROM events"


def states(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").selectExpr("user_id as id", "ts", "event_id as seq", "event_type as state", "event_type = 'error' as failed")


@query("state_transition_audit", f"SELECT user_id AS id, ts, source, target, CASE WHEN (source, target) IN (('signup', 'view'), ('view', 'click'), ('click', 'purchase'), ('click', 'error'), ('error', 'view')) THEN 'legal' WHEN source = 'purchase' THEN 'from_final' ELSE 'illegal' END AS verdict FROM ({_E}) WHERE source <> target")
def audit(spark: SparkSession, d: str) -> DataFrame:
    return L.transition_audit(states(spark, d), _EDGES, ("purchase",))


@query("latest_state", "SELECT user_id AS id, arg_max(event_type, {'a': ts, 'b': event_id}) AS state FROM events GROUP BY user_id")
def latest(spark: SparkSession, d: str) -> DataFrame:
    return L.latest_state(states(spark, d))


@query("guarded_update", X.sql(X.KEYS) + "SELECT key AS id, CASE WHEN r AND state = 'NEW' THEN 'CATALOG_PARSING' ELSE state END AS value, CASE WHEN r THEN state = 'NEW' END AS applied FROM (SELECT key, state, key::BIGINT % 2 = 0 AS r FROM keys)")
def guarded(spark: SparkSession, d: str) -> DataFrame:
    keys = X.keys(spark, d)
    requests = keys.where("cast(key as bigint) % 2 = 0").selectExpr("key as id", "'NEW' as expected", "'CATALOG_PARSING' as new")
    return L.guarded_update(keys.selectExpr("key as id", "state as value"), requests)


@query("guarded_update_counts", X.sql(X.KEYS) + "SELECT count(*) FILTER (state = 'NEW') AS applied, count(*) FILTER (state <> 'NEW') AS skipped FROM keys WHERE key::BIGINT % 2 = 0")
def guarded_counts(spark: SparkSession, d: str) -> DataFrame:
    return L.update_counts(guarded(spark, d))


_STEPS = "(['NEW','CATALOG_PARSED','VALIDATING','VALIDATED'])"
_REQUESTS = f"""asked AS (SELECT l_partkey::VARCHAR AS id, CASE WHEN l_quantity < 49 THEN {_STEPS}[l_linenumber % 4 + 1] END AS expected, CASE WHEN l_tax < 0.08 THEN {_STEPS}[(l_linenumber + 1) % 4 + 1] END AS new,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_tax) AS i FROM lineitem),
  walk AS (SELECT key AS id, state AS value, 0 AS i, 0::BIGINT AS applied FROM keys
    UNION ALL SELECT w.id, CASE WHEN w.value = a.expected THEN a.new ELSE w.value END, a.i, w.applied + CASE WHEN w.value = a.expected THEN 1 ELSE 0 END FROM walk w JOIN asked a ON a.id = w.id AND a.i = w.i + 1)"""


@query("guarded_update_sequence", X.sql(X.KEYS, _REQUESTS).replace("WITH ", "WITH RECURSIVE ", 1) + "SELECT id, value, applied, i - applied AS skipped FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY i DESC) AS last FROM walk) WHERE last = 1")
def guarded_sequence(spark: SparkSession, d: str) -> DataFrame:
    """A part's line items are requests to move its key on, one after the other; some expect or set no state."""
    steps = "array('NEW','CATALOG_PARSED','VALIDATING','VALIDATED')"
    asked = t(spark, d, "lineitem").selectExpr(
        "cast(l_partkey as string) as id", f"case when l_quantity < 49 then {steps}[cast(l_linenumber % 4 as int)] end as expected", f"case when l_tax < 0.08 then {steps}[cast((l_linenumber + 1) % 4 as int)] end as new",
        "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_tax")
    order = ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_tax")
    return L.guarded_updates(X.keys(spark, d).selectExpr("key as id", "state as value"), asked, order)


@query("oldest_pending", X.sql(X.TASKS) + "SELECT task_id, key FROM tasks WHERE status = 'pending' AND key::BIGINT % 2 = 0 ORDER BY heartbeat_at, task_id LIMIT 25")
def oldest(spark: SparkSession, d: str) -> DataFrame:
    parents = t(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr("cast(c_custkey as string) as key")
    return L.oldest_pending(X.tasks(spark, d), parents, 25).select("task_id", "key")


@query("expired_leases", X.sql(X.TASKS) + "SELECT task_id, worker_id FROM tasks WHERE status = 'processing' AND heartbeat_at < TIMESTAMP '2024-01-01' - INTERVAL 1800 SECONDS")
def expired(spark: SparkSession, d: str) -> DataFrame:
    return L.expired(X.tasks(spark, d), "2024-01-01 00:00:00", 1800).select("task_id", "worker_id")


@query("orphaned_parents", "SELECT c_custkey::VARCHAR AS key FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def orphaned(spark: SparkSession, d: str) -> DataFrame:
    return L.orphaned(t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("cast(c_custkey as string) as key"), X.tasks(spark, d))


@query("cascade_delete", "SELECT 'lineitem' AS name, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 20) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 20)")
def cascade(spark: SparkSession, d: str) -> DataFrame:
    left = L.cascade_delete(t(spark, d, "part").where("p_size < 20").selectExpr("p_partkey as key"), {"lineitem": (t(spark, d, "lineitem"), "l_partkey"), "orders": (t(spark, d, "orders"), "o_custkey")})
    one = lambda n: left[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
    return one("lineitem").union(one("orders"))


@query("reset_keys", X.sql(X.KEYS) + "SELECT key, state FROM keys WHERE key::BIGINT % 5 <> 0 UNION ALL SELECT DISTINCT (p_partkey * 5)::VARCHAR, 'NEW' FROM part")
def reset(spark: SparkSession, d: str) -> DataFrame:
    return L.reset_keys(X.keys(spark, d), t(spark, d, "part").selectExpr("cast(p_partkey * 5 as string) as key"))


@query("rollback_key", X.sql(X.KEYS, X.LISTINGS, X.VERDICTS) + "SELECT k.key, CASE WHEN state = 'VALIDATING' AND k.key::BIGINT % 2 = 0 THEN 'CATALOG_PARSED' ELSE state END AS state, CASE WHEN state = 'VALIDATING' AND k.key::BIGINT % 2 = 0 THEN 0 ELSE count(v.key) END AS n_verdicts FROM keys k LEFT JOIN verdicts v ON v.key = k.key GROUP BY k.key, state")
def rollback(spark: SparkSession, d: str) -> DataFrame:
    keys = X.keys(spark, d)
    moved, left = L.rollback(keys, X.verdicts(spark, d), keys.where("cast(key as bigint) % 2 = 0").select("key"), "VALIDATING", "CATALOG_PARSED")
    return moved.join(left.groupBy("key").agg(F.count("*").alias("n")), "key", "left").select("key", "state", F.coalesce("n", F.lit(0)).alias("n_verdicts"))


_RUNS = """WITH e AS (SELECT user_id AS id, event_type = 'error' AS failed, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM events),
  i AS (SELECT id, island, count(*) FILTER (failed) AS n FROM e GROUP BY id, island) SELECT id, arg_max(n, island) AS run, max(n) >= 3 AS blocked FROM i GROUP BY id"""


@query("consecutive_errors", _RUNS)
def runs(spark: SparkSession, d: str) -> DataFrame:
    return L.consecutive_errors(states(spark, d))


@query("retry_counter", "SELECT user_id AS id, count(*) FILTER (event_type = 'error') AS retries FROM events GROUP BY user_id")
def retries(spark: SparkSession, d: str) -> DataFrame:
    return L.retry_counter(states(spark, d))


@query("latest_progress", "SELECT user_id AS task_id, arg_max((props->>'$.k')::INT, {'a': ts, 'b': event_id}) AS page, max(ts) AS heartbeat_at FROM events GROUP BY user_id")
def progress(spark: SparkSession, d: str) -> DataFrame:
    return L.latest_progress(t(spark, d, "events").selectExpr("user_id as task_id", "ts", "event_id as seq", "cast(get_json_object(props, '$.k') as int) as page"))


@query("task_seed", X.sql(X.KEYS) + "SELECT key, 'pending' AS status, 1 AS checkpoint, 0 AS retry_count FROM keys WHERE state = 'NEW' AND key NOT IN (SELECT o_custkey::VARCHAR FROM orders)")
def seed(spark: SparkSession, d: str) -> DataFrame:
    return L.task_seed(X.keys(spark, d), X.tasks(spark, d))
