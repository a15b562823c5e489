"""The model's tables over the test tables: for Spark, and as common table expressions for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2026-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return t("lineitem").join(t("part"), F.expr("l_partkey = p_partkey")).join(t("supplier"), F.expr("l_suppkey = s_suppkey")).join(
        t("orders"), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "cast(l_partkey as string) as key", "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as item_id", "p_name as title",
        "o_orderpriority as snippet", "l_extendedprice as price", "case when l_suppkey % 10 <> 0 then cast(l_suppkey as string) end as seller_id",
        "case when l_suppkey % 20 <> 0 then s_name end as seller_name", "cast(l_quantity as int) as seller_reviews",
        "cast(l_quantity as int) % 6 as images_count", "md5(concat(cast(l_suppkey % 40 as string), '|', l_linestatus)) as image_hash",
        "l_orderkey % 500 as vec_id", "l_shipdate as created_at", "o_custkey as custkey")


LISTINGS = """listings AS (SELECT l_partkey::VARCHAR AS key, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS item_id, p_name AS title,
  o_orderpriority AS snippet, l_extendedprice AS price, CASE WHEN l_suppkey % 10 <> 0 THEN l_suppkey::VARCHAR END AS seller_id,
  CASE WHEN l_suppkey % 20 <> 0 THEN s_name END AS seller_name, l_quantity::INT AS seller_reviews, l_quantity::INT % 6 AS images_count,
  md5(concat((l_suppkey % 40)::VARCHAR, '|', l_linestatus)) AS image_hash, l_orderkey % 500 AS vec_id, l_shipdate AS created_at, o_custkey AS custkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey)"""


def keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) as key", "element_at(array('NEW','CATALOG_PARSED','VALIDATING','VALIDATED'), cast(p_size % 4 + 1 as int)) as state",
        "date_add(date'2025-01-01', cast(p_partkey % 300 as int)) as created_at")


KEYS = """keys AS (SELECT p_partkey::VARCHAR AS key, (['NEW','CATALOG_PARSED','VALIDATING','VALIDATED'])[p_size % 4 + 1] AS state,
  DATE '2025-01-01' + (p_partkey % 300)::INT AS created_at FROM part)"""


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) as item_id", "event_type as key", "ts as parsed_at", "case when event_id % 17 <> 0 then cast(floor(value) as int) end as views", "value as price", "props")


MEASUREMENTS = """measurements AS (SELECT user_id::VARCHAR AS item_id, event_type AS key, ts AS parsed_at,
  CASE WHEN event_id % 17 <> 0 THEN floor(value)::INT END AS views, value AS price, props FROM events)"""


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as task_id", "case when o_orderkey % 2 = 0 then 'catalog' else 'object' end as kind", "cast(o_custkey as string) as key",
        "case o_orderstatus when 'P' then 'pending' when 'O' then 'processing' else 'completed' end as status",
        "concat('w', o_custkey % 12) as worker_id", "o_orderdate as heartbeat_at", "cast(o_orderkey % 9 as int) as checkpoint")


TASKS = """tasks AS (SELECT o_orderkey AS task_id, CASE WHEN o_orderkey % 2 = 0 THEN 'catalog' ELSE 'object' END AS kind, o_custkey::VARCHAR AS key,
  CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'O' THEN 'processing' ELSE 'completed' END AS status,
  concat('w', o_custkey % 12) AS worker_id, o_orderdate AS heartbeat_at, (o_orderkey % 9)::INT AS checkpoint FROM orders)"""


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored verdict log: three stages an item, with gaps, from the listings."""
    rows = listings(spark, sf_dir)
    return rows.selectExpr("key", "item_id", "explode(array(named_struct('stage','price_filter','passed',price >= 8000,'on',true),"
                           "named_struct('stage','mechanical','passed',images_count > 1,'on',price >= 8000),"
                           "named_struct('stage','ai','passed',seller_reviews > 20,'on',price >= 8000 and images_count > 1 and vec_id % 3 <> 0),"
                           "named_struct('stage','seller_dedup','passed',false,'on',images_count = 5))) as v").where("v.on").selectExpr(
        "key", "item_id", "v.stage", "v.passed", "case when not v.passed then concat('rule ', v.stage) end as reason")


VERDICTS = """verdicts AS (SELECT key, item_id, v.stage AS stage, v.passed AS passed, CASE WHEN NOT v.passed THEN concat('rule ', v.stage) END AS reason FROM (
  SELECT key, item_id, unnest([{'stage': 'price_filter', 'passed': price >= 8000, 'live': true}, {'stage': 'mechanical', 'passed': images_count > 1, 'live': price >= 8000},
  {'stage': 'ai', 'passed': seller_reviews > 20, 'live': price >= 8000 AND images_count > 1 AND vec_id % 3 <> 0}, {'stage': 'seller_dedup', 'passed': false, 'live': images_count = 5}]) AS v FROM listings) WHERE v.live)"""


def sql(*ctes: str) -> str:
    """A WITH clause of the tables named."""
    return "WITH " + ", ".join(ctes) + " "
