"""Queries of de-duplication, sets and model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.operators import dedup as D
from vetrina.operators import model_io as M
from vetrina.queries import query

t = X.table


@query("dedup_key", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1")
def dedup_key(spark: SparkSession, d: str) -> DataFrame:
    return D.first_per(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("dedup_title_snippet", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY lang, text")
def dedup_text(spark: SparkSession, d: str) -> DataFrame:
    return D.first_per(t(spark, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("h")), ["lang", "h"], ["doc_id"]).select("doc_id")


@query("dedup_title_snippet_removed", "SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, text FROM documents)))::BIGINT AS removed FROM documents")
def dedup_removed(spark: SparkSession, d: str) -> DataFrame:
    return D.removed_count(t(spark, d, "documents").select("lang", F.sha2("text", 256).alias("h")), ["lang", "h"])


@query("distinct_on_oldest", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def oldest(spark: SparkSession, d: str) -> DataFrame:
    return D.oldest_per(t(spark, d, "orders"), "o_custkey", "o_orderdate", ["o_orderkey"])


@query("seeded_sample", X.sql(X.KEYS, X.LISTINGS) + "SELECT key FROM keys WHERE state = 'VALIDATED' AND key IN (SELECT key FROM listings GROUP BY key HAVING count(*) >= 25) ORDER BY md5(concat('s1', key)), key LIMIT 10")
def sample(spark: SparkSession, d: str) -> DataFrame:
    many = X.listings(spark, d).groupBy("key").count().where("count >= 25")
    return D.seeded_sample(X.keys(spark, d).where("state = 'VALIDATED'").join(many, "key", "left_semi"), "key", "s1", 10).select("key")


@query("chunk_rows", "SELECT o_custkey, o_orderkey, ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) // 4)::INT AS chunk FROM orders")
def chunk_rows(spark: SparkSession, d: str) -> DataFrame:
    return D.chunks(t(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], 4).select("o_custkey", "o_orderkey", "chunk")


@query("union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer")
def union_distinct(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").selectExpr("o_custkey as k").union(t(spark, d, "customer").selectExpr("c_custkey")).distinct()


@query("union_all_exists", "SELECT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0 UNION ALL SELECT 1 FROM customer WHERE c_acctbal > 9000) AS found")
def exists(spark: SparkSession, d: str) -> DataFrame:
    return D.any_rows(t(spark, d, "orders").where("o_totalprice < 0"), t(spark, d, "customer").where("c_acctbal > 9000"))


@query("set_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders")
def difference(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").selectExpr("c_custkey as k").subtract(t(spark, d, "orders").selectExpr("o_custkey")).orderBy("k")


@query("prompt_batches", X.sql(X.LISTINGS) + """SELECT key, 'Judge: ' || to_json(list(CASE WHEN seller_name IS NULL THEN json_object('id', item_id, 'title', title, 'price', floor(price)::INT, 'snippet', snippet)
  ELSE json_object('id', item_id, 'title', title, 'price', floor(price)::INT, 'snippet', snippet, 'seller', seller_name) END ORDER BY item_id)) AS prompt FROM (SELECT * FROM listings QUALIFY row_number() OVER (PARTITION BY key ORDER BY item_id) <= 10) GROUP BY key""")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    return M.prompt_batches(X.listings(spark, d).withColumn("price", F.expr("cast(floor(price) as int)")), "Judge: ", 10)


_ITEMS = "items AS (SELECT DISTINCT key, replace(item_id, '-', '0') AS item_id, price, key::BIGINT % 6 AS form FROM listings)"


def items(spark: SparkSession, d: str) -> DataFrame:
    return X.listings(spark, d).selectExpr("key", "replace(item_id, '-', '0') as item_id", "price", "cast(key as bigint) % 6 as form").distinct()


def answers(rows: DataFrame) -> DataFrame:
    """Answers in six forms: clean, after thoughts, in prose, broken, without any id, and with an id on both lists."""
    ids = F.array_sort(F.collect_list(F.when(F.col("price") > 50000, F.col("item_id"))))
    bad = F.array_sort(F.collect_list(F.when(F.col("price") <= 20000, F.struct(F.col("item_id").alias("id"), F.lit("far").alias("reason")))))
    both = F.struct(ids.alias("passed_ids"), bad.alias("rejected"))
    json = rows.groupBy("key", "form").agg(F.to_json(both).alias("j"), F.max("item_id").alias("top"))
    raw = F.when(F.col("form") == 1, F.concat(F.lit('<think>{"passed_ids": [1]}\nhm</think>\n'), "j")).when(F.col("form") == 2, F.concat(F.lit("Here it is: "), "j", F.lit(" as asked"))).when(
        F.col("form") == 3, F.concat(F.lit("["), "j", F.lit(" {"))).when(F.col("form") == 4, "I cannot help.").otherwise(F.col("j"))
    return json.select("key", raw.alias("raw"))


_SAID = """said AS (SELECT key, item_id, price > 50000 AS passed, CASE WHEN price <= 20000 THEN 'far' END AS reason, form FROM items WHERE price > 50000 OR price <= 20000),
  heard AS (SELECT DISTINCT key FROM said WHERE form <> 4),
  v AS (SELECT key, item_id, passed, reason, 'ok' AS status FROM said WHERE form <> 4 UNION ALL SELECT DISTINCT key, NULL, NULL::BOOLEAN, 'no id recognised', 'error' FROM items WHERE key NOT IN (SELECT key FROM heard)
    UNION ALL SELECT key, item_id, false, 'not covered by the answer', 'ok' FROM items WHERE price <= 50000 AND price > 20000 AND key IN (SELECT key FROM heard))"""


@query("parse_llm_verdicts", X.sql(X.LISTINGS, _ITEMS, _SAID) + "SELECT * FROM v")
def parse_verdicts(spark: SparkSession, d: str) -> DataFrame:
    rows = items(spark, d)
    return M.parse_verdicts(answers(rows), rows.select("key", "item_id"))


def odd_answers(rows: DataFrame) -> DataFrame:
    """Answers in five other forms by key: empty lists, ids as numbers, further fields, no reasons, no list of the passed."""
    ids = F.array_sort(F.collect_list(F.when(F.col("price") > 50000, F.col("item_id"))))
    bad = F.array_sort(F.collect_list(F.when(F.col("price") <= 20000, F.struct(F.col("item_id").alias("id"), F.lit("far").alias("reason")))))
    json = rows.groupBy("key").agg(F.to_json(F.struct(ids.alias("passed_ids"), bad.alias("rejected"))).alias("j"))
    forms = [F.lit('{"passed_ids": [], "rejected": []}'), F.regexp_replace("j", '"([0-9]+)"', "$1"),
             F.concat(F.lit('<think>[1]</think>\n{"note": {"ids": ["1"]}, "x": null, '), F.substring("j", F.lit(2), F.length("j"))),
             F.regexp_replace("j", ',"reason":"far"', ""), F.regexp_replace("j", r'"passed_ids":\[[^\]]*\],', "")]
    return json.select("key", F.element_at(F.array(*forms), (F.col("key").cast("bigint") % 5 + 1).cast("int")).alias("raw"))


@query("parse_llm_verdicts_odd", X.sql(X.LISTINGS, "items AS (SELECT DISTINCT key, replace(item_id, '-', '0') AS item_id, price, key::BIGINT % 5 AS form FROM listings)",
       """said AS (SELECT key, item_id, price > 50000 AS passed, CASE WHEN price <= 20000 THEN CASE WHEN form = 3 THEN 'no reason given' ELSE 'far' END END AS reason
    FROM items WHERE (price > 50000 AND form IN (1, 2, 3)) OR (price <= 20000 AND form IN (1, 2, 3, 4)))""") + """SELECT key, item_id, passed, reason, 'ok' AS status FROM said
  UNION ALL SELECT DISTINCT key, NULL, NULL::BOOLEAN, 'no id recognised', 'error' FROM items WHERE key NOT IN (SELECT key FROM said)
  UNION ALL SELECT i.key, i.item_id, false, 'not covered by the answer', 'ok' FROM items i LEFT JOIN said s ON s.key = i.key AND s.item_id = i.item_id WHERE s.key IS NULL AND i.key IN (SELECT key FROM said)""")
def parse_odd(spark: SparkSession, d: str) -> DataFrame:
    rows = items(spark, d)
    return M.parse_verdicts(odd_answers(rows), rows.select("key", "item_id"))


@query("apply_verdicts", X.sql(X.LISTINGS, _ITEMS, _SAID) + "SELECT key, item_id, coalesce(v.passed, false) AS passed, CASE WHEN NOT coalesce(v.passed, false) THEN coalesce(v.reason, 'not_relevant') END AS reason FROM items LEFT JOIN v USING (key, item_id)")
def apply_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return M.apply_verdicts(items(spark, d), parse_verdicts(spark, d))


@query("fallback_verdicts", X.sql(X.LISTINGS, _ITEMS, _SAID) + "SELECT key, item_id, passed, reason FROM v WHERE status = 'ok' UNION ALL SELECT key, item_id, price > 30000, 'second' FROM items WHERE key NOT IN (SELECT key FROM heard)")
def fallback(spark: SparkSession, d: str) -> DataFrame:
    second = items(spark, d).selectExpr("key", "item_id", "price > 30000 as passed", "'second' as reason", "'ok' as status")
    return M.fallback_verdicts(parse_verdicts(spark, d), second).select("key", "item_id", "passed", "reason")


@query("parse_photo_classes", """SELECT o_orderkey AS batch_id, 'a' AS name, CASE o_orderkey % 4 WHEN 3 THEN 'error' ELSE 'new' END AS class, CASE o_orderkey % 4 WHEN 3 THEN 'the answer is no JSON' ELSE 'r1' END AS reason FROM orders
  UNION ALL SELECT o_orderkey, 'b', CASE o_orderkey % 4 WHEN 0 THEN 'used' ELSE 'error' END, CASE o_orderkey % 4 WHEN 0 THEN 'r2' WHEN 1 THEN 'no such class: odd' WHEN 2 THEN 'not named in the answer' ELSE 'the answer is no JSON' END FROM orders""")
def photos(spark: SparkSession, d: str) -> DataFrame:
    one, two = '{"photo":1,"status":"new","reason":"r1"}', '{"photo":2,"status":"used","reason":"r2"}'
    forms = [f'{{"results":[{one},{two}]}}', f'<think>x</think>{{"results":[{one},{{"photo":2,"status":"odd"}},{two}]}}', f'so: {{"results":[{one}]}} ok', "none"]
    raw = F.element_at(F.array(*map(F.lit, forms)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return M.parse_photo_classes(t(spark, d, "orders").select(F.col("o_orderkey").alias("batch_id"), F.array(F.lit("a"), F.lit("b")).alias("names"), raw.alias("raw")))


@query("parse_event_jsonl", """SELECT event_id AS run, CASE event_id % 3 WHEN 0 THEN 'second' WHEN 1 THEN 'plain ' || event_type END AS message, CASE event_id % 3 WHEN 0 THEN event_id END AS tokens_in,
  CASE event_id % 3 WHEN 0 THEN 7::BIGINT END AS tokens_out, CASE event_id % 3 WHEN 2 THEN 'limit' END AS failure FROM events""")
def events(spark: SparkSession, d: str) -> DataFrame:
    msg = lambda s: f'{{"type":"item.completed","item":{{"type":"agent_message","text":"{s}"}}}}'
    full = F.concat(F.lit(msg("first") + "\nnoise\n" + msg("second") + '\n{"type":"turn.completed","usage":{"input_tokens":'), F.col("event_id"), F.lit(',"output_tokens":7}}\n'))
    raw = F.when(F.col("event_id") % 3 == 0, full).when(F.col("event_id") % 3 == 1, F.concat(F.lit(" plain "), "event_type")).otherwise(msg("x") + '\n{"type":"turn.failed","error":{"message":"limit"}}')
    return M.parse_events(t(spark, d, "events").select(F.col("event_id").alias("run"), raw.alias("raw")))
