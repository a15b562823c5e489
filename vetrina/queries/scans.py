"""Queries of sources, sinks, projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.functions import text as T
from vetrina.operators import joins as J
from vetrina.operators import records as R
from vetrina.queries import query
from vetrina.sources import sinks, text

t = X.table
_LINES = "SELECT CASE WHEN c_custkey % 7 = 0 THEN '# note' WHEN c_custkey % 11 = 0 THEN '   ' ELSE concat('  ', c_mktsegment, '-', {m}, ' ') END AS value FROM customer"


def key_lines(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").selectExpr("case when c_custkey % 7 = 0 then '# note' when c_custkey % 11 = 0 then '   ' else concat('  ', c_mktsegment, '-', c_custkey % 40, ' ') end as value")


_L = _LINES.format(m="c_custkey % 40")


@query("src_keylist", f"SELECT DISTINCT trim(value) AS key FROM ({_L}) WHERE trim(value) <> '' AND NOT starts_with(trim(value), '#')")
def src_keylist(spark: SparkSession, d: str) -> DataFrame:
    return text.key_list(key_lines(spark, d))


@query("src_keylist_counts", f"""SELECT count(*) AS lines, count(*) FILTER (trim(value) = '' OR starts_with(trim(value), '#')) AS skipped,
  (count(*) FILTER (trim(value) <> '' AND NOT starts_with(trim(value), '#')) - count(DISTINCT trim(value)) FILTER (trim(value) <> '' AND NOT starts_with(trim(value), '#')))::BIGINT AS duplicates FROM ({_L})""")
def src_keylist_counts(spark: SparkSession, d: str) -> DataFrame:
    return text.key_list_counts(key_lines(spark, d))


@query("src_numeric_ids", "SELECT DISTINCT id, regexp_full_match(id, '[0-9]+') AS good FROM (SELECT concat(CASE WHEN o_custkey % 10 = 0 THEN 'x' ELSE '' END, o_custkey) AS id FROM orders)")
def src_numeric_ids(spark: SparkSession, d: str) -> DataFrame:
    return text.numeric_ids(t(spark, d, "orders").selectExpr("concat(case when o_custkey % 10 = 0 then 'x' else '' end, o_custkey, ' ') as value"))


_REC = "concat_ws(':', CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE s_name END, CASE WHEN s_suppkey % 5 = 0 THEN 'port' ELSE (s_nationkey * 5000 - 3000)::VARCHAR END, 'user' || s_suppkey, 'pw:' || s_nationkey)"


def record_lines(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "supplier").selectExpr("concat_ws(':', case when s_suppkey % 9 = 0 then '' else s_name end, case when s_suppkey % 5 = 0 then 'port' else cast(s_nationkey * 5000 - 3000 as string) end, concat('user', s_suppkey), concat('pw:', s_nationkey)) as value")


@query("src_delimited_record", f"""SELECT host, port, username, secret, host <> '' AND coalesce(port BETWEEN 1 AND 65535, false) AS valid FROM (
  SELECT split_part(value, ':', 1) AS host, try_cast(split_part(value, ':', 2) AS INT) AS port, split_part(value, ':', 3) AS username, array_to_string(string_split(value, ':')[4:], ':') AS secret FROM (SELECT {_REC} AS value FROM supplier))""")
def src_delimited(spark: SparkSession, d: str) -> DataFrame:
    return text.delimited_records(record_lines(spark, d))


@query("mask_secret_field", f"SELECT array_to_string(string_split({_REC}, ':')[1:3], ':') || ':****' AS preview FROM supplier")
def mask(spark: SparkSession, d: str) -> DataFrame:
    return record_lines(spark, d).select(text.masked(F.col("value")).alias("preview"))


@query("src_table", "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_quantity > 45 AND l_extendedprice > 60000")
def src_table(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").where("l_quantity > 45 and l_extendedprice > 60000").select("l_orderkey", "l_extendedprice")


@query("src_binary_objects", """SELECT 'shelf=' || (page_id // 50) AS name, CASE WHEN page_id // 50 % 2 = 0 THEN sum(strlen(coalesce(url, '')) + 1)::BIGINT END AS length,
  CASE WHEN page_id // 50 % 2 = 0 THEN sha256(string_agg(coalesce(url, ''), chr(10) ORDER BY page_id) || chr(10)) END AS sha256 FROM pages GROUP BY page_id // 50""")
def src_binary(spark: SparkSession, d: str) -> DataFrame:
    """An object for every other shelf of 50 pages is written first; the other shelves' objects are missing."""
    path = sinks.shared_path(spark, "objects")
    rows = t(spark, d, "pages").selectExpr("page_id", "coalesce(url, '') as value", "page_id div 50 as shelf")
    rows.where("shelf % 2 = 0").repartition("shelf").sortWithinPartitions("shelf", "page_id").select("value", "shelf").write.partitionBy("shelf").text(path)
    wanted = rows.select(F.concat(F.lit("shelf="), F.col("shelf").cast("string")).alias("name")).distinct()
    return sinks.binary_objects(spark, path, wanted, part=-2).select("name", "length", F.sha2("content", 256).alias("sha256"))


@query("flatten_card", """SELECT user_id::VARCHAR AS item_id, event_type AS title, floor(value)::INT AS price, 'seller ' || user_id AS seller_name, NULL::VARCHAR AS location_name,
  CASE WHEN event_id % 5 <> 0 THEN ts END AS published_at, '{"k":"' || event_type || '"}' AS characteristics, event_id AS views_total FROM events""")
def flatten(spark: SparkSession, d: str) -> DataFrame:
    cards = t(spark, d, "events").selectExpr(
        "cast(user_id as string) as item_id", "event_type as title", "cast(floor(value) as int) as price", "named_struct('name', concat('seller ', user_id), 'profile_url', 'u') as seller",
        "case when event_id % 5 = 0 then 'not a time' else cast(ts as string) end as published_at", "named_struct('address', cast(null as string), 'metro', 'm') as location",
        "map('k', event_type) as characteristics", "event_id as views_total")
    return R.flatten_card(cards).withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))


@query("image_list_summary", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, list_transform(range(0, least(5, l_linenumber + 2)), lambda i: i::INT) AS images, greatest(l_linenumber + 2, l_quantity::INT % 9) AS n,
  CASE WHEN l_quantity::INT % 9 > 0 THEN to_json(list_transform(range(0, least(5, l_quantity::INT % 9)), lambda i: 'u' || i))::VARCHAR END AS urls FROM lineitem""")
def image_list(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "sequence(0, l_linenumber + 1) as a",
                                              "case when cast(l_quantity as int) % 9 > 0 then transform(sequence(0, cast(l_quantity as int) % 9 - 1), i -> concat('u', i)) end as u")
    images, n, urls = R.image_summary(F.col("a"), F.col("u"), 5)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", images.alias("images"), n.alias("n"), urls.alias("urls"))


@query("object_key_format", "SELECT concat('photos/', l_orderkey, '/', l_linenumber, '.jpg') AS object_key FROM lineitem")
def object_keys(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").select(R.object_key("photos", F.col("l_orderkey").cast("string"), F.col("l_linenumber")).alias("object_key"))


@query("sink_append", "SELECT user_id, 2 * count(*) AS n, 2 * count(*) AS stamped FROM events GROUP BY user_id")
def sink_append(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.shared_path(spark, "append")
    rows = t(spark, d, "events").select("event_id", "user_id")
    for label in ("first", "second", "second"):  # the second run again, as after a lost driver
        sinks.append(rows, path, label=label)
    return sinks.stored(spark, path).groupBy("user_id").agg(F.count("*").alias("n"), F.count("created_at").alias("stamped"))


@query("sink_insert_absent", """SELECT (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)) AS inserted,
  (SELECT count(*) FROM orders) - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)) AS duplicates""")
def sink_insert(spark: SparkSession, d: str) -> DataFrame:
    return sinks.insert_counts(t(spark, d, "orders").selectExpr("o_custkey as k", "o_orderkey as v"), t(spark, d, "customer").where("c_custkey % 3 = 0").selectExpr("c_custkey as k"), "k")


@query("sink_insert_absent_rows", """SELECT k, min(v) AS v FROM (SELECT o_custkey AS k, o_orderkey AS v FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)) GROUP BY k
  UNION ALL SELECT c_custkey, -1 FROM customer WHERE c_custkey % 3 = 0""")
def sink_insert_rows(spark: SparkSession, d: str) -> DataFrame:
    """Two merges into one table, the second of them run twice."""
    path = sinks.shared_path(spark, "merge")
    sinks.insert_absent(t(spark, d, "customer").where("c_custkey % 3 = 0").selectExpr("c_custkey as k", "cast(-1 as bigint) as v"), path, "k")
    for _ in range(2):
        sinks.insert_absent(t(spark, d, "orders").selectExpr("o_custkey as k", "o_orderkey as v"), path, "k")
    return sinks.stored(spark, path)


@query("sink_replace", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def sink_replace(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.shared_path(spark, "replace")
    for col in ("event_id", "user_id"):
        sinks.replace(t(spark, d, "events").groupBy(col).agg(F.count("*").alias("n")), path)
    return sinks.stored(spark, path)


@query("sink_csv_profile", "SELECT l_partkey, count(*) AS listings, min(l_extendedprice)::DOUBLE AS min_price FROM lineitem GROUP BY l_partkey")
def sink_csv(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.shared_path(spark, "csv")
    t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("listings"), F.min("l_extendedprice").alias("min_price")).write.option("header", True).csv(path)
    return spark.read.schema("l_partkey long, listings long, min_price double").option("header", True).csv(path)


@query("resume_unprocessed", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id").join(t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("used_condition", "SELECT event_id, event_type IN ('click', 'error') AND (event_id % 3 = 0) AS used FROM events")
def used(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events").selectExpr("event_id", "map('Вид', 'x', case when event_type in ('click', 'error') then 'Состояние товара' else 'Цвет' end, case when event_id % 3 = 0 then ' Б/У ' else 'новое' end) as m")
    return rows.select("event_id", T.used_condition(F.col("m"), ["состояние", "condition"], ["б/у", "бу", "used"]).alias("used"))


@query("state_filter", X.sql(X.KEYS) + "SELECT key, created_at FROM keys WHERE state = 'NEW' ORDER BY created_at, key LIMIT 50")
def state_filter(spark: SparkSession, d: str) -> DataFrame:
    return X.keys(spark, d).where("state = 'NEW'").orderBy("created_at", "key").limit(50).select("key", "created_at")


@query("key_in_list", X.sql(X.LISTINGS) + "SELECT key, item_id FROM listings WHERE key::BIGINT IN (SELECT p_partkey FROM part WHERE p_size < 5)")
def key_in(spark: SparkSession, d: str) -> DataFrame:
    wanted = t(spark, d, "part").where("p_size < 5").selectExpr("cast(p_partkey as string) as key")
    return X.listings(spark, d).select("key", "item_id").join(wanted, "key", "left_semi")


@query("search_filter", X.sql(X.LISTINGS) + "SELECT key, item_id, created_at FROM listings WHERE price >= 30000 AND NOT contains(lower(snippet), 'urgent') ORDER BY created_at DESC, item_id LIMIT 150")
def search(spark: SparkSession, d: str) -> DataFrame:
    page, pages = 50, 3
    rows = X.listings(spark, d).where((F.col("price") >= 30000) & ~F.contains(F.lower("snippet"), F.lit("urgent")))
    return rows.orderBy(F.desc("created_at"), "item_id").limit(page * pages).select("key", "item_id", "created_at")


@query("search_url", "SELECT p_partkey, 'https://market.example/search?q=' || replace(url_encode(p_name || '/' || p_brand), '%2F', '/') AS url FROM part")
def search_url(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", T.search_url("https://market.example/search?q=", F.concat_ws("/", "p_name", "p_brand")).alias("url"))


@query("nul_scrub", "SELECT conv_id, turn, replace(text || chr(0) || role, chr(0), '') AS clean FROM conversations")
def nul(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "conversations").select("conv_id", "turn", T.nul_scrub(F.concat("text", F.lit("\0"), "role")).alias("clean"))


@query("text_truncate", "SELECT doc_id, left(text, 60) AS head FROM documents")
def truncate(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", F.left("text", F.lit(60)).alias("head"))


_MSG = "concat((['net::ERR_CONNECTION_RESET at ', 'ERR_PROXY_AUTH ', 'Timeout exceeded ', 'something else '])[(event_id % 4 + 1)::INT], event_type, repeat('x', 120))"


@query("error_classify", f"""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'transient' WHEN 1 THEN 'permanent' ELSE 'unknown' END AS class,
  CASE event_id % 4 WHEN 0 THEN 'ERR_CONNECTION_RESET (TCP RST)' WHEN 2 THEN 'Timeout error' ELSE left({_MSG}, 100) END AS label FROM events""")
def errors(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events").selectExpr("event_id", "concat(element_at(array('net::ERR_CONNECTION_RESET at ', 'ERR_PROXY_AUTH ', 'Timeout exceeded ', 'something else '), cast(event_id % 4 + 1 as int)), event_type, repeat('x', 120)) as m")
    return rows.select("event_id", T.error_class(F.col("m")).alias("class"), T.error_label(F.col("m")).alias("label"))


@query("page_state_class", "SELECT event_id, CASE event_type WHEN 'view' THEN 'success' WHEN 'click' THEN 'captcha' WHEN 'error' THEN 'blocked' ELSE 'unknown' END AS page_state FROM events")
def page_state(spark: SparkSession, d: str) -> DataFrame:
    detector = F.expr("case event_type when 'view' then 'card_found_detector' when 'click' then 'captcha_geetest_detector' when 'error' then 'proxy_block_403_detector' else event_type end")
    return t(spark, d, "events").select("event_id", R.page_state(detector).alias("page_state"))


@query("outcome_dispatch", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'return' ELSE 'fail' END AS task_action,
  CASE o_orderstatus WHEN 'O' THEN 'block' ELSE 'keep' END AS resource_action, o_orderstatus = 'O' AS close_page FROM orders""")
def outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "orders").selectExpr("o_orderkey", "case o_orderstatus when 'F' then 'success' when 'O' then 'blocked' else 'odd' end as status")
    return R.dispatch(rows).select("o_orderkey", "task_action", "resource_action", "close_page")


@query("json_path_extract", "SELECT event_id, props->>'$.k' AS k FROM events WHERE value >= 20 AND try_cast(props->>'$.k' AS INT) > 10")
def json_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = R.json_paths(t(spark, d, "events").where("value >= 20"), "props", {"k": "k"})
    return rows.where(F.col("k").try_cast("int") > 10).select("event_id", "k")


@query("json_path_nested", """SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE AS price, CASE WHEN l_quantity > 10 THEN 'u' || l_suppkey END AS first_url, CASE WHEN l_quantity > 10 AND l_quantity <= 45 THEN 's' || l_linenumber END AS second_url,
  CASE WHEN l_quantity > 10 THEN CASE WHEN l_quantity <= 45 THEN '[1,2]' ELSE '[1]' END ELSE '[]' END AS sizes, NULL::VARCHAR AS absent FROM lineitem""")
def json_nested(spark: SparkSession, d: str) -> DataFrame:
    """Cards as JSON texts, read by dotted paths through objects and lists; cards of heavy items are cut short or have no list."""
    image = lambda url, n: F.struct(F.struct(url.alias("link")).alias("url"), F.lit(n).alias("size"))
    one, two = image(F.concat(F.lit("u"), "l_suppkey"), 1), image(F.concat(F.lit("s"), "l_linenumber"), 2)
    images = F.when(F.col("l_quantity") > 45, F.array(one)).when(F.col("l_quantity") > 10, F.array(one, two)).otherwise(F.array_except(F.array(one), F.array(one)))
    card = F.struct(F.struct(F.col("l_extendedprice").alias("value")).alias("priceDetailed"), images.alias("images"), F.transform(images, lambda x: x["size"]).alias("sizes"))
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_json(card).alias("card"))
    out = R.json_paths(rows, "card", {"price": "priceDetailed.value", "first_url": "images.0.url.link", "second_url": "images.1.url.link", "sizes": "sizes", "absent": "seller.name"})
    return out.select("l_orderkey", "l_linenumber", F.col("price").cast("double").alias("price"), "first_url", "second_url", "sizes", "absent")


@query("join_inner_equi", X.sql(X.KEYS, X.LISTINGS) + "SELECT k.key, state, item_id FROM keys k JOIN listings l ON k.key = l.key")
def inner(spark: SparkSession, d: str) -> DataFrame:
    return X.keys(spark, d).join(X.listings(spark, d).select("key", "item_id"), "key").select("key", "state", "item_id")


@query("join_left_pivot", X.sql(X.LISTINGS, X.VERDICTS) + """SELECT l.key, l.item_id, p AS price_passed, m AS mechanical_passed FROM listings l LEFT JOIN (
  SELECT key, item_id, bool_or(passed) FILTER (stage = 'price_filter') AS p, bool_or(passed) FILTER (stage = 'mechanical') AS m FROM verdicts GROUP BY key, item_id) v ON v.key = l.key AND v.item_id = l.item_id""")
def left_pivot(spark: SparkSession, d: str) -> DataFrame:
    v = X.verdicts(spark, d).groupBy("key", "item_id").agg(*(F.bool_or(F.when(F.col("stage") == s, F.col("passed"))).alias(n) for s, n in (("price_filter", "price_passed"), ("mechanical", "mechanical_passed"))))
    return X.listings(spark, d).select("key", "item_id").join(v, ["key", "item_id"], "left")


@query("join_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").select("c_custkey").join(t(spark, d, "orders").where("o_orderstatus = 'P'"), F.expr("o_custkey = c_custkey"), "left_semi")


@query("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").select("c_custkey").join(t(spark, d, "orders").where("o_orderstatus = 'P'"), F.expr("o_custkey = c_custkey"), "left_anti")


@query("join_semi_and_anti", X.sql(X.LISTINGS, X.VERDICTS) + "SELECT DISTINCT key, item_id FROM verdicts v WHERE stage = 'ai' AND passed AND NOT EXISTS (SELECT 1 FROM verdicts w WHERE w.key = v.key AND w.item_id = v.item_id AND NOT w.passed)")
def semi_anti(spark: SparkSession, d: str) -> DataFrame:
    return J.passed_without_failure(X.verdicts(spark, d), "ai", ["key", "item_id"])


@query("join_self_extremes", X.sql(X.MEASUREMENTS) + "SELECT item_id, count(*) AS n, min(parsed_at) AS first_at, max(parsed_at) AS last_at, arg_min(price, parsed_at) AS first_value, arg_max(price, parsed_at) AS last_value FROM measurements GROUP BY item_id")
def extremes(spark: SparkSession, d: str) -> DataFrame:
    return J.endpoints(X.measurements(spark, d), "item_id", "parsed_at", "price")


@query("existence_split", "SELECT DISTINCT o_custkey + 20 AS k, o_custkey + 20 IN (SELECT c_custkey FROM customer) AS found FROM orders")
def split(spark: SparkSession, d: str) -> DataFrame:
    return J.existence_split(t(spark, d, "orders").selectExpr("o_custkey + 20 as k").distinct(), t(spark, d, "customer").selectExpr("c_custkey as k"), "k")


@query("all_stages_passed", X.sql(X.LISTINGS, X.VERDICTS) + """SELECT key, item_id FROM (SELECT key, item_id, list_sort(list(DISTINCT stage)) AS s FROM verdicts WHERE passed GROUP BY key, item_id)
  JOIN (SELECT key, bool_or(stage = 'ai') AS has_ai FROM verdicts GROUP BY key) USING (key)
  WHERE s = CASE WHEN has_ai THEN ['ai', 'mechanical', 'price_filter'] ELSE ['mechanical', 'price_filter'] END AND item_id NOT IN (SELECT item_id FROM listings WHERE vec_id < 50)""")
def all_passed(spark: SparkSession, d: str) -> DataFrame:
    return J.all_stages_passed(X.verdicts(spark, d), X.listings(spark, d).where("vec_id < 50").select("item_id"))
