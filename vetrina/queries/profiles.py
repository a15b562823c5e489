"""Queries of velocity and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.config import FIXTURE as CFG
from vetrina.plans import profiles as P
from vetrina.plans import velocity as V
from vetrina.queries import query
from vetrina.queries.funnel import stats_sql

t = X.table
_V = """vel AS (SELECT *, last_views - first_views AS views_diff, epoch_us(last_at) / 3.6e9 - epoch_us(first_at) / 3.6e9 AS h0 FROM (
  SELECT item_id, count(*) AS n, min(parsed_at) AS first_at, max(parsed_at) AS last_at, arg_min(price, parsed_at) AS price,
  arg_min({'v': views}, parsed_at).v AS first_views, arg_max({'v': views}, parsed_at).v AS last_views FROM measurements GROUP BY item_id HAVING count(*) >= 2)),
velo AS (SELECT item_id, n, first_at, last_at, price, first_views, last_views, views_diff, (epoch_us(last_at) - epoch_us(first_at)) / 3.6e9 AS hours,
  CASE WHEN last_at > first_at THEN views_diff / ((epoch_us(last_at) - epoch_us(first_at)) / 3.6e9) END AS views_per_hour FROM vel)"""
_W = X.sql(X.MEASUREMENTS, _V)


@query("view_velocity", _W + "SELECT * FROM velo WHERE first_views IS NOT NULL AND last_views IS NOT NULL")
def velocity(spark: SparkSession, d: str) -> DataFrame:
    return V.view_velocity(X.measurements(spark, d))


@query("keys_per_item", X.sql(X.MEASUREMENTS) + "SELECT item_id, array_to_string(list_sort(list(DISTINCT key)), ', ') AS keys FROM measurements GROUP BY item_id")
def keys_per_item(spark: SparkSession, d: str) -> DataFrame:
    return V.keys_per_item(X.measurements(spark, d))


@query("velocity_quality_flags", _W + "SELECT item_id, 'null_views' AS issue FROM velo WHERE first_views IS NULL OR last_views IS NULL UNION ALL SELECT item_id, 'zero_interval' FROM velo WHERE hours = 0 UNION ALL SELECT item_id, 'negative_diff' FROM velo WHERE views_diff < 0")
def flags(spark: SparkSession, d: str) -> DataFrame:
    return V.quality_flags(V.view_velocity(X.measurements(spark, d), keep_all=True))


@query("velocity_stats", _W + "SELECT count(*) AS n, min(views_per_hour) AS low, max(views_per_hour) AS high, round(avg(views_per_hour), 6) AS mean, count(*) FILTER (views_per_hour IS NULL) AS n_null FROM velo WHERE first_views IS NOT NULL AND last_views IS NOT NULL")
def velocity_stats(spark: SparkSession, d: str) -> DataFrame:
    return V.velocity_stats(velocity(spark, d)).withColumn("mean", F.round("mean", 6))


@query("measure_multiplicity", "SELECT count(*) FILTER (n >= 2) AS n_many, count(*) FILTER (n = 1) AS n_one FROM (SELECT doc_id % 400 + (doc_id // 400) * (doc_id % 3) AS item_id, count(*) AS n FROM documents GROUP BY 1)")
def multiplicity(spark: SparkSession, d: str) -> DataFrame:
    return V.multiplicity(t(spark, d, "documents").selectExpr("doc_id % 400 + (doc_id div 400) * (doc_id % 3) as item_id"))


@query("reparse_candidates", X.sql(X.MEASUREMENTS) + """, ends AS (SELECT max(parsed_at) AS m FROM measurements),
  p AS (SELECT item_id, key, max(parsed_at) AS last_at FROM measurements GROUP BY item_id, key), w AS (SELECT item_id FROM measurements WHERE key = 'error' OR item_id IN ('1', '2', '3'))
  SELECT item_id, key, last_at FROM p WHERE item_id IN (SELECT item_id FROM w) AND epoch_us(TIMESTAMP '2026-01-01') - epoch_us(last_at) >= 24 * 3600000000 AND item_id NOT IN (SELECT o_custkey::VARCHAR FROM orders WHERE o_orderstatus = 'P')
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY last_at, key) = 1""")
def reparse(spark: SparkSession, d: str) -> DataFrame:
    m = X.measurements(spark, d)
    items = m.where("item_id in ('1', '2', '3')").select("item_id").distinct()
    keys = m.where("key = 'error'").select("key").distinct()
    active = t(spark, d, "orders").where("o_orderstatus = 'P'").selectExpr("cast(o_custkey as string) as item_id")
    return V.reparse_candidates(m, items, keys, active, X.AS_OF, 24)


_PR = "prof AS (SELECT key, count(*) AS listings, min(price) AS min_price, median(price) AS median_price, round(avg(price), 6) AS avg_price, max(price) AS max_price, count(*) FILTER (price <= 12000) AS n_low, count(*) FILTER (price <= 20000) AS n_high FROM listings GROUP BY key HAVING min(price) < 5000)"


def profile(spark: SparkSession, d: str) -> DataFrame:
    return P.price_profile(X.listings(spark, d), 5000, 12000, 20000)


@query("price_profile", X.sql(X.LISTINGS, _PR) + "SELECT * FROM prof")
def price_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile(spark, d).withColumn("avg_price", F.round("avg_price", 6)).orderBy("min_price")


@query("price_big_gap", X.sql(X.LISTINGS, _PR) + "SELECT key, min_price, median_price, median_price / min_price AS ratio FROM prof ORDER BY ratio DESC, key LIMIT 10")
def big_gap(spark: SparkSession, d: str) -> DataFrame:
    return P.big_gap(profile(spark, d))


@query("price_low_fraction", X.sql(X.LISTINGS, _PR) + "SELECT key, listings, n_low, n_low / listings AS fraction FROM prof ORDER BY fraction DESC, key LIMIT 10")
def low_fraction(spark: SparkSession, d: str) -> DataFrame:
    return P.low_fraction(profile(spark, d))


@query("robust_min_price", X.sql(X.LISTINGS, stats_sql("listings")) + "SELECT key, min(price) FILTER (q1 IS NULL OR price >= q1 - (q3 - q1)) AS robust_min FROM listings JOIN stats USING (key) GROUP BY key")
def robust_min(spark: SparkSession, d: str) -> DataFrame:
    return P.robust_min_price(X.listings(spark, d), CFG)


_STOP = ", ".join(f"'{w}'" for w in P.BRAND_STOPWORDS)
_LATIN = f"translate(x, '{P.CYRILLIC}', '{P.LATIN}')"
for _a, _b in P.LATIN_MORE:
    _LATIN = f"replace({_LATIN}, '{_a}', '{_b}')"


@query("brand_tokens", """WITH r AS (SELECT l_partkey AS key, l_extendedprice AS price, lower(concat_ws(' ', p_name, p_brand)) AS text FROM lineitem JOIN part ON l_partkey = p_partkey),
  b AS (SELECT DISTINCT lower(p_brand) AS brand FROM part UNION SELECT DISTINCT lower(p_name) FROM part WHERE p_size < 10),
  w AS (SELECT key, list_transform(list_filter(regexp_split_to_array(text, '[^\\p{L}\\p{N}#]+'), lambda x: x NOT IN (""" + _STOP + """)), lambda x: """ + _LATIN + """) AS ws FROM (SELECT DISTINCT key, text FROM r)),
  k AS (SELECT DISTINCT key, unnest(list_distinct(list_concat(ws, list_transform(generate_series(1, len(ws)), lambda i: concat_ws(' ', ws[i], ws[i + 1]))))) AS brand FROM w)
  SELECT m.key, min_price, brands FROM (SELECT key, min(price) AS min_price FROM r GROUP BY key) m JOIN (SELECT key, array_to_string(list_sort(list(DISTINCT brand)), ', ') AS brands FROM k JOIN b USING (brand) GROUP BY key) f ON f.key = m.key""")
def brand_tokens(spark: SparkSession, d: str) -> DataFrame:
    part = t(spark, d, "part")
    rows = t(spark, d, "lineitem").join(part, F.expr("l_partkey = p_partkey")).selectExpr("l_partkey as key", "l_extendedprice as price", "concat_ws(' ', p_name, p_brand) as text")
    brands = part.selectExpr("lower(p_brand) as brand").union(part.where("p_size < 10").selectExpr("lower(p_name)")).distinct()
    return P.brand_tokens(rows, brands)


_WORDS = "list_transform(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}#]+'), lambda x: x <> '' AND x NOT IN (" + _STOP + ")), lambda x: " + _LATIN + ")"


@query("brand_longest_match", "WITH RECURSIVE r AS (SELECT DISTINCT l_partkey AS key, concat_ws(' ', p_name, p_brand, o_orderpriority) AS text FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey), "
       "b AS (SELECT DISTINCT array_to_string(" + _WORDS + ", ' ') AS brand FROM (SELECT p_brand AS text FROM part UNION SELECT p_name FROM part WHERE p_size < 20 UNION SELECT concat_ws(' ', p_name, p_brand) FROM part WHERE p_size < 5 UNION SELECT o_orderpriority FROM orders)), "
       "w AS (SELECT key, text, " + _WORDS + """ AS ws FROM r),
  m AS (SELECT key, text, i, max(n) AS n FROM (SELECT key, text, ws, i, unnest(range(1, len(ws) - i + 2)) AS n FROM (SELECT key, text, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)) x JOIN b ON b.brand = array_to_string(ws[i:i + n - 1], ' ') GROUP BY key, text, i),
  walk AS (SELECT key, text, 1::BIGINT AS i, len(ws) AS size FROM w UNION ALL SELECT k.key, k.text, k.i + coalesce(m.n, 1), k.size FROM walk k LEFT JOIN m ON m.key = k.key AND m.text = k.text AND m.i = k.i WHERE k.i <= k.size)
  SELECT m.key, array_to_string(ws[m.i:m.i + m.n - 1], ' ') AS brand, count(*) AS n FROM walk k JOIN m ON m.key = k.key AND m.text = k.text AND m.i = k.i JOIN w ON w.key = m.key AND w.text = m.text GROUP BY ALL""")
def brand_longest(spark: SparkSession, d: str) -> DataFrame:
    """Brands, names, names with a brand and priorities, of one word and more, in the texts of a part's listings."""
    part, orders = t(spark, d, "part"), t(spark, d, "orders")
    rows = t(spark, d, "lineitem").join(part, F.expr("l_partkey = p_partkey")).join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr("l_partkey as key", "concat_ws(' ', p_name, p_brand, o_orderpriority) as text")
    brands = part.selectExpr("p_brand as brand").union(part.where("p_size < 20").selectExpr("p_name")).union(part.where("p_size < 5").selectExpr("concat_ws(' ', p_name, p_brand)")).union(orders.selectExpr("o_orderpriority"))
    return P.brand_matches(rows, brands)


@query("missing_keys_sample", X.sql(X.LISTINGS) + "SELECT key, min(price) AS min_price FROM listings WHERE price > 50000 AND key NOT IN (SELECT key FROM listings WHERE images_count = 5) GROUP BY key ORDER BY key LIMIT 20")
def missing_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = X.listings(spark, d)
    gone = rows.where("price > 50000").join(rows.where("images_count = 5").select("key").distinct(), "key", "left_anti")
    return gone.groupBy("key").agg(F.min("price").alias("min_price")).orderBy("key").limit(20)


@query("size_histogram", "SELECT w, h, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem) AS share FROM (SELECT l_quantity::INT % 7 * 100 AS w, l_linenumber * 80 AS h FROM lineitem) GROUP BY w, h ORDER BY n DESC, w, h LIMIT 15")
def size_histogram(spark: SparkSession, d: str) -> DataFrame:
    return P.size_histogram(t(spark, d, "lineitem").selectExpr("cast(l_quantity as int) % 7 * 100 as w", "l_linenumber * 80 as h"), 15)


@query("size_long_side", "SELECT greatest(l_quantity::INT % 7 * 100, l_linenumber * 80) AS long_side, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def long_side(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").selectExpr("greatest(cast(l_quantity as int) % 7 * 100, l_linenumber * 80) as long_side").groupBy("long_side").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "long_side").limit(10)


@query("download_quality", X.sql(X.LISTINGS) + """SELECT key, count(*) AS total, count(*) FILTER (found > 0) AS with_urls, count(*) FILTER (found > 0 AND ok = found) AS all_ok, count(*) FILTER (ok > 0 AND ok < found) AS partial,
  count(*) FILTER (found > 0 AND ok = 0) AS failed, count(*) FILTER (found = 0) AS none FROM (SELECT key, images_count AS found, least(images_count, vec_id % 5) AS ok FROM listings) GROUP BY key""")
def download_quality(spark: SparkSession, d: str) -> DataFrame:
    return P.download_quality(X.listings(spark, d).selectExpr("key", "images_count as found", "least(images_count, vec_id % 5) as ok"))


@query("image_payload_stats", "SELECT source AS key, count(*) AS images, sum(strlen(text))::BIGINT AS bytes, round(sum(strlen(text)) / count(*) / 1024, 2) AS avg_kb FROM documents GROUP BY source")
def payload(spark: SparkSession, d: str) -> DataFrame:
    return P.payload_stats(t(spark, d, "documents").selectExpr("source as key", "cast(octet_length(text) as bigint) as bytes"))


@query("token_cost", """WITH r AS (SELECT conv_id::VARCHAR AS run, sum(CASE WHEN role = 'user' THEN length(text) ELSE 0 END)::DOUBLE AS tokens_in, sum(CASE WHEN role <> 'user' THEN length(text) ELSE 0 END)::DOUBLE AS tokens_out, count(*) AS images FROM conversations GROUP BY conv_id),
  c AS (SELECT *, (tokens_in * 0.6 + tokens_out * 3.0) / 1e6 AS cost FROM r)
  SELECT run, round(tokens_in, 6) AS tokens_in, round(tokens_out, 6) AS tokens_out, round(cost, 9) AS cost, round(per_image, 9) AS per_image, round(projected, 6) AS projected FROM (
  SELECT run, tokens_in, tokens_out, cost, cost / images AS per_image, NULL::DOUBLE AS projected FROM c UNION ALL SELECT NULL, avg(tokens_in), avg(tokens_out), avg(cost), sum(cost) / sum(images), avg(cost) * 1000 * 0.8 FROM c)""")
def token_cost(spark: SparkSession, d: str) -> DataFrame:
    runs = t(spark, d, "conversations").groupBy(F.col("conv_id").cast("string").alias("run")).agg(
        F.sum(F.when(F.col("role") == "user", F.length("text")).otherwise(0)).cast("double").alias("tokens_in"),
        F.sum(F.when(F.col("role") != "user", F.length("text")).otherwise(0)).cast("double").alias("tokens_out"), F.count("*").alias("images"))
    return P.token_cost(runs).withColumns({c: F.round(c, n) for c, n in (("tokens_in", 6), ("tokens_out", 6), ("cost", 9), ("per_image", 9), ("projected", 6))})  # sums depend on their order
