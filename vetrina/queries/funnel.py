"""Queries of the validation funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.config import FIXTURE as CFG
from vetrina.functions.text import stopword_first_match
from vetrina.operators import price as P
from vetrina.operators import stages as S
from vetrina.plans import funnel as PF
from vetrina.queries import query
from vetrina.sources.sinks import kept

EDGE = r"[^\p{L}\p{N}_]"
_TEXT = "lower(concat_ws(' ', coalesce(title, ''), coalesce(snippet, ''), coalesce(seller_name, '')))"
_WORD = "CASE " + " ".join(f"WHEN regexp_matches({_TEXT}, '(^|{EDGE}){w}($|{EDGE})') THEN '{w}'" for w in CFG.stopwords) + " END"


def _alive(spark: SparkSession, d: str, *columns: str | Column) -> DataFrame:
    """The listings before any stage; with columns, these alone, written once for the stages that read them twice."""
    rows = X.listings(spark, d)
    rows = kept(rows.select("key", "item_id", *columns), "rows") if columns else rows
    return rows.withColumns({"alive": F.lit(True), "gate": F.lit(None).cast("string")})


def stats_sql(rows: str) -> str:
    """stats(key, n_prices, q1, ...) from a relation with key and price, by sorted lists."""
    q = lambda i: f"(ps[greatest(1, least(n - 1, ({i} * (n + 1)) // 4))] * (4 - ({i} * (n + 1) - 4 * greatest(1, least(n - 1, ({i} * (n + 1)) // 4)))) + ps[greatest(1, least(n - 1, ({i} * (n + 1)) // 4)) + 1] * ({i} * (n + 1) - 4 * greatest(1, least(n - 1, ({i} * (n + 1)) // 4)))) / 4"
    return f"""s1 AS (SELECT key, count(price) AS n, list(price ORDER BY price) FILTER (price IS NOT NULL) AS ps FROM {rows} GROUP BY key),
  s2 AS (SELECT *, CASE WHEN n >= 4 THEN {q(1)} END AS q1, CASE WHEN n >= 4 THEN {q(3)} END AS q3 FROM s1),
  s3 AS (SELECT *, q1 - (q3 - q1) AS lo, q3 + (q3 - q1) AS hi FROM s2),
  s4 AS (SELECT *, list_filter(ps, lambda x: x BETWEEN lo AND hi) AS clean FROM s3),
  s5 AS (SELECT *, list_median(clean) AS cm, list_median(ps) AS am FROM s4),
  s6 AS (SELECT *, CASE WHEN len(list_filter(clean, lambda x: x <= 2.5 * cm)) > 0 THEN list_filter(clean, lambda x: x <= 2.5 * cm) ELSE clean END AS fin FROM s5),
  s7 AS (SELECT *, list_median(list_reverse_sort(fin)[1:greatest(1, len(fin) * 2 // 5)]) AS t FROM s6),
  stats AS (SELECT key, n AS n_prices, q1, q3, coalesce(cm, am) AS clean_median, CASE WHEN cm IS NOT NULL THEN t ELSE am END AS top_median, CASE WHEN cm IS NOT NULL THEN hi ELSE 3 * am END AS upper_bound FROM s7)"""


@query("price_stats", X.sql(X.LISTINGS, stats_sql("listings")) + "SELECT * FROM stats")
def price_stats(spark: SparkSession, d: str) -> DataFrame:
    return P.stats_by_key(X.listings(spark, d), CFG)


@query("price_verdict", X.sql(X.LISTINGS, stats_sql("listings")) + """SELECT item_id, CASE WHEN price < 0.2 * top_median THEN 'too_cheap' WHEN price > upper_bound THEN 'outlier' END AS verdict
  FROM listings JOIN stats USING (key)""")
def price_verdict(spark: SparkSession, d: str) -> DataFrame:
    return P.price_stats(X.listings(spark, d), CFG).select("item_id", P.price_verdict(F.col("price"), CFG).alias("verdict"))


@query("price_floor", X.sql(X.LISTINGS) + "SELECT key, item_id, 'price_filter' AS stage, coalesce(price >= 8000, false) AS passed FROM listings")
def price_floor(spark: SparkSession, d: str) -> DataFrame:
    return X.listings(spark, d).select("key", "item_id", F.lit("price_filter").alias("stage"), P.price_floor(F.col("price"), CFG).alias("passed"))


@query("require_images", X.sql(X.LISTINGS) + "SELECT key, item_id FROM listings WHERE coalesce(images_count, 0) = 0")
def require_images(spark: SparkSession, d: str) -> DataFrame:
    return X.listings(spark, d).where(F.coalesce("images_count", F.lit(0)) == 0).select("key", "item_id")


@query("stopword_first_match", X.sql(X.LISTINGS) + f"SELECT item_id, {_WORD} AS word FROM listings")
def stopword(spark: SparkSession, d: str) -> DataFrame:
    return X.listings(spark, d).select("item_id", stopword_first_match(CFG.stopwords, F.col("title"), F.col("snippet"), F.col("seller_name")).alias("word"))


@query("seller_reviews_min", X.sql(X.LISTINGS) + "SELECT item_id, coalesce(seller_reviews >= 5, false) AS passed FROM listings")
def reviews(spark: SparkSession, d: str) -> DataFrame:
    return X.listings(spark, d).select("item_id", F.coalesce(F.col("seller_reviews") >= CFG.min_reviews, F.lit(False)).alias("passed"))


def mechanical_sql(rows: str, name: str) -> str:
    """name: rows with the reason of the mechanical stage."""
    return f"""{name}_in AS (SELECT key, price FROM {rows} WHERE coalesce(images_count, 0) > 0), {stats_sql(name + '_in')},
  {name} AS (SELECT r.*, CASE WHEN coalesce(images_count, 0) = 0 THEN 'no_image' WHEN {_WORD} IS NOT NULL THEN 'stopword:' || {_WORD}
    WHEN seller_reviews IS NULL OR seller_reviews < 5 THEN 'few_reviews' WHEN price < 0.2 * top_median THEN 'too_cheap' WHEN price > upper_bound THEN 'outlier' END AS why
    FROM {rows} r LEFT JOIN stats USING (key))"""


@query("mechanical_stage", X.sql(X.LISTINGS, mechanical_sql("listings", "m")) + "SELECT key, item_id, why IS NULL AS passed, why AS reason FROM m")
def mechanical(spark: SparkSession, d: str) -> DataFrame:
    rows = _alive(spark, d, "price", "images_count", S.row_reason(CFG).alias("by_row"))
    return S.mechanical_stage(rows, CFG, F.col("by_row")).select("key", "item_id", F.col("mechanical").alias("passed"), F.col("mechanical_reason").alias("reason"))


@query("min_count_gate", X.sql(X.LISTINGS) + "SELECT key, count(*) AS n, count(*) >= 30 AS kept FROM listings GROUP BY key")
def gate(spark: SparkSession, d: str) -> DataFrame:
    return S.min_count_gate(_alive(spark, d), 30, "catalog").groupBy("key").agg(F.count("*").alias("n"), F.bool_and("alive").alias("kept"))


def best_sql(rows: str, group: str, out: str) -> str:
    w = f"(PARTITION BY key, {group} ORDER BY coalesce(images_count, 0) DESC, coalesce(price, 0), item_id)"
    return f"{out} AS (SELECT *, row_number() OVER {w} AS i, first_value(item_id) OVER {w} AS best FROM {rows})"


_SELLER = "coalesce(nullif(seller_id, ''), nullif(seller_name, ''), '')"


@query("seller_dedup", X.sql(X.LISTINGS, best_sql("listings", _SELLER, "b")) + "SELECT key, item_id, 'kept:' || best AS reason FROM b WHERE i > 1")
def seller(spark: SparkSession, d: str) -> DataFrame:
    return S.seller_dedup(_alive(spark, d, "price", "images_count", "seller_id", "seller_name")).where("not seller_dedup").select("key", "item_id", F.col("seller_dedup_reason").alias("reason"))


@query("content_hash_dedup", X.sql(X.LISTINGS, best_sql("(SELECT * FROM listings WHERE images_count > 0)", "image_hash", "b")) + "SELECT key, item_id, 'kept:' || best AS reason FROM b WHERE i > 1")
def image(spark: SparkSession, d: str) -> DataFrame:
    rows = _alive(spark, d, "price", "images_count", F.when(F.col("images_count") > 0, F.col("image_hash")).alias("image_hash"))
    return S.content_hash_dedup(rows).where("not image_dedup").select("key", "item_id", F.col("image_dedup_reason").alias("reason"))


@query("array_share_above", "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) / len(embedding) AS share, len(list_filter(embedding, lambda x: x > 0)) / len(embedding) > 0.56 AS rejected FROM embeddings")
def share(spark: SparkSession, d: str) -> DataFrame:
    s = S.share_above(F.col("embedding"), CFG.white_level)
    return X.table(spark, d, "embeddings").select("vec_id", s.alias("share"), F.coalesce(s > CFG.white_share, F.lit(False)).alias("rejected"))


@query("cap_per_key", X.sql(X.LISTINGS) + "SELECT key, item_id FROM listings QUALIFY row_number() OVER (PARTITION BY key ORDER BY item_id) <= 10")
def cap(spark: SparkSession, d: str) -> DataFrame:
    return S.cap_per_key(X.listings(spark, d), 10).select("key", "item_id")


def _listings(spark: SparkSession, d: str) -> DataFrame:
    share = X.table(spark, d, "embeddings").select("vec_id", S.share_above(F.col("embedding"), CFG.white_level).alias("share"))
    return X.listings(spark, d).join(kept(share, "share"), "vec_id", "left")


#: Rows of a slice of keys, about, while the slices are fewer than SLICES; the disk grows with the rows of a slice beyond.
SLICE_ROWS, SLICES = 16_000_000, 8


def _slices(spark: SparkSession, d: str) -> int:
    return max(1, min(SLICES, -(-X.table(spark, d, "lineitem").count() // SLICE_ROWS)))


def wide(spark: SparkSession, d: str) -> DataFrame:
    """The funnel on the fixture; the model accepts sellers with more than 20 reviews."""
    return PF.funnel(_listings(spark, d), CFG, F.col("seller_reviews") > 20, _slices(spark, d))


def funnel_ctes() -> list[str]:
    """The funnel in SQL: f_<stage> are the verdicts, l<i> the rows alive after stage i and its gate."""
    gate = lambda rows, out: f"{out} AS (SELECT * FROM {rows} QUALIFY count(*) OVER (PARTITION BY key) >= 12)"
    cols = "vec_id, key, item_id, title, snippet, price, seller_id, seller_name, seller_reviews, images_count, image_hash, created_at, pixels"
    return [
        X.LISTINGS, "l0a AS (SELECT l.*, embedding AS pixels FROM listings l LEFT JOIN embeddings USING (vec_id))", gate("l0a", "l0"),
        "f1 AS (SELECT *, coalesce(price >= 8000, false) AS ok FROM l0)", gate("(SELECT * FROM f1 WHERE ok)", "l1"),
        mechanical_sql("l1", "f2"), gate("(SELECT * FROM f2 WHERE why IS NULL)", "l2"),
        best_sql("l2", _SELLER, "f3"), gate(f"(SELECT {cols} FROM f3 WHERE i = 1)", "l3"),
        best_sql("l3", "image_hash", "f4"), gate(f"(SELECT {cols} FROM f4 WHERE i = 1)", "l4"),
        "f5 AS (SELECT *, coalesce(len(list_filter(pixels, lambda x: x > 0)) / len(pixels) > 0.56, false) AS white FROM l4)", gate("(SELECT * FROM f5 WHERE NOT white)", "l5"),
        "f6 AS (SELECT *, seller_reviews > 20 AS ok FROM l5 QUALIFY row_number() OVER (PARTITION BY key ORDER BY item_id) <= 10)", gate("(SELECT * FROM f6 WHERE ok)", "l6"),
        """log AS (SELECT key, item_id, 'price_filter' AS stage, ok AS passed, CASE WHEN NOT ok THEN 'below_floor' END AS reason FROM f1
  UNION ALL SELECT key, item_id, 'mechanical', why IS NULL, why FROM f2 UNION ALL SELECT key, item_id, 'seller_dedup', false, 'kept:' || best FROM f3 WHERE i > 1
  UNION ALL SELECT key, item_id, 'image_dedup', false, 'kept:' || best FROM f4 WHERE i > 1 UNION ALL SELECT key, item_id, 'white_bg', false, 'white' FROM f5 WHERE white
  UNION ALL SELECT key, item_id, 'ai', ok, CASE WHEN NOT ok THEN 'not_relevant' END FROM f6)""",
    ]


@query("funnel", X.sql(*funnel_ctes()) + "SELECT * FROM log")
def funnel(spark: SparkSession, d: str) -> DataFrame:
    return PF.verdict_log(wide(spark, d))


@query("funnel_key_states", X.sql(*funnel_ctes()) + """SELECT key, CASE WHEN key IN (SELECT key FROM l6) THEN 'VALIDATED' ELSE 'REJECTED_BY_MIN_COUNT' END AS state,
  CASE WHEN key NOT IN (SELECT key FROM l0) THEN 'catalog' WHEN key NOT IN (SELECT key FROM l1) THEN 'price_filter' WHEN key NOT IN (SELECT key FROM l2) THEN 'mechanical'
  WHEN key NOT IN (SELECT key FROM l3) THEN 'seller_dedup' WHEN key NOT IN (SELECT key FROM l4) THEN 'image_dedup' WHEN key NOT IN (SELECT key FROM l5) THEN 'white_bg'
  WHEN key NOT IN (SELECT key FROM l6) THEN 'ai' END AS gate FROM (SELECT DISTINCT key FROM listings)""")
def states(spark: SparkSession, d: str) -> DataFrame:
    return PF.final_states(_listings(spark, d), CFG, F.col("seller_reviews") > 20, _slices(spark, d))


@query("funnel_stage_counts", X.sql(*funnel_ctes()) + "SELECT key, stage, count(*) AS n, count(*) FILTER (passed) AS n_passed, count(*) FILTER (NOT passed) AS n_failed FROM log GROUP BY key, stage")
def counts(spark: SparkSession, d: str) -> DataFrame:
    return PF.stage_counts(funnel(spark, d))


@query("adhoc_filter_stats", X.sql(X.LISTINGS, mechanical_sql("listings", "m")) + "SELECT coalesce(why, 'passed') AS reason, count(*) AS n FROM (SELECT CASE WHEN price IS NULL OR price < 8000 THEN 'below_floor' ELSE why END AS why FROM m) GROUP BY 1")
def adhoc(spark: SparkSession, d: str) -> DataFrame:
    rows = P.price_stats(X.listings(spark, d), CFG, F.coalesce("images_count", F.lit(0)) > 0)
    why = F.coalesce(F.when(~P.price_floor(F.col("price"), CFG), "below_floor"), S.mechanical_reason(CFG), F.lit("passed"))
    return rows.groupBy(why.alias("reason")).agg(F.count("*").alias("n"))
