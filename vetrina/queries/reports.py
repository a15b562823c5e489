"""Queries of reports over the verdict log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vetrina import fixtures as X
from vetrina.plans import reports as R
from vetrina.queries import query
from vetrina.sources import sinks

_PIVOT = """pv AS (SELECT key, item_id, coalesce(bool_or(stage = 'price_filter' AND passed), false) AS price_filter_passed, max(reason) FILTER (stage = 'price_filter' AND NOT passed) AS price_filter_reason,
  coalesce(bool_or(stage = 'mechanical' AND passed), false) AS mechanical_passed, max(reason) FILTER (stage = 'mechanical' AND NOT passed) AS mechanical_reason,
  coalesce(bool_or(stage = 'ai' AND passed), false) AS ai_passed, max(reason) FILTER (stage = 'ai' AND NOT passed) AS ai_reason, bool_or(stage = 'ai') AS has_ai FROM verdicts GROUP BY key, item_id)"""
_REPORT = """rep AS (SELECT *, rejection_stage IS NULL AS final_passed, CASE rejection_stage WHEN 'price_filter' THEN price_filter_reason WHEN 'mechanical' THEN mechanical_reason WHEN 'ai' THEN ai_reason END AS rejection_reason FROM (
  SELECT l.key, l.item_id, title, price, seller_name, coalesce(price_filter_passed, false) AS price_filter_passed, price_filter_reason, coalesce(mechanical_passed, false) AS mechanical_passed, mechanical_reason,
    CASE WHEN has_ai THEN ai_passed END AS ai_passed, ai_reason, CASE WHEN NOT coalesce(price_filter_passed, false) THEN 'price_filter' WHEN NOT coalesce(mechanical_passed, false) THEN 'mechanical' WHEN has_ai AND NOT ai_passed THEN 'ai' END AS rejection_stage
  FROM listings l LEFT JOIN pv p ON p.key = l.key AND p.item_id = l.item_id))"""
_W = X.sql(X.LISTINGS, X.VERDICTS, _PIVOT, _REPORT)

#: Least number of passed items of a key in the validated list. A fixed value.
MIN_VALIDATED = 5


def report(spark: SparkSession, d: str) -> DataFrame:
    return R.funnel_report(X.listings(spark, d), X.verdicts(spark, d))


@query("verdict_pivot", X.sql(X.LISTINGS, X.VERDICTS, _PIVOT) + "SELECT * FROM pv")
def pivot(spark: SparkSession, d: str) -> DataFrame:
    return R.verdict_pivot(X.verdicts(spark, d))


@query("final_verdict", X.sql(X.LISTINGS, X.VERDICTS, _PIVOT, _REPORT) + "SELECT key, item_id, final_passed, rejection_stage, rejection_reason FROM rep JOIN pv USING (key, item_id)")
def final(spark: SparkSession, d: str) -> DataFrame:
    return R.final_verdict(R.verdict_pivot(X.verdicts(spark, d))).select("key", "item_id", "final_passed", "rejection_stage", "rejection_reason")


@query("funnel_report", _W + "SELECT * FROM rep")
def funnel_report(spark: SparkSession, d: str) -> DataFrame:
    return report(spark, d)


@query("report_totals", _W + "SELECT count(DISTINCT key) AS n_keys, count(*) AS n, count(*) FILTER (final_passed) AS n_passed, count(*) FILTER (NOT final_passed) AS n_rejected, round(100.0 * count(*) FILTER (final_passed) / count(*), 1)::DOUBLE AS passed_pct FROM rep")
def totals(spark: SparkSession, d: str) -> DataFrame:
    return R.totals(report(spark, d))


@query("report_by_stage", _W + "SELECT rejection_stage, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS share_pct FROM rep WHERE NOT final_passed GROUP BY rejection_stage")
def by_stage(spark: SparkSession, d: str) -> DataFrame:
    return R.by_stage(report(spark, d))


@query("report_top_reasons", _W + "SELECT rejection_stage, rejection_reason, count(*) AS n FROM rep WHERE NOT final_passed GROUP BY 1, 2 ORDER BY n DESC, 1 NULLS FIRST, 2 NULLS FIRST LIMIT 10")
def top_reasons(spark: SparkSession, d: str) -> DataFrame:
    return R.top_reasons(report(spark, d))


@query("export_summary", X.sql(X.LISTINGS, X.VERDICTS) + """SELECT k.key, count(l.item_id) AS n, count(*) FILTER (p) AS price_filter_passed, count(*) FILTER (NOT p) AS price_filter_rejected, count(l.item_id) FILTER (p IS NULL) AS price_filter_no_data,
  count(*) FILTER (m) AS mechanical_passed, count(*) FILTER (NOT m) AS mechanical_rejected, count(l.item_id) FILTER (m IS NULL) AS mechanical_no_data,
  count(*) FILTER (a) AS ai_passed, count(*) FILTER (NOT a) AS ai_rejected, count(l.item_id) FILTER (a IS NULL) AS ai_no_data, count(l.item_id) > 0 AS found
  FROM (SELECT DISTINCT (p_partkey * 2)::VARCHAR AS key FROM part) k LEFT JOIN listings l ON l.key = k.key LEFT JOIN (SELECT key, item_id, bool_or(passed) FILTER (stage = 'price_filter') AS p,
  bool_or(passed) FILTER (stage = 'mechanical') AS m, bool_or(passed) FILTER (stage = 'ai') AS a FROM verdicts GROUP BY key, item_id) v ON v.key = l.key AND v.item_id = l.item_id GROUP BY k.key""")
def export_summary(spark: SparkSession, d: str) -> DataFrame:
    return R.export_summary(X.table(spark, d, "part").selectExpr("cast(p_partkey * 2 as string) as key").distinct(), X.listings(spark, d), X.verdicts(spark, d))


@query("verdict_agreement", "SELECT doc_id, quality = 1 AS before, toxic = 0 AS after, (quality = 1) <> (toxic = 0) AS result_changed FROM labels")
def agreement(spark: SparkSession, d: str) -> DataFrame:
    rows = X.table(spark, d, "labels")
    return R.agreement(rows.selectExpr("doc_id", "quality = 1 as passed"), rows.selectExpr("doc_id", "toxic = 0 as passed"), "doc_id", "passed")


@query("verdict_agreement_rate", """SELECT count(*) FILTER ((quality = 1) = (toxic = 0)) AS matched, count(*) AS compared,
  round(100.0 * count(*) FILTER ((quality = 1) = (toxic = 0)) / count(*), 1)::DOUBLE AS rate_pct FROM labels""")
def agreement_rate(spark: SparkSession, d: str) -> DataFrame:
    return R.agreement_rate(agreement(spark, d))


@query("pass_rate_summary", _W + "SELECT key, count(*) AS n, count(*) FILTER (final_passed) AS n_passed, round(100.0 * count(*) FILTER (final_passed) / count(*), 1)::DOUBLE AS rate_pct FROM rep GROUP BY ROLLUP (key)")
def pass_rates(spark: SparkSession, d: str) -> DataFrame:
    return R.pass_rates(report(spark, d), "key", F.col("final_passed"))


@query("confusion_metrics", """SELECT *, (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM (
  SELECT count(*) FILTER (quality = 1 AND toxic = 0) AS tp, count(*) FILTER (quality = 0 AND toxic = 0) AS fp, count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 0 AND toxic = 1) AS tn, 0::BIGINT AS errors FROM labels)""")
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return R.confusion(X.table(spark, d, "labels"), F.col("quality") == 1, F.col("toxic") == 0)


@query("sink_nested_json", _W + """SELECT key, to_json({'key': key, 'summary': {'total': count(*), 'passed': count(*) FILTER (final_passed)}, 'listings': list(CASE WHEN rejection_stage IS NULL THEN
  json_object('item_id', item_id, 'final_passed', final_passed) ELSE json_object('item_id', item_id, 'final_passed', final_passed, 'rejection_stage', rejection_stage) END ORDER BY item_id)})::VARCHAR AS doc FROM rep GROUP BY key""")
def nested_json(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.shared_path(spark, "json")
    R.nested(X.listings(spark, d), report(spark, d)).select("key", F.col("doc").alias("value")).write.partitionBy().format("json").save(path)
    return spark.read.schema("key string, value string").json(path).select("key", F.col("value").alias("doc"))


@query("sink_validated_list", _W + f"SELECT key || ': ' || count(*) AS line FROM rep WHERE final_passed GROUP BY key HAVING count(*) >= {MIN_VALIDATED}")
def validated_list(spark: SparkSession, d: str) -> DataFrame:
    path = sinks.shared_path(spark, "list")
    rows = report(spark, d).where("final_passed").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_VALIDATED)
    rows.orderBy(F.desc("n"), "key").select(F.concat_ws(": ", "key", F.col("n").cast("string")).alias("value")).write.text(path)
    return spark.read.text(path).select(F.col("value").alias("line"))
