"""Reports over a verdict log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STAGES = ("price_filter", "mechanical", "ai")


def verdict_pivot(verdicts: DataFrame) -> DataFrame:
    """A row an item: whether each stage was passed (false without a verdict), the reason it failed with, and has_ai of the item."""
    cols = []
    for s in STAGES:
        here = F.col("stage") == s
        cols += [F.coalesce(F.bool_or(here & F.col("passed")), F.lit(False)).alias(f"{s}_passed"), F.max(F.when(here & ~F.col("passed"), F.col("reason"))).alias(f"{s}_reason")]
    return verdicts.groupBy("key", "item_id").agg(*cols, F.bool_or(F.col("stage") == "ai").alias("has_ai"))


def final_verdict(wide: DataFrame, no_ai: Column | None = None) -> DataFrame:
    """Adds final_passed, rejection_stage and rejection_reason; the model's stage counts where an item has its verdict. ai_passed is null elsewhere."""
    has_ai = F.coalesce("has_ai", F.lit(False)) if no_ai is None else ~no_ai
    fails = [(s, ~F.coalesce(F.col(f"{s}_passed"), F.lit(False)) & (has_ai if s == "ai" else F.lit(True))) for s in STAGES]
    stage = F.coalesce(*(F.when(bad, s) for s, bad in fails))
    reason = F.when(fails[0][1], F.col("price_filter_reason")).when(fails[1][1], F.col("mechanical_reason")).when(fails[2][1], F.col("ai_reason"))
    return wide.withColumns({"final_passed": stage.isNull(), "rejection_stage": stage, "rejection_reason": reason, "ai_passed": F.when(has_ai, F.col("ai_passed"))})


def funnel_report(listings: DataFrame, verdicts: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """A report row for each listing of a key, or of the listed keys."""
    if keys is not None:
        listings, verdicts = listings.join(keys, "key", "left_semi"), verdicts.join(keys, "key", "left_semi")
    out = final_verdict(listings.select("key", "item_id", "title", "price", "seller_name").join(verdict_pivot(verdicts), ["key", "item_id"], "left"))
    false = {f"{s}_passed": F.coalesce(f"{s}_passed", F.lit(False)) for s in STAGES[:2]}
    return out.withColumns(false).drop("has_ai")


def totals(report: DataFrame) -> DataFrame:
    n, ok = F.count("*"), F.count_if("final_passed")
    return report.agg(F.count_distinct("key").alias("n_keys"), n.alias("n"), ok.alias("n_passed"), (n - ok).alias("n_rejected"), F.round(F.try_divide(100 * ok, n), 1).alias("passed_pct"))


def by_stage(report: DataFrame) -> DataFrame:
    # the stages are three rows by then
    counts = report.where(~F.col("final_passed")).groupBy("rejection_stage").agg(F.count("*").alias("n"))
    return counts.withColumn("share_pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))


def top_reasons(report: DataFrame, n: int = 10) -> DataFrame:
    return report.where(~F.col("final_passed")).groupBy("rejection_stage", "rejection_reason").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "rejection_stage", "rejection_reason").limit(n)


def export_summary(keys: DataFrame, listings: DataFrame, verdicts: DataFrame) -> DataFrame:
    """A row a key of the list: found, and passed, rejected and no_data items of each stage."""
    rows = listings.select("key", "item_id").join(
        verdicts.groupBy("key", "item_id").agg(*(F.bool_or(F.when(F.col("stage") == s, F.col("passed"))).alias(s) for s in STAGES)), ["key", "item_id"], "left")
    counts = [F.count("item_id").alias("n")]
    for s in STAGES:
        here = F.col("item_id").isNotNull()
        counts += [F.count_if(here & F.col(s)).alias(f"{s}_passed"), F.count_if(here & ~F.col(s)).alias(f"{s}_rejected"), F.count_if(here & F.col(s).isNull()).alias(f"{s}_no_data")]
    return keys.join(rows, "key", "left").groupBy("key").agg(*counts).withColumn("found", F.col("n") > 0)


def agreement(stored: DataFrame, fresh: DataFrame, key: str, value: str) -> DataFrame:
    """(key, before, after, result_changed) of the items that both runs judged."""
    both = stored.select(key, F.col(value).alias("before")).join(fresh.select(key, F.col(value).alias("after")), key)
    return both.withColumn("result_changed", F.col("before") != F.col("after"))


def agreement_rate(rows: DataFrame) -> DataFrame:
    """One row: items of agreement() on which the runs matched, those compared, and the rate in percent; items that lack a value are not compared."""
    same = F.count_if(~F.col("result_changed"))
    return rows.agg(same.alias("matched"), F.count("result_changed").alias("compared"), F.round(F.try_divide(100 * same, F.count("result_changed")), 1).alias("rate_pct"))


def pass_rates(rows: DataFrame, key: str, passed: Column) -> DataFrame:
    """(key, n, n_passed, rate_pct) of each key, and overall with a null key."""
    return rows.rollup(key).agg(F.count("*").alias("n"), F.count_if(passed).alias("n_passed"), F.round(100 * F.count_if(passed) / F.count("*"), 1).alias("rate_pct"))


def confusion(rows: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """One row: counts and rates; rows with a null truth or guess are errors."""
    ok = truth.isNotNull() & guess.isNotNull()
    n = lambda a, b: F.count_if(ok & (truth == a) & (guess == b))
    c = rows.agg(n(True, True).alias("tp"), n(False, True).alias("fp"), n(True, False).alias("fn"), n(False, False).alias("tn"), F.count_if(~ok).alias("errors"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.withColumns({"accuracy": F.try_divide(tp + tn, tp + fp + fn + tn), "precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn),
                          "f1": F.try_divide(2 * tp, 2 * tp + fp + fn)})


def nested(listings: DataFrame, report: DataFrame) -> DataFrame:
    """(key, doc): one JSON document a key, with a summary and its listings by item_id."""
    item = F.struct("item_id", "final_passed", "rejection_stage")
    return report.groupBy("key").agg(F.count("*").alias("total"), F.count_if("final_passed").alias("passed"), F.array_sort(F.collect_list(item)).alias("listings")).select(
        "key", F.to_json(F.struct("key", F.struct("total", "passed").alias("summary"), "listings")).alias("doc"))
