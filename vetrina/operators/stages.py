"""Stages of the funnel over one wide frame.

A row that a stage rejects stays in the frame with ``alive`` false, so that nothing is computed
twice for survivors and verdicts. A stage adds its verdict column (null: not judged) and a reason
column. One key may hold most rows: what a stage must know of a key, or of a seller or content in it, is
aggregated before it moves and joined back. The only window is the limit of rows that a model is
asked about, which each task applies to its own rows first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.config import Config
from vetrina.functions.text import stopword_first_match
from vetrina.operators.joins import with_group
from vetrina.operators.price import STATS, price_floor, price_stats, price_verdict, with_key
from vetrina.sources.sinks import kept


def _after(df: DataFrame, stage: str, passed: Column, reason: Column) -> DataFrame:
    """Adds the verdict of the rows that are alive, and lets the others of them go."""
    return df.withColumns({stage: F.when(F.col("alive"), passed), f"{stage}_reason": F.when(F.col("alive") & ~passed, reason)}).withColumn(
        "alive", F.col("alive") & passed)


def min_count_gate(df: DataFrame, least: int, stage: str, key: str = "key") -> DataFrame:
    """Lets all rows of a key go that has too few alive; ``gate`` names the first stage after which that was so."""
    n = df.groupBy(key).agg(F.count_if("alive").alias("_n"))
    return with_key(df, n, key).withColumn("gate", F.coalesce("gate", F.when(F.col("_n") < least, stage))).withColumn(
        "alive", F.col("alive") & F.col("gate").isNull()).drop("_n")


def gates(df: DataFrame, least: int, stages: list[str], key: str = "key") -> DataFrame:
    """(key, gate, at): the first gate that a key fails, before the first stage ("catalog") or after each, and its place; null where it passes all.

    For a frame that went through the stages without gates. A gate takes or leaves whole keys and a stage looks at one key at a
    time, so the rows of a key are the same up to its first gate: one count a key of the rows that passed so far finds it.
    """
    passed, alive = F.lit(True), {"catalog": F.lit(True)}
    for s in stages:
        passed = passed & F.coalesce(F.col(s), F.lit(True))
        alive[s] = passed
    alive[stages[-1]] = passed & F.col("alive")
    first = F.coalesce(*(F.when(F.col(f"_n{i}") < least, F.struct(F.lit(i).alias("i"), F.lit(s).alias("stage"))) for i, s in enumerate(alive)))
    return df.groupBy(key).agg(*(F.count_if(a).alias(f"_n{i}") for i, a in enumerate(alive.values()))).select(key, first.alias("_gate")).select(
        key, F.col("_gate.stage").alias("gate"), F.col("_gate.i").alias("at"))


def min_count_gates(df: DataFrame, least: int, stages: list[str], key: str = "key") -> DataFrame:
    """min_count_gate before the first and after each of the stages at once, see gates(); verdicts after a key's gate become null."""
    by = gates(df, least, stages, key).select(key, F.col("gate").alias("_failed"), F.col("at").alias("_at"))
    seen = lambda i: F.col("_at").isNull() | (F.col("_at") >= i)
    return with_key(df, by, key).withColumns({c: F.when(seen(i), F.col(c)) for i, s in enumerate(stages, 1) for c in (s, f"{s}_reason")}).withColumns(
        {"alive": F.col("alive") & F.col("_at").isNull(), "gate": F.col("_failed")}).drop("_failed", "_at")


def price_stage(df: DataFrame, cfg: Config) -> DataFrame:
    return _after(df, "price_filter", price_floor(F.col("price"), cfg), F.lit("below_floor"))


def row_reason(cfg: Config) -> Column:
    """The first rule that a row fails by itself: image, stop-word, reviews. Null: none."""
    word = stopword_first_match(cfg.stopwords, F.col("title"), F.col("snippet"), F.col("seller_name"))
    few = F.coalesce(F.col("seller_reviews") < cfg.min_reviews, F.lit(True)) if cfg.min_reviews > 0 else F.lit(False)
    rules = [F.concat(F.lit("stopword:"), word), F.when(few, "few_reviews")]  # null without a word
    if cfg.require_images:
        rules.insert(0, F.when(F.coalesce("images_count", F.lit(0)) == 0, "no_image"))
    return F.coalesce(*rules)


def mechanical_reason(cfg: Config, by_row: Column | None = None) -> Column:
    """by_row, by default row_reason, then too cheap or outlier. Null: none. Beside the columns of price_stats."""
    by_row = row_reason(cfg) if by_row is None else by_row
    return F.coalesce(by_row, price_verdict(F.col("price").cast("double"), cfg)) if cfg.check_prices else by_row


def mechanical_stage(df: DataFrame, cfg: Config, by_row: Column | None = None) -> DataFrame:
    shown = F.coalesce("images_count", F.lit(0)) > 0 if cfg.require_images else F.lit(True)
    df = price_stats(df, cfg, F.col("alive") & shown).withColumn("_why", mechanical_reason(cfg, by_row))
    return _after(df, "mechanical", F.col("_why").isNull(), F.col("_why")).drop("_why", *STATS)


def _best_of(df: DataFrame, stage: str, group: Column, bypass: Column) -> DataFrame:
    """The best alive row of a group stays: most images, lowest price, then item_id. Only fail rows get a verdict.

    A group's best is an aggregate that starts in each task, and is joined back without gathering a group; a row that is alone
    in its group has nothing to lose to, so only groups of more rows are written and joined. Rows of one key and item_id are one item.
    """
    rows = df.withColumns({"_g": group, "_in": F.col("alive") & ~bypass})
    order = F.struct((-F.coalesce("images_count", F.lit(0))).alias("i"), F.coalesce("price", F.lit(0.0)).alias("p"), "item_id")
    best = kept(rows.where("_in").groupBy("key", "_g").agg(F.min(order)["item_id"].alias("_kept"), F.count("*").alias("_n")).where("_n > 1"), "best")
    rows = with_group(rows, best, ["key", "_g"], "_n", F.xxhash64("item_id"), F.col("_in"))
    loses = F.col("_kept").isNotNull() & ~F.col("item_id").eqNullSafe(F.col("_kept"))
    return rows.withColumn("_loses", loses).withColumns({stage: F.when(F.col("_loses"), False), f"{stage}_reason": F.when(F.col("_loses"), F.concat(F.lit("kept:"), F.col("_kept")))}).withColumn(
        "alive", F.col("alive") & ~F.col("_loses")).drop("_g", "_in", "_kept", "_n", "_loses")


def seller_key() -> Column:
    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    return F.coalesce(empty("seller_id"), empty("seller_name"), F.lit(""))


def seller_dedup(df: DataFrame) -> DataFrame:
    return _best_of(df, "seller_dedup", seller_key(), F.lit(False))


def content_hash_dedup(df: DataFrame, hash_col: str = "image_hash") -> DataFrame:
    """Rows without content bypass."""
    return _best_of(df, "image_dedup", F.col(hash_col), F.col(hash_col).isNull())


def share_above(values: Column, level: float) -> Column:
    """Share of the elements above a level; null for a null or empty array."""
    return F.when(F.size(values) > 0, F.size(F.filter(values, lambda x: x > level)) / F.size(values))


def array_share_stage(df: DataFrame, cfg: Config, values: str = "pixels", share: Column | None = None) -> DataFrame:
    """Rows whose share (by default that of values) is over the limit go; rows without an array bypass. Only fail rows get a verdict."""
    share = share_above(F.col(values), cfg.white_level) if share is None else share
    loses = F.col("alive") & F.coalesce(share > cfg.white_share, F.lit(False))
    return df.withColumns({"_l": loses}).withColumns({"white_bg": F.when(F.col("_l"), False), "white_bg_reason": F.when(F.col("_l"), "white")}).withColumn(
        "alive", F.col("alive") & ~F.col("_l")).drop("_l")


def cap_per_key(df: DataFrame, n: int, key: str = "key", order: tuple[str, ...] = ("item_id",)) -> DataFrame:
    return df.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_i") <= n).drop("_i")


def model_stage(df: DataFrame, cfg: Config, accepted: Column) -> DataFrame:
    """The verdict of a model for the first rows of a key by item_id, which names a row of a key; rows beyond get no verdict and go.

    The last row asked is found by a limit a key, which Spark applies in each task before rows move.
    """
    first = cap_per_key(df.where("alive").select("key", "item_id"), cfg.model_rows)
    df = with_key(df, first.groupBy("key").agg(F.max("item_id").alias("_last")))
    df = df.withColumn("_asked", F.col("alive") & F.coalesce(F.col("item_id") <= F.col("_last"), F.lit(False)))
    return df.withColumns({"ai": F.when(F.col("_asked"), accepted), "ai_reason": F.when(F.col("_asked") & ~accepted, "not_relevant")}).withColumn(
        "alive", F.col("_asked") & accepted).drop("_asked", "_last")
