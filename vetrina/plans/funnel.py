"""The funnel: stages over all keys, then all gates at once."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.operators import stages as S
from vetrina.sources.sinks import kept, settled

#: Names of the stages, and of the gates after them.
STAGES = ("price_filter", "mechanical", "seller_dedup", "image_dedup", "white_bg", "ai")


def judged(listings: DataFrame, cfg: Config = Config(), accepted: Column | None = None, reasons: bool = True) -> tuple[DataFrame, list[str]]:
    """The listings after all stages, without gates, and the stages that judged.

    What a row shows by itself is computed first, so texts and arrays never move; these narrow rows are written once, as stages
    read them for what they need of a key and for the rows. So are the rows before the model, which reads them twice. Listings may
    bring the ``share`` of their pixels, found once an image, in place of ``pixels``.
    """
    rows = listings.select("key", "item_id", "price", "images_count", S.seller_key().alias("seller_id"), F.lit("").alias("seller_name"), "image_hash", S.row_reason(cfg).alias("by_row"),
                           (F.col("share") if "share" in listings.columns else S.share_above(F.col("pixels"), cfg.white_level)).alias("share"), (F.lit(None).cast("boolean") if accepted is None else accepted).alias("accepted"))
    rows = kept(rows, "listings").withColumns({"alive": F.lit(True), "gate": F.lit(None).cast("string")})
    df = S.mechanical_stage(S.price_stage(rows, cfg), cfg, F.col("by_row"))
    df = S.array_share_stage(S.content_hash_dedup(S.seller_dedup(df)), cfg, share=F.col("share"))
    stages = [s for s in STAGES if s in df.columns]
    df = kept(df.select("key", "item_id", "accepted", "alive", "gate", *stages, *(f"{s}_reason" for s in stages if reasons)), "funnel")
    if accepted is not None:
        df, stages = S.model_stage(df, cfg, F.col("accepted")), [*stages, "ai"]
    return df, stages


def by_slice(listings: DataFrame, slices: int, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """make(listings), for a plan that looks at one key at a time: keys are dealt into slices by hash, and these are made one after the other.

    A slice's shuffles and tables go when its result is written, so that the disk holds those of one slice and the results.
    """
    if slices <= 1:
        return make(listings)
    mine = F.pmod(F.xxhash64("key"), F.lit(slices))
    parts = [settled(listings.sparkSession, functools.partial(make, listings.where(mine == i)), "slice") for i in range(slices)]
    return functools.reduce(DataFrame.unionByName, parts)


def funnel(listings: DataFrame, cfg: Config = Config(), accepted: Column | None = None, slices: int = 1) -> DataFrame:
    """(key, item_id) of listings with a verdict and a reason column a stage, ``alive`` (passed all) and ``gate`` (stage after which
    the key had too few).

    accepted: a model's verdict, if there is a model. slices: see by_slice().
    """
    def whole(rows: DataFrame) -> DataFrame:
        df, stages = judged(rows, cfg, accepted)
        return S.min_count_gates(df, cfg.min_items, stages).drop("accepted")

    return by_slice(listings, slices, whole)


def verdict_log(wide: DataFrame) -> DataFrame:
    """(key, item_id, stage, passed, reason): a row for each verdict of a funnel frame."""
    have = [s for s in STAGES if s in wide.columns]
    each = F.array(*(F.struct(F.lit(s).alias("stage"), F.col(s).alias("passed"), F.col(f"{s}_reason").alias("reason")) for s in have))
    return wide.select("key", "item_id", F.explode(F.filter(each, lambda v: v["passed"].isNotNull())).alias("v")).select("key", "item_id", "v.*")


def key_states(wide: DataFrame) -> DataFrame:
    """(key, state, gate): the final state of each key of a funnel frame."""
    return _states(wide.groupBy("key").agg(F.max("gate").alias("gate")))


def final_states(listings: DataFrame, cfg: Config = Config(), accepted: Column | None = None, slices: int = 1) -> DataFrame:
    """(key, state, gate) as key_states() of the funnel, from counts alone: no row is joined to its key's gate."""
    def whole(rows: DataFrame) -> DataFrame:
        df, stages = judged(rows, cfg, accepted, reasons=False)
        return _states(S.gates(df, cfg.min_items, stages))

    return by_slice(listings, slices, whole)


def _states(gates: DataFrame) -> DataFrame:
    return gates.select("key", F.when(F.col("gate").isNull(), "VALIDATED").otherwise("REJECTED_BY_MIN_COUNT").alias("state"), "gate")


def stage_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("key", "stage").agg(F.count("*").alias("n"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"))
