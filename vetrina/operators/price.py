"""Price statistics of a key's listings, from ranks of its prices, and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.operators.selection import SPLIT, Step, by_key, counts
from vetrina.sources.sinks import kept

STATS = ("n_prices", "q1", "q3", "clean_median", "top_median", "upper_bound")


def price_floor(price: Column, cfg: Config) -> Column:
    """Whether a price passes; a null price does not."""
    return F.coalesce(price >= cfg.min_price, F.lit(False))


def _steps(cfg: Config) -> list[Step]:
    """The statistics by ranks: quartiles are exclusive; the rows inside the fences are consecutive ranks, so every median is the mean of two."""
    j = {i: f"greatest(1, least(n - 1, floor({i} * (n + 1) / 4)))" for i in (1, 3)}
    quartile = lambda i: f"if(n >= 4, (_at{i} * (4 - ({i} * (n + 1) - 4 * {j[i]})) + _next{i} * ({i} * (n + 1) - 4 * {j[i]})) / 4, null)"
    middle = lambda name, low, high: {f"_{name}_low": f"floor(({low} + {high}) / 2)", f"_{name}_high": f"ceil(({low} + {high}) / 2)"}
    mean = lambda name: f"(_{name}_low + _{name}_high) / 2"
    return [
        Step(ranks={f"_at{i}": j[i] for i in j} | {f"_next{i}": f"{j[i]} + 1" for i in j} | middle("all", "1", "n"),
             then={"q1": quartile(1), "q3": quartile(3), "_all": mean("all"), "_low": f"q1 - {cfg.fence}D * (q3 - q1)", "_high": f"q3 + {cfg.fence}D * (q3 - q1)"}),
        Step(counts={"_below": "{p} < _low", "_b": "{p} <= _high"}, then={"_a": "_below + 1"}),
        Step(ranks=middle("clean", "_a", "_b"), then={"_clean": f"if(_b >= _a, {mean('clean')}, null)"}),
        Step(counts={"_near": f"{{p}} <= _high and {{p}} <= {cfg.extreme}D * _clean"},
             then={"_c": "if(_near < _a, _b, _near)", "_k": "greatest(1, floor((_c - _a + 1) * 2 / 5))"}),
        Step(ranks=middle("top", "_c - _k + 1", "_c"),
             then={"n_prices": "n", "clean_median": "coalesce(_clean, _all)", "top_median": f"if(_clean is null, _all, {mean('top')})",
                   "upper_bound": f"if(_clean is null, {cfg.small_bound}D * _all, _high)"}),
    ]


def stats_by_key(df: DataFrame, cfg: Config = Config(), eligible: Column | None = None, key: str = "key", price: str = "price", split: int = SPLIT) -> DataFrame:
    """(key, STATS): the statistics of the eligible rows' prices of each key, one row a key, by exact selection (selection.py)."""
    p = F.when(F.lit(True) if eligible is None else eligible, F.col(price).cast("double"))
    return by_key(counts(df, key, p), key, _steps(cfg), list(STATS), split)


def price_stats(df: DataFrame, cfg: Config = Config(), eligible: Column | None = None, key: str = "key", price: str = "price") -> DataFrame:
    """df with STATS of its key, see stats_by_key; df is read for its counts, which are written at once, and for its rows."""
    return with_key(df, kept(stats_by_key(df, cfg, eligible, key, price), "stats"), key)


def with_key(df: DataFrame, by_key: DataFrame, key: str = "key") -> DataFrame:
    """df with the columns of its key's row; null is a key too. No order or partitioning is asked for, so a hot key's rows can be split."""
    return df.join(by_key.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def price_verdict(price: Column, cfg: Config = Config()) -> Column:
    """'too_cheap', 'outlier' or null, beside the columns of price_stats."""
    return F.when(price < cfg.cheap_share * F.col("top_median"), "too_cheap").when(price > F.col("upper_bound"), "outlier")
