"""Price statistics against the rules restated in Python."""

import statistics

import pytest
from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.operators import price as P


def by_rule(prices):
    n = len(prices)
    if n >= 4:
        q = statistics.quantiles(sorted(prices), n=4)
        low, high = q[0] - (q[2] - q[0]), q[2] + (q[2] - q[0])
        clean = [p for p in sorted(prices) if low <= p <= high]
        if clean:
            m = statistics.median(clean)
            fin = [p for p in clean if p <= 2.5 * m] or clean
            return m, statistics.median(sorted(fin, reverse=True)[: max(1, len(fin) * 2 // 5)]), high
    if not n:
        return None, None, None
    m = statistics.median(prices)
    return m, m, 3 * m


CASES = {
    "none": [], "one": [5.0], "three": [1.0, 9.0, 4.0], "four": [1.0, 2.0, 3.0, 50.0], "five": [10.0, 11.0, 12.0, 13.0, 900.0], "equal": [7.0] * 6,
    "known": [1, 2, 4, 7, 11, 16, 22.5], "wide": [1.0, 1.0, 1.0, 100.0, 101.0, 102.0, 300.0], "many": [float((i * 37) % 101 + 1) for i in range(60)],
}


def test_price_stats(spark):
    rows = [(k, float(p)) for k, v in CASES.items() for p in v] + [("none", None), ("five", None)]
    got = {r["key"]: r for r in P.price_stats(spark.createDataFrame(rows, "key string, price double")).collect()}
    for k, prices in CASES.items():
        want = by_rule([float(p) for p in prices])
        assert got[k]["n_prices"] == len(prices)
        for a, b in zip((got[k]["clean_median"], got[k]["top_median"], got[k]["upper_bound"]), want):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b)), k
    assert (got["known"]["q1"], got["known"]["q3"]) == (2.0, 16.0)


def test_price_verdict(spark):
    rows = [("k", p) for p in (100.0, 110.0, 120.0, 130.0, 1.0, 9000.0)]
    out = P.price_stats(spark.createDataFrame(rows, "key string, price double")).withColumn("v", P.price_verdict(F.col("price"), Config()))
    m, top, bound = by_rule([p for _, p in rows])
    want = {p: "too_cheap" if p < 0.2 * top else "outlier" if p > bound else None for _, p in rows}
    assert {r["price"]: r["v"] for r in out.collect()} == want


def test_a_hot_key_brings_its_distinct_prices_only(spark):
    prices = [float((i * 37) % 23 + 5) for i in range(9000)]
    df = spark.createDataFrame([("hot", p) for p in prices] + [(f"k{i % 100}", float(i)) for i in range(1000)] + [(None, 3.0)], "key string, price double")
    got = {r["key"]: r for r in P.stats_by_key(df).collect()}
    m, top, bound = by_rule(prices)
    assert len(got) == 102 and got[None]["n_prices"] == 1
    assert (got["hot"]["clean_median"], got["hot"]["top_median"], got["hot"]["upper_bound"]) == (m, top, bound)
    assert P.price_stats(df).where("n_prices is null").count() == 0
    lines = P.stats_by_key(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [x for x in lines if "Window [" in x]  # ranks are found without gathering a key
