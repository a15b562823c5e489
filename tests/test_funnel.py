"""Traps of the funnel and of the reports."""

import re

from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.functions.text import stopword_first_match, used_condition
from vetrina.operators import stages as S
from vetrina.plans import funnel as PF
from vetrina.plans import reports as R
from vetrina.queries.funnel import wide

ROW = "key string, item_id string, title string, snippet string, price double, seller_id string, seller_name string, seller_reviews int, images_count int, image_hash string, pixels array<double>"


def frame(spark, rows):
    base = dict(key="k", title="t", snippet="s", price=100.0, seller_id=None, seller_name=None, seller_reviews=9, images_count=1, image_hash=None, pixels=None)
    names = [c.split()[0] for c in ROW.split(", ")]
    return spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], ROW)


def alive(df):
    return df.withColumns({"alive": F.lit(True), "gate": F.lit(None).cast("string")})


def test_stopwords_are_bounded_and_ordered(spark):
    words = ("копия", "бу", "б/у", "аналог")
    texts = ["Б/У деталь", "бушпин", "аналоговый", "деталь бу, копия", "аналог", None, "x_бу"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", stopword_first_match(words, F.col("t")).alias("w"))
    want = {}
    for i, t in enumerate(texts):
        want[i] = next((w for w in words if re.search(r"\b" + re.escape(w) + r"\b", (t or "").lower())), None)
    assert {r["i"]: r["w"] for r in df.collect()} == want
    assert want == {0: "б/у", 1: None, 2: None, 3: "копия", 4: "аналог", 5: None, 6: None}


def test_stopword_in_the_seller_name_counts(spark):
    cfg = Config(stopwords=("used",), check_prices=False)
    out = S.mechanical_stage(alive(frame(spark, [{"item_id": "1", "seller_name": "Used parts"}, {"item_id": "2"}, {"item_id": "3", "images_count": 0, "title": "used"}])), cfg)
    assert {r["item_id"]: r["mechanical_reason"] for r in out.collect()} == {"1": "stopword:used", "2": None, "3": "no_image"}


def test_used_condition_is_by_parts(spark):
    df = spark.createDataFrame([({"Состояние": "бумага"},), ({"Цвет": "бу"},), ({},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(used_condition(F.col("m"), ["состояние"], ["бу"])).collect()] == [True, False, False, False]


def test_sellers_without_a_name_are_one_group_and_ties_go_by_item(spark):
    rows = [{"item_id": "b"}, {"item_id": "a", "seller_id": ""}, {"item_id": "c", "seller_name": ""}, {"item_id": "d", "seller_name": "n"}]
    out = S.seller_dedup(alive(frame(spark, rows)))
    assert {r["item_id"]: r["seller_dedup_reason"] for r in out.collect()} == {"a": None, "b": "kept:a", "c": "kept:a", "d": None}


def test_rows_without_content_bypass(spark):
    rows = [{"item_id": "1"}, {"item_id": "2"}, {"item_id": "3", "image_hash": "h"}, {"item_id": "4", "image_hash": "h", "images_count": 3}]
    out = S.array_share_stage(S.content_hash_dedup(alive(frame(spark, rows))), Config())
    assert {r["item_id"] for r in out.where("alive").collect()} == {"1", "2", "4"}


def test_rows_past_the_models_limit_get_no_verdict_and_go(spark):
    out = S.model_stage(alive(frame(spark, [{"item_id": f"{i:02d}"} for i in range(31)])), Config(), F.lit(True))
    assert out.where("ai").count() == 30 and out.where("ai is null and not alive").count() == 1


def test_gate_names_the_first_stage(spark):
    rows = [{"item_id": str(i), "price": 10.0 if i < 4 else 5000.0} for i in range(8)]
    out = PF.funnel(frame(spark, rows), Config(min_price=1000.0, min_items=5))
    assert {r["gate"] for r in out.collect()} == {"price_filter"} and PF.key_states(out).first()["state"] == "REJECTED_BY_MIN_COUNT"
    assert {r["stage"] for r in PF.verdict_log(out).collect()} == {"price_filter"}


def test_missing_verdicts_in_report_and_export(spark):
    listings = frame(spark, [{"item_id": x} for x in "abc"])
    v = spark.createDataFrame([("k", "a", "seller_dedup", False, "dup"), ("k", "b", "price_filter", True, None), ("k", "b", "mechanical", True, None), ("k", "b", "ai", False, "no")],
                              "key string, item_id string, stage string, passed boolean, reason string")
    rep = {r["item_id"]: r for r in R.funnel_report(listings, v).collect()}
    assert rep["c"]["price_filter_passed"] is False and rep["c"]["ai_passed"] is None and rep["b"]["rejection_stage"] == "ai"
    out = R.export_summary(spark.createDataFrame([("k",), ("z",)], "key string"), listings, v).collect()
    assert {r["key"]: (r["found"], r["price_filter_no_data"], r["n"]) for r in out} == {"k": (True, 2, 3), "z": (False, 0, 0)}


def test_a_hot_key_is_counted_before_it_moves(spark):
    """No window over a key's rows: only the model's limit, which each task applies first, and those of the groups within a key."""
    rows = frame(spark, [{"item_id": f"{i:04d}", "key": "hot" if i % 10 else "cold", "price": 5000.0 + i % 7, "seller_name": f"s{i}", "title": f"t{i}"} for i in range(400)])
    out = PF.funnel(rows, Config(min_items=45), F.lit(True))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == plan.count("Window [row_number") == plan.count("WindowGroupLimit") / 2 > 0
    assert "Window" not in S.min_count_gate(alive(rows), 5, "catalog")._jdf.queryExecution().executedPlan().toString()
    got = {r["key"]: (r["n"], r["alive"], r["gate"]) for r in out.groupBy("key").agg(F.count("*").alias("n"), F.count_if("alive").alias("alive"), F.max("gate").alias("gate")).collect()}
    assert got == {"hot": (360, 0, "ai"), "cold": (40, 0, "catalog")}
    assert out.where("key = 'hot' and ai").count() == 30 and out.where("key = 'cold' and price_filter is not null").count() == 0


def test_funnel_on_the_test_table(spark):
    out = wide(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "ai" in out.columns
