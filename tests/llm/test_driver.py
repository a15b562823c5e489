"""What reaches the driver."""

import pytest
from pyspark.sql import functions as F

from vetrina.llm import jaccard, url_filter
from vetrina.llm.common import BROADCAST_BYTES, THRESHOLD, Scratch


def rows_of(df, node):
    """Rows that came out of the nodes of a name in the plan that ran, the largest."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        p = p.finalPhysicalPlan() if p.nodeName().startswith("AdaptiveSparkPlan") else p.plan() if "QueryStage" in p.nodeName() else p
        if node in p.nodeName() and p.metrics().contains("numOutputRows"):
            found.append(p.metrics().apply("numOutputRows").value())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return max(found, default=None)


@pytest.mark.parametrize("most", [url_filter.BROADCAST_BYTES, 1000, 0])
def test_a_salted_side_is_not_broadcast(spark, monkeypatch, most):
    """A side of 3,000 rows, far below Spark's threshold, has 48,000 with its salts."""
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", most)
    with Scratch(spark) as scratch:
        right = scratch.keep(spark.range(3000).select(F.col("id").alias("k"), F.xxhash64("id").alias("v")), "right")
        left = scratch.keep(spark.range(9000).select(F.when(F.col("id") % 9 > 0, F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id"))).alias("k"), F.col("id").alias("i")), "left")
        out = url_filter.salted_join(left, right, "k", F.xxhash64("i"))
        assert out.columns == ["k", "i", "v"]
        got = sorted(out.collect(), key=lambda r: r["i"])
        want = left.join(right, "k", "left").orderBy("i").collect()
        assert got == want and len(got) == 9000
        assert rows_of(out, "BroadcastExchange") == (3000 if most > 1000 else None)
        few = right.groupBy("k").agg(F.min("v").alias("v"))  # of which Spark knows the size when it has run
        monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 0)
        out = url_filter.salted_join(left, few, "k", F.xxhash64("i"))
        assert sorted(out.collect(), key=lambda r: r["i"]) == want and rows_of(out, "BroadcastExchange") is None


def test_frequent_tokens_are_sorted_and_no_rows_of_objects(spark, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "toPandas", None)
    texts = [f"a b c d e f{i}" for i in range(40)] + ["p q r s t u"] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "_text string").coalesce(1)
    with Scratch(spark) as scratch:
        tokens, n = jaccard._frequent(docs, 5, scratch)
        assert tokens.tolist() == [jaccard.shingles("a b c d e").tolist()[0]] and n.tolist() == [40]
    with Scratch(spark) as scratch:
        tokens, n = jaccard._frequent(docs.limit(0), 5, scratch)
        assert len(tokens) == len(n) == 0


def test_similar_texts_are_joined_with_small_broadcasts(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three four five six seven {i % 3}") for i in range(9)], "doc_id long, text string")
    seen, links = [], jaccard.links

    def spied(*args):
        seen.append(int(spark.conf.get(THRESHOLD)))
        return links(*args)

    monkeypatch.setattr(jaccard, "links", spied)
    for asked, inside in (("64m", BROADCAST_BYTES), ("1000", 1000), ("-1", -1)):
        spark.conf.set(THRESHOLD, asked)
        try:
            assert {r["component_id"] for r in jaccard.classes(docs).collect()} == {0, 1, 2}
            assert spark.conf.get(THRESHOLD) == asked and seen.pop() == inside
        finally:
            spark.conf.unset(THRESHOLD)


def test_the_pipelines_near_duplicates_send_no_salted_side(spark, monkeypatch):
    """Salted sides were broadcast with 16 rows a key, whatever the threshold made of them."""
    import corpus_pipeline

    docs = spark.createDataFrame([(i, f"one two three four five six seven {i % 3}", "en", "s", 9) for i in range(9)], "doc_id long, text string, lang string, source string, n_chars long")
    plans, join = [], url_filter.salted_join
    monkeypatch.setattr(url_filter, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(jaccard, "salted_join", lambda *a: plans.append(out := join(*a)) or out)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [0, 1, 2]
    hints = [p._jdf.queryExecution().optimizedPlan().toString() for p in plans]
    assert plans and all("rightHint=(strategy=merge)" in x for x in hints)
