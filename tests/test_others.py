"""Velocity, lifecycle, answers, sources, streams and the registry."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from vetrina.operators import lifecycle as L
from vetrina.operators import model_io as M
from vetrina.plans import profiles as P
from vetrina.plans import reports as R
from vetrina.plans import velocity as V
from vetrina.queries import stream
from vetrina.sources import sinks, text
from vetrina.streaming import jobs as J

T0 = dt.datetime(2025, 1, 1)


def test_velocity_of_ties_nulls_and_falls(spark):
    h = lambda n: T0 + dt.timedelta(hours=n)
    rows = [("tie", "k", h(0), 5, 1.0), ("tie", "k", h(0), 5, 1.0), ("null", "k", h(0), None, 1.0), ("null", "k", h(2), 9, 1.0), ("fall", "k", h(0), 9, 1.0), ("fall", "k", h(3), 3, 1.0), ("one", "k", h(0), 1, 1.0)]
    df = spark.createDataFrame(rows, "item_id string, key string, parsed_at timestamp, views int, price double")
    got = {r["item_id"]: r for r in V.view_velocity(df).collect()}
    assert set(got) == {"tie", "fall"} and got["tie"]["views_per_hour"] is None and got["fall"]["views_per_hour"] == -2.0
    assert {(r["item_id"], r["issue"]) for r in V.quality_flags(V.view_velocity(df, keep_all=True)).collect()} == {("tie", "zero_interval"), ("null", "null_views"), ("fall", "negative_diff")}


def test_a_stale_pair_makes_an_item_a_candidate(spark):
    rows = spark.createDataFrame([("i", "a", T0), ("i", "b", T0 + dt.timedelta(days=9))], "item_id string, key string, parsed_at timestamp")
    none = spark.createDataFrame([], "item_id string")
    out = V.reparse_candidates(rows, none, spark.createDataFrame([], "key string"), none, "2025-01-10 00:00:00", 48).collect()
    assert [(r["item_id"], r["key"]) for r in out] == [("i", "a")]


def test_profile_golden(spark):
    """Two keys whose ratio and fraction are known."""
    df = spark.createDataFrame([("a", p) for p in (100.0, 1200.0, 5000.0)] + [("b", p) for p in (900.0, 1000.0)], "key string, price double")
    prof = P.price_profile(df, 1000, 1200, 2000)
    assert [(r["key"], r["ratio"]) for r in P.big_gap(prof).collect()] == [("a", 12.0), ("b", 950 / 900)]
    assert [(r["key"], r["fraction"]) for r in P.low_fraction(prof).collect()] == [("b", 1.0), ("a", 2 / 3)]


def test_model_answers(spark):
    ask = spark.createDataFrame([(k, i) for k in "abcdef" for i in ("1", "2", "3")], "key string, item_id string")
    ok = '{"passed_ids": ["1"], "rejected": [{"id": "2", "reason": "r"}]}'
    raw = {"a": ok, "b": f"<think>{{}}</think> {ok}", "c": f"Sure: {ok} done", "d": '{"passed_ids": ["1"], "rejected": [{"id": "2", "reason": "r"}', "e": "nothing", "f": '{"passed_ids": ["1", "2"], "rejected": [{"id": "2", "reason": "r"}]}'}
    v = M.parse_verdicts(spark.createDataFrame(list(raw.items()), "key string, raw string"), ask)
    got = {(r["key"], r["item_id"]): (r["passed"], r["reason"], r["status"]) for r in v.collect()}
    for k in "abcd":
        assert got[k, "1"] == (True, None, "ok") and got[k, "2"] == (False, "r", "ok") and got[k, "3"][1] == "not covered by the answer"
    assert got["e", None][2] == "error" and got["f", "2"][0] is True
    applied = {(r["key"], r["item_id"]): r["passed"] for r in M.apply_verdicts(ask, v).collect()}
    assert len(applied) == 18 and sum(applied.values()) == 6


def test_runs_and_guards(spark):
    e = spark.createDataFrame([(1, T0 + dt.timedelta(minutes=i), i, f) for i, f in enumerate([True, True, True, False, True])], "id int, ts timestamp, seq int, failed boolean")
    assert [(r["run"], r["blocked"]) for r in L.consecutive_errors(e).collect()] == [(1, True)]
    s = spark.createDataFrame([("a", "NEW"), ("b", "DONE"), ("c", "NEW")], "id string, value string")
    q = spark.createDataFrame([("a", "NEW", "X"), ("b", "NEW", "X")], "id string, expected string, new string")
    assert {r["id"]: (r["value"], r["applied"]) for r in L.guarded_update(s, q).collect()} == {"a": ("X", True), "b": ("DONE", False), "c": ("NEW", None)}


def test_key_list_and_merge(spark, tmp_path):
    (tmp_path / "keys.txt").write_text(" a \n\n# c\nb\na\n" + "x" * 300 + "\n")
    rows = text.lines(spark, str(tmp_path / "keys.txt"))
    assert {r["key"] for r in text.key_list(rows).collect()} == {"a", "b"}
    assert tuple(text.key_list_counts(rows).first()) == (6, 3, 1)
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert tuple(sinks.insert_counts(new, spark.createDataFrame([("b",)], "k string"), "k").first()) == (1, 2)


def test_every_query_has_a_callable_and_sql_names_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100


@pytest.mark.parametrize("name", ["funnel", "view_velocity", "stream_velocity", "stream_consecutive_errors", "parse_photo_classes", "parse_event_jsonl", "export_summary"])
def test_query_equals_its_sql(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "supplier", "customer", "events", "embeddings", "documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    df = entry.queries()[name](spark, d)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    norm = lambda rows: sorted((tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows))
    assert norm(df.select(*cols).collect()) == norm(cur.fetchall())


def test_stream_of_a_hot_key_in_many_files(spark, tmp_path, monkeypatch):
    """A key's state sees a row for each slice of time, and the copy is written by many tasks."""
    r = random.Random(4)
    rows = [(i, T0 + dt.timedelta(seconds=r.randrange(40_000)) if i % 500 else None, 0 if i % 3 else r.randrange(9), "error" if r.random() < 0.4 else "view", 1.0, "") for i in range(6000)]
    rows += [(7000 + i, T0 + dt.timedelta(seconds=i), 50, "error", 1.0, "") for i in range(3)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(stream, "ROWS", 500)
    seen = []
    monkeypatch.setattr(stream, "shared_path", lambda _, name: seen.append(f"{tmp_path}/{name}") or f"{tmp_path}/{name}")
    got = {x["id"]: (x["run"], x["blocked"]) for x in stream.stream_errors(spark, str(tmp_path)).collect()}
    last = dt.datetime.max
    want = {}
    for _, _, user, kind in sorted((t or last, i, u, k) for i, t, u, k, _, _ in rows):
        n, blocked = want.get(user, (0, False))
        n = n + 1 if kind == "error" else 0
        want[user] = (n, blocked or n >= 3)
    assert got == want
    files = spark.read.parquet(seen[0]).select(F.input_file_name().alias("f"), "ts").groupBy("f").count().collect()
    assert len(files) == 2 * -(-6003 // 1000) and max(x["count"] for x in files) < 1000
    hot = spark.read.parquet(seen[0]).selectExpr("user_id as id", "ts", "event_id as seq", "event_type = 'error' as failed")
    assert J._summaries(hot, 600).where("id = 0").count() <= 40_000 // 600 + 2


def test_brands_without_stopwords_and_in_latin_letters(spark):
    rows = spark.createDataFrame([("k", 5.0, "Новый Ленд Ровер для BOSCH"), ("k", 3.0, "land new rover"), ("none", 1.0, "для the")], "key string, price double, text string")
    brands = spark.createDataFrame([("lend rover",), ("land rover",), ("bosch",), ("the",)], "brand string")
    assert [tuple(r) for r in P.brand_tokens(rows, brands).collect()] == [("k", 3.0, "bosch, land rover, lend rover")]
    assert P.latin(F.lit("щюжя")) is not None and spark.range(1).select(P.latin(F.lit("щюжья"))).first()[0] == "schyuzhya"


def test_counts_of_guarded_updates_and_agreement(spark):
    after = L.guarded_update(spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, value string"),
                             spark.createDataFrame([(1, "a", "z"), (2, "a", "z")], "id long, expected string, new string"))
    assert tuple(L.update_counts(after).first()) == (1, 1)
    runs = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, v boolean")
    other = spark.createDataFrame([(1, True), (2, True), (3, True), (4, True)], "id long, v boolean")
    assert tuple(R.agreement_rate(R.agreement(runs, other, "id", "v")).first()) == (1, 2, 50.0)
    assert tuple(R.agreement_rate(R.agreement(runs.limit(0), other, "id", "v")).first()) == (0, 0, None)
