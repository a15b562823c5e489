"""Operators on hot keys, reruns and competing writers: what one task, or one attempt, must not decide alone."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.operators import dedup as D
from vetrina.operators import folds
from vetrina.operators import lifecycle as L
from vetrina.operators import price as P
from vetrina.operators import records as R
from vetrina.operators import stages as S
from vetrina.operators.joins import with_group
from vetrina.operators.ranks import ranked
from vetrina.plans import profiles
from vetrina.sources import relational, sinks
from vetrina.sources.tables import StoredTable
from vetrina.streaming import jobs as J
from test_price import by_rule


# ranks and selection


def test_ranks_of_ties_and_nulls(spark):
    rows = [(i % 7 if i % 11 else None, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(7)
    got = {r["v"]: r["rank"] for r in ranked(df, [F.desc("k"), F.asc("v")]).collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert got == {v: i for i, (_, v) in enumerate(want, 1)}
    assert ranked(df.limit(0), ["k"]).count() == 0


def test_chunks_of_a_hot_key(spark):
    rows = [("hot" if i % 10 else None if i % 20 else f"k{i}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "key string, v int").repartition(8)
    got = {(r["key"], r["v"]): r["chunk"] for r in D.chunks(df, "key", ["v"], 7).collect()}
    by = {}
    for k, v in sorted(rows, key=lambda r: r[1]):
        by.setdefault(k, []).append(v)
    assert got == {(k, v): i // 7 for k, vs in by.items() for i, v in enumerate(vs)}


def windows_by(df, key):
    """Windows of a plan that are partitioned by the key alone."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in text.splitlines() if "Window [" in x and f"], [{key}#" in x and "," not in x.split("], [")[1].split("]")[0]]


@pytest.mark.parametrize("split", [10_000, 50])
def test_a_key_of_nine_tenths_of_all_rows(spark, split):
    r = random.Random(2)
    hot = [r.randrange(10**9) / 100 for _ in range(9000)]
    rest = [(f"k{i % 100}", float(r.randrange(50))) for i in range(900)] + [(None, 3.0), ("none", None)] + [(f"mid{i % 2}", float(i * i % 997)) for i in range(98)]
    df = spark.createDataFrame([("hot", p) for p in hot] + rest, "key string, price double").repartition(6)
    out = P.stats_by_key(df, split=split)
    got = {x["key"]: x for x in out.collect()}
    assert not windows_by(out, "key") and len(got) == 105
    for key in got:
        prices = hot if key == "hot" else [p for k, p in rest if k == key and p is not None]
        want = by_rule(prices)
        assert got[key]["n_prices"] == len(prices)
        for a, b in zip((got[key]["clean_median"], got[key]["top_median"], got[key]["upper_bound"]), want):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b)), key
    prof = {x["key"]: x["median_price"] for x in profiles.price_profile(df, 1e9, 10, 20, split).collect()}
    assert prof["hot"] == statistics.median(hot) and prof["mid1"] == statistics.median([p for k, p in rest if k == "mid1"]) and "none" not in prof


# best rows of a group


def listing(i, key, seller, images, price, image):
    return (key, f"i{i:05}", seller, "", images, price, image, True)


def test_sellers_without_id_and_name_hold_half_of_all_rows(spark):
    r = random.Random(3)
    rows = [listing(i, f"k{i % 2}", None if i % 2 else f"s{r.randrange(40)}", r.choice([None, 0, 1, 5]), r.choice([None, 9.0, 5.0]), None if i % 3 else f"h{r.randrange(9)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, item_id string, seller_id string, seller_name string, images_count int, price double, image_hash string, alive boolean").repartition(5)
    for stage, out, group in (("seller_dedup", S.seller_dedup(df), lambda x: x[2] or ""), ("image_dedup", S.content_hash_dedup(df), lambda x: x[6])):
        best = {}
        for x in rows:
            if group(x) is not None:
                best.setdefault((x[0], group(x)), []).append((-(x[4] or 0), x[5] or 0.0, x[1]))
        got = {x["item_id"]: (x["alive"], x[stage], x[f"{stage}_reason"]) for x in out.collect()}
        for x in rows:
            top = min(best[x[0], group(x)])[2] if group(x) is not None else x[1]
            assert got[x[1]] == ((True, None, None) if top == x[1] else (False, False, f"kept:{top}"))
        assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_with_group_of_nulls_and_absent_groups(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, "b"), (4, "hot"), (5, "hot")], "i int, g string")
    groups = spark.createDataFrame([(None, 1, "n"), ("a", 1, "x"), ("hot", 5000, "h")], "g string, n int, v string")
    got = {r["i"]: r["v"] for r in with_group(rows, groups, ["g"], "n", F.xxhash64("i"), F.col("i") != 5).collect()}
    assert got == {1: "n", 2: "x", 3: None, 4: "h", 5: None}


# ordered folds


def test_runs_in_small_pieces(spark):
    r = random.Random(1)
    rows = [(r.choice([0, 0, 0, 1, 2, None]), i // 3, i, r.choice([True, True, True, False, None])) for i in range(900)]
    df = spark.createDataFrame(rows, "id int, ts int, seq int, failed boolean").repartition(4)
    for size in (3, 1000):
        got = {x["id"]: tuple(x["s"]) for x in folds.fold(df, "id", ["ts", "seq"], folds.runs_of, folds.merged_runs, size).collect()}
        for k in {x[0] for x in rows}:
            f = [x[3] for x in rows if x[0] == k and x[3] is not None]
            runs = [len(x) for x in "".join("x" if y else " " for y in f).split(" ")]
            assert got[k] == (len(f), runs[0], runs[-1], max(runs))
    got = {x["id"]: (x["run"], x["blocked"]) for x in L.consecutive_errors(df, 9).collect()}
    assert len(got) == 4 and all(isinstance(b, bool) for _, b in got.values())


def walk(value, asked):
    applied = 0
    for expected, new in asked:
        if value is not None and value == expected:
            value, applied = new, applied + 1
    return value, applied, len(asked) - applied


def test_competing_updates_are_applied_in_order(spark, monkeypatch):
    r = random.Random(8)
    states = ["a", "b", "c", None]
    asked = [(r.choice([1, 1, 1, 2, 3]), r.choice(states), r.choice(["a", "b", "c", "c", None]), i) for i in range(600)]
    snapshot = [(1, "a"), (2, None), (3, "b"), (4, "c"), (5, None)]
    s = spark.createDataFrame(snapshot, "id int, value string")
    q = spark.createDataFrame(asked, "id int, expected string, new string, at int").repartition(5)
    want = {i: walk(v, [(e, n) for j, e, n, _ in asked if j == i]) for i, v in snapshot}
    for size in (4, 128):
        monkeypatch.setattr(L, "UPDATES", size)
        assert {x["id"]: (x["value"], x["applied"], x["skipped"]) for x in L.guarded_updates(s, q, ("at",)).collect()} == want
    one = {x["id"]: (x["value"], x["applied"]) for x in L.guarded_update(s, q, ("at",)).collect()}
    assert one == {i: (v, None if a + k == 0 else a > 0) for i, (v, a, k) in want.items()} and len(one) == 5
    twice = spark.createDataFrame([(3, "b", "x"), (3, "b", "y"), (2, "a", "z")], "id int, expected string, new string")
    after = L.guarded_update(s, twice)
    assert {x["id"]: (x["value"], x["applied"]) for x in after.where("id in (2, 3)").collect()} == {3: ("x", True), 2: (None, False)}
    assert tuple(L.update_counts(after).first()) == (1, 1)


# tables and streams


def test_a_labelled_commit_happens_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    t = StoredTable(spark, str(tmp_path / "t"))
    assert [t.append(df, "one"), t.append(df, "one"), t.append(df, "two"), t.append(df)] == [True, False, True, True]
    assert t.read().count() == 6
    assert t.replace(t.read().where("k = 1").distinct(), "three") and not t.replace(df, "three") and t.read().collect() == [(1, "a")]
    assert t.insert_absent(spark.createDataFrame([(1, "z"), (3, "y"), (3, "x")], "k int, v string"), "k")
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (3, "x")]
    assert t.clear() == 3 and t.read().count() == 2
    with pytest.raises(ValueError):
        StoredTable(spark, str(tmp_path / "none")).read()


def test_a_failed_write_is_not_seen(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path / "t"))
    t.append(spark.range(5))
    with pytest.raises(Exception, match="boom"):
        t.replace(spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")))
    assert t.read().count() == 5


def test_of_two_writers_one_looks_again(spark, tmp_path):
    t = StoredTable(spark, str(tmp_path / "t"))
    t.append(spark.range(2))
    other, calls = StoredTable(spark, str(tmp_path / "t")), []

    def rows(now):
        if not calls:
            other.append(spark.range(10, 13))  # commits between our look and our commit
        calls.append(now.count())
        return now.selectExpr("id + 100 as id")

    assert t.commit(rows, keep=True) and calls == [2, 5]
    assert sorted(r["id"] for r in t.read().collect()) == [0, 1, 10, 11, 12, 100, 101, 110, 111, 112]


class Lost(Exception):
    pass


@pytest.mark.parametrize("kind", ["append", "errors"])
def test_a_batch_that_is_run_again_is_written_once(spark, tmp_path, monkeypatch, kind):
    """The driver is lost after a batch's commit and before the stream notes it: the batch is run again."""
    source = str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame([(i % 3, part * 10 + i, i, i % 4 > 0) for i in range(10)], "id long, ts long, seq long, failed boolean").coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema("id long, ts long, seq long, failed boolean").option("maxFilesPerTrigger", 1).parquet(source)
    path = str(tmp_path / "out")
    run = lambda: J.run_once(stream(), path) if kind == "append" else J.consecutive_errors(stream(), path, 5)
    commit, done = StoredTable.commit, []

    def fails_after(self, *args, **kwargs):
        done.append(commit(self, *args, **kwargs))
        if len(done) == 2:
            raise Lost("after the write")
        return done[-1]

    monkeypatch.setattr(StoredTable, "commit", fails_after)
    with pytest.raises(Exception, match="after the write"):
        run()
    out = run()
    assert done == [True, True, False, True]
    if kind == "append":
        assert out.count() == 30 and out.select("batch").distinct().count() == 3
    else:
        rows = spark.read.parquet(source).withColumn("at", F.col("ts"))
        want = {x["id"]: (x["run"], x["blocked"]) for x in L.consecutive_errors(rows, 5).collect()}
        assert {x["id"]: (x["run"], x["blocked"]) for x in out.collect()} == want


def test_states_are_written_anew_now_and_then(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(J, "COMPACT", 2)
    source = str(tmp_path / "in")
    for part in range(5):
        spark.createDataFrame([(part, part, 0, True), (9, part, 1, True)], "id long, ts long, seq long, failed boolean").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("id long, ts long, seq long, failed boolean").option("maxFilesPerTrigger", 1).parquet(source)
    out = J.consecutive_errors(stream, str(tmp_path / "out"), 4)
    assert {x["id"]: (x["run"], x["blocked"]) for x in out.collect()} == {9: (5, True)} | {i: (1, False) for i in range(5)}
    assert len(StoredTable(spark, f"{tmp_path}/out/states")._state(5)["folders"]) == 1


# paths, brands, databases


def test_paths_into_objects_and_lists(spark):
    texts = ['{"a": {"b": [1, {"c": "x"}]}, "d\\"e": 2, "n": null}', "no json", None, "[]", '{"a": 5}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(r)[2:] for r in R.json_paths(df, "t", {"c": "a.b.1.c", "list": "a.b", "first": "a.b.0", "odd": 'd"e', "n": "n"}).orderBy("i").collect()]
    assert got == [("x", '[1,{"c":"x"}]', "1", "2", None)] + [(None,) * 5] * 4


def test_brands_of_any_length_by_longest_match(spark):
    rows = spark.createDataFrame([("k", "Land Rover Range Rover sport, rover; LAND rover"), ("k", "Ленд Ровер для ленд"), ("k", "Land Rover Range Rover sport, rover; LAND rover"), ("x", None), ("y", "")], "key string, text string")
    brands = spark.createDataFrame([("land rover",), ("Land  Rover-Range Rover",), ("rover",), ("lend rover",), ("",), (None,), ("for",)], "brand string")
    got = {(r["key"], r["brand"]): r["n"] for r in profiles.brand_matches(rows, brands).collect()}
    assert got == {("k", "land rover range rover"): 1, ("k", "rover"): 1, ("k", "land rover"): 1, ("k", "lend rover"): 1}


def test_a_relational_table_in_ranges(spark):
    url, driver = "jdbc:derby:memory:shop;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = [(i, f"n{i}", None if i % 10 == 0 else i * 1.5) for i in range(1000)]
    relational.write(spark.createDataFrame(rows, "id long, name string, price double"), url, "items", **driver)
    df = relational.read(spark, url, "items", by="id", columns=["id", "price"], where='"id" < 900', range_rows=100, connections=8, **driver)
    assert df.rdd.getNumPartitions() == 8 and df.columns == ["id", "price"] and df.count() == 900
    few = df.where("price > 1000").select("id")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThan(price,1000.0)" in plan.replace("*", "") and few.count() == sum(i < 900 and p is not None and p > 1000 for i, _, p in rows)
    assert relational.read(spark, url, "items", by="price", range_rows=300, **driver).where("price is null").count() == 100
    assert relational.read(spark, url, "items", **driver).rdd.getNumPartitions() == 1
    assert relational.read(spark, url, "items", by="id", where='"id" < 0', **driver).count() == 0
    new = spark.createDataFrame([(5, "new", 0.0), (2000, "two", 1.0), (2000, "one", 2.0)], "id long, name string, price double")
    for update, name in ((False, "n5"), (False, "n5"), (True, "new")):
        relational.upsert_from_stage(spark, new, url, "items", ["id"], update, **driver)
        back = {r["id"]: r["name"] for r in relational.read(spark, url, "items", where='"id" in (5, 2000)', **driver).collect()}
        assert back == {5: name, 2000: "one"}
    assert relational.read(spark, url, "items", **driver).count() == 1001


def test_kept_tables_are_cleared(spark):
    import os

    with sinks.cleared(spark):
        df = sinks.kept(spark.range(3), "x")
        path = df.inputFiles()[0].removeprefix("file://")
        assert df.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)
    assert Config().fence > 0
