"""The corpus operators against brute force, on small frames with nulls, empty and long texts, ties, repeats, clashing columns and empty tables."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vetrina.llm import bpe, decontamination, jaccard, language_id, line_dedup, pii, quality, secrets, sharding, url_filter
from vetrina.llm.common import Scratch
from vetrina.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WS = r"[^\x20\x09-\x0D]+"


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in enumerate(texts)], DOCS)


def words(n, seed=0):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(n))


ODD = [None, "", " \n\t", "x", "one two three four five", words(3000, 1), words(60, 2), words(60, 2), "é" * 50, "a\nb\na\n\na"]
EMPTY = []


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# quality


def repeat_words(ws):
    at = defaultdict(list)
    for i in range(len(ws) - 4):
        at[tuple(ws[i : i + 5])].append(i)
    return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)})


def test_quality(spark):
    texts = [*ODD, "a b c d e a b c d e", "a a a a a a a", "# $ * | x y", "p q r s t u v w x y z " * 3]
    for r, t in zip(quality.judge(docs(spark, texts)).orderBy("doc_id").collect(), texts):
        ws = re.findall(WS, t or "")
        lines = [x for x in (t or "").split("\n") if re.search(WS, x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(ws), sum(map(len, ws)), len(lines) - len(set(lines)), repeat_words(ws)), t
        assert r.base_failed == (len(ws) < 10 or 100 * repeat_words(ws) > 20 * len(ws)) and not (r.base_failed and r.kept)


def test_quality_ablations_and_clashing_columns(spark):
    df = docs(spark, ["# " * 40, "# $ %", words(50), "A B C " * 20]).withColumn("mask", F.lit("x")).withColumn("f", F.lit(1)).withColumn("row", F.lit(2))
    rows = quality.ledger(df)
    masks = [r["mask"] for r in rows.collect()]
    for r in quality.ablations(rows).collect():
        bit = quality.BIT[r["rule"]]
        assert (r["n_failed"], r["n_only"], r["n_kept_without"]) == (sum(bool(m & bit) for m in masks), sum(m == bit for m in masks), sum(m & ~bit == 0 for m in masks))
    assert quality.keep(df).columns == df.columns and [r["doc_id"] for r in quality.keep(df).collect()] == [i for i, m in enumerate(masks) if m == 0]
    assert quality.judge(docs(spark, EMPTY)).count() == 0


# secrets


def test_trigram_queries_are_necessary():
    for rule, sample in zip(secrets.BASE[:2], ("api_key = abcdefgh", "AKIA" + "Z" * 16)):
        q = secrets.trigram_query(rule.pattern)
        assert q and any(all(g in sample.lower() for g in s) for s in q)
    assert secrets.trigram_query("[0-9a-f]{24,}") == [] and secrets.trigram_query("abc|d") == [] and secrets.trigram_query("a?bcd") == [frozenset({"bcd"})]


def test_postings(spark):
    grams = {"aba", "bab", "abc", "a.c", "://", " ke", "]^-", "\\d\n"}
    texts = [None, "", "ab", "ABABA abcabc a.c", "x://://", " key]^-", "\\d\n" * 3, "é" * 9 + "abc"]
    got = defaultdict(list)
    for r in secrets.postings(docs(spark, texts), grams).collect():
        got[r.doc_id].append(r.trigram)
    assert {i: sorted(v) for i, v in got.items()} == {i: w for i, t in enumerate(texts) if (w := sorted(g for g in grams if g in (t or "").lower()))}
    assert secrets.postings(docs(spark, texts), set()).count() == 0


def test_secrets(spark):
    hexed = "0123456789abcdef" * 2
    texts = [*ODD, 'é token = "abcdef" and SECRET:x', f"token=token:abcdefgh {hexed}", "AKIA" + "A" * 16 + " AKIAB", f"passwd: '{hexed}'", "api-key=1 apikey:zzzzzz", "ghp_" + "a1" * 18]
    rules = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
             ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    for r, t in zip(secrets.digest(docs(spark, texts)).orderBy("doc_id").collect(), texts):
        found = sorted((m.start(), k, m.end(), n) for k, (n, p, ok) in enumerate(rules) for m in re.finditer(p, t or "") if ok(m))
        want = ",".join(f"{n}:{s}:{e}" for s, _, e, n in found)
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and r.n_hex == sum(x[3] == "hex" for x in found)
    assert "github" in r.spans and secrets.digest(docs(spark, EMPTY)).count() == 0


# sharding


def test_sharding(spark):
    texts = [*ODD, *["same"] * 300, *(words(n % 50, n) for n in range(300))]
    rows = sharding.deal(docs(spark, texts)).collect()
    by = defaultdict(list)
    for r in rows:
        t = (texts[r.doc_id] or "").encode()
        assert r.size == len(t) + 8 and r.text_crc32 == zlib.crc32(t)
        by[r.shard].append(r)
    total = sum(r.size for r in rows)
    assert len(rows) == len(texts) and all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    assert all(abs(sum(r.size for r in v) - total / 24) <= 2 * max(r.size for r in rows) for v in by.values())
    assert sharding.deal(docs(spark, EMPTY)).count() == 0
    twice = docs(spark, ["a"]).union(docs(spark, ["a"])).withColumn("size", F.lit(1))
    assert sorted(r.slot for r in sharding.deal(twice, 1).collect()) == [0, 1]


def brute_shards(rows, shards):
    """{(key, text): (shard, slot)}: the whole order at once, borders by bytes, moved to the end of small groups."""
    order = sorted(rows, key=lambda r: ("-" if r[1] is None else hashlib.md5(r[1].encode()).hexdigest(), r[0] is not None, r[0] or 0))
    sizes = [len((t or "").encode()) + 8 for _, t in order]
    total, before, borders, place = sum(sizes), 0, [0] + [len(order)] * (shards - 1), {}
    for i, n in enumerate(sizes):
        for s in range(1, shards):
            if before * shards // total >= s:
                borders[s] = min(borders[s], i)
        before += n
    for s in range(1, shards):
        at = borders[s]
        alike = [i for i, (_, t) in enumerate(order) if at < len(order) and t == order[at][1]]
        if alike and sum(sizes[i] for i in alike) <= sharding.TOGETHER * total / shards:
            borders[s] = alike[0] if at - alike[0] <= alike[-1] + 1 - at else alike[-1] + 1
    for i, r in enumerate(order):
        s = max(s for s in range(shards) if borders[s] <= i)
        place[r] = (s, i - borders[s])
    return place


@pytest.mark.parametrize("ranges, shards", [(192, 24), (3, 5), (2000, 24)])
def test_sharding_by_brute_force(spark, monkeypatch, ranges, shards):
    """Few and many ranges, groups of a hundred and of two, keys that are null, negative or shared by other texts."""
    monkeypatch.setattr(sharding, "RANGES", ranges)
    r = random.Random(3)
    texts = [*ODD, *["same"] * 900, *(words(r.choice([3, 20, 200]), n) for n in range(500) for _ in range(r.choice([1, 1, 2])))]
    rows = [(i - 40, t) for i, t in enumerate(texts)] + [(None, "no key"), (7, "another"), (7, None)]
    dealt = sharding.deal(spark.createDataFrame(rows, DOCS.split(", lang")[0]).withColumn("text_crc32", F.lit("x")), shards)
    want = brute_shards(rows, shards)
    by_size = defaultdict(list)
    for (k, t), v in want.items():
        by_size[k, len((t or "").encode()) + 8].append(v)
    for x in dealt.collect():
        assert (x.shard, x.slot) in by_size[x.doc_id, x.size]
    assert dealt.select("shard", "slot").distinct().count() == len(rows)


def test_sharding_of_other_keys(spark):
    rows = spark.createDataFrame([("a", "t"), ("b", "t"), (None, None), ("c", "u")], "name string, text string")
    assert sorted((r.shard, r.slot) for r in sharding.deal(rows, 1, "name").collect()) == [(0, 0), (0, 1), (0, 2), (0, 3)]


def test_splitters_are_found_by_halving(spark):
    bounds = ["b", "d", "f"]
    for n in range(4):
        got = {r.k: r.range for r in sharding._ranged(spark.createDataFrame([(c,) for c in "abcdefg"], "k string"), bounds[:n]).collect()}
        assert got == {c: sum(b <= c for b in bounds[:n]) for c in "abcdefg"}


# Jaccard


def brute_components(texts):
    sets = []
    for t in texts:
        ws = re.findall(WS, (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_copies():
    r, out = random.Random(5), [*ODD]
    for g in range(25):
        base = words(r.choice([6, 12, 40, 90]), 100 + g).split()
        for _ in range(r.choice([1, 3, 9])):
            w = list(base)
            for _ in range(r.choice([0, 1, 1, 2])):
                w[r.randrange(len(w))] = f"new{r.randrange(99)}"
            out.append(" ".join(w[: r.choice([len(w), len(w), len(w) - 2])]))
    shared = words(30, 77)
    out += [shared + " " + words(r.choice([5, 8, 20]), 900 + i) for i in range(30)]
    return out


def test_jaccard(spark):
    texts = near_copies()
    rows = jaccard.classes(docs(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in rows] == brute_components(texts)


def test_jaccard_small_parts_and_empty(spark, monkeypatch):
    texts = near_copies()
    for k, v in (("GROUP", 2), ("QUERIES", 3), ("LEAST_SUM", 2), ("POSTING", 4), ("TRY_SHARE", 0.9), ("TRIES", 1), ("TURNS", 2)):
        monkeypatch.setattr(jaccard, k, v)
    rows = jaccard.classes(docs(spark, texts).repartition(3)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in rows] == brute_components(texts)
    assert jaccard.classes(docs(spark, EMPTY)).count() == 0
    twice = docs(spark, [words(20)]).union(docs(spark, [words(20)])).withColumn("sid", F.lit("x"))
    assert [r.component_id for r in jaccard.classes(twice).collect()] == [0, 0]
    clash = twice.withColumnRenamed("doc_id", "n").withColumn("tokens", F.lit(1)).union(twice.selectExpr("null", "text", "lang", "source", "n_chars", "sid", "1"))
    assert {(r[0], r.n_shingles, r.component_id) for r in jaccard.classes(clash, key="n").collect()} == {(0, 16, 0), (None, 16, 0)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_links_of_much_copied_texts_are_kept(spark, monkeypatch, seed):
    """Two near copies, each copied into many Arrow batches, whose postings are dealt into parts."""
    ws = words(120, seed).split()
    texts = [" ".join(ws), " ".join([*ws[:-2], "x", "y"])] * 40 + [words(30, seed + 9)]
    for k, v in (("POSTING", 4), ("LEAST", 1), ("LEAST_SUM", 1)):
        monkeypatch.setattr(jaccard, k, v)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        rows = jaccard.classes(docs(spark, texts).repartition(4)).orderBy("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.component_id for r in rows] == [0] * 80 + [80]


def test_jaccard_bound_holds_for_all_sizes(spark):
    for percent, most in ((80, 110), (75, 60)):
        up = lambda a, b: -(-a // b)
        need = lambda n, m: up(percent * (n + m), 100 + percent) - up(percent * max(n, m), 100) + 1
        rows = []
        for n in range(1, most):
            sizes = range(up(percent * n, 100), 100 * n // percent + 1)
            rows += [(n, low, high, min(need(n, m) for m in range(low, high + 1))) for low in sizes for high in sizes if low <= high]
            rows += [(n, 1, 2 * n, min(need(n, m) for m in sizes))]
        found = spark.createDataFrame(rows, "n long, low long, high long, least long").withColumn(
            "found", jaccard._least_need(F.col("n"), F.col("low"), F.col("high"), percent))
        assert found.where("found is null or found != least").take(3) == []


def test_jaccard_by_the_matrix_alone(spark, monkeypatch):
    texts = near_copies()
    monkeypatch.setattr(jaccard, "TRIES", 0)
    rows = jaccard.classes(docs(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in rows] == brute_components(texts)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    with Scratch(spark) as scratch:
        found = {r["id"]: r["root"] for r in jaccard.components(edges, scratch).collect()}
    assert found == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


# BPE


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(vocabulary())
    lib.no_truncation()
    texts = [*ODD, "ΟΔΟΣ İstanbul", "don't I'LL 12 ½", "a<|endoftext|>b", "🙂!!", "é  x"]
    for r, t in zip(bpe.encode(docs(spark, texts), vocabulary()).orderBy("doc_id").collect(), texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.decoded == lib.decode(ids, skip_special_tokens=False), t
    d = bpe.digests(docs(spark, texts), vocabulary()).where("doc_id = 5").first()
    ids = lib.encode(texts[5], add_special_tokens=False).ids
    assert (d.n_tokens, d.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    assert bpe.digests(docs(spark, EMPTY), vocabulary()).count() == 0


# URL filters


def test_url_rules_and_reputation(spark):
    urls = ["https://WWW.Example.com/en/1?x", "http://a.example.com/en/", "http://example.com", "http://x.net/es/?q", "http://spam.org/a", "http://ok.org/b#c", None, "no scheme", "http://example.com?x=/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rate", F.lit(1))
    out = spark.createDataFrame([("http://spam.org/", True)] * 30 + [("http://ok.org/", False)] * 400 + [("http://ok.org/", None)], "url string, bad boolean")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judge(pages, out).collect()}
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and got[1][2:] == ("example.com/en/", "block")
    assert got[2] == ("example.com", "", None, "allow") and got[3][2:] == ("net/es/", "block") and got[4][2:] == (None, "block") and got[5][2:] == (None, "allow")
    assert got[6][:2] == got[7][:2] == ("", "") and got[8][:3] == ("example.com", "", None)
    none = out.limit(0)
    assert {r["verdict"] for r in url_filter.judge(pages.where("page_id in (4, 5)"), none).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), out).count() == 0


# language


def test_language_held_out_accuracy(spark, table):
    truth = {r.doc_id: r.lang for r in table.collect()}
    rows = language_id.digest(table).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def brute_language(train, text):
    """Scores from the training texts by the definition: words, else their n-grams' mean times 0.8 for each shortening."""
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    langs = sorted({x for _, x in train})
    words = [w for w, _ in (x for t, lang in train for x in ((w, lang) for w in split(t)))]
    units = lambda w, n: [w] if n > 5 else [f"^{w}$"[i : i + n] for i in range(len(w) + 3 - n)]
    logs = []
    for lang in langs:
        own = {n: Counter(u for t, x in train if x == lang for w in split(t) for u in units(w, n)) for n in range(1, 7)}
        every = {n: {u for w in words for u in units(w, n)} for n in range(1, 7)}
        total = math.log(sum(x == lang for _, x in train) / len(train))
        for w in split(text):
            for step, n in enumerate(range(6, 0, -1)):
                if found := [u for u in units(w, n) if u in every[n]]:
                    p = [math.log((own[n][u] + 0.5) / (sum(own[n].values()) + 0.5 * len(every[n]))) for u in found]
                    total += 0.8**step * sum(p) / len(p)
                    break
        logs.append(total)
    best = max(logs)
    return langs[logs.index(best)], 1 / sum(math.exp(x - best) for x in logs)


def test_language_scores_by_brute_force(spark):
    train = [("the thing with that", "en"), ("ding und dass thing", "de"), ("und und der", "de"), ("les choses été नमस्ते", "fr")]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(train)], "doc_id long, text string, lang string")
    model = language_id.fit(df)
    for t in ("the und", "thingding", "zz dasß", "q", "that thit", "été", "नमस्तेद", "chose und xx the"):
        lang, score = model.predict(t)
        want = brute_language(train, t)
        assert lang == want[0] and abs(score - want[1]) < 1e-5, t
    tie = language_id.fit(spark.createDataFrame([(1, "same", "x"), (2, "same", "b")], "doc_id long, text string, lang string"))
    assert tie.predict("same") == ("b", 0.5)


def test_language_sample_of_a_large_table(spark):
    """However small the share, documents are picked."""
    df = docs(spark, [words(5, i) for i in range(400)])
    assert 20 <= sum(language_id.fit(df, fit_docs=40).tables[0][1].shape[:1]) / 5 <= 70


def test_language_backs_off_and_handles_odd_texts(spark):
    train = docs(spark, ["the and that with thing"] * 5, "en").union(docs(spark, ["der und dass mit ding"] * 5, "de")).union(docs(spark, ["le"], None))
    model = language_id.fit(train)
    assert model.langs == ["de", "en"] and model.predict("thingthat")[0] == "en" and model.predict("12 !")[0] == "und"
    rows = language_id.predict(docs(spark, ODD), model).orderBy("doc_id").collect()
    assert [r.lang_pred == "und" for r in rows] == [not re.search(r"[^\W\d_]", t or "") for t in ODD]
    empty = language_id.fit(docs(spark, EMPTY))
    assert language_id.predict(docs(spark, ["text"]), empty).first().lang_pred == "und"


# decontamination


def test_decontamination(spark):
    item = words(20, 50)
    texts = [*ODD, words(100, 3) + " " + item.upper() + " " + words(30, 4), item.split()[0], "xx " + words(13, 60) + " yy", " ".join(item.split()[:12]), f"{words(400, 9)} q, r! {words(3, 8)}", item + " " + item]
    items = [item, words(13, 60), "Q-R", None, "", item]
    pat = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = lambda t: re.findall(pat, (t or "").translate({c: c + 32 for c in range(65, 91)}))
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontamination.report(docs(spark, texts).withColumn("found", F.lit(0)), b).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        ws, hit, had = split(t), set(), set()
        for i, x in enumerate(map(split, items)):
            for w in ([x[p : p + 13] for p in range(max(1, len(x) - 12))] if x else []):
                for p in range(len(ws) - len(w) + 1):
                    if ws[p : p + len(w)] == w:
                        hit |= set(range(p, p + len(w)))
                        had.add(str(i))
        want = (len(ws), len(hit), len(had), hashlib.sha256(",".join(sorted(had)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(ws))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want, t
    assert decontamination.report(docs(spark, EMPTY), b).count() == 0
    assert not decontamination.report(docs(spark, texts), b.limit(0)).where("n_hit > 0").count()


def test_proximity_matches(spark):
    w = words(13, 21).split()
    moved = [*w[:6], "extra", *w[6:]]
    out = decontamination.report(docs(spark, [" ".join(moved), " ".join(w), words(40, 5)]), spark.createDataFrame([(0, " ".join(w))], "item_id long, text string"))
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].n_hit == 0 and rows[1].n_hit == 13 and rows[2].n_near == 0


@pytest.mark.parametrize("at", [0, 3, 6, 9, 12])
def test_proximity_is_found_across_one_added_word(spark, at):
    w = words(13, 21).split()
    marks = sorted(range(13), key=lambda i: (sum(x == w[i] for x in w), i))[:2]  # all terms are as frequent: the first two places
    moved = [*w[:at], "extra", *w[at:]]
    out = decontamination.report(docs(spark, [" ".join(moved)]), spark.createDataFrame([(0, " ".join(w))], "item_id long, text string")).first()
    assert (out.n_hit, out.n_near) == ((13, 0) if at == 0 else (0, int(min(marks) < at <= max(marks))))


def test_proximity_is_of_one_text(spark):
    item = spark.createDataFrame([(0, "w0 w1")], "item_id long, text string")
    df = spark.createDataFrame([(1, "w0 a b c"), (1, "z z w1 a b"), (1, "w0 a w1"), (1, "w0 a w1")], "doc_id long, text string")
    assert sorted((r.n_words, r.n_near) for r in decontamination.report(df, item).collect()) == [(3, 1), (3, 1), (4, 0), (5, 0)]


# line dedup


def brute_lines(texts, least):
    """Removed line places of each document, by the longest runs that occur before."""
    order = [(i, [(p, x, len(re.findall(WS, x))) for p, x in enumerate(t.split("\n")) if re.search(WS, x)]) for i, t in enumerate(texts) if t is not None]
    seen, cut = {}, defaultdict(set)
    for i, ls in order:
        for s in range(len(ls)):
            for e in range(s + 1, len(ls) + 1):
                seen.setdefault(tuple(x[1] for x in ls[s:e]), (i, s))
    for i, ls in order:
        for s in range(len(ls)):
            for e in range(s + 1, len(ls) + 1):
                if sum(x[2] for x in ls[s:e]) >= least and seen[tuple(x[1] for x in ls[s:e])] < (i, s):
                    cut[i] |= {x[0] for x in ls[s:e]}
    return cut


def test_line_dedup(spark):
    r = random.Random(3)
    pool = [words(r.choice([1, 2, 3, 5]), i) for i in range(8)] + [""]
    texts = [None, "", *("\n".join(r.choice(pool) for _ in range(r.randrange(12))) for _ in range(40))]
    clash = {c: F.lit(f"own {c}") for c in ("d", "k", "u", "at", "row", "x", "removed", "n_lines", "_d", "_key", "line_dedup")}
    out = line_dedup.dedup(docs(spark, texts).withColumns(clash), 5).orderBy("doc_id").collect()
    want = brute_lines(texts, 5)
    assert {(r.removed, r.n_lines, r._d, r.row) for r in out} == {("own removed", "own n_lines", "own _d", "own row")}
    for row, t in zip(out, texts):
        assert set(row.line_dedup.removed) == want.get(row.doc_id, set()), row.doc_id
        assert row.text == (None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want.get(row.doc_id, set())))
    assert line_dedup.dedup(docs(spark, EMPTY)).count() == 0
    twice = docs(spark, [words(60)]).union(docs(spark, [words(60)]))
    assert {r.line_dedup.n_removed for r in line_dedup.dedup(twice).collect()} == {0}
    unkeyed = twice.selectExpr("if(doc_id = 0, null, 'b') as key", "text").union(docs(spark, [words(60) + "\nx"]).selectExpr("'b'", "text"))
    assert sorted((r.key or "", r.line_dedup.n_removed) for r in line_dedup.dedup(unkeyed, key="key").collect()) == [("", 0), ("", 0), ("b", 1)]


def test_line_dedup_of_one_long_text(spark):
    """100,000 lines, in seconds: what a text costs grows with its lines."""
    block = [f"line {i} of the block has just eight words" for i in range(50_000)]
    began = time.time()
    x = line_dedup.dedup(docs(spark, ["\n".join(block + block), "\n".join(block[:7])])).orderBy("doc_id").collect()
    assert [r.line_dedup.n_removed for r in x] == [50_000, 7] and x[0].text == "\n".join(block)
    assert time.time() - began < 90


# PII


def luhn(x):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(x))) % 10 == 0


def base_pii(t):
    d = lambda m: re.sub("[^0-9]", "", m)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d(m)) <= 19 and luhn(d(m))), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(d(m)) <= 15)]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, t or "") if ok(m.group())]


def test_pii_base_spans_stay(spark):
    texts = [*ODD, "é a.b@c.de, x@y", "1.2.3.4 300.1.1.1 001.2.3.0255 1.2.3.4.5", "4111 1111 1111 1111 4111111111111112", "+1 (499) 555-6503 +12", "1" * 5000, "call 499-555-6503 now", "x@y.z" * 50]
    for r, t in zip(pii.digest(docs(spark, texts)).orderBy("doc_id").collect(), texts):
        want = ",".join(f"{k}:{s}:{e}" for k, s, e in base_pii(t))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and r.spans.startswith(want), t
    assert pii.digest(docs(spark, EMPTY)).count() == 0


def test_pii_spans_of_long_texts(spark):
    """As many matches, and as long runs, as a text may have, in seconds; matches that follow each other without a gap."""
    touching = "a@b.c_x@d.e 1.2.3.4.5.6.7.8 %q@r.s%t@u.v"
    many, run = " ".join(f"u{i}@h.org" for i in range(100_000)), "z" * 1_000_000
    texts = [touching, many, "a@" + run, run + "@" + run + ".de", "7" * 200_000 + ".1.1.1", "7." * 100_000]
    began = time.time()
    for r, t in zip(docs(spark, texts).select("doc_id", *(x.alias(k) for x, k in zip(pii.base_spans(F.col("text")), pii.KINDS))).orderBy("doc_id").collect(), texts):
        want = base_pii(t) if t in (touching, many) else None
        got = [(k, x.s, x.e) for k in pii.KINDS for x in r[k]]
        assert want is None or got == want
        if t is texts[3]:
            assert got == [("email", 0, len(t))]
    assert time.time() - began < 100


def test_pii_redacts_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd now", "own"), (1, "or call +1 555 010 9999 now", "own"), (None, "x@y.zz", "own"), (1, "mail a@b.cd now", "own")], "doc_id long, text string, spans string")
    found = pii.redact(df).collect()
    assert sorted(r.text for r in found) == ["<EMAIL>", "mail <EMAIL> now", "mail <EMAIL> now", "or call <PHONE> now"] and {r.spans for r in found} == {"own"}


def test_pii_redaction(spark, table):
    out = {r.doc_id: r.text for r in pii.redact(docs(spark, ["mail a@b.cd now", "none", None])).collect()}
    assert out == {0: "mail <EMAIL> now", 1: "none", 2: None}


def test_pii_adds_what_the_base_rules_leave_out(spark):
    r = random.Random(8)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    texts = []
    for i in range(160):
        card = number(16)
        texts += [f"{words(3, i)} +1 ({number(3)}) 555-{number(4)} {words(2, i)}", f"{words(2, i)} a{number(2)}.b@mail{i % 9}.example.com {words(2, i)}",
                  f"{words(2, i)} {card} {words(2, i)}", f"x = {number(3)}af{number(8)}bc", next(f"{words(2, i)} {card[:-1]}{c} {words(2, i)}" for c in "0123456789" if luhn(card[:-1] + c))]
    planted = {"so (499) 555-6503 is": "(499) 555-6503", "call 499-555-6503 now": "499-555-6503", "to jane.doe (at) example (dot) org please": "jane.doe (at) example (dot) org",
               "to +1 (603) 555-8791 499-555-6503 or": "+1 (603) 555-8791 499-555-6503"}
    clean = ["so 4111111111111112 is", "on 2021-03-14 we", "a 0af12345678bc b"]
    rows = {r.doc_id: r.spans for r in pii.find(docs(spark, [*texts, *planted, *clean])).collect()}
    added = [[(x.s, x.e) for x in rows[len(texts) + i] if x.kind not in pii.KINDS] for i in range(len(planted) + len(clean))]
    for found, (t, span) in zip(added, list(planted.items())[:3]):
        assert found == [(t.index(span), t.index(span) + len(span))], t
    assert added[len(planted):] == [[], [], []]
    assert all([(x.kind, x.s, x.e) for x in rows[i] if x.kind in pii.KINDS] == base_pii(t) for i, t in enumerate(texts))


# pipeline


def test_pipeline_stages_by_brute_force(spark):
    item = words(20, 50)
    passage = "\n".join(words(20, 300 + i) for i in range(3))
    base = words(80, 400).split()
    texts = [words(30, 1), words(30, 1), " ".join(base), " ".join([*base[:70], "changed", *base[71:]]), "too short", None, item + " " + words(40, 7), words(40, 8) + "\n" + passage, words(40, 9) + "\n" + passage + "\nend of it", "# $ " * 30]
    df, d = docs(spark, texts), None
    spark.createDataFrame([(0, item)], "item_id long, text string").write.mode("overwrite").parquet(d := f"{spark.sparkContext.getCheckpointDir() or '/tmp'}/b{random.random()}/benchmark.parquet")
    sf = d.removesuffix("/benchmark.parquet")
    kept = []
    for _, f in corpus_pipeline.STAGES[:-1]:
        df = f(spark, df, sf)
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append(sorted(r.doc_id for r in df.collect()))
    assert kept == [[0, 1, 2, 3, 6, 7, 8], [0, 1, 2, 3, 6, 7, 8], [0, 2, 6, 7, 8], [0, 2, 7, 8]]
    assert df.where("doc_id = 8").first().text == words(40, 9) + "\nend of it"
    assert corpus_pipeline.tokens(spark, df, sf).count() == 4


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs(spark, EMPTY).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_domains(spark):
    from vetrina.llm import url_filter

    want = {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "www.shop.com.au": ("shop.com.au", "com.au"), "x.co": ("x.co", "co"),
            "a.b.example.com": ("example.com", "com"), "net": ("net", "net"), "": ("", ""), "co.com": ("co.com", "com"), "a.com.b.de": ("b.de", "de"), "x.xco.uk": ("xco.uk", "uk")}
    df = spark.createDataFrame([(h,) for h in want], "host string")
    assert {r[0]: (r[1], r[2]) for r in df.select("host", url_filter.domain_of(F.col("host")), url_filter.suffix_of(F.col("host"))).collect()} == want


# all operators on a table: ids that are null or repeat with other texts, and columns whose names clash

CLASHING = ("spans kinds kind n k h key m w s e p r a b t d term trigram path need at before range row mask measures words ws n_words n_hit n_near item items item_id "
            "text_crc32 size shard slot lang_pred score held_out component_id n_shingles token tokens ids n_tokens part kept removed n_lines base_sha256 label features").split()
MIXED = ["password = abcdef12 in one", "mail me at a.b@c.de or +49 30 1234567", None, "", words(40, 8), words(40, 8), " ".join(["one two three four five"] * 4), "10.0.0.1\n10.0.0.1\nAKIA" + "A" * 18]


def test_language_of_texts_without_words_and_other_keys(spark):
    """A task whose texts hold no word, in learning and in predicting; keys that are strings."""
    blank = spark.createDataFrame([(str(i), t, "en") for i, t in enumerate(["", " ", "12", None] * 5)], "name string, text string, lang string")
    model = language_id.fit(blank, key="name")
    assert {(r.lang_pred, r.score) for r in language_id.predict(blank, model, key="name").collect()} == {("und", 0.0)}
    some = blank.union(spark.createDataFrame([("x", "hello world", "en"), ("y", "hallo welt", "de"), (None, "hallo", "de")], blank.schema))
    got = language_id.predict(some.repartition(7), language_id.fit(some, key="name"), key="name").collect()
    assert len(got) == 23 and {r.name: r.lang_pred for r in got}["y"] == "de" and sum(r.lang_pred == "und" for r in got) == 20


def mixed(spark, ids):
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, MIXED)], DOCS)
    return frame.withColumns({c: F.lit("mine") for c in CLASHING})


def judged(name, frame, spark):
    bench = spark.createDataFrame([("b", words(40, 8))], "item_id string, text string")
    return {"op1": lambda: language_id.digest(frame), "op2": lambda: secrets.digest(frame), "op3": lambda: sharding.digest(frame), "op4": lambda: jaccard.classes(frame),
            "op5": lambda: bpe.digests(frame, vocabulary()), "op7": lambda: decontamination.report(frame, bench), "op8": lambda: quality.judge(frame),
            "op9": lambda: line_dedup.digest(frame), "op10": lambda: pii.digest(frame)}[name]()


@pytest.mark.parametrize("name, left_out", [
    ("op1", {"held_out", "lang_pred", "score"}), ("op2", set()), ("op3", {"slot", "shard"}), ("op4", {"component_id"}), ("op5", set()), ("op7", set()), ("op8", set()),
    ("op9", {"n_removed", "removed", "text_sha256"}), ("op10", {"spans"})])
def test_repeated_and_null_ids_and_clashing_columns(spark, name, left_out):
    """Each row is judged as with an id of its own, but for what depends on ids (left_out)."""
    want = judged(name, mixed(spark, range(len(MIXED))), spark)
    got = judged(name, mixed(spark, [1, 1, None, None, 2, 1, None, 2]), spark)
    columns = [c for c in want.columns if c not in {"doc_id", *left_out}]
    assert got.columns == want.columns and Counter(map(str, got.select(columns).collect())) == Counter(map(str, want.select(columns).collect()))
    assert Counter(r.doc_id for r in got.collect()) == Counter([1, 1, None, None, 2, 1, None, 2])


def test_url_ties_nulls_and_clashing_columns(spark):
    """Pages that repeat wholly, with null ids or urls, each get a row; equal outcomes of two hosts get equal verdicts."""
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://b.org/x"), (2, None), (None, None)], "page_id long, url string").withColumns({c: F.lit("mine") for c in CLASHING})
    outcomes = spark.createDataFrame([(f"http://{h}.org/x", bad) for h in "ab" for bad in (True, False, True)], "url string, bad boolean")
    rows = url_filter.judge(pages, outcomes).collect()
    assert Counter(r.page_id for r in rows) == Counter([1, 1, None, 2, None]) and len({r.verdict for r in rows if r.host.endswith(".org")}) == 1
