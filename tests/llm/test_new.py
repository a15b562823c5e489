"""Resampling, phrases and exact de-duplication against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from vetrina.llm import exact_dedup, language_id, phrases, pii, resampling, secrets
from vetrina.llm.quotient_filter import QuotientFilter, permute, restore

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t", "x", "Ünï ß Éa 12é", "a\x00b\x7fc", "one. two, three", "A b A b A b A b A b"]


def docs(spark, texts, langs=("en",)):
    return spark.createDataFrame([(i, t, langs[i % len(langs)], "s", 0) for i, t in enumerate(texts)], DOCS)


def prose(n, seed, kinds=30):
    r = random.Random(seed)
    return "".join(r.choice(["Ab", "ab", "cé", "d", "éf", "x1"]) * r.randint(1, 2) + r.choice([" ", " ", " ", ". ", "\n", ", "]) for _ in range(n)) if kinds else ""


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# resampling


def features(t):
    ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    return len(ws), ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def expected(rows, target, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    g = Counter(bucket(f) for t in target for f in features(t)[1])
    total_s, total_t = sum(s.values()), sum(g.values())
    gain = lambda b: math.floor(1000 * math.log((g[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))
    out = []
    for i, t in rows:
        n, fs = features(t)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(drawn[: percent * len(drawn) // 100], 1):
        r[4] = k
    return [tuple(r[:5]) for r in out]


def test_resampling(spark):
    texts = ODD + [prose(n, n) for n in range(15, 90)] + ["same words " * 15] * 12 + [prose(50_000, 3)]
    target = ["ab ab d d cé", None, "x1 " * 40]
    got = resampling.digest(docs(spark, texts), docs(spark, target)).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(list(enumerate(texts)), target)


def test_resampling_edges(spark):
    none = docs(spark, [])
    assert resampling.digest(none, none).count() == 0
    rows = docs(spark, ["w%d " % (i % 3) * 25 for i in range(8)])
    twice = rows.union(rows).withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("k", F.lit(1)).withColumn("_row", F.lit(1))
    got = resampling.digest(twice, none)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == [1, 2, 3, 4] and got.count() == 16
    odd = rows.withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id")))
    assert resampling.resample(odd, none, percent=100).agg(F.max("rank")).first()[0] == 8
    kept = resampling.sample(twice, docs(spark, ["w1"]), percent=50)
    assert kept.columns == twice.columns and 8 <= kept.count() <= 10


def test_resampling_blocks_and_longer_grams():
    import pyarrow as pa

    texts = ["a b c", "", "c", "b c a b c", "é é é é"]
    want = Counter()
    for t in texts:
        ws = t.split()
        want.update(zlib.crc32(" ".join(ws[i : i + n]).encode()) % 97 for n in (1, 2, 3) for i in range(len(ws) - n + 1))
    counts = resampling.Grams(pa.array(texts), 3, 97).counts(97)
    assert {i: c for i, c in enumerate(counts.tolist()) if c} == dict(want)


# phrases


@pytest.mark.parametrize("k", [1, 2, 3])
@pytest.mark.parametrize("n", [0, 1, 5, 4000])
def test_quotient_filter(n, k):
    r = np.random.default_rng(n + k)
    keys = [r.integers(0, 50, n).astype(np.uint64) << np.uint64(32) | r.integers(0, 9, n).astype(np.uint64) for _ in range(k)]
    want = Counter(zip(*(a.tolist() for a in keys)))
    f = QuotientFilter.of(permute(keys))
    halves = [QuotientFilter.of([a[i::2] for a in permute(keys)]) for i in (0, 1)]
    for x in (f, QuotientFilter.merge(halves)):
        back = [(part, QuotientFilter.load(p.dump(3), part, 3)) for part, p in x.parts(3)]
        got = Counter()
        for part, p in back:
            assert ((p.limbs[0] >> np.uint64(61)) == part).all()
            got.update(dict(zip(zip(*(a.tolist() for a in restore(p.limbs))), p.counts.tolist())))
        assert got == want
        if n:
            whole = QuotientFilter.load(x.dump())
            assert all((a == b).all() for a, b in zip(whole.limbs, x.limbs)) and (whole.counts == x.counts).all()


def test_quotient_filter_keeps_keys_apart_that_share_a_limb():
    limbs = [np.array([7, 7, 7, 7], dtype=np.uint64), np.array([1, 2, 1, 2], dtype=np.uint64)]
    f = QuotientFilter.of(limbs, np.array([1, 10, 300, 1000]))
    assert f.counts.tolist() == [301, 1010] and QuotientFilter.load(f.dump()).counts.tolist() == [301, 1010]


def brute_phrases(rows, top, least):
    n, f = Counter(), Counter()
    for lang, t in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", low(t)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i : i + k])) for k in range(1, 6) for i in range(len(ws) - k + 1))
    cand = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    out = []
    for (lang, p), a in cand.items():
        inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(la == lang and len(q) > len(p) and c >= a and inside(q) for (la, q), c in cand.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    ranked = []
    for lang in sorted({r[0] for r in out}):
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(lang, i, *r[1:]) for i, r in enumerate(mine, 1)]
    return ranked


@pytest.mark.parametrize("sizes", [{}, {"range_words": 64, "block_names": 5}])
def test_phrases(spark, sizes):
    texts = ODD + [prose(200, n) for n in range(40)] + ["The cat sat\ton the mat. The cat sat on" for _ in range(30)] + [prose(30_000, 9)]
    langs = ("en", "de", None)
    df = docs(spark, texts, langs).withColumn("words", F.lit("x")).withColumn("ids", F.lit(1)).repartition(3)
    got = phrases.collocations(df, top=40, least=12, **sizes).orderBy("lang", "rank").collect()
    rows = [(langs[i % 3] or "und", t) for i, t in enumerate(texts)]
    assert [tuple(r) for r in got] == brute_phrases(rows, 40, 12) and len(got) > 60


def test_phrases_edges(spark):
    assert phrases.collocations(docs(spark, [])).count() == 0
    assert phrases.collocations(docs(spark, [None, "", "a b"])).count() == 0
    one = phrases.collocations(docs(spark, ["a b"] * 100, (None,)).drop("doc_id", "source")).collect()
    assert [tuple(r) for r in one] == [("und", 1, "a b", 100, 100, 100, 200, 2000)]


def test_a_full_bit_table_changes_no_count(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TABLE_BITS", 1 << 6)
    monkeypatch.setattr(phrases, "BITS_EACH", 1)
    texts = [prose(300, n) for n in range(20)]
    got = phrases.collocations(docs(spark, texts), top=30, least=15).orderBy("rank").collect()
    assert [tuple(r) for r in got] == brute_phrases([("en", t) for t in texts], 30, 15)


# exact de-duplication


def brute_groups(rows):
    by = {}
    for i, t in rows:
        by.setdefault(low(t), []).append(i)
    return [(i, max(by[low(t)]), len(by[low(t)]), i == max(by[low(t)]), hashlib.sha256(low(t).encode()).hexdigest()) for i, t in rows]


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_exact_dedup(spark, broadcast_rows):
    texts = [*ODD, *ODD, "É", "é", "ÀB", "Àb", *["Hot Text"] * 300, *(prose(5, n % 40) for n in range(200)), prose(100_000, 1), prose(100_000, 1).upper()]
    texts[-1] = texts[-2].replace("A", "a")
    want = brute_groups(list(enumerate(texts)))
    got = exact_dedup.label(docs(spark, texts).repartition(5), broadcast_rows=broadcast_rows).orderBy("doc_id").collect()
    assert [(*r[:4], r["sha"].hex()) for r in got] == want
    assert [tuple(r) for r in exact_dedup.digest(docs(spark, texts)).orderBy("doc_id").collect()] == want


def test_exact_dedup_tells_collisions_apart(spark):
    texts = ["aa", "bb", "AA", "ccc", "ab", "bb", None, "", "ddd"]
    got = exact_dedup.label(docs(spark, texts), hashed=lambda t: F.char_length(t)).orderBy("doc_id").collect()
    assert [(*r[:4], r["sha"].hex()) for r in got] == brute_groups(list(enumerate(texts)))


def test_exact_dedup_edges(spark):
    assert exact_dedup.digest(docs(spark, [])).count() == 0 and exact_dedup.keep(docs(spark, [])).count() == 0
    rows = docs(spark, ["a", "A", "b"]).withColumn("h", F.lit("x")).withColumn("n", F.lit(1)).withColumn("row", F.lit(2)).withColumn("best", F.lit(3))
    twice = rows.union(rows)
    kept = exact_dedup.keep(twice)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert sorted((r.doc_id, r.kept) for r in exact_dedup.digest(twice).collect()) == [(0, False), (0, False), (1, False), (1, True), (2, False), (2, True)]
    nulls = rows.withColumn("doc_id", F.when(F.col("doc_id") == 0, 0))
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.digest(nulls).collect()} == {(0, 0, True), (None, None, True), (None, 0, False)}
    assert sorted(str(r.doc_id) for r in exact_dedup.keep(nulls).collect()) == ["0", "None"]


# letters of languages, spans of long texts


def test_only_letters_make_words(spark):
    assert language_id.words_of("½ ² Ⅷ ① 12_3 a²b É ß ñ́x") == ["a", "b", "é", "ß", "ñ", "x"]
    texts = ["the cat sat"] * 10 + ["le chat noir"] * 10 + ["½ ²", "Ⅷ ①", "٣٤", "_ - _", "the"]
    df = spark.createDataFrame([(i, t, "fr" if t.startswith("le") else "en" if i < 20 else None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.digest(df).collect()}
    assert [got[i] for i in range(20, 25)] == ["und"] * 4 + ["en"]


def brute_beside(cands, base):
    return [(any(b[0] <= s and e <= b[1] for b in base), any(b[0] < e and s < b[1] for b in base)) for s, e in cands]


def test_pii_candidates_beside_base_spans(spark):
    r = random.Random(5)
    text = "".join(r.choice(["a.b@c.de ", "(at)", "+49 170 1234567 ", "1.2.3.4 ", "4111 1111 1111 1111 ", "12-34-56-78", "x", " ", "99"]) for _ in range(400))
    rows = pii.propose(docs(spark, [text]))
    row = rows.first()
    base = [(b.s, b.e) for k in pii.KINDS for b in row[k]]
    got = {(x.g, x.s, x.e): x.new for x in pii.features(rows).where("copy < 0").collect()}
    cands = [(c.gen, c.s, c.e) for c in row.cands if c.copy < 0]
    assert len(base) > 50 and {c: not inside for c, (inside, _) in zip(cands, brute_beside([c[1:] for c in cands], base))} == got
    for c in row.cands:
        assert text[c.s : c.e] == c.src and text[max(0, c.s - 16) : c.s] == c.before and text[c.e : c.e + 1] == c.after


def test_pii_of_a_text_of_100_000_emails(spark):
    import time

    began = time.time()
    text = " ".join(f"user{i}@mail{i % 97}.com" for i in range(100_000))
    row = pii.digest(docs(spark, [text])).first()
    assert row["n_email"] == 100_000 and time.time() - began < 60


def test_a_benchmark_too_large_to_broadcast(spark, monkeypatch):
    """Words that no anchor has are dropped where they are: the filter's only exchanges are those of the listed terms."""
    from vetrina.llm import decontamination as dc

    r = random.Random(4)
    ws = [f"w{i}" for i in range(400)]
    items = spark.createDataFrame([(i, " ".join(r.choice(ws) for _ in range(r.choice([2, 13, 30])))) for i in range(40)], "item_id long, text string")
    texts = [" ".join(r.choice(ws) for _ in range(60)) for _ in range(30)] + [x["text"] + " and more" for x in items.collect()] + [None, ""]
    want = sorted(map(tuple, dc.report(docs(spark, texts), items).collect()))
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, dc.report(docs(spark, texts), items).collect())) == want and sum(x[2] > 0 for x in want) >= 40
    words = docs(spark, texts).select("doc_id", F.explode(dc.words_of(F.col("text"))).alias("term"))
    terms = spark.createDataFrame([(w,) for w in ws[:50]], "term string")
    found = dc._listed(words, terms)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert found.join(terms, "term").count() == words.join(terms, "term").count() and found.count() < words.count() / 4


def test_signed_tokens_by_their_definition(spark):
    rule = next(r for r in secrets.MORE if r.kind == "jwt")
    r, parts = random.Random(5), ["eyJ", "eyJabcdefgh", "abcdefgh", "a-_0", ".", ".eyJabcdefgh", ".eyJabcdefgh", ".abcdefgh", " é", "ey"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(600)] + ["xeyJeyJ12345678.eyJ12345678.12345678.eyJ12345678.12345678"]
    got = {x.doc_id: [(s.s, s.e) for s in x.spans if s.kind == "jwt"] for x in secrets.scan(docs(spark, texts)).collect()}
    want = {i: [m.span() for m in re.finditer(rule.pattern, t)] for i, t in enumerate(texts)}
    assert got == want
    assert sum(map(len, want.values())) > 100


def test_secrets_of_a_text_of_200_000_marks(spark):
    import time

    began = time.time()
    text = "eyJ" * 200_000 + " eyJabcdefgh.eyJabcdefgh.abcdefgh"
    assert secrets.digest(docs(spark, [text])).first()["spans"] == f"jwt:600001:{len(text)}" and time.time() - began < 60


def labelled(spark, n, **columns):
    """n labelled candidates of one generator; features not named are zero."""
    given = {"g": "1", "gen": "1", "src": "string(id)"} | columns
    return spark.range(n).select(F.col("id").alias("rid"), *(F.expr(given.get(c, "0")).cast(t).alias(c) for c, t in
                                 [("g", "int"), ("s", "long"), ("e", "long"), ("new", "boolean"), ("copy", "int"), ("src", "string"), *((f, "double") for f in ("label", *pii.FEATURES))]))


def test_pii_fits_on_all_labelled_candidates(spark):
    """Many more of them than weigh in full: the first tree's leaves are the means of all, and thresholds are those of all."""
    cands = labelled(spark, 60_000, luhn="id % 2", label="if(crc32(string(id)) % 10 < if(id % 2 = 1, 9, 3), 1, 0)").cache()
    model, limits = pii.fit(cands)
    n = {(r.luhn, r.label): r.n for r in cands.groupBy("luhn", "label").agg(F.count("*").alias("n")).collect()}
    wrong, right = (sum(n[x, y] for x in (0, 1)) for y in (0, 1))
    for x in (0, 1):
        p, q = n[x, 1] / right, n[x, 0] / wrong
        assert model.trees[0].predict(Vectors.dense([float(x) if f == "luhn" else 1.0 if f == "gen" else 0.0 for f in pii.FEATURES])) == pytest.approx((p - q) / (p + q), abs=1e-9)
    assert limits == {}  # of those with the digit right, less than 95 % are hits
    assert pii.tally(cands).agg(F.sum("n")).first()[0] == 60_000


def test_pii_splits_at_values_of_one_candidate_in_many(spark):
    """More candidates that differ than Spark ML would look at for split places: the few that have a label's features are still told apart."""
    rare = ("plus", "parens", "ats", "octets")
    cands = labelled(spark, 30_000, chars="id % 300", seps="floor(id / 300)", label="if(id in (7, 777, 7777, 17777), 1, 0)",
                     **{f: f"if(id = {i}, 1, 0)" for f, i in zip(rare, (7, 777, 7777, 17777))}).cache()
    model, _ = pii.fit(cands)
    for f in rare:
        assert model.featureImportances[pii.FEATURES.index(f)] > 0, f
