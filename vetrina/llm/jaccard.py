"""N-gram Jaccard self-join by a token-group matrix.

A document is the set of its distinct 5-word shingles, 64-bit fingerprints; documents with one
set are one from here on. The sets are written once, with the tokens of their prefix first. Tokens
are ordered by how many sets have them, as counted in blocks over all documents, and two sets that
link share tokens in their prefixes under any such order.

1. Grouping. In a few turns, sets that share much of their prefix with another one are compared
   with it. Verified links make components; these, joined by pairs that are similar but don't link,
   make groups of similar documents. A group is dealt into parts of about ``GROUP`` sets; a large
   component gets parts of its own.
2. Matrix. A part's row is the union of its members' prefix tokens, with their sizes. Two parts are
   compared by the tokens that their rows share. If these are fewer than linked sets of such sizes
   need, or all is one component, the pair stays closed.
3. Opening. A query of one part counts its tokens in the other part's whole token union, and reads
   its members only if these can reach the threshold. The links found join components.

All links between different components are found by opened parts, so components are exact; copies
and near copies cost a row each and no pairs of a group are listed. Similar sets that don't link are
the remaining cost: ``m`` of them in one group are compared by m / GROUP parts, inside tasks.

Defined cases: null texts and texts without words have no shingle and link with nothing; fewer
than five words are one shingle. Repeated rows share a component. A null key is in no minimum. An
empty table gives an empty result. Other columns are not read. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain, islice
from math import gcd

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.llm.common import Scratch, cut, small_broadcasts
from vetrina.llm.url_filter import salted_join

WORDS = 5
PERCENT = 80
#: Sets in a part of a group, about; queries that open one part in one task.
GROUP, QUERIES = 256, 256
#: Frequent tokens: least sets in a block of documents, least sum over the blocks, and how many are told apart (16 bytes each are broadcast).
LEAST, LEAST_SUM, FREQUENT = 2, 8, 1 << 18
#: Classes of counts per doubling, to find the least count of a frequent token.
CLASSES = 8
#: Rows of a frequent token's posting that are looked through in one task while groups are formed.
POSTING = 20_000
#: Texts that a task handles at once.
BLOCK = 256
#: Share of its sketch that a set has in common with another one for the two to be compared at once, and for them to be in one
#: group; with how many at most, and how often; from which similarity on compared ones are in one group. This only forms the
#: groups: what it leaves out is found by the matrix.
TRY_SHARE, GROUP_SHARE, TRIES, TURNS, SIMILAR = 0.3, 0.12, 3, 2, 50
#: Tokens of a set's prefix (in expectation, those with the least hashes) that look for other sets to compare.
SKETCH = 12
#: Sets first in a posting, and before a set, that it may be compared with.
HUBS, NEAR = 2, 3
#: log2 of the bits of the filter on wanted sets: 2 MB.
FILTER = 24

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: Iterable[str | None], k: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct fingerprints of the k-word shingles of its lower-cased words; a block of texts at a time."""
    texts = iter(texts)
    while block := list(islice(texts, BLOCK)):
        words = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in block]
        sizes = [len(w) for w in words]
        n = sum(sizes)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), dtype=np.uint64, count=n)
        codes = _window_codes(h, k)
        at = 0
        for size in sizes:
            own = codes[at : at + size - k + 1] if size >= k else _window_codes(h[at : at + size], size) if size else codes[:0]
            own = np.sort(own)
            yield own[np.concatenate(([True], own[1:] != own[:-1]))] if size else own
            at += size


def _window_codes(h: np.ndarray, k: int) -> np.ndarray:
    n = max(0, len(h) - k + 1)
    total = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        total += _mixed(h[i : n + i] * _ODD[i % len(_ODD)] + np.uint64(i))
    return _mixed(total).view(np.int64)


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    return next(shingle_sets([text], k))


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _prefix(percent: int) -> Column:
    return (F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100 - 1e-9) + 1).cast("int")


def _set_id(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _frequent(docs: DataFrame, k: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """The tokens in most sets, sorted, and their counts: FREQUENT at most."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            sets = {}
            for s in shingle_sets(x["_text"], k):
                if len(s):
                    sets[_set_id(s)] = s
            if sets:
                tokens, n = np.unique(np.concatenate(list(sets.values())), return_counts=True)
                yield pd.DataFrame({"token": tokens[n >= LEAST], "n": n[n >= LEAST]})

    kind = F.floor(F.log2("n") * CLASSES)
    counts = scratch.keep(docs.select("_text").mapInPandas(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(
        F.col("n") >= LEAST_SUM).withColumn("class", kind), "counts")
    classes = sorted(((r["class"], r["count"]) for r in counts.groupBy("class").count().collect()), reverse=True)  # 64 CLASSES rows at most
    least, total = 64 * CLASSES, 0
    for c, n in classes:
        total += n
        if total > FREQUENT:
            break
        least = c
    top = counts.where(F.col("class") >= least).select("token", "n").toArrow()  # a row object each would take the driver 100 MB and more
    tokens, n = top["token"].to_numpy(), top["n"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _ordered_sets(docs: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """(_key, n, sid, tokens, salts) of every row; tokens, the prefix first, only in the first row that a task has of a set.

    salts has the part of its posting for each token of the prefix, -1 if the posting is whole; null if all are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, k, scratch))

    def ordered(s: np.ndarray, sid: int) -> tuple[np.ndarray, np.ndarray | None]:
        tokens, counts = shared.value
        at = np.minimum(np.searchsorted(tokens, s), max(0, len(tokens) - 1))
        n = np.where(tokens[at] == s, counts[at], 0) if len(tokens) else np.zeros(len(s), dtype=np.int64)
        if not n.any():
            return s, None
        order = np.lexsort((s, n))
        parts = n[order][: prefix_size(len(s), percent)] // POSTING + 1
        return s[order], np.where(parts > 1, sid % parts, -1).astype(np.int32) if parts[-1] > 1 else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for x in (b.iloc[i : i + BLOCK] for b in batches for i in range(0, len(b), BLOCK)):
            rows = []
            for s in shingle_sets(x["_text"], k):
                sid = _set_id(s) if len(s) else None
                rows.append((len(s), sid, *(ordered(s, sid) if sid is not None and sid not in done else (None, None))))
                done.add(sid)
            yield pd.DataFrame({"_key": x["_key"].array, "n": [r[0] for r in rows], "sid": pd.array([r[1] for r in rows], dtype="Int64"),
                                "tokens": pd.Series([r[2] for r in rows], dtype=object), "salts": pd.Series([r[3] for r in rows], dtype=object)})

    kind = dict(docs.dtypes)["_key"]
    return scratch.keep(docs.mapInPandas(run, f"_key {kind}, n long, sid long, tokens array<long>, salts array<int>"), "sets")


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(sid, tokens) of the wanted sets and, as the filter is hashed, a few more: a join would move all tokens."""
    bits = wanted.select(F.expr(f"sid & {(1 << FILTER) - 1}").alias("b")).groupBy(F.expr("b div 64").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("m"))
    placed = rows.where("tokens is not null").select("sid", "tokens", F.expr(f"(sid & {(1 << FILTER) - 1}) div 64").alias("w"))
    hit = placed.join(F.broadcast(bits), "w").where("shiftright(m, cast(sid & 63 as int)) & 1 = 1")  # at most 2^FILTER / 64 rows are broadcast
    return hit.select("sid", "tokens").dropDuplicates(["sid"])


def _shared(rows: DataFrame, percent: int) -> DataFrame:
    """(token, salt, sid, n): the prefix tokens of each set that another set may have, once.

    In a posting that is dealt into parts, by which only groups are formed, all rows stay.
    """
    posting = rows.where("tokens is not null").select("sid", "n", "salts", F.posexplode(F.slice("tokens", 1, _prefix(percent))).alias("at", "token")).select(
        "token", F.coalesce(F.get("salts", "at"), F.lit(-1)).alias("salt"), "sid", "n")
    by_token = Window.partitionBy("token", "salt").orderBy("sid")
    once = posting.withColumn("prev", F.lag("sid").over(by_token)).where("prev is null or prev <> sid")  # a set has a row a task
    seen = once.select("token", "salt", "sid", "n", F.lag("sid").over(by_token).alias("prev"), F.lead("sid").over(by_token).alias("next"))
    return seen.where("salt >= 0 or prev is not null or next is not null").select("token", "salt", "sid", "n")


def _likely(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """(sid, up, g, h, close): for each set up to TRIES sets of other components that share some of its prefix with it, or much.

    rows: (token, salt, sid, n, g, size). In each posting a set looks at the first ones, which are of the largest component from
    the second turn on, and at some before it. Links share most of their prefixes; what shares little is left to the matrix.
    """
    order = ("n", "sid") if not turn else (F.desc("size"), F.xxhash64("sid", F.lit(turn)), "sid")
    w = Window.partitionBy("token", "salt").orderBy(*order)
    looks = [F.nth_value("me", i).over(w) for i in range(1, HUBS + 1)] + [F.lag("me", i).over(w) for i in range(1, NEAR + 1)]
    hashed = F.expr("cast(xxhash64(token) & 1048575 as double) / 1048576") < F.lit(SKETCH) / _prefix(percent)
    placed = rows.where(hashed).withColumn("me", F.struct("n", "sid", "g")).select("sid", "n", "g", *(x.alias(f"p{i}") for i, x in enumerate(looks)))
    tries = placed.select("sid", "n", "g", F.explode(F.array_distinct(F.array_compact(F.array(*(f"p{i}" for i in range(len(looks))))))).alias("up")).where(
        (F.col("up.g") != F.col("g")) & (100 * F.least("n", "up.n") >= percent * F.greatest("n", "up.n")))
    likely = tries.groupBy("sid", "n", "g", "up").count().where(F.col("count") >= GROUP_SHARE * F.least(F.lit(SKETCH), _prefix(percent)))
    best = Window.partitionBy("sid").orderBy(F.desc("count"), "up")  # of one set's prefix
    return likely.withColumn("i", F.row_number().over(best)).where(F.col("i") <= TRIES).select(
        "sid", F.col("up.sid").alias("up"), "g", F.col("up.g").alias("h"), (F.col("count") >= TRY_SHARE * F.least(F.lit(SKETCH), _prefix(percent))).alias("close"))


def _compared(tried: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): the pairs of components that were tried, if similar."""
    pairs = tried.join(sets.withColumnRenamed("tokens", "ta"), "sid").join(sets.select(F.col("sid").alias("up"), F.col("tokens").alias("tb")), "up")
    both = F.size(F.array_intersect("ta", "tb"))
    sized = pairs.select(F.col("g").alias("a"), F.col("h").alias("b"), both.alias("both"), (F.size("ta") + F.size("tb")).alias("sum"))
    reaches = lambda p: 100 * F.col("both") >= p * (F.col("sum") - F.col("both"))
    return sized.where(reaches(min(SIMILAR, percent))).groupBy("a", "b").agg(F.max(reaches(percent)).alias("linked"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) for the ends of undirected edges (a, b): root is the least id reached.

    By contraction: each end hooks on to its least neighbour, paths are halved twice, and the edges between different
    roots are those of the next round.
    """
    left = scratch.step(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    at = None
    while True:
        hooks = left.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("p"))
        for _ in range(2):
            up = hooks.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            hooks = scratch.step(hooks.join(up, "p").select("a", F.col("pp").alias("p")))
        if at is None:
            at = hooks.select(F.col("a").alias("id"), F.col("p").alias("root"))
        else:
            at = scratch.step(salted_join(at, hooks.select(F.col("a").alias("root"), "p"), "root", F.xxhash64("id")).select("id", F.coalesce("p", "root").alias("root")))
        one = salted_join(left, hooks, "a", F.xxhash64("b")).select(F.col("p").alias("x"), F.col("b").alias("a"))
        left = scratch.step(salted_join(one, hooks, "a", F.xxhash64("x")).select(F.col("x").alias("a"), F.col("p").alias("b")).where("a <> b").distinct())
        if left.isEmpty():
            return at


def _need(small: Column, large: Column, percent: int) -> Column:
    """Least prefix tokens that linked sets of these sizes share."""
    return F.ceil(F.lit(percent) * (small + large) / F.lit(100 + percent) - 1e-9) - F.ceil(F.lit(percent) * large / 100 - 1e-9) + 1


def _least_need(n: Column, low: Column, high: Column, percent: int) -> Column:
    """The least of _need over all sizes from low to high that can link with a set of size n.

    For smaller sizes it grows with the size. For larger ones it goes up and down by its two ceilings, but never up over a
    whole period of the prefixes' sizes, so that the last period up to the upper end has the least one.
    """
    share, period = percent / 100, 100 // gcd(percent, 100)
    top = F.least(high, F.floor(n / share + 1e-9))
    last = F.sequence(F.greatest(low, n, top - (period - 1)), top)
    return F.least(
        F.when(low <= n, _need(F.greatest(low, F.ceil(n * share - 1e-9)), n, percent)),
        F.when(top >= F.greatest(low, n), F.array_min(F.transform(last, lambda large: _need(n, large, percent)))))


def _grown(roots: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """roots (sid, n, root, size) after the links (a, b) between roots."""
    merged = components(edges, scratch).select(F.col("id").alias("root"), F.col("root").alias("top"))
    new = scratch.step(salted_join(roots.drop("size"), merged, "root", F.xxhash64("sid")).select("sid", "n", F.coalesce("top", "root").alias("root")))
    return scratch.step(salted_join(new, new.groupBy("root").agg(F.count("*").alias("size")), "root", F.xxhash64("sid")).select("sid", "n", "root", "size"))


def _opened(queries: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links between components; queries and members are (part, deal, c, tokens)."""
    def run(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        out = set()
        if len(q) and len(m):
            sets, comps = [np.asarray(t) for t in m["tokens"]], m["c"].to_numpy()
            sizes = np.array([len(s) for s in sets])
            tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(tokens, kind="stable")
            owner = owner[order]
            union, start, count = np.unique(tokens[order], return_index=True, return_counts=True)
            for c, t in zip(q["c"], q["tokens"]):
                t = np.asarray(t)
                at = np.minimum(np.searchsorted(union, t), len(union) - 1)
                at = at[union[at] == t]
                if 100 * len(at) < percent * len(t):
                    continue  # no member can reach the threshold
                n, end = count[at], np.cumsum(count[at])
                both = np.bincount(owner[np.repeat(start[at] - end + n, n) + np.arange(end[-1])], minlength=len(sets))
                found = comps[(100 * both >= percent * (len(t) + sizes - both)) & (comps != c)]
                out.update((c, other) for other in np.unique(found))
        return pd.DataFrame(list(out), columns=["a", "b"], dtype="int64")

    return queries.groupBy("part", "deal").cogroup(members.groupBy("part", "deal")).applyInPandas(run, "a long, b long")


def _dealt(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(sid, n, c, part): the sets (sid, n, c, g) of the matrix, dealt into parts of their groups."""
    members = scratch.step(members)
    by_comp = members.groupBy("g", "c").agg(F.count("*").alias("m"))
    rest = by_comp.where(F.col("m") <= GROUP).groupBy("g").agg(F.sum("m").alias("rest"))
    parts = salted_join(by_comp, rest, "g", F.xxhash64("c")).select(
        "c", (F.col("m") > GROUP).alias("own"), F.ceil(F.when(F.col("m") > GROUP, F.col("m")).otherwise(F.col("rest")) / GROUP).alias("parts"))
    part = F.when(F.col("own"), F.xxhash64("c", F.pmod(F.xxhash64("sid"), "parts"))).otherwise(F.xxhash64("g", F.lit("rest"), F.pmod(F.xxhash64("c"), "parts")))
    return scratch.step(salted_join(members, parts, "c", F.xxhash64("sid")).select("sid", "n", "c", part.alias("part")))


def _ready(crossing: DataFrame, dealt: DataFrame, percent: int) -> DataFrame:
    """(ask, part): pairs of parts that can hold a link between components; the smaller one asks."""
    facts = dealt.groupBy("part").agg(F.count("*").alias("m"), F.collect_set("n").alias("sizes"), F.min("n").alias("low"), F.max("n").alias("high"),
                                      F.min("c").alias("c0"), F.max("c").alias("c1"))  # of about GROUP sets
    matrix = crossing.select("token", "sid").join(dealt.select("sid", "part", "n"), "sid").groupBy("token", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    can = f"x.part < y.part and {percent} * x.low <= 100 * y.high and {percent} * y.low <= 100 * x.high"
    shared = matrix.alias("x").join(matrix.alias("y"), "token").where(can).groupBy(
        F.col("x.part").alias("p"), F.col("y.part").alias("q")).agg(F.count("*").alias("both"))
    side = lambda name: facts.select(F.col("part").alias(name), F.struct("m", "sizes", "low", "high", "c0", "c1").alias(f"f{name}"))
    pairs = shared.join(side("p"), "p").join(side("q"), "q").where("fp.c0 <> fp.c1 or fq.c0 <> fq.c1 or fp.c0 <> fq.c0")
    asks = F.when(F.col("fp.m") <= F.col("fq.m"), F.struct(F.col("p").alias("ask"), F.col("q").alias("part"), F.col("fp").alias("fa"), F.col("fq").alias("fo"))).otherwise(
        F.struct(F.col("q").alias("ask"), F.col("p").alias("part"), F.col("fq").alias("fa"), F.col("fp").alias("fo")))
    asked = pairs.select("both", asks.alias("x")).select("both", "x.*")
    fit = F.filter("fa.sizes", lambda n: (percent * F.col("fo.low") <= 100 * n) & (percent * n <= 100 * F.col("fo.high")))
    need = F.array_min(F.transform(fit, lambda n: _least_need(n, F.col("fo.low"), F.col("fo.high"), percent)))
    return asked.where(F.col("both") >= need).select("ask", "part").unionByName(facts.where("c0 <> c1").select(F.col("part").alias("ask"), "part"))


def _matrix_links(rows: DataFrame, crossing: DataFrame, groups: DataFrame, scratch: Scratch, percent: int) -> DataFrame | None:
    """(a, b): the links between components that are left."""
    dealt = _dealt(groups.join(crossing.select("sid").distinct(), "sid", "left_semi"), scratch)
    ready = scratch.step(_ready(crossing, dealt, percent))
    if ready.isEmpty():
        return None
    one = dealt.groupBy("part").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 = c1").select("part", F.col("c0").alias("only"))
    asked = ready.join(dealt.select(F.col("part").alias("ask"), "sid", "c"), "ask").join(one, "part", "left").where("only is null or only <> c").select("part", "sid", "c")
    asked = scratch.step(asked)
    deals = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).alias("deals"))
    inside = scratch.step(dealt.select("part", "sid", "c").join(deals, "part"))
    found = scratch.step(_sets(rows, asked.select("sid").union(inside.select("sid"))))
    queries = salted_join(asked, deals, "part", F.xxhash64("sid")).withColumn("deal", F.pmod(F.xxhash64("sid"), "deals")).join(found, "sid")
    members = inside.join(found, "sid").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
    fresh = lambda df: df.select(*(F.col(c).alias(c) for c in ("part", "deal", "c", "tokens")))  # noqa: E731  both sides read one table
    edges = scratch.step(_opened(fresh(queries), fresh(members), percent).distinct())
    return None if edges.isEmpty() else edges


def links(docs: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """((_key, n, sid) of every row, (sid, root) of the sets that share a token with another one)."""
    rows = _ordered_sets(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), k, percent, scratch)
    shared = scratch.keep(_shared(rows, percent), "shared")
    roots = scratch.step(shared.select("sid", "n").distinct().select("sid", "n", F.col("sid").alias("root"), F.lit(1).cast("long").alias("size")))
    similar = []
    for turn in range(TURNS):
        known = salted_join(shared, roots.drop("n"), "sid", F.xxhash64("token")).withColumnRenamed("root", "g")
        tried = scratch.step(_likely(known, turn, percent))
        close = tried.where("close")
        compared = scratch.step(_compared(close, _sets(rows, close.select("sid").union(close.select("up"))), percent))
        similar += [compared.where("not linked").select("a", "b"), tried.where("not close").select(F.col("g").alias("a"), F.col("h").alias("b"))]
        edges = compared.where("linked")
        if edges.isEmpty():
            break
        roots = _grown(roots, edges, scratch)
    groups = roots.select("sid", "n", F.col("root").alias("c"), F.col("root").alias("g"))
    of = lambda c: salted_join(pairs, roots.select(F.col("sid").alias(c), F.col("root").alias(f"r{c}")), c, F.xxhash64("a", "b"))
    pairs = reduce(DataFrame.unionByName, similar) if similar else None
    if pairs is not None:
        pairs = of("a")
        pairs = scratch.step(of("b").select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct())
        if not pairs.isEmpty():
            alike = components(pairs, scratch).select(F.col("id").alias("c"), F.col("root").alias("top"))
            groups = scratch.step(salted_join(groups, alike, "c", F.xxhash64("sid")).select("sid", "n", "c", F.coalesce("top", "c").alias("g")))
    placed = salted_join(shared.select("token", "sid"), groups.select("sid", "c"), "sid", F.xxhash64("token"))
    mixed = placed.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("token")
    crossing = scratch.keep(placed.select("token", "sid").join(mixed, "token", "left_semi"), "crossing")
    if not crossing.isEmpty():
        edges = _matrix_links(rows, crossing, groups, scratch, percent)
        if edges is not None:
            roots = _grown(roots, edges, scratch)
    return rows.select("_key", "n", "sid"), roots.select("sid", "root")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id): the least key reachable by links."""
    with Scratch(docs.sparkSession) as scratch, small_broadcasts(docs.sparkSession):
        rows, roots = links(docs, scratch, key, text, k, percent)
        sets = rows.where("sid is not null").groupBy("sid").agg(F.min("_key").alias("least"))
        tops = sets.join(roots, "sid", "left").withColumn("top", F.coalesce("root", "sid"))
        least = tops.groupBy("top").agg(F.min("least").alias("component_id"))
        by_set = scratch.step(salted_join(tops.select("sid", "top"), least, "top", F.col("sid")).select("sid", "component_id"))
        out = salted_join(rows, by_set, "sid", F.xxhash64("_key"))
        return cut(out.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_key").alias("component_id")))
