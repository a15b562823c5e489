"""Personal data by boosted trees over candidate spans.

Plain rules give base spans, which always stay. Generators of high recall propose more spans,
which may overlap; boosted trees score each by its format and the characters around it; for each
generator the lowest score bin whose accepted candidates keep a precision on held-out candidates
is the threshold; of overlapping accepted spans the best one stays. A candidate inside a base span
adds nothing and is not scored; one that reaches beyond a base span is.

Whether a base rule matched is not what the trees learn, as they are to find what it leaves out.
Weak labels come from copies of base spans in other forms at the same place ('+' or the country
code left out, '@' written as '(at)', other separators; dates and broken check digits as
negatives) and from rules on format and context (cue words, glued letters, impossible counts of
digits). Other candidates have no label, but all are scored. The trees are fitted on all labelled
candidates: those with the same features and label are one row with their number as weight, which
comes to the same. A label of a generator with very many candidates is weighed down, so that none
outweighs the rest. The candidates are in folds, all copies of one span in one; each fold is scored
by trees fitted on the others, and the thresholds come from these scores of all labelled candidates.
As copies do not come in the numbers in which cases occur, a threshold weighs the positives of a
generator as much as its negatives, and it is at least even odds.

Defined cases: a null text is empty and has no spans; repeated rows are judged one by one; with no
labelled candidates of both classes nothing is added to the base spans; a fold whose others lack a
class is not scored; an empty table gives an empty result. Other columns are not read. Texts are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import Scratch, cut, first_that, let, no_spans, spans_of

KINDS = ("email", "ip", "card", "phone")
#: A run is tried from its first character only, or from where the match before ends: a later start finds no other match.
LOCAL, DIGITS = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++", r"(?:(?<![0-9])|\G)[0-9]++"
#: Possessive repeats match as greedy ones do here, without recursion on long runs.
PATTERNS = {
    "email": LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": DIGITS + r"\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text can have a match at all.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
GENERATORS = {
    "x_mail": LOCAL + r"(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]+)++",
    "x_number": r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+",
    "x_dotted": DIGITS + r"(?:\.[0-9]++){3,}+",
    "x_groups": r"[0-9]{2,4}(?:[\x20-][0-9]{2,4}){2,4}+",
}
FOLDS = 4
#: What all labels of all generators weigh together at most, each as much; one with fewer candidates than its part weighs their number.
FULL_WEIGHT = 20_000
LEAST_SPLITS = 32
MIN_PRECISION = 0.95
BINS = 50
FEATURES = ("gen", "chars", "digits", "seps", "plus", "parens", "dots", "dashes", "ats", "groups", "luhn", "octets", "left_word", "right_word", "left_digit", "cue")
CUES = r"(?i)(?:tel|phone|call|fax|mail|contact|card|visa|konto|addr|ip)[^A-Za-z]{0,12}$"
#: Words before a number that say what it is, for the labels.
PHONE_CUES = r"(?i)(?:^|[^A-Za-z])(?:tel|telefon|telephone|phone|call|fax|mobile|cell|whatsapp|sms)[^A-Za-z0-9]{0,12}$"
CARD_CUES = r"(?i)(?:^|[^A-Za-z])(?:card|visa|mastercard|amex)[^A-Za-z0-9]{0,12}$"
DATE = r"^(?:(?:19|20)[0-9]{2}[\x20.-][0-9]{1,2}[\x20.-][0-9]{1,2}|[0-9]{1,2}[\x20.-][0-9]{1,2}[\x20.-](?:19|20)[0-9]{2})$"
#: Characters on either side that are context.
AROUND = 16


def luhn(digits: Column) -> Column:
    def term(i: Column) -> Column:
        d = F.ascii(F.substring(digits, F.length(digits) - i, F.lit(1))) - 48
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return (F.length(digits) > 0) & (F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + term(i)) % 10 == 0)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def octets(m: Column) -> Column:
    """Whether all dotted parts are at most 255."""
    return F.forall(F.split(m, "[.]"), lambda p: let(F.ltrim(p, F.lit("0")), lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255"))))


def base_spans(text: Column) -> list[Column]:
    """For each kind array<struct<s, e, m, b, a>>, see spans_of(); in order, and no two of a kind overlap."""
    passes = {
        "email": lambda m: F.lit(True),
        "ip": octets,
        "card": lambda m: let(digits_of(m), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)),
        "phone": lambda m: F.length(digits_of(m)).between(8, 15),
    }
    out = []
    for k in KINDS:
        found = _passing(spans_of(text, PATTERNS[k], around=AROUND), passes[k])
        out.append(F.when(F.contains(text, F.lit(HINTS[k])), found).otherwise(no_spans(True)) if HINTS[k] else found)
    return out


def _passing(spans: Column, test) -> Column:  # noqa: ANN001
    return F.filter(spans, lambda x: test(x["m"]))


def _forms() -> list[tuple[str, float, tuple[str, ...], Callable[[Column], Column]]]:
    """(base kind, label, generators, how a base span is written so that the base rule leaves it out)."""
    sub = F.regexp_replace
    local = lambda m: sub(m, r"^[+][0-9]{1,3}[\x20.-]+", "")
    spaced = lambda m, sep: sub(sub(local(m), "[()]", ""), r"[\x20.-]+", sep)
    mail = lambda m, at, dot: sub(sub(m, r"[.](?=[^@]*$)", dot), "@", at)
    fours = lambda m, sep: sub(digits_of(m), "([0-9]{4})(?=[0-9])", f"$1{sep}")
    broken = lambda m: let(digits_of(m), lambda d: F.concat(
        F.substring(d, F.lit(1), F.length(d) - 1), F.translate(F.right(d, F.lit(1)), "0123456789", "1234567890")))
    date = lambda m, to: sub(digits_of(m), "^.*([0-9])([0-9])([0-9])([0-9])$", to)
    groups = ("x_number", "x_groups")
    return [
        ("email", 1.0, ("x_mail",), lambda m: mail(m, " (at) ", " (dot) ")),
        ("email", 1.0, ("x_mail",), lambda m: mail(m, "[at]", "[dot]")),
        ("email", 1.0, ("x_mail",), lambda m: mail(m, "(at)", ".")),
        ("phone", 1.0, groups, lambda m: sub(m, "^[+]", "")),
        ("phone", 1.0, groups, local),
        ("phone", 1.0, groups, lambda m: spaced(m, "-")),
        ("phone", 1.0, groups, lambda m: spaced(m, " ")),
        ("phone", 0.0, groups, lambda m: date(m, "20$1$2-0$3-1$4")),
        ("phone", 0.0, groups, lambda m: date(m, "1$4.0$3.19$1$2")),
        ("card", 1.0, ("x_number", "x_dotted"), lambda m: fours(m, ".")),
        ("card", 0.0, groups, broken),
        ("card", 0.0, groups, lambda m: fours(broken(m), " ")),
        ("card", 0.0, ("x_number", "x_dotted"), lambda m: fours(broken(m), ".")),
    ]


CANDIDATE = "struct<gen:int,s:bigint,e:bigint,m:string,before:string,after:string,src:string,copy:int,given:double>"


def _candidate(x: Column, g: int, m: Column, copy: int = -1, given: float | None = None) -> Column:
    """A candidate with the characters around it; src is the span as it stands in the text."""
    return F.struct(F.lit(g).alias("gen"), x["s"].alias("s"), x["e"].alias("e"), m.alias("m"), x["b"].alias("before"), x["a"].alias("after"),
                    x["m"].alias("src"), F.lit(copy).alias("copy"), F.lit(given).cast("double").alias("given"))


def _proposed(text: Column, g: int, name: str) -> Column:
    return F.transform(spans_of(text, GENERATORS[name], around=AROUND), lambda x: _candidate(x, g, x["m"]))


def _copied(spans: Column, kind: str) -> Column:
    """Copies of the base spans of a kind in other forms, where a generator would propose just the copy."""
    at = list(GENERATORS)

    def copies(x: Column) -> Column:
        each = [_candidate(x, at.index(g), form(x["m"]), i, label)
                for i, (k, label, names, form) in enumerate(_forms()) if k == kind for g in names]
        return F.filter(F.array(*each), lambda c: F.element_at(F.array(*(F.regexp_like(c["m"], F.lit(f"^(?:{p})$")) for p in GENERATORS.values())), c["gen"] + 1)
                        & ~F.startswith(c["m"], F.lit("+")) & ~F.regexp_like(c["before"], F.lit(r"[0-9][\x20().-]{0,2}$")))

    return F.flatten(F.transform(spans, copies))


def propose(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(rid, _k, one array of base spans per kind, cands): one pass over the texts; rows with one rid have one key and text."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = base_spans(F.col("t"))
    some = F.regexp_like(F.col("t"), F.lit(r"[0-9]{2}|@|[(\[]at[)\]]|[0-9](?:[\x20().-]{1,2}[0-9]){6}|[0-9](?:[.][0-9]){3}"))
    none = F.expr(f"cast(array() as array<{CANDIDATE}>)")
    cands = F.when(some, F.concat(*(_proposed(F.col("t"), g, n) for g, n in enumerate(GENERATORS)))).otherwise(none)
    copied = [F.when(F.size(k) > 0, _copied(F.col(k), k)).otherwise(none) for k in KINDS if any(f[0] == k for f in _forms())]
    bare = lambda a: F.transform(a, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(a)
    return docs.select(F.xxhash64(key, text).alias("rid"), F.col(key).alias("_k"), body.alias("t")).select(
        "rid", "_k", "t", *(b.alias(k) for k, b in zip(KINDS, base))).select(
        "rid", "_k", *(bare(k) for k in KINDS), F.concat(cands, *copied).alias("cands"))


def features(rows: DataFrame) -> DataFrame:
    """(rid, gen, s, e, new, copy, src, label, features as doubles): a row for each candidate; new ones are to be scored."""
    def beside(x: Column, kind: str) -> Column:
        """Whether a candidate lies inside a base span of a kind, and whether it touches one: the first that ends after it begins tells. Copies need neither."""
        at = let(F.get(kind, first_that(F.col(kind), lambda b: b["e"] > x["s"])), lambda b: F.struct(
            F.coalesce((b["s"] <= x["s"]) & (x["e"] <= b["e"]), F.lit(False)).alias("inside"), F.coalesce(b["s"] < x["e"], F.lit(False)).alias("touch")))
        return F.when((F.size(kind) > 0) & x["given"].isNull(), at).otherwise(F.struct(F.lit(False).alias("inside"), F.lit(False).alias("touch")))

    c = F.explode(F.transform("cands", lambda x: let(F.array(*(beside(x, k) for k in KINDS)), lambda found: F.struct(
        x.alias("c"), F.exists(found, lambda f: f["inside"]).alias("inside"), F.exists(found, lambda f: f["touch"]).alias("touch"))))).alias("x")
    m, before = F.col("c.m"), F.col("c.before")
    count = lambda chars: F.length(m) - F.length(F.translate(m, chars, ""))
    yes = lambda cond: F.when(cond, 1.0).otherwise(0.0)
    digits = digits_of(m)
    values = {
        "gen": F.col("c.gen"), "chars": F.length(m), "digits": F.length(digits), "seps": count(" .-()"), "plus": count("+"), "parens": count("()"),
        "dots": count("."), "dashes": count("-"), "ats": count("@"), "groups": F.size(F.split(m, "[^0-9A-Za-z]+")),
        "luhn": yes(F.length(digits).between(12, 19) & luhn(F.substring(digits, 1, 19))), "octets": yes(octets(m)),
        "left_word": yes(F.regexp_like(before, F.lit("[A-Za-z_]$"))), "right_word": yes(F.regexp_like(F.col("c.after"), F.lit("[A-Za-z0-9_]"))),
        "left_digit": yes(F.regexp_like(before, F.lit("[0-9][^A-Za-z]?$"))), "cue": yes(F.regexp_like(before, F.lit(CUES))),
    }
    wide = rows.select("rid", c).select("rid", "x.c", "x.inside", "x.touch").select(
        "rid", F.col("c.gen").alias("g"), F.col("c.s").alias("s"), F.col("c.e").alias("e"), (F.col("c.given").isNull() & ~F.col("inside")).alias("new"),
        "touch", F.col("c.copy").alias("copy"), F.col("c.src").alias("src"), F.col("c.given").alias("given"), m.alias("m"), before.alias("before"),
        *(values[f].cast("double").alias(f) for f in FEATURES))
    label = F.when(F.col("given").isNotNull(), F.col("given")).when(~F.col("touch"), _weak())
    return wide.select("rid", "g", "s", "e", "new", "copy", "src", label.alias("label"), *FEATURES)


def _weak() -> Column:
    """The label that format and context give a candidate which touches no base span; null where they say nothing."""
    digits, mail = F.col("digits"), F.col("g") == list(GENERATORS).index("x_mail")
    cue = lambda words: F.regexp_like("before", F.lit(words))
    glued = (F.col("left_word") + F.col("right_word")) > 0
    bad_mail = glued | ~F.regexp_like("m", F.lit(r"[A-Za-z]{2,}$"))
    bad_number = glued | (digits < 7) | (digits > 19) | ((digits > 15) & (F.col("luhn") == 0)) | F.regexp_like("m", F.lit(DATE)) | (
        F.regexp_like("m", F.lit(r"^[0-9]{1,3}(?:[.][0-9]{1,3}){3,}$")))
    said = (digits.between(7, 15) & cue(PHONE_CUES)) | (digits.between(13, 19) & (F.col("luhn") == 1) & cue(CARD_CUES))
    return F.when(mail, F.when(bad_mail, 0.0)).when(bad_number, 0.0).when(said, 1.0)


def tally(cands: DataFrame) -> DataFrame:
    """(label, fold, features, n): all labelled candidates, with those alike counted instead of repeated."""
    fold = F.pmod(F.xxhash64("src"), F.lit(FOLDS)).cast("int").alias("fold")
    return cands.where("label is not null").groupBy("label", fold, *FEATURES).agg(F.count("*").cast("double").alias("n"))


def fit(cands: DataFrame):  # noqa: ANN201
    """(model or None, {generator: threshold}): fitted on all labelled candidates; for the thresholds each fold is scored by trees fitted on the others."""
    known = cut(tally(cands))
    counts = [tuple(r) for r in known.groupBy("fold", "gen", "label").agg(F.count("*"), F.sum("n")).collect()]  # at most folds x generators x 2
    weighed: dict[tuple, float] = {}
    for _, g, x, _, n in counts:
        weighed[g, x] = weighed.get((g, x), 0.0) + n
    share = F.element_at(F.create_map(*(F.lit(v) for (g, x), n in weighed.items() for v in (f"{g:.0f} {x:.0f}", min(1.0, FULL_WEIGHT / len(weighed) / n)))),
                         F.format_string("%.0f %.0f", "gen", "label")) if weighed else F.lit(1.0)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known.withColumn("weight", F.col("n") * share))

    def trees(without: int | None = None):  # noqa: ANN202
        """Fitted on all folds but one; None if they lack a label."""
        parts = [(x, k) for f, _, x, k, _ in counts if f != without]
        if len({x for x, _ in parts}) < 2:
            return None
        # Spark ML looks for split places in a sample of maxBins squared rows, or 10,000: so many bins that it is all rows
        bins = max(LEAST_SPLITS, math.isqrt(sum(k for _, k in parts)) + 1)
        return GBTClassifier(maxIter=6, maxDepth=3, maxBins=bins, stepSize=0.3, seed=7, featuresCol="features", labelCol="label", weightCol="weight").fit(
            rows if without is None else rows.where(F.col("fold") != without))

    model = trees()
    apart = {f: m for f in sorted({f for f, *_ in counts}) if model and (m := trees(f))}
    if not apart:
        return None, {}
    scored = reduce(DataFrame.union, (m.transform(rows.where(F.col("fold") == f)).select(F.col("gen").cast("int").alias("g"), "label", "n", _bin().alias("b")) for f, m in apart.items()))
    bins: dict[int, list] = {}
    for r in scored.groupBy("g", "b").agg(F.sum(F.col("label") * F.col("n")).alias("hits"), F.sum("n").alias("n")).orderBy("g", F.desc("b")).collect():  # at most generators x bins rows
        bins.setdefault(r["g"], []).append((r["b"], r["hits"], r["n"]))
    limits = {}
    for g, found in bins.items():
        right, wrong = sum(h for _, h, _ in found), sum(k - h for _, h, k in found)
        hits = misses = 0.0
        for b, h, k in found:
            hits, misses = hits + h / max(1, right), misses + (k - h) / max(1, wrong)
            if h and 2 * b >= BINS and hits >= MIN_PRECISION * (hits + misses):
                limits[g] = b
    return model, limits


def _bin() -> Column:
    return F.floor(vector_to_array("probability")[1] * BINS).cast("int")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): array<struct<k, s, e, kind>> by kind as listed (base kinds, then generators), then start."""
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.keep(propose(docs, key, text), "spans")
        cands = features(rows)
        model, limits = fit(cands)
        struct = lambda k, name: lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(name).alias("kind"))
        base = F.concat(*(F.transform(F.col(k), struct(i, k)) for i, k in enumerate(KINDS)))
        if not limits:
            return cut(rows.select(F.col("_k").alias(key), F.sort_array(base).alias("spans")))
        free = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(cands.where("new"))
        least = F.element_at(F.create_map(*(F.lit(x) for kv in limits.items() for x in kv)), F.col("g"))
        good = model.transform(free).withColumn("b", _bin()).where(F.col("b") >= least)
        more = good.groupBy("rid").agg(F.collect_set(F.struct((-F.col("b")).alias("b"), "s", "e", "g")).alias("more"))  # of one text

        def best(found: Column) -> Column:
            """Those without a better one that they overlap: spans of one generator are disjoint, so those that one overlaps are neighbours."""
            by_start = lambda x, y: F.when(x["s"] < y["s"], -1).when(x["s"] > y["s"], 1).otherwise(0)
            of = lambda g: F.filter(found, lambda y: y["g"] == g)
            families = F.array(*(F.array_sort(of(g), by_start) for g in range(len(GENERATORS))))
            return let(families, lambda fs: F.filter(found, lambda x: ~F.exists(fs, lambda ys: _better(ys, x))))

        def _better(ys: Column, x: Column) -> Column:
            first, last = first_that(ys, lambda y: y["e"] > x["s"]), first_that(ys, lambda y: y["s"] >= x["e"])
            return let(F.struct(first.alias("i"), last.alias("j")), lambda r: F.exists(F.slice(ys, r["i"] + 1, r["j"] - r["i"]), lambda y: y < x))

        names = F.array(*(F.lit(n) for n in GENERATORS))
        extra = F.transform(let(F.col("more"), best), lambda x: F.struct(
            (x["g"] + len(KINDS)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.get(names, x["g"]).alias("kind")))
        none = F.expr("cast(array() as array<struct<k:int,s:bigint,e:bigint,kind:string>>)")
        out = rows.join(more, "rid", "left").select(F.col("_k").alias(key), F.sort_array(F.concat(base, F.coalesce(extra, none))).alias("spans"))
        return cut(out)


def digest(docs: DataFrame) -> DataFrame:
    from vetrina.llm.secrets import joined, n_of

    base = F.filter("spans", lambda x: x["k"] < len(KINDS))
    return find(docs).select("doc_id", *(n_of("spans", i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                             F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with each found span replaced by <KIND>; overlapping spans are replaced as one, named after the first."""
    packed = docs.select(F.xxhash64(key, text).alias("rid"), F.col(text).alias("t"), F.struct(*docs.columns).alias("row"))
    found = find(packed, "rid", "t").dropDuplicates(["rid"])
    t = F.col("t")

    def cut_out(spans: Column) -> Column:
        done = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), lambda a, x: F.when(
            x["s"] < a["at"], F.struct(F.greatest(a["at"], x["e"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
                x["e"].alias("at"), F.concat(a["out"], F.substring(t, (a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int")),
                                             F.lit("<"), F.upper(x["kind"]), F.lit(">")).alias("out"))))
        return let(done, lambda a: F.concat(a["out"], F.substring(t, (a["at"] + 1).cast("int"), F.length(t))))

    placed = F.sort_array(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    rows = packed.join(found, "rid", "left")
    return rows.select(*(F.when(F.size("spans") > 0, let(placed, cut_out)).otherwise(t).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns))
