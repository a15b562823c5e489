"""Secret scans through a trigram inverted index.

Each rule's regular expression gives a Boolean trigram query: alternatives of sets of trigrams
that every match must contain. The index has a posting (trigram, document) for the trigrams of
the queries; intersecting the postings of an alternative gives candidate documents, whose texts
are then verified with the expression itself. A rule without mandatory trigrams scans every text.

Defined cases: a null text is empty and has no spans; a null key is joined null-safely;
repeated rows are judged one by one; an empty table gives an empty result; other columns of the
input are not read. Very long texts are scanned whole, in time that grows as their length.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import no_spans, spans_of


@dataclass(frozen=True)
class Rule:
    """kind; pattern, with no flags; group whose length is at least least.

    once: an expression whose group 1, at its end, is each match of pattern, where pattern would read one run again from many places.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    once: str = ""


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


BASE = (
    Rule("assign", f"({either_case('password')}|{either_case('passwd')}|{either_case('secret')}|{either_case('token')}|{either_case('api')}_?{either_case('key')})"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Characters of a part of a signed token; a part ends where its run of them does, so what its first mark can't begin, no later one can.
PART = "[A-Za-z0-9_-]"
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", rf"eyJ{PART}{{8,}}\.eyJ{PART}{{8,}}\.{PART}{{8,}}",
         once=rf"(?<!{PART})(?>{PART}*?(?=eyJ))(eyJ{PART}{{8,}}+\.eyJ{PART}{{8,}}+\.{PART}{{8,}}+)"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("url_login", r"[a-z]{2,12}://[A-Za-z0-9._-]+:[^\x00-\x20/:@]+@"),
)
#: Alternatives of an expression that are told apart; beyond that the rule scans fully.
MOST_PATHS = 256


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives, each a set of lower-case trigrams that a match along it contains; [] if some match need contain none."""
    Path = tuple[tuple[str, ...], str]  # finished runs of literals, the open run

    def broken(paths: set[Path]) -> set[Path]:
        return {((*done, run) if len(run) > 2 else done, "") for done, run in paths}

    def added(paths: set[Path], c: str) -> set[Path]:
        return {(done, run + c) for done, run in paths}

    def through(paths: set[Path], items: Iterable) -> set[Path]:
        for op, arg in items:
            if len(paths) > MOST_PATHS:
                return {((), "")}
            if op is sre.LITERAL:
                paths = added(paths, chr(arg).lower())
            elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(alike := {chr(a).lower() for _, a in arg}) <= 5:
                paths = set().union(*(added(paths, c) for c in alike))
            elif op is sre.SUBPATTERN:
                paths = through(paths, arg[-1])
            elif op is sre.BRANCH:
                paths = set().union(*(through(paths, x) for x in arg[1]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                least, most, item = arg
                if most == 1:
                    paths = paths | through(paths, item)
                else:
                    for _ in range(min(least, 3)):
                        paths = through(paths, item)
                    paths = paths if least == most <= 3 else broken(paths)
            elif op is not sre.AT:
                paths = broken(paths)
        return paths

    runs = [done for done, _ in broken(through({((), "")}, sre_parse.parse(pattern)))]
    sets = {frozenset(r[i : i + 3] for r in done for i in range(len(r) - 2)) for done in runs}
    return [] if not all(sets) else sorted((x for x in sets if not any(y < x for y in sets)), key=sorted)


def _any_of(trigrams: Iterable[str]) -> str:
    """An expression that stands before each place of a text where one of the trigrams begins, with the trigram as group 1."""
    written = lambda c: f"\\x{{{ord(c):x}}}"
    tree: dict[str, dict[str, str]] = {}
    for t in sorted(trigrams):
        second = tree.setdefault(written(t[0]), {})
        second[written(t[1])] = second.get(written(t[1]), "") + written(t[2])
    return "(?=(" + "|".join(a + "(?:" + "|".join(f"{b}[{cs}]" for b, cs in second.items()) + ")" for a, second in tree.items()) + "))"


def postings(docs: DataFrame, trigrams: set[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index: a row (trigram, key) for each listed trigram that a text contains, whatever its case; one pass over a text."""
    if not trigrams:
        return docs.select(F.lit("").alias("trigram"), F.col(key)).where("false")
    hits = F.regexp_extract_all(F.lower(F.col(text)), F.lit(_any_of(trigrams)), F.lit(1))
    return docs.select(F.explode(F.array_distinct(hits)).alias("trigram"), F.col(key))


def candidates(docs: DataFrame, rules: Iterable[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, kinds): the rules whose trigram query a document meets; for rules that have one."""
    queries = [(r.kind, n, t, len(q)) for r in rules for n, q in enumerate(trigram_query(r.pattern)) for t in sorted(q)]
    wanted = docs.sparkSession.createDataFrame(queries, "kind string, path int, trigram string, need int")
    # the query table is as large as the rule set is, whatever the documents are
    met = postings(docs, {t for _, _, t, _ in queries}, key, text).join(F.broadcast(wanted), "trigram").groupBy(key, "kind", "path").agg(
        F.count("*").alias("n"), F.first("need").alias("need")).where("n >= need")
    return met.groupBy(key).agg(F.collect_set("kind").alias("kinds"))


def _verified(text: Column, r: Rule) -> Column:
    """array<struct<s, k, e, kind>> of a rule, unordered kinds apart."""
    if r.once:
        return F.transform(spans_of(text, r.once, 1), lambda x: F.struct((x["e"] - F.length(x["m"])).alias("s"), x["e"].alias("e"), x["m"].alias("m")))
    found = spans_of(text, r.pattern, r.group)
    return F.filter(found, lambda x: F.length(x["m"]) >= r.least) if r.least else found


def labelled(spans: Column, k: int, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def n_of(spans: Column | str, k: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == k)).cast("long")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): spans is array<struct<s, k, e, kind>>, by start, then kind as listed; k is the kind's place."""
    indexed = [r for r in rules if trigram_query(r.pattern)]
    body = F.coalesce(F.col(text), F.lit(""))
    found = candidates(docs, indexed, key, text).withColumnRenamed(key, "_key")
    rows = docs.select(key, text).join(found, F.col(key).eqNullSafe(F.col("_key")), "left") if indexed else docs.select(key, text, F.lit(None).cast("array<string>").alias("kinds"))
    kept = []
    for k, r in enumerate(rules):
        spans = _verified(body, r)
        if r in indexed:
            spans = F.when(F.array_contains("kinds", r.kind), spans).otherwise(no_spans())
        kept.append(labelled(spans, k, r.kind))
    return rows.select(key, F.sort_array(F.concat(*kept)).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans, all spans."""
    names = [r.kind for r in BASE]
    base = F.filter("spans", lambda x: x["k"] < len(names))
    return scan(docs).select(
        "doc_id", *(n_of("spans", k).alias(f"n_{n}") for k, n in enumerate(names)),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
