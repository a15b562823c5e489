"""Quality rules as a bitmask ledger.

Every rule is evaluated once for a document; a set bit says that the document fails it, and
the measurements stand beside the bits. A policy is a named, versioned mask: applying it, or
asking what a policy without one of its rules would keep, is bitwise arithmetic over the
ledger and reads no text again.

Defined cases: a null or blank text has no words and every measurement 0; it fails
``few_words``. Repeated rows are judged one by one. An empty table gives an empty ledger.
Columns of the input that are not the key or the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import BLANKS, UPPER, let, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Bits of the ledger, in order.
RULES = ("few_words", "repeated_windows", "symbol_density", "duplicate_lines", "shouting", "long_words")
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    max_repeat_pct: int = 20
    max_symbols_pct: int = 30
    max_duplicate_lines_pct: int = 50
    max_upper_pct: int = 60
    max_mean_word_chars: int = 40


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...] = field(default=RULES)

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 1, RULES)


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the text, the first one included."""
    def covered(windows: Column) -> Column:
        def starts(order: Column) -> Column:
            here = lambda i: F.get(order, i)["h"]
            alike = F.filter(
                F.transform(F.sequence(F.lit(0), F.size(order) - 1), lambda i: F.when(
                    F.coalesce(here(i) == here(i - 1), F.lit(False)) | F.coalesce(here(i) == here(i + 1), F.lit(False)),
                    F.get(order, i)["i"])),
                lambda x: x.isNotNull())
            return let(F.sort_array(alike), lambda at: F.aggregate(
                at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
                lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n")),
                lambda acc: acc["n"]))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), starts))

    def hashed(codes: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(1), F.size(codes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(codes, i, WINDOW))), covered)

    return F.when(F.size(words) < WINDOW + 1, 0).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), hashed))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, measurements): one pass over the texts, no shuffle."""
    return docs.select(F.col(key), _facts(text).alias("f")).select(key, *_columns())


def _columns() -> list[Column]:
    return [F.col("f.n_words"), F.col("f.word_chars"), F.col("f.n_symbols"), F.col("f.lines.dup").alias("n_dup_lines"), F.col("f.n_repeat_words"),
            F.col("f.lines.n").alias("n_lines"), F.col("f.n_upper")]


def _facts(text: str) -> Column:
    body = F.coalesce(F.col(text), F.lit(""))

    def facts(words: Column) -> Column:
        lines = F.filter(F.split(body, "\n", -1), lambda x: F.trim(x, F.lit(BLANKS)) != "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            (F.length(body) - F.length(F.translate(body, UPPER, ""))).cast("long").alias("n_upper"),
        )

    return let(words_of(body), facts)


def ledger(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The measurements and ``mask`` (long): a bit for each failed rule."""
    return measure(docs, key, text).withColumn("mask", _mask(limits))


def _mask(limits: Limits) -> Column:
    c = F.col
    fails = {
        "few_words": c("n_words") < limits.min_words,
        "repeated_windows": 100 * c("n_repeat_words") > limits.max_repeat_pct * c("n_words"),
        "symbol_density": 100 * c("n_symbols") > limits.max_symbols_pct * c("n_words"),
        "duplicate_lines": 100 * c("n_dup_lines") > limits.max_duplicate_lines_pct * c("n_lines"),
        "shouting": 100 * c("n_upper") > limits.max_upper_pct * c("word_chars"),
        "long_words": c("word_chars") > limits.max_mean_word_chars * c("n_words"),
    }
    mask = sum((F.when(fails[r], BIT[r]).otherwise(0) for r in RULES[1:]), F.when(fails[RULES[0]], BIT[RULES[0]]).otherwise(0))
    return mask.cast("long")


def keep(docs: DataFrame, policy: Policy = STANDARD, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The rows of docs that no rule of the policy rejects, with all their columns, whatever their names."""
    rows = docs.select(F.struct("*").alias("row"), _facts(text).alias("f")).select("row", *_columns()).withColumn("mask", _mask(limits))
    return rows.where(F.col("mask").bitwiseAND(F.lit(policy.mask).cast("long")) == 0).select("row.*")


def apply_policy(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Adds ``kept`` and the policy's name and version to ledger rows."""
    return rows.withColumn("kept", F.col("mask").bitwiseAND(F.lit(policy.mask).cast("long")) == 0).withColumn(
        "policy", F.lit(f"{policy.name}@{policy.version}"))


def ablations(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """(rule, n_failed, n_only, n_kept_without): for each rule of a policy, what leaving it out would change."""
    masked = F.col("mask").bitwiseAND(F.lit(policy.mask).cast("long"))
    seen = rows.groupBy(masked.alias("bits")).agg(F.count("*").alias("n"))  # at most 2^rules groups
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in policy.rules))).alias("r")
    return seen.select("bits", "n", rules).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0, F.col("n")).otherwise(0)).alias("n_kept_without"))


def judge(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The digest of the ledger under a policy; the base rules always hold."""
    rows = apply_policy(ledger(docs), policy)
    failed = F.col("mask").bitwiseAND(F.lit(BASE.mask).cast("long")) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"), "mask")
