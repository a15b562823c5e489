"""Requests to and answers of an external model, as tables: no call is made here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.operators.stages import cap_per_key
from vetrina.sources.sinks import kept

#: Which noise around an answer is cut off, and how broken answers are read.
THINK = "(?s)<think>.*?</think>"
OBJECT = r'(?s)\{[^{}]*"passed_ids"[^{}]*\{.*?\}.*?\}'
ANY_OBJECT = r"(?s)\{.*\}"
PASSED_LIST = r'(?s)"passed_ids"\s*:\s*\[(.*?)\]'
QUOTED_ID = r'"(\d+)"'
REJECTED = r'\{"id"\s*:\s*"(\d+)"\s*,\s*"reason"\s*:\s*"([^"]*)"'
#: Classes of photos.
PHOTO_CLASSES = ("new", "used", "catalog")


def prompt_batches(listings: DataFrame, head: str, n: int = 30) -> DataFrame:
    """(key, prompt): instruction text and a JSON array of the first n listings of each key."""
    item = F.struct(F.col("item_id").alias("id"), "title", "price", "snippet", F.col("seller_name").alias("seller"))
    # at most n rows a key
    return cap_per_key(listings, n).groupBy("key").agg(F.array_sort(F.collect_list(item)).alias("items")).select("key", F.concat(F.lit(head), F.to_json("items")).alias("prompt"))


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def _list(json: Column, name: str) -> Column:
    """The elements of a list of a Variant object, each a Variant; null where there is none."""
    return F.try_variant_get(json, f"$.{name}", "array<variant>")


def _text(x: Column, path: str = "$") -> Column:
    return F.try_variant_get(x, path, "string")


def parse_verdicts(answers: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, item_id, passed, reason, status) from (key, raw) answers to (key, item_id) questions.

    Noise around the JSON is cut off; broken JSON is read by patterns, digits only. An answer is parsed once, to a Variant, and the part
    of it that looks like an object only if the whole is no JSON; what was said is written once for the steps that follow. An id
    that the answer doesn't mention is rejected as not covered; an answer without any id gives one error row.
    """
    cleaned = F.trim(F.regexp_replace("raw", THINK, ""))
    part = F.coalesce(_found(F.col("cleaned"), OBJECT), _found(F.col("cleaned"), ANY_OBJECT))
    read = answers.select("key", "raw", cleaned.alias("cleaned")).withColumn("json", F.coalesce(F.try_parse_json("cleaned"), F.try_parse_json(part)))
    broken = F.col("json").isNull()
    ids = F.when(broken, F.regexp_extract_all(F.regexp_extract("raw", PASSED_LIST, 1), F.lit(QUOTED_ID), F.lit(1))).otherwise(F.transform(_list(F.col("json"), "passed_ids"), lambda x: _text(x)))
    pairs = F.when(broken, F.zip_with(F.regexp_extract_all("raw", F.lit(REJECTED), F.lit(1)), F.regexp_extract_all("raw", F.lit(REJECTED), F.lit(2)), lambda i, r: F.struct(i.alias("id"), r.alias("reason")))).otherwise(
        F.transform(_list(F.col("json"), "rejected"), lambda x: F.struct(_text(x, "$.id").alias("id"), _text(x, "$.reason").alias("reason"))))
    some = lambda a, kind: F.coalesce(a, F.expr(f"cast(array() as {kind})"))
    both = read.select("key", some(ids, "array<string>").alias("ids"), some(pairs, "array<struct<id:string,reason:string>>").alias("pairs"))
    said = F.concat(F.transform("ids", lambda i: F.struct(i.alias("item_id"), F.lit(True).alias("passed"), F.lit(None).cast("string").alias("reason"))),
                    F.transform("pairs", lambda p: F.struct(p["id"].alias("item_id"), F.lit(False).alias("passed"), F.coalesce(p["reason"], F.lit("no reason given")).alias("reason"))))
    rows = kept(both.select("key", F.explode_outer(said).alias("v")).select("key", "v.*"), "said")
    best = rows.where("item_id is not null").groupBy("key", "item_id").agg(F.max(F.struct("passed", "reason")).alias("x")).select("key", "item_id", "x.passed", "x.reason", F.lit("ok").alias("status"))
    silent = rows.where("item_id is null").select("key", F.lit(None).cast("string").alias("item_id"), F.lit(None).cast("boolean").alias("passed"), F.lit("no id recognised").alias("reason"), F.lit("error").alias("status"))
    heard = rows.where("item_id is not null").select("key").distinct()
    missing = asked.join(heard, "key", "left_semi").join(rows.where("item_id is not null").select("key", "item_id"), ["key", "item_id"], "left_anti").select(
        "key", "item_id", F.lit(False).alias("passed"), F.lit("not covered by the answer").alias("reason"), F.lit("ok").alias("status"))
    return best.unionByName(silent).unionByName(missing)


def apply_verdicts(batch: DataFrame, verdicts: DataFrame, default: str = "not_relevant") -> DataFrame:
    """(key, item_id, passed, reason) of each row of a batch; passed wins, silence rejects."""
    one = verdicts.where("item_id is not null").groupBy("key", "item_id").agg(F.max(F.struct("passed", "reason")).alias("v"))
    passed = F.coalesce("v.passed", F.lit(False))
    return batch.select("key", "item_id").join(one, ["key", "item_id"], "left").select("key", "item_id", passed.alias("passed"), F.when(~passed, F.coalesce("v.reason", F.lit(default))).alias("reason"))


def fallback_verdicts(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """primary, and for keys that it failed on or lacks, secondary."""
    good = primary.where("status = 'ok'")
    return good.unionByName(secondary.join(good.select("key").distinct(), "key", "left_anti"))


def parse_photo_classes(answers: DataFrame) -> DataFrame:
    """(batch_id, name, class, reason) from (batch_id, names, raw): the first mention of a photo counts; unknown classes and silence are errors."""
    cleaned = F.trim(F.regexp_replace("raw", THINK, ""))
    read = answers.select("batch_id", "names", cleaned.alias("c")).withColumn("v", F.coalesce(F.try_parse_json("c"), F.try_parse_json(_found(F.col("c"), ANY_OBJECT))))
    one = lambda x: F.struct(F.try_variant_get(x, "$.photo", "int").alias("photo"), _text(x, "$.status").alias("status"), _text(x, "$.reason").alias("reason"))
    read = read.select("batch_id", "names", F.col("v").isNull().alias("broken"), F.transform(_list(F.col("v"), "results"), one).alias("r"))
    broken = F.col("broken")

    def first(i: Column) -> Column:
        hit = F.get(F.filter("r", lambda x: x["photo"] == i + 1), F.lit(0))
        known = hit["status"].isin(*PHOTO_CLASSES)
        return F.struct(
            F.get("names", i).alias("name"),
            F.when(~broken & known, hit["status"]).otherwise("error").alias("class"),
            F.when(broken, "the answer is no JSON").when(hit.isNull(), "not named in the answer").when(known, F.coalesce(hit["reason"], F.lit(""))).otherwise(
                F.concat(F.lit("no such class: "), F.coalesce(hit["status"], F.lit("None")))).alias("reason"))

    return read.select("batch_id", F.explode(F.transform(F.sequence(F.lit(0), F.size("names") - 1), first)).alias("p")).select("batch_id", "p.*")


def parse_events(logs: DataFrame) -> DataFrame:
    """(run, message, tokens_in, tokens_out, failure) from (run, raw) logs of JSON lines: the last agent message, else the raw text; a failure hides it."""
    get = lambda path: F.get_json_object("line", path)
    lines = logs.select("run", "raw", F.posexplode_outer(F.split("raw", "\n")).alias("pos", "line")).where("pos is not null").withColumn("line", F.trim("line"))
    kind = get("$.type")
    text = F.when((kind == "item.completed") & (get("$.item.type") == "agent_message"), F.nullif(get("$.item.text"), F.lit("")))
    done = kind == "turn.completed"
    fail = F.when(kind == "turn.failed", F.coalesce(get("$.error.message"), get("$.error"), F.lit("unknown error"))).when(kind == "error", F.coalesce(get("$.message"), F.lit("error")))
    facts = lines.select("run", "raw", "pos", text.alias("text"), F.when(done, get("$.usage.input_tokens").cast("long")).alias("i"), F.when(done, get("$.usage.output_tokens").cast("long")).alias("o"), fail.alias("fail"))
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pos")))
    out = facts.groupBy("run").agg(F.first("raw").alias("raw"), last("text").alias("text"), last("i").alias("tokens_in"), last("o").alias("tokens_out"), F.min_by("fail", F.when(F.col("fail").isNotNull(), F.col("pos"))).alias("fail"))
    stripped = F.nullif(F.trim("raw"), F.lit(""))
    failure = F.coalesce("fail", F.when(F.coalesce("text", stripped).isNull(), "empty answer"))
    return out.select("run", F.when(failure.isNull(), F.coalesce("text", stripped)).alias("message"), "tokens_in", "tokens_out", failure.alias("failure"))
