"""Price, brand, image and cost profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.config import Config
from vetrina.operators.price import stats_by_key, with_key
from vetrina.operators.selection import SPLIT, Step, by_key, counts
from vetrina.sources.sinks import kept


def price_profile(rows: DataFrame, max_min: float, low: float, high: float, split: int = SPLIT) -> DataFrame:
    """(key, listings, min, median, avg and max of the price, n_low, n_high) of keys with a cheap listing; the median is exact, by selection."""
    p = F.col("price")
    flat = rows.groupBy("key").agg(F.count("*").alias("listings"), F.min(p).alias("min_price"), F.avg(p).alias("avg_price"), F.max(p).alias("max_price"),
                                   F.count_if(p <= low).alias("n_low"), F.count_if(p <= high).alias("n_high")).where(F.col("min_price") < max_min)
    steps = [Step(ranks={"_a": "floor((n + 1) / 2)", "_b": "ceil((n + 1) / 2)"}, then={"median_price": "(_a + _b) / 2"})]
    return with_key(flat, by_key(counts(rows, "key", p), "key", steps, ["median_price"], split)).select(
        "key", "listings", "min_price", "median_price", "avg_price", "max_price", "n_low", "n_high")


def big_gap(profile: DataFrame, n: int = 10) -> DataFrame:
    return profile.withColumn("ratio", F.col("median_price") / F.col("min_price")).orderBy(F.desc("ratio"), "key").limit(n).select("key", "min_price", "median_price", "ratio")


def low_fraction(profile: DataFrame, n: int = 10) -> DataFrame:
    return profile.withColumn("fraction", F.col("n_low") / F.col("listings")).orderBy(F.desc("fraction"), "key").limit(n).select("key", "listings", "n_low", "fraction")


def robust_min_price(rows: DataFrame, cfg: Config) -> DataFrame:
    """The least price of a key that is not under its lower fence; the fence is joined to the rows, so a key's rows stay where they are."""
    fence = F.col("q1") - cfg.fence * (F.col("q3") - F.col("q1"))
    fences = stats_by_key(rows, cfg).select("key", fence.alias("fence"))
    return with_key(rows.select("key", "price"), fences).groupBy("key").agg(
        F.min(F.when(F.col("fence").isNull() | (F.col("price") >= F.col("fence")), F.col("price"))).alias("robust_min"))


#: Words that never are part of a brand, and Latin forms of Cyrillic letters: one for one, then those of more letters or none.
BRAND_STOPWORDS = ("for", "the", "and", "new", "original", "для", "новый", "оригинал")
CYRILLIC, LATIN = "абвгдеёзийклмнопрстуфхыэ", "abvgdeezijklmnoprstufhye"
LATIN_MORE = (("ж", "zh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "sch"), ("ю", "yu"), ("я", "ya"), ("ъ", ""), ("ь", ""))


def latin(text: Column) -> Column:
    out = F.translate(text, CYRILLIC, LATIN)
    for a, b in LATIN_MORE:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def brand_tokens(rows: DataFrame, brands: DataFrame, stopwords: tuple[str, ...] = BRAND_STOPWORDS) -> DataFrame:
    """(key, brands, min_price): dictionary entries of one or two words found in a key's texts; brands (brand) is a dictionary in Latin letters.

    Texts are lower-cased; stop-words go before words are paired; Cyrillic letters become Latin ones.
    """
    every = F.split(F.lower("text"), r"[^\p{L}\p{N}#]+")
    words = F.transform(F.filter(every, lambda w: ~w.isin(*stopwords)) if stopwords else every, latin)
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    tokens = rows.select("key", "text").distinct().select("key", F.explode(F.array_distinct(F.concat(words, pairs))).alias("brand"))
    found = tokens.join(brands, "brand").groupBy("key").agg(F.array_join(F.array_sort(F.collect_set("brand")), ", ").alias("brands"))
    return rows.groupBy("key").agg(F.min("price").alias("min_price")).join(found, "key")


def _brand_words(text: Column, stopwords: tuple[str, ...]) -> Column:
    every = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}#]+"), lambda w: w != "")
    return F.transform(F.filter(every, lambda w: ~w.isin(*stopwords)) if stopwords else every, latin)


def brand_matches(rows: DataFrame, brands: DataFrame, stopwords: tuple[str, ...] = BRAND_STOPWORDS) -> DataFrame:
    """(key, brand, n): dictionary entries of any number of words in a key's distinct texts, and how often each is there.

    Matches are the leftmost longest ones and don't overlap, so "land rover" isn't found in "land rover sport" if both are entries.
    An index of the entries' first words, with the greatest number of words that follow one, leaves the few places where
    an entry can begin; only their word sequences are looked up. Texts and entries are split and spelt by the same rules.
    """
    entry = F.array_join("_e", " ")
    known = brands.select(_brand_words(F.col("brand"), stopwords).alias("_e")).where(F.size("_e") > 0).select(entry.alias("_brand"), F.get("_e", F.lit(0)).alias("_first"), F.size("_e").alias("_n")).distinct()
    first = known.groupBy("_first").agg(F.max("_n").alias("_most"))
    texts = rows.select("key", "text").distinct().select("key", _brand_words(F.col("text"), stopwords).alias("_w"))
    texts = kept(texts.withColumn("_t", F.monotonically_increasing_id()), "texts")
    starts = texts.select("_t", "_w", F.posexplode("_w").alias("_i", "_first")).join(first, "_first").select(
        "_t", "_i", F.slice("_w", F.col("_i") + 1, F.col("_most")).alias("_s"))
    tried = starts.select("_t", "_i", "_s", F.explode(F.sequence(F.lit(1), F.size("_s"))).alias("_n")).select(
        "_t", "_i", "_n", F.array_join(F.slice("_s", F.lit(1), F.col("_n")), " ").alias("_brand"))
    longest = tried.join(known.select("_brand").distinct(), "_brand").groupBy("_t", "_i").agg(F.max(F.struct("_n", "_brand")).alias("_m"))
    nothing = F.struct(F.lit(0).alias("next"), F.expr("cast(array() as array<string>)").alias("found"))

    def take(acc: Column, x: Column) -> Column:
        return F.when(x["_i"] < acc["next"], acc).otherwise(F.struct((x["_i"] + x["_n"]).alias("next"), F.concat(acc["found"], F.array(x["_brand"])).alias("found")))

    chosen = longest.groupBy("_t").agg(F.array_sort(F.collect_list(F.struct("_i", "_m._n", "_m._brand"))).alias("_x")).select("_t", F.aggregate("_x", nothing, take)["found"].alias("_found"))
    return chosen.join(texts.select("_t", "key"), "_t").select("key", F.explode("_found").alias("brand")).groupBy("key", "brand").agg(F.count("*").alias("n"))


def size_histogram(rows: DataFrame, n: int) -> DataFrame:
    """The n most frequent (w, h), with their share of all rows."""
    total = rows.agg(F.count("*")).scalar()
    return rows.groupBy("w", "h").agg(F.count("*").alias("n")).select("w", "h", "n", (F.col("n") / total).alias("share")).orderBy(F.desc("n"), "w", "h").limit(n)


def download_quality(rows: DataFrame) -> DataFrame:
    """(key, ...): rows with found and ok counts of image downloads."""
    f, ok = F.col("found"), F.col("ok")
    return rows.groupBy("key").agg(F.count("*").alias("total"), F.count_if(f > 0).alias("with_urls"), F.count_if((f > 0) & (ok == f)).alias("all_ok"),
                                   F.count_if((ok > 0) & (ok < f)).alias("partial"), F.count_if((f > 0) & (ok == 0)).alias("failed"), F.count_if(f == 0).alias("none"))


def payload_stats(rows: DataFrame) -> DataFrame:
    b = F.sum("bytes")
    return rows.groupBy("key").agg(F.count("*").alias("images"), b.alias("bytes"), F.round(b / F.count("*") / 1024, 2).alias("avg_kb"))


def token_cost(runs: DataFrame, price_in: float = 0.60, price_out: float = 3.00, keys: int = 1000, share: float = 0.8) -> DataFrame:
    """Per run: cost at prices per million tokens, and per image; overall means and a projection to so many keys (run is null)."""
    cost = (F.col("tokens_in") * price_in + F.col("tokens_out") * price_out) / 1e6
    rows = runs.withColumn("cost", cost)
    per = rows.select("run", "tokens_in", "tokens_out", "cost", F.try_divide("cost", "images").alias("per_image"), F.lit(None).cast("double").alias("projected"))
    overall = rows.agg(F.avg("tokens_in").alias("tokens_in"), F.avg("tokens_out").alias("tokens_out"), F.avg("cost").alias("cost"), F.try_divide(F.sum("cost"), F.sum("images")).alias("per_image"))
    return per.unionByName(overall.select(F.lit(None).cast("string").alias("run"), "tokens_in", "tokens_out", "cost", "per_image", (F.col("cost") * keys * share).alias("projected")))
