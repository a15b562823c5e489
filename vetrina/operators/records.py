"""Reshaping of parsed records, and classification by rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Classes of page detectors.
PAGE_STATES = {
    "catalog_page_detector": "success", "card_found_detector": "success", "seller_profile_detector": "success", "continue_button_detector": "captcha",
    "captcha_geetest_detector": "captcha", "proxy_block_429_detector": "captcha", "proxy_block_403_detector": "blocked", "proxy_auth_407_detector": "blocked",
    "removed_or_not_found_detector": "final", "unknown_page_detector": "final",
}
#: What an outcome does to the task and to the resource, and whether the page is closed: (status, task, resource, close).
OUTCOMES = (
    ("success", "complete", "keep", False), ("empty", "complete", "keep", False), ("not_found", "invalidate", "keep", False),
    ("blocked", "return", "block", True), ("auth_required", "return", "block", True), ("captcha_unsolved", "return", "block", True),
    ("server_unavailable", "return", "release", True), ("load_timeout", "return", "count_error", True),
)


def flatten_card(cards: DataFrame) -> DataFrame:
    """A flat measurement row of a nested card; an unreadable time is null."""
    return cards.select("item_id", "title", "price", F.col("seller.name").alias("seller_name"), F.col("location.address").alias("location_name"),
                        F.try_to_timestamp("published_at").alias("published_at"), F.to_json("characteristics").alias("characteristics"), "views_total")


def image_summary(images: Column, urls: Column, n: int) -> tuple[Column, Column, Column]:
    """(first n images, count of the longer list, first n urls as JSON or null)."""
    size = lambda a: F.coalesce(F.size(a), F.lit(0))
    return F.slice(images, 1, n), F.greatest(size(images), size(urls)), F.when(size(urls) > 0, F.to_json(F.slice(urls, 1, n)))


def object_key(prefix: str, item: Column, n: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix), item, F.concat(n.cast("string"), F.lit(".jpg")))


def page_state(detector: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in PAGE_STATES.items() for x in kv))
    return F.coalesce(F.try_element_at(table, detector), F.lit("unknown"))


def dispatch(rows: DataFrame, status: str = "status", rules: tuple = OUTCOMES, default: tuple = ("fail", "keep", False)) -> DataFrame:
    """rows with task_action, resource_action and close_page, by a rules table of fixed size."""
    table = rows.sparkSession.createDataFrame(list(rules), f"{status} string, task_action string, resource_action string, close_page boolean")
    out = rows.join(F.broadcast(table), status, "left")
    return out.withColumns({"task_action": F.coalesce("task_action", F.lit(default[0])), "resource_action": F.coalesce("resource_action", F.lit(default[1])),
                            "close_page": F.coalesce("close_page", F.lit(default[2]))})


def variant_path(path: str) -> str:
    """A dotted path as Spark's path into a Variant: digits are a place in an array, all else a name."""
    def name(x: str) -> str:
        if '"' in x and "'" in x:
            raise ValueError(f"a name with both quotes can't be in a path: {x}")
        return f"['{x}']" if '"' in x else f'["{x}"]'

    return "$" + "".join(f"[{x}]" if x.isdigit() else name(x) for x in path.split("."))


def json_paths(rows: DataFrame, source: str, paths: dict[str, str]) -> DataFrame:
    """rows with a column, a text, for each dotted path into a JSON text: priceDetailed.value, images.0.url.

    A text is parsed once, to a Variant, however many paths are read; lists and objects are given as JSON. What is no JSON has
    no values.
    """
    parsed = rows.withColumn("_v", F.try_parse_json(source))
    return parsed.withColumns({name: F.try_variant_get("_v", variant_path(path), "string") for name, path in paths.items()}).drop("_v")
