"""Text rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EDGE = r"[^\p{L}\p{N}_]"
#: Parts of messages by class of network error; the permanent ones are looked for first.
PERMANENT = ("err_proxy_connection_failed", "err_tunnel_connection_failed", "proxy authentication required", "err_proxy_auth", "407 proxy authentication")
TRANSIENT = ("err_connection_closed", "err_connection_reset", "err_network_changed", "err_connection_timed_out", "err_timed_out", "err_empty_response",
             "connection closed", "connection reset", "net::err_aborted")
#: Labels of errors, by the first part found.
LABELS = (("err_connection_closed", "ERR_CONNECTION_CLOSED (TCP FIN)"), ("err_connection_reset", "ERR_CONNECTION_RESET (TCP RST)"),
          ("err_proxy_connection_failed", "ERR_PROXY_CONNECTION_FAILED (proxy unavailable)"), ("err_connection_timed_out", "ERR_CONNECTION_TIMED_OUT (TCP timeout)"),
          ("timeout", "Timeout error"))


def escaped(word: str) -> str:
    return "".join(f"\\{c}" if c in r".^$*+?()[]{}|\\" else c for c in word)


def bounded(word: str) -> str:
    """A pattern for a word between characters that are not of a word, in any script."""
    return f"(^|{EDGE}){escaped(word.lower())}($|{EDGE})"


def stopword_first_match(words: Iterable[str], *parts: Column) -> Column:
    """The first listed word in the lower-cased, blank-joined parts; null if there is none.

    The list is walked only for texts that have one of the words anywhere, and a word's edges are looked at only where it is found.
    """
    words = list(words)
    if not words:
        return F.lit(None).cast("string")
    text = F.lower(F.concat_ws(" ", *(F.coalesce(p, F.lit("")) for p in parts)))
    some = "|".join(escaped(w.lower()) for w in words)
    return F.when(text.rlike(some), F.coalesce(*(F.when(F.contains(text, F.lit(w.lower())) & text.rlike(bounded(w)), F.lit(w)) for w in words)))


def nul_scrub(text: Column) -> Column:
    return F.translate(text, "\0", "")


def error_class(message: Column) -> Column:
    low = F.lower(message)
    has = lambda parts: F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(low, p))
    return F.when(has(PERMANENT), "permanent").when(has(TRANSIENT), "transient").otherwise("unknown")


def error_label(message: Column) -> Column:
    low, out = F.lower(message), F
    for part, label in LABELS:
        out = out.when(F.contains(low, F.lit(part)), label)
    return out.otherwise(F.left(message, F.lit(100)))


def used_condition(items: Column, key_words: Iterable[str], variants: Iterable[str]) -> Column:
    """Whether an entry's key contains a condition word and its value a variant, as parts of the lower-cased strings."""
    keys, values = F.array(*map(F.lit, key_words)), F.array(*map(F.lit, variants))
    return F.coalesce(F.exists(F.map_entries(items), lambda e: F.exists(keys, lambda k: F.contains(F.lower(e["key"]), k)) & F.exists(
        values, lambda v: F.contains(F.lower(F.trim(e["value"])), v))), F.lit(False))


def search_url(base: str, key: Column) -> Column:
    """Blanks become %20 and a slash stays."""
    return F.concat(F.lit(base), F.replace(F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")))
