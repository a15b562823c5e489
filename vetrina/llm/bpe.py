"""BPE encoding and decoding with a public vocabulary file.

A word's symbols form a doubly linked list; a heap holds the merge rank of each adjacent pair.
The lowest rank is merged first, the leftmost among equals, and entries whose symbols have
changed meanwhile are stale and skipped. Decoding joins vocabulary strings. Words repeat, so a
task keeps the ids of the words that it has met, up to a bound.

The vocabulary's own text rules hold: Unicode NFC, white space dropped, lower case, the
splitting pattern of the file, byte symbols, a word-end mark.

Defined cases: null is encoded as the empty text (no tokens, empty decoded text); strings of
special tokens become their ids; repeated rows are encoded one by one; an empty table gives an
empty result. Only the key and the text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame

#: Words whose ids a task keeps.
KNOWN_WORDS = 150_000


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Tokenizer:
    """Built once in a Python worker from the JSON file of a word-end BPE vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.rank = {(a, b): i for i, (a, b) in enumerate(map(tuple, model["merges"]))}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        self.bytes = byte_symbols()
        self.pieces = regex.compile(next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"])
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, tuple[str, int, str]] = {}

    def merge(self, piece: str) -> list[int]:
        symbols = [self.bytes[b] for b in piece.encode("utf-8")]
        symbols[-1] += self.end
        n, rank = len(symbols), self.rank
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := rank.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # stale: one of the two was merged into another symbol
            symbols[i], symbols[j], after[i] = a + b, "", after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (r := rank.get((symbols[left], symbols[right]))) is not None:
                    heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        ids, unknown = self.ids, []
        out = [ids.get(s, unknown) for s in symbols if s]
        return [x for x in out if x is not unknown]

    def word(self, piece: str) -> tuple[str, int, str]:
        """Decimal ids, their number and the decoded text of a piece."""
        ids = self.merge(piece)
        if len(self.known) >= KNOWN_WORDS:
            self.known.clear()
        self.known[piece] = found = (" ".join(map(str, ids)), len(ids), self.decode(ids))
        return found

    def normal(self, text: str) -> str:
        # per character, so no final sigma
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def parts(self, text: str) -> list[tuple[str, int, str]]:
        known, out = self.known, []
        for i, run in enumerate(self.specials.split(text) if self.specials and "<|" in text else [text]):
            if i % 2:
                out.append((str(self.special[run]), 1, run))
            else:
                out += [known.get(p) or self.word(p) for p in self.pieces.findall(self.normal(run))]
        return [x for x in out if x[1]]

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for ids, _, _ in self.parts(text or "") for i in ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings; a file without a decoder joins them by blanks."""
        return " ".join(self.strings[i] for i in ids)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>, decoded string) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for x in batches:
            ids = [t.encode(s) for s in x[text]]
            yield pd.DataFrame({key: x[key], "ids": ids, "decoded": [t.decode(i) for i in ids]})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) without shipping the ids themselves."""
    def sha(s: str) -> str:
        return hashlib.sha256(s.encode("utf-8")).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = tokenizer(path)
        for x in batches:
            rows = []
            for s in x[text]:
                parts = t.parts(s or "")
                rows.append((sum(p[1] for p in parts), sha(" ".join([p[0] for p in parts])), sha(" ".join([p[2] for p in parts]))))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(**{key: list(x[key])})[[key, "n_tokens", "ids_sha256", "decoded_sha256"]].astype({"n_tokens": "int64"})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
