"""Language identification by words first, then shorter and shorter character n-grams.

A known word adds its log frequency in each language. An unseen word backs off to its character
n-grams, with marks at both ends: of the longest length of which any is known, the known ones'
mean is added, and every step of backing off weighs that evidence by ``BACKOFF``, so that a
5-gram says less than a word and a letter says next to nothing. The language with the highest sum, counting
its prior, wins; the score is its posterior probability.

The model is fitted on at most ``FIT_DOCS`` labelled documents (in expectation), picked by hash
of the key over all of them; it keeps all words and n-grams of these, so that this bound, not the input,
gives its size. Texts are split into words by one function on both sides. Every text is judged whole.

Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is every
text if nothing was learned. Ties go to the first language by name. Repeated rows are judged one
by one. Labels that are null teach nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetrina.llm.common import cut

FIT_DOCS = 10_000
LONGEST = 5
BACKOFF = 0.8
#: Added to each count of a word or n-gram.
SMOOTH = 0.5
#: Texts whose words are counted at once.
BLOCK = 512
#: Words whose score vectors a task keeps.
KNOWN_WORDS = 200_000
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


def _logs(counts: pd.DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """The place of each word or n-gram (the first column) and the logs of its share in each language."""
    m = counts.iloc[:, 1:].to_numpy(dtype=float) + SMOOTH
    return dict(zip(counts.iloc[:, 0], range(len(counts)))), np.log(m / m.sum(axis=0)).astype(np.float32) if len(counts) else m.astype(np.float32)


class Model:
    """Log frequencies: rows of one matrix, found by word or by n-gram of each length."""

    def __init__(self, langs: list[str], prior: list[float], words: pd.DataFrame, grams: list[pd.DataFrame]) -> None:
        """words and grams (n-grams of length 1, 2 and so on): a name and its count in each language."""
        self.langs, self.prior = langs, np.log(np.array(prior) / sum(prior)) if langs else np.zeros(0)
        self.tables = [_logs(words), *map(_logs, reversed(grams))]  # from words to letters
        self.known: dict[str, int] = {}
        self.rows: list[np.ndarray] = []

    def word(self, w: str) -> np.ndarray:
        names, logs = self.tables[0]
        if (at := names.get(w)) is not None:
            return logs[at]
        marked = f"^{w}$"
        for step, (names, logs) in enumerate(self.tables[1:], 1):
            n = len(self.tables) - step
            found = [at for i in range(len(marked) - n + 1) if (at := names.get(marked[i : i + n])) is not None]
            if found:
                return BACKOFF**step * logs[found].mean(axis=0)
        return np.zeros(len(self.langs), dtype=np.float32)

    def _place(self, w: str) -> int:
        self.known[w] = at = len(self.rows)
        self.rows.append(self.word(w))
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return "und", 0.0
        if len(self.rows) > KNOWN_WORDS:
            self.known.clear()
            self.rows.clear()
        counts: dict[int, int] = defaultdict(int)
        known, place = self.known, self._place
        total = self.prior.astype(float).copy()
        for w in words:
            at = known.get(w)
            counts[place(w) if at is None else at] += 1
        total += np.array(list(counts.values()), dtype=float) @ np.array([self.rows[i] for i in counts], dtype=float)
        p = np.exp(total - total.max())
        best = int(p.argmax())
        return self.langs[best], float(p[best] / p.sum())


def held_out(key: Column) -> Column:
    """Documents that nothing is learned from: a fifth, by the crc32 of the key as text."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """Learns from the rows given."""
    labelled = docs.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    sizes = {r[label]: r["n"] for r in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}  # a row a language
    langs = sorted(sizes)
    if not langs:
        return Model([], [], pd.DataFrame({"w": []}), [pd.DataFrame({"g": []})] * LONGEST)
    share = min(1.0, fit_docs / sum(sizes.values()))
    pick = F.pmod(F.xxhash64(key, text), F.lit(1 << 52)) / float(1 << 52)
    chosen = labelled.where(pick < share) if share < 1 else labelled
    names = [f"c{i}" for i in range(len(langs))]
    place = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for i in range(0, len(x), BLOCK):
                found: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(langs), dtype=np.int64))
                for t, lang in zip(x["t"].iloc[i : i + BLOCK], x["lang"].iloc[i : i + BLOCK]):
                    for w in words_of(t):
                        found[w][place[lang]] += 1
                if found:
                    yield pd.DataFrame(np.array(list(found.values())), columns=names).assign(w=list(found))[["w", *names]]

    sums = [F.sum(c).alias(c) for c in names]
    # one row a word: the counts of all languages side by side
    words = cut(chosen.select(F.col(text).alias("t"), F.col(label).alias("lang")).mapInPandas(count, "w string, " + ", ".join(f"{c} long" for c in names)).groupBy("w").agg(*sums))
    grams = []
    for n in range(1, LONGEST + 1):
        marked = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
        at = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - n + 1)).otherwise(F.expr("cast(array() as array<int>)"))
        # what fit_docs documents hold reaches the driver
        grams.append(words.select(F.explode(_grams(marked, at, n)).alias("g"), *names).groupBy("g").agg(*sums).toPandas())
    return Model(langs, [sizes[x] for x in langs], words.toPandas(), grams)


def _grams(marked: Column, at: Column, n: int) -> Column:
    return F.transform(at, lambda i: F.substring(marked, i, F.lit(n)))


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FIT_DOCS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for x in batches:
            out = [m.predict(t) for t in x[text]]
            yield pd.DataFrame({key: x[key], "lang_pred": [o[0] for o in out], "score": [o[1] for o in out]})

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInPandas(run, f"`{key}` {kind}, lang_pred string, score double")


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
