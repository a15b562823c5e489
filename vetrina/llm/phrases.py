"""Collocations: phrases of two to five words that are frequent and hold together, by language.

Texts are packed into blocks of word ids. A block brings its own dictionary of its distinct words, in
pieces by hash ranges of the vocabulary; the pieces of one range meet, their counts are added up, and
frequent words get ids, which go back to the blocks. So no task holds the whole vocabulary, and the
ranges grow in number with the tasks that read the texts. Then phrases are counted length by length
in counting quotient filters (quotient_filter.py): a task counts the phrases of its blocks, cuts its
filter at quotient bounds, and the pieces of one quotient range are merged as sorted runs. The number of
ranges grows with the words, so ranges stay of one size.

A phrase can only be frequent if all its parts are: words that aren't frequent break blocks up, and
before counting length k a position is looked up in a bit table of the frequent phrases of length
k - 1. The table is sized by their number up to ``TABLE_BITS``; it lets some others through and never
holds a frequent one back, so it changes the work and no count.

Both parts of a cut of a frequent phrase are frequent too, so their counts are joined from the same
tables. As a phrase occurs in all occurrences of a longer one, a phrase that goes for a longer one
goes for one of just one word more.

Defined cases: a null text is empty; a null language is ``und``; a language without frequent phrases
has no row; rows that repeat count each time; an empty table gives an empty result. Only text and
language are read. Texts are taken whole. More than 2^31 frequent words are an error.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vetrina.llm.common import Scratch, blocks, cut
from vetrina.llm.quotient_filter import Limbs, QuotientFilter, permute, restore

BREAKS, BLANK = "[.,;:!?\n-\r]+", "[ \t]+"
LONGEST = 5
LEAST = 100
TOP = 2_000
#: Words of all texts for each quotient range.
RANGE_WORDS = 1 << 20
#: Distinct phrases that a task counts before it passes them on.
HELD = 1 << 21
#: The bit table's bits: so many a phrase, but no more than these.
BITS_EACH, TABLE_BITS = 16, 1 << 26
#: Words of a block, and distinct words of a task's open blocks, before they are passed on.
BLOCK_WORDS, BLOCK_NAMES = 1 << 23, 1 << 20


def _packed(texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(distinct words, the texts as places of words from 1 on, with 0 for breaks)."""
    spaced = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), BREAKS, " \n ")
    flat = pc.list_flatten(pc.split_pattern_regex(pc.binary_join_element_wise(spaced, "\n", " "), BLANK))
    found = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
    word = pc.not_equal(found.dictionary, "\n").to_numpy(zero_copy_only=False)
    place = np.where(word, np.cumsum(word), 0).astype(np.int32)
    return found.dictionary.filter(pa.array(word)).to_pylist(), place[found.indices.to_numpy()]


def _planes(ids: np.ndarray) -> bytes:
    """32-bit ids with their first bytes first, then their second ones and so on: the high ones are mostly zero."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: pa.Scalar) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data.as_buffer(), dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.uint32)


class _Block:
    """Texts of one language that a task has read, as places in their dictionary."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: pa.Array) -> None:
        words, ids = _packed(texts)
        place = self.place
        to = np.array([0, *(place.setdefault(w, len(place) + 1) for w in words)], dtype=np.int32)
        self.parts.append(to[ids])
        self.size += len(ids)

    def pieces(self, block: int, lang: str, ranges: int) -> pa.RecordBatch:
        """A row with the ids, of range -1, and one for each hash range of the dictionary."""
        ids, words = np.concatenate(self.parts), list(self.place)
        counts = np.bincount(ids, minlength=len(words) + 1)[1:]
        part = np.array([zlib.crc32(w.encode()) for w in words], dtype=np.int64) % ranges
        order = np.argsort(part, kind="stable")
        some, starts = np.unique(part[order], return_index=True)
        bounds = pa.array([0, *starts.tolist(), len(words)], pa.int32())  # the first row has no words
        listed = lambda values: pa.ListArray.from_arrays(bounds, values)
        n = len(some) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * n), pa.array([lang] * n), pa.array([-1, *some.tolist()], pa.int32()), listed(pa.array(words, pa.string()).take(pa.array(order))),
             listed(pa.array(order + 1, pa.int32())), listed(pa.array(counts[order], pa.int64())), pa.array([_planes(ids), *[None] * (n - 1)], pa.binary())],
            ["block", "lang", "range", "words", "at", "counts", "ids"])


def _blocks(docs: DataFrame, ranges: int, text: str, lang: str, names: int = BLOCK_NAMES) -> DataFrame:
    """(block, lang, range, words, at, counts, ids), see _Block.pieces()."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[str, _Block] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, block in held.items():
                yield block.pieces(next(number), name, ranges)
            held.clear()

        for batch in batches:
            for x in blocks(batch, "t"):
                for name in pc.unique(x["lang"]).to_pylist():
                    held.setdefault(name, _Block()).add(x["t"].filter(pc.equal(x["lang"], name)))
                if sum(b.size for b in held.values()) > BLOCK_WORDS or sum(len(b.place) for b in held.values()) > names:
                    yield from out()
        yield from out()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("t"))
    return rows.mapInArrow(run, "block long, lang string, range int, words array<string>, at array<int>, counts array<long>, ids binary")


def _vocabulary(packed: DataFrame, least: int) -> DataFrame:
    """(range, lang, n, first, words, f, block, at, place): of each range and language a row with n, the number of its words in all texts,
    and its frequent words with their counts, whose places in the range start at first; and of each block a row with which of its words have which place among these."""
    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        rows, out, base = rows.combine_chunks(), [], 0
        for name in pc.unique(rows["lang"]).to_pylist():
            own = rows.filter(pc.equal(rows["lang"], name)).combine_chunks()
            flat = pc.list_flatten(own["words"]).combine_chunks().dictionary_encode()
            index, counts = flat.indices.to_numpy(), pc.list_flatten(own["counts"]).to_numpy()
            f = np.zeros(len(flat.dictionary), dtype=np.int64)
            np.add.at(f, index, counts)
            many = f >= least
            place = np.where(many, base + np.cumsum(many) - 1, -1)
            out.append((name, int(f.sum()), base, flat.dictionary.filter(pa.array(many)).to_pylist(), f[many].tolist(), None, None, None))
            base += int(many.sum())
            at, ids, ends = pc.list_flatten(own["at"]).to_numpy(), place[index], np.cumsum(pc.list_value_length(own["words"]).to_numpy())
            for block, a, b in zip(own["block"].to_pylist(), np.append(0, ends[:-1]), ends):
                some = ids[a:b] >= 0
                if some.any():
                    out.append((None, None, None, None, None, block, at[a:b][some], ids[a:b][some]))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(out), pa.int32()), *columns], names=["range", "lang", "n", "first", "words", "f", "block", "at", "place"])

    pieces = packed.where("range >= 0").select("block", "lang", "range", "words", "at", "counts")
    return pieces.groupBy("range").applyInArrow(merge, "range int, lang string, n long, first long, words array<string>, f array<long>, block long, at array<int>, place array<long>")


def _encoded(packed: DataFrame, vocabulary: DataFrame, bases: DataFrame) -> DataFrame:
    """(ids): the blocks in ids of frequent words, 0 for breaks and others."""
    found = vocabulary.where("block is not null").join(F.broadcast(bases), "range").groupBy("block").agg(F.collect_list(F.struct("base", "at", "place")).alias("found"))  # of one block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, pieces in zip(batch["ids"], batch["found"]):
                ids = _from_planes(raw)
                to = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.uint32)
                lists = pieces.values
                n = pc.list_value_length(lists.field("at")).to_numpy()
                to[pc.list_flatten(lists.field("at")).to_numpy()] = pc.list_flatten(lists.field("place")).to_numpy() + np.repeat(lists.field("base").to_numpy(), n)
                yield pa.RecordBatch.from_arrays([pa.array([_planes(to[ids])], pa.binary())], ["ids"])

    return packed.where("range = -1").select("block", "ids").join(found, "block").select("ids", "found").mapInArrow(run, "ids binary")


def _limbs(ids: np.ndarray, at: np.ndarray, k: int) -> Limbs:
    """The phrases of k words at these places as permuted keys: two words a limb."""
    word = [ids[at + i].astype(np.uint64) for i in range(k)]
    return permute([word[i] << np.uint64(32) | (word[i + 1] if i + 1 < k else np.uint64(0)) for i in range(0, k, 2)])


def _words(limbs: Limbs, k: int) -> np.ndarray:
    halves = [h for a in restore(limbs) for h in (a >> np.uint64(32), a & np.uint64(0xFFFFFFFF))]
    return np.stack(halves[:k], axis=1).astype(np.int64)


class Table:
    """A bit table of permuted keys: all that were added are found, and some others."""

    def __init__(self, bits: int, words: np.ndarray | None = None) -> None:
        self.bits, self.words = bits, np.zeros(max(1, bits >> 6), dtype=np.uint64) if words is None else words

    def _places(self, limbs: Limbs) -> tuple[np.ndarray, np.ndarray]:
        return limbs[0] & np.uint64(self.bits - 1), (limbs[0] >> np.uint64(32)) & np.uint64(self.bits - 1)

    def add(self, limbs: Limbs) -> None:
        for p in self._places(limbs):
            np.bitwise_or.at(self.words, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))

    def has(self, limbs: Limbs) -> np.ndarray:
        a, b = ((self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) for p in self._places(limbs))
        return (a & b).astype(bool)


def _table(phrases: DataFrame, n: int, k: int) -> Table:
    bits = max(1 << 12, min(TABLE_BITS, 1 << (BITS_EACH * n - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Table(bits)
        for x in batches:
            ids = x["ids"].values.to_numpy()
            own.add(_limbs(ids, np.arange(0, len(ids), k), k))
        some = np.flatnonzero(own.words)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(own.words[some].view(np.int64), pa.int64())], ["i", "w"])

    out = Table(bits)
    for r in phrases.select("ids").mapInArrow(run, "i long, w long").groupBy("i").agg(F.bit_or("w").alias("w")).collect():  # at most TABLE_BITS / 64 rows
        out.words[r["i"]] = np.int64(r["w"]).astype(np.uint64)
    return out


def _places(ids: np.ndarray, k: int, tables: list[Table]) -> np.ndarray:
    """Where phrases of k words can be frequent."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    for j, table in enumerate(tables, 2):
        at = at[table.has(_limbs(ids, at, j))]
        at = at[:-1][np.diff(at) == 1]  # the phrase of j words one place on can be frequent too
    return at


def _frequent(encoded: DataFrame, k: int, tables: list[Table], bits: int, least: int) -> DataFrame:
    """(ids array<int>, f): the phrases of k words that occur so often."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[QuotientFilter] = []

        def out() -> Iterator[pa.RecordBatch]:
            for part, f in QuotientFilter.merge(held).parts(bits) if held else []:
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([f.dump(bits)], pa.binary())], ["part", "data"])
            held.clear()

        for batch in batches:
            for raw in batch["ids"]:
                ids = _from_planes(raw)
                held.append(QuotientFilter.of(_limbs(ids, _places(ids, k, tables), k)))
                if sum(map(len, held)) > HELD:
                    yield from out()
        yield from out()

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        f = QuotientFilter.merge([QuotientFilter.load(x.as_buffer(), part, bits) for x in rows["data"]]).at_least(least)
        ids = pa.ListArray.from_arrays(pa.array(np.arange(0, len(f) * k + 1, k), pa.int32()), pa.array(_words(f.limbs, k).ravel(), pa.int64()))
        return pa.Table.from_arrays([ids, pa.array(f.counts, pa.int64())], names=["ids", "f"])

    return encoded.mapInArrow(count, "part long, data binary").groupBy("part").applyInArrow(merge, "ids array<long>, f long")


def phrases(docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang",
            range_words: int = RANGE_WORDS, block_names: int = BLOCK_NAMES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases): (lang, word, f, id) of frequent words, (lang, n), and (ids, f) of frequent phrases of one word and more."""
    tasks = docs.select(F.spark_partition_id().alias("p")).agg(F.coalesce(F.max("p"), F.lit(0)) + 1).first()[0]
    packed = scratch.keep(_blocks(docs, tasks, text, lang, block_names), "packed", compression="zstd")
    vocabulary = scratch.keep(_vocabulary(packed, least), "vocabulary")
    listed = vocabulary.where("block is null")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = listed.groupBy("range").agg(F.sum(F.size("words")).alias("size"))  # as many rows as tasks read the texts
    bases = scratch.keep(sizes.select("range", (F.coalesce(F.sum("size").over(before), F.lit(0)) + 1).alias("base"), "size"), "bases")
    n_words = bases.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    words = scratch.keep(listed.join(F.broadcast(bases), "range").select("lang", (F.col("base") + F.col("first")).alias("id"), F.posexplode(F.arrays_zip("words", "f")).alias("i", "x")).select(
        "lang", F.col("x.words").alias("word"), F.col("x.f").alias("f"), (F.col("id") + F.col("i")).alias("id")), "words")
    if n_words >= 1 << 31:
        raise ValueError(f"{n_words} frequent words: ids have 32 bits")
    totals = listed.groupBy("lang").agg(F.sum("n").alias("n"))
    total = int(totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    encoded = scratch.keep(_encoded(packed, vocabulary, bases), "encoded", compression="zstd")
    scratch.drop("packed")
    bits = max(0, (total // range_words).bit_length())
    found, tables = [words.select(F.array("id").alias("ids"), "f")], []
    for k in range(2, longest + 1):
        found.append(scratch.keep(_frequent(encoded, k, tables, bits, least), f"phrases{k}"))
        if k < longest:
            if not (n := found[-1].count()):
                break
            tables.append(_table(found[-1], n, k))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return words, totals, out


def _scored(found: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, ids, phrase, a, l, r, n, score) of phrases of two and more words, those that go for a longer one left out."""
    size, at = F.size("ids"), F.col("cut")
    many = found.where(size > 1)
    part = lambda first, n: F.slice("ids", first, n)
    longer = many.where(size > 2).select("f", F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("ids")).groupBy("ids").agg(F.max("f").alias("most"))
    stay = many.join(longer, "ids", "left").where(F.coalesce(F.col("most") < F.col("f"), F.lit(True))).select("ids", F.col("f").alias("a"))
    cuts = stay.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")).select("*", part(1, at).alias("left"), part(at + 1, size - at).alias("right"))
    side = lambda name, value: found.select(F.col("ids").alias(name), F.col("f").alias(value))
    lang = words.select(F.col("id").alias("first"), "lang")
    rows = cuts.join(side("left", "l"), "left").join(side("right", "r"), "right").withColumn("first", F.element_at("ids", 1)).join(lang, "first").join(totals, "lang")
    exact = lambda c, digits: F.col(c).cast(f"decimal({digits},0)")  # noqa: E731  # products of 37 digits at most
    score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * exact("a", 15) * exact("n", 16), exact("l", 18) * exact("r", 18))
    best = rows.withColumn("score", score).groupBy("ids").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"), F.first("a").alias("a"), F.first("lang").alias("lang"), F.first("n").alias("n"))
    spelt = best.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id").groupBy("ids").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    return best.join(spelt, "ids").select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang", **sizes: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases by score, count and spelling.

    score is 1000 a n / (l r) of the cut that lowers it most, in whole numbers. The first rows of a language are found in each
    task before they meet.
    """
    with Scratch(docs.sparkSession) as scratch:
        words, totals, found = phrases(docs, scratch, least, longest, text, lang, **sizes)
        order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        rows = _scored(found, words, totals).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
        return cut(rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
