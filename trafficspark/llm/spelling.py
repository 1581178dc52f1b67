"""Spelling variants: words within one edit of each other, found over a reduced alphabet.

Letters are dealt to a few symbols, as evenly as their counts allow. Words one edit apart have reduced words at most one
edit apart, so each reduced word's one-edit neighbourhood, as hashed keys, is joined with the reduced vocabulary and only
then are the words themselves compared. How many symbols a length has goes by how many words there are: as many as keep
reduced words of that length rarer than words. Nearness goes both ways, so a neighbourhood is emitted from one side only:
replacements by a greater symbol, deletions (insertions are the deletions of the longer word), and the reduced word itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common

# The letters of a run.
LETTERS = r"A-Za-zÀ-ÿ"
#: Reduced words there are for each word of a length, at least.
ROOM = 4
#: Words whose neighbourhoods are made at a time.
ROWS = 2048
PRIME = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 7, count: int = 2, noise: int | None = 31) -> DataFrame:
    """word, n: the lower-cased (A-Z) runs of letters of at least `least` characters that occur `count` times or more.

    With `noise`, a run whose crc32 with its document's id that number divides first loses one character, which only
    then has to leave `least`; runs of documents without an id keep all. Counts are summed in each task before they are shuffled.
    """
    # A run that is shorter can't become a word, so the pattern skips it.
    found = F.regexp_extract_all(common.lower_ascii(F.col(text_col)), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(found).alias("run"))
    if noise:
        rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("size"))
        cut = F.expr("substring(run, 1, cast(h % size as int)) || substring(run, cast(h % size as int) + 2)")
        rows = rows.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("run"))
    return rows.where(F.length("run") >= least).groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


class Alphabets:
    """For each length of a word, its number of symbols and each letter's symbol."""

    def __init__(self, lengths: dict[int, int], letters: dict[str, int], room: int = ROOM):
        self.symbols = {n: self.size(n, words * room, len(letters)) for n, words in lengths.items()}
        falling = sorted(letters, key=lambda c: (-letters[c], c))
        self.tables = {k: self.deal(falling, letters, k) for k in set(self.symbols.values())}

    @staticmethod
    def size(length: int, wanted: int, most: int) -> int:
        k = 2
        while k < most and k**length < wanted:
            k += 1
        return k

    @staticmethod
    def deal(falling: list[str], counts: dict[str, int], k: int) -> np.ndarray:
        """Symbols (1 to k) by code point: each letter goes to the symbol that has least so far, common letters first."""
        table, load = np.zeros(1 + max(map(ord, falling), default=0), np.uint64), [0] * k
        for c in falling:
            s = load.index(min(load))
            load[s] += counts[c]
            table[ord(c)] = s + 1
        return table

    def reduced(self, points: np.ndarray, length: int) -> np.ndarray | None:
        """Symbols of words (rows of code points) under the alphabet of words of a length; None if there are no such words."""
        k = self.symbols.get(length)
        return None if k is None else self.tables[k][points]


def mixed(h: np.ndarray, length: int) -> np.ndarray:
    """Keys from polynomial hashes, unlike for each length."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(length)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def keys_of(points: np.ndarray, alphabets: Alphabets) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of words of one length, as rows of code points: the key of each one's reduced word, and (row, key) arrays of the
    rest of its neighbourhood, each key once a word."""
    rows, size = points.shape
    power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, PRIME))))[::-1]  # power[i] = PRIME ** (size - i)
    s = alphabets.reduced(points, size)
    whole = (s * power[1:]).sum(axis=1, dtype=np.uint64)
    out = []
    row = np.arange(rows)
    for i in range(size):
        for symbol in range(2, alphabets.symbols[size] + 1):
            some = row[s[:, i] < symbol]
            out.append((some, mixed(whole[some] + (np.uint64(symbol) - s[some, i]) * power[i + 1], size)))
    shorter = alphabets.reduced(points, size - 1)
    if shorter is not None:
        # Without the symbol at i: what stands before moves down one place. Of equal symbols in a row, the last goes.
        before, after = np.zeros(rows, np.uint64), (shorter * power[1:]).sum(axis=1, dtype=np.uint64)
        for i in range(size):
            after = after - shorter[:, i] * power[i + 1]
            some = row if i == size - 1 else row[shorter[:, i] != shorter[:, i + 1]]
            out.append((some, mixed((before + after)[some], size - 1)))
            if i < size - 1:
                before = before + shorter[:, i] * power[i + 2]
    return mixed(whole, size), out


def by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points (a matrix) of the words of each length, at most ROWS at a time."""
    texts = words.to_pylist()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for size in np.unique(lengths):
        places = np.flatnonzero(lengths == size)
        for a in range(0, len(places), ROWS):
            some = places[a : a + ROWS]
            yield some, np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le"), np.uint32).reshape(len(some), size)


def near_pairs(words: DataFrame, alphabets: Alphabets) -> DataFrame:
    """a, an, b, bn: each pair of words one edit apart, once; from a stored table of word, n."""

    def forms(neighbours: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for places, points in by_length(batch.column(0)):
                    own, others = keys_of(points, alphabets) if neighbours else (own_keys(points, alphabets), [])
                    at = np.concatenate([np.arange(len(places)), *(r for r, _ in others)])
                    keys = np.concatenate([own, *(k for _, k in others)])
                    picked = batch.take(pa.array(places[at]))
                    yield pa.RecordBatch.from_arrays([pa.array(keys), *picked.columns, pa.array(np.arange(len(at)) < len(places))], ["key", "word", "n", "own"])

        return run

    def own_keys(points: np.ndarray, alphabets: Alphabets) -> np.ndarray:
        size = points.shape[1]
        power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, PRIME))))[::-1]
        return mixed((alphabets.reduced(points, size) * power).sum(axis=1, dtype=np.uint64), size)

    schema = "key long, word string, n long, own boolean"
    left = words.mapInArrow(forms(True), schema).select("key", F.col("word").alias("a"), F.col("n").alias("an"), "own")
    right = words.mapInArrow(forms(False), schema).select("key", F.col("word").alias("b"), F.col("n").alias("bn"))
    # Words with one reduced word meet from both sides; those of unlike reduced words from one.
    met = left.join(right.hint("shuffle_hash"), "key").where("not own or a < b")
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "an", "b", "bn")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of each word that has a form (word, form): the last of its forms.

    Each round goes twice as far along; a form occurs many times as often as its word, so chains are short and rounds few.
    """
    held = common.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = held.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = common.stored(held.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        common.forget(held)
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        held = common.stored(longer.select("word", "root"), "roots")
        common.forget(longer)


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = 7, count: int = 2, times: int = 10, noise: int | None = 31) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary, by how often it occurs.

    Near words are one inserted, deleted or replaced character apart. form is the near word of greatest n (ties: least by
    code point) if that is at least `times` the word's n, else null, as is form_n; root is the last of the forms that
    follow one another, the word itself without any. Null and empty texts have no words, very long ones are read whole,
    repeated rows count each, documents without an id keep their runs whole, other columns are ignored, and an empty
    table gives an empty result.
    """
    words = common.stored(vocabulary(docs, id_col=id_col, text_col=text_col, least=least, count=count, noise=noise), "words")
    lengths = dict(words.groupBy(F.length("word")).count().collect())  # a row a length
    letters = dict(words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect())  # at most the letters of the pattern
    pairs = near_pairs(words, Alphabets(lengths, letters))
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("an").alias("n"), F.col("b").alias("near"), F.col("bn").alias("near_n")), F.struct(F.col("b").alias("word"), F.col("bn").alias("n"), F.col("a").alias("near"), F.col("an").alias("near_n")))
    both = pairs.select(F.inline(sides))
    every = both.unionByName(words.withColumns({"near": F.lit(None).cast("string"), "near_n": F.lit(None).cast("long")}))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))).alias("best")
    told = every.groupBy("word", "n").agg(F.count("near").alias("n_near"), best)
    is_form = -F.col("best.less") >= times * F.col("n")
    told = common.stored(told.select("word", "n", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "told")
    return told.join(roots(told.where("form is not null")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
