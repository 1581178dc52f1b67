"""Scoring documents with a gated recurrent language model trained on the corpus.

Word counts of all training documents are summed by word over the cluster. The most frequent words (a bounded
number: a word with 1/n of all tokens or more, of which there are n at most) go to every task; the counts of all
other words meet the documents in a join. One pass turns every text into token ids, which are stored; the model
starts from a bounded sample and then learns all tokens of all training documents in shards, whose weights are
averaged. Documents are dealt to shards by a hash of id and text, so scores don't depend on the layout of files.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficspark.llm import common, gated_lm
from trafficspark.llm.gated_lm import Shape

END = b""
#: Tokens that a task scores at a time, and those that a shard learns (about), in how many lanes.
BLOCK = 2_000_000
SHARD_TOKENS = 2_000_000
LANES = 256


def words_of(texts: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """Distinct words of UTF-8 texts (A-Z lower-cased, parted at ASCII white space), and for every word in turn its
    place among these and the number of its text. The empty string may be among the distinct words; none is counted."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.utf8())))
    coded = split.flatten().dictionary_encode()
    distinct, at = coded.dictionary.view(pa.binary()), coded.indices.to_numpy()
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(split).to_numpy())
    # White space before the first word and after the last leaves an empty string.
    empty = pc.index(distinct, pa.scalar(b"", pa.binary())).as_py()
    full = at != empty
    return distinct, at[full], owner[full]


def tail_class(word: Column, tails: int) -> Column:
    """A word's class by its last two bytes, as `bucket` has it."""
    return F.crc32(F.substring(word, -2, 2)) % tails


def bucket(word: bytes, shape: Shape) -> int:
    """A word's bucket: its tail class, and within that a hash of the whole word."""
    return zlib.crc32(word[-2:]) % shape.tails + shape.tails * (zlib.crc32(word) % (shape.buckets // shape.tails))


def word_counts(train: DataFrame) -> DataFrame:
    """word, c over all texts; the end of each text is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            distinct, at, _ = words_of(batch.column(0))
            c = np.bincount(at, minlength=len(distinct))
            words = pa.concat_arrays([distinct.filter(pa.array(c > 0)), pa.array([END], pa.binary())])
            yield pa.RecordBatch.from_arrays([words, pa.array(np.append(c[c > 0], batch.num_rows), pa.int64())], ["word", "c"])

    return train.select("bytes").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The frequent words with their counts; head words first, by falling count. The end is always a head word."""

    def __init__(self, shape: Shape, frequent: pd.DataFrame, tokens: int, words: int, tails: dict[int, tuple[int, int]]):
        """tails: for each tail class, tokens and distinct words of all training texts, head words included."""
        table = {bytes(w): int(c) for w, c in zip(frequent["word"], frequent["c"], strict=True)}
        end = table.pop(END, 0)
        order = [(END, end), *sorted(table.items(), key=lambda x: (-x[1], x[0]))]
        self.shape, self.place = shape, {w: i for i, (w, _) in enumerate(order)}
        self.counts = np.array([c for _, c in order], np.float64)
        self.all_mass = tokens + 0.1 * (words + 1)
        self.bucket = np.array([bucket(w, shape) for w, _ in order])
        # Smoothed counts of the words of each tail class that aren't head words, and of an unseen one.
        mass = np.full(shape.tails, 0.1)
        for k, (c, n) in tails.items():
            mass[k] += c + 0.1 * n
        for w, c in order[: shape.head]:
            if c:
                mass[zlib.crc32(w[-2:]) % shape.tails] -= c + 0.1
        self.tail_logs = np.log10(np.maximum(mass, 0.1))
        #: for each place: the model's token id, and what a token adds to the logs
        head = np.arange(len(order)) < shape.head
        self.ids = np.where(head, np.arange(len(order)), shape.head + self.bucket).astype(np.uint16)
        self.base = np.log10((self.counts + 0.1) / self.all_mass)
        self.inside = np.where(head, 0.0, np.log10(self.counts + 0.1) - self.tail_logs[self.bucket % shape.tails])

    def code(self, texts: pa.BinaryArray) -> list[pa.Array]:
        """For each text: the token ids of its words and its end, how many tokens, how many of its frequent words were
        counted, and the sums of base and inside logs; rare words with their numbers, for which these sums lack the logs
        of the smoothed count alone."""
        distinct, at, owner = words_of(texts)
        n, words = len(texts), distinct.to_pylist()
        places = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        rare = np.flatnonzero(places < 0)
        buckets = np.fromiter((bucket(words[i], self.shape) for i in rare.tolist()), np.int64, len(rare))
        of_word = {"ids": self.ids[places], "known": self.counts[places] > 0, "base": self.base[places], "inside": self.inside[places]}
        of_word["ids"][rare] = self.shape.head + buckets
        of_word["known"][rare] = False
        of_word["base"][rare] = -math.log10(self.all_mass)
        of_word["inside"][rare] = -self.tail_logs[buckets % self.shape.tails]
        summed = lambda name: np.bincount(owner, weights=of_word[name][at], minlength=n)
        sizes = np.bincount(owner, minlength=n) + 1
        # Each text's end comes after its words; its place is 0.
        ends = np.cumsum(sizes)
        ids = np.full(int(sizes.sum()), self.ids[0], np.uint16)
        ids[np.arange(len(at)) + owner] = of_word["ids"][at]
        offsets = np.concatenate(([0], 2 * ends)).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
        some = places[at] < 0
        pairs, times = np.unique(owner[some].astype(np.int64) * max(1, len(words)) + at[some], return_counts=True)
        entries = pa.StructArray.from_arrays([distinct.take(pa.array(pairs % max(1, len(words)))), pa.array(times, pa.int64())], ["word", "n"])
        lists = pa.array(np.searchsorted(pairs // max(1, len(words)), np.arange(n + 1)), pa.int32())
        known = summed("known").astype(np.int64) + int(self.counts[0] > 0)
        return [binary, pa.array(sizes, pa.int64()), pa.array(known), pa.array(summed("base") + self.base[0]), pa.array(summed("inside") + self.inside[0]), pa.ListArray.from_arrays(lists, entries)]


def averaged(rows: DataFrame) -> np.ndarray | None:
    """Mean of the weight vectors (weights binary, n long, shard long), by n; groups of shards are averaged on the cluster first."""

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        n = pdf["n"].to_numpy()
        total = sum(np.frombuffer(w, np.float32).astype(np.float64) * k for w, k in zip(pdf["weights"], n, strict=True))
        return pd.DataFrame({"weights": [(total / n.sum()).astype(np.float32).tobytes()], "n": [int(n.sum())], "shard": [int(pdf["shard"].iloc[0] // 16)]})

    while (shards := rows.count()) > 16:
        rows = common.stored(rows.groupBy(F.floor(F.col("shard") / 16).alias("g")).applyInPandas(mean, rows.schema), "weights")
    return np.frombuffer(mean(rows.toPandas())["weights"][0], np.float32) if shards else None


def fit(coded: DataFrame, shape: Shape, documents: int, tokens: int, *, sample_docs: int = 2000, passes: int = 3, rate: float = 0.01) -> dict[str, np.ndarray]:
    """Weights from mark (a hash), ids: first from about `sample_docs` documents, drawn by their marks, in one task;
    then shards of documents, dealt by their marks, learn every token of all of them, and their weights are averaged."""
    spark = coded.sparkSession

    def learned(shard: int, documents: list[np.ndarray], weights: dict[str, np.ndarray], rates: list[float], lanes: int) -> pa.RecordBatch:
        trainer = gated_lm.Trainer(shape, weights, rate, lanes=lanes)
        for trainer.rate in rates:
            trainer.learn(documents)
        return pa.RecordBatch.from_arrays([pa.array([gated_lm.flat(trainer.w).tobytes()], pa.binary()), pa.array([trainer.tokens], pa.int64()), pa.array([shard], pa.int64())], ["weights", "n", "shard"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = [np.frombuffer(ids, np.uint16) for batch in batches for ids in batch.column(1).to_pylist()]
        if documents:
            yield learned(0, documents, gated_lm.start(shape), [rate / (1 + i) for i in range(passes)], 64)

    parts = 1 << 20
    share = min(parts, math.ceil(parts * sample_docs / max(1, documents)))
    sample = coded.where(F.pmod(F.xxhash64("mark"), F.lit(parts)) < share).select("mark", "ids").repartition(1).sortWithinPartitions("mark", "ids")
    weights = averaged(common.stored(sample.mapInArrow(first, "weights binary, n long, shard long"), "weights"))
    if weights is None:
        return gated_lm.start(shape)
    begun = spark.sparkContext.broadcast(weights)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, documents, rates = None, [], [rate / (2 * passes)]
        for batch in batches:
            for one, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if one != shard:
                    if documents:
                        yield learned(shard, documents, gated_lm.unflat(shape, begun.value), rates, LANES)
                    shard, documents = one, []
                documents.append(np.frombuffer(ids, np.uint16))
        if documents:
            yield learned(shard, documents, gated_lm.unflat(shape, begun.value), rates, LANES)

    shards = max(1, round(tokens / SHARD_TOKENS))
    dealt = coded.select(F.pmod("mark", F.lit(shards)).alias("shard"), "ids", "mark").repartitionByRange(shards, "shard").sortWithinPartitions("shard", "mark", "ids")
    final = averaged(common.stored(dealt.select("shard", "ids").mapInArrow(go_on, "weights binary, n long, shard long"), "weights"))
    return gated_lm.unflat(shape, final)


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out_col: str = "held_out", shape: Shape = Shape(), frequent: int = 1_000_000, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Scores are log10 probabilities of whole texts: words (A-Z lower-cased, parted at ASCII white space), then one
    end. Rows with held_out false train the counts and the model, each text whole however long it is; null counts
    as false. base_score is the smoothed unigram model; score the recurrent one. A null or empty text is its end
    alone. Repeated rows are scored (and counted) each. Without training rows the counts are 0 and the model is
    untrained. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    whole = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(held_out_col), F.lit(False)).alias("held_out"), common.binary_large(F.col(text_col)).alias("bytes"))
    whole = whole.select("doc_id", "held_out", F.xxhash64("doc_id", "bytes").alias("mark"), "bytes")
    kind = whole.schema["doc_id"].dataType.simpleString()
    counts = common.stored(word_counts(whole.where("not held_out")), "words")
    by_tail = {r[0]: (r[1], r[2]) for r in counts.groupBy(tail_class(F.col("word"), shape.tails)).agg(F.sum("c"), F.count(F.lit(1))).collect()}
    tokens, words = (sum(t[i] for t in by_tail.values()) for i in (0, 1))
    often = counts.where((F.col("c") * frequent >= tokens) | (F.col("word") == F.lit(END)))
    vocabulary = Vocabulary(shape, often.toPandas(), tokens, words, by_tail)
    vocab = spark.sparkContext.broadcast(vocabulary)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        for batch in common.slices(batches, 2000):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *v.code(batch.column(3))], ["doc_id", "held_out", "mark", "ids", "n_tokens", "n_known", "base", "inside", "rare"])

    schema = f"doc_id {kind}, held_out boolean, mark long, ids binary, n_tokens long, n_known long, base double, inside double, rare array<struct<word:binary,n:bigint>>"
    coded = common.stored(whole.mapInArrow(code, schema).withColumn("row", F.monotonically_increasing_id()), "coded")
    # The end's count is the number of training documents.
    model = spark.sparkContext.broadcast(fit(coded.where("not held_out"), shape, int(vocabulary.counts[0]), tokens, **options))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            logs = gated_lm.score_documents(shape, model.value, [np.frombuffer(ids, np.uint16) for b in some for ids in b.column(0).to_pylist()], 0) / math.log(10)
            at = 0
            for b in some:
                yield pa.RecordBatch.from_arrays([pa.array(logs[at : at + b.num_rows]), *b.columns[1:]], ["logs", *b.schema.names[1:]])
                at += b.num_rows

        for batch in batches:
            held.append(batch)
            size += batch.column(0).nbytes // 2
            if size >= BLOCK:
                yield from out(held)
                held, size = [], 0
        if held:
            yield from out(held)

    scored = coded.select("ids", "doc_id", "held_out", "row", "n_tokens", "n_known", "base", "inside").mapInArrow(score, f"logs double, doc_id {kind}, held_out boolean, row long, n_tokens long, n_known long, base double, inside double")
    others = coded.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    met = others.join(counts.where(F.col("c") * frequent < tokens), "word", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    sums = met.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.1)).alias("more_logs"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"))
    more_logs = F.coalesce("more_logs", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more_logs).alias("base_score"),
        (F.col("logs") + F.col("inside") + more_logs).alias("score"),
    )
